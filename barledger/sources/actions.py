"""Corporate actions from HTML tables."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

import barledger
from barledger.fixed_values import MISSING_ACTION_VALUE

ACTION_FIELDS = ("symbol", "type", "ex_date", "value")
HIDDEN_TEXT = ("script", "style", "template")

# The parser travels with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(barledger)


class _Tables(HTMLParser):
    """Collect the rows of every table as they open and close.

    An end tag closes everything opened since its own start tag, and an end tag without a start
    tag is ignored. A row belongs to every open table, a cell to every open row, and text to
    every open cell, so nested tables are seen from the outside as well.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list | None]] = []
        self.tables: list[list[list[list[str]]]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        held: list | None = None
        if tag == "table":
            held = []
            self.tables.append(held)
        elif tag == "tr":
            held = []
            self._give("table", held)
        elif tag == "td":
            held = []
            self._give("tr", held)
        self.open.append((tag, held))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                return

    def handle_data(self, data: str) -> None:
        if not any(tag in HIDDEN_TEXT for tag, _ in self.open):
            self._give("td", data)

    def _give(self, parent: str, item: object) -> None:
        for tag, held in self.open:
            if tag == parent and held is not None:
                held.append(item)


# --- fixed values: elements that have no content and no end tag ---
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)


class _VoidAware(_Tables):
    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in VOID_TAGS:
            super().handle_starttag(tag, attrs)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in VOID_TAGS:
            super().handle_startendtag(tag, attrs)


def actions_of(html: str) -> list[tuple[str, str, str, str]]:
    """Rows of three or more cells of every table, the first row of each table left out."""
    parser = _VoidAware()
    parser.feed(html)
    parser.close()
    found = []
    for rows in parser.tables:
        for cells in rows[1:]:
            if len(cells) >= 3:
                text = ["".join(cell).strip() for cell in cells[:4]]
                found.append(tuple(text + [MISSING_ACTION_VALUE] * (4 - len(text))))
    return found


def extract_actions(pages: DataFrame, key: str, *, html: str = "html") -> DataFrame:
    """All corporate actions of all pages: (key, symbol, type, ex_date, value) as text.

    Pages without a table are dropped on the JVM; only the others reach the Python workers, in
    Arrow batches.
    """
    key_type = pages.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, " + ", ".join(f"{name} string" for name in ACTION_FIELDS)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, columns = [], [[] for _ in ACTION_FIELDS]
            for page_key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for action in actions_of(text.as_py()):
                    keys.append(page_key)
                    for column, value in zip(columns, action):
                        column.append(value)
            arrays = [pa.array(keys, type=batch.column(0).type)] + [pa.array(c, type=pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, *ACTION_FIELDS])

    with_tables = pages.where(F.lower(html).contains("<table")).select(key, html)
    return with_tables.mapInArrow(parse, schema)


def with_ex_day(actions: DataFrame) -> DataFrame:
    """Add ``ex_day``, the ISO date in ``ex_date``; other text has no day."""
    return actions.withColumn("ex_day", F.try_to_date("ex_date", "yyyy-MM-dd"))
