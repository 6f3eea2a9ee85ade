"""Landed provider price files: one frame per file, its header and column types judged first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barledger import fixed_values as fv
from barledger.functions.values import missing_text_to_null, number_of_text, once
from barledger.operators.skew import HOT_ROWS, attach_by_key
from barledger.operators.audit import RAW_CELLS
from barledger.sources.lines import file_headers, number_lines, open_quote, read_lines, split_fields
from barledger.sources.scratch import written

DATE_LABEL = "Date"
LABELS = {**fv.PRICE_COLUMNS, fv.ADJUSTED_LABEL: "adj_close"}
CELLS = (DATE_LABEL, *LABELS)


def _places() -> Column:
    """Where a file has the columns of CELLS, -1 for one that it has not."""
    return F.transform(F.array(*map(F.lit, CELLS)), lambda label: F.array_position("raw_names", label).cast("int") - 1)


def _cells() -> Column:
    """Texts of the cells of CELLS of a line, null where the file has no such column or no value.

    One function over the places: as an expression each, the code is too large for the JVM to compile.
    """
    texts = F.transform("__places", lambda place: F.trim(F.get("values", place)))
    return F.transform(texts, missing_text_to_null)


def _time(text: Column) -> Column:
    return F.coalesce(text.try_cast("timestamp_ntz"), F.try_to_date(text, "dd-MM-yyyy").cast("timestamp_ntz"))


def scan_price_files(
    spark: SparkSession, directory: str, symbol: str = r"^(.*)\.csv$", *, pattern: str = "*.csv",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Raw frames of all files, ready for the audit, with the faults of each file in ``frame_errors``.

    ``symbol`` is matched against a file's name and its first group is the provider symbol; the
    run is the file's directory below the scanned one (the scanned one's own name for files in it).
    A repeated header, a row of more cells than the header or a line that ends inside quotes makes
    the columns ambiguous; otherwise a missing price column, or text in one, is the fault. Rows keep
    their position in their file and, in ``raw``, every cell with its column, type and text.
    """
    numbered = number_lines(read_lines(spark, directory, pattern), hot_rows=hot_rows)
    return frames_of_lines(numbered, _run(directory), symbol, hot_rows=hot_rows)


def frames_of_lines(
    numbered: DataFrame, run: Column, symbol: str = r"^(.*)\.csv$", *, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The same from numbered lines (file, name, row_position, line); ``run`` is an expression over the file.

    The lines and the headers are written once. Lines are brought to the header of their file, and what is wrong with any of
    them is gathered where they are together then; of hot files it is known beforehand.
    """
    numbered = written(numbered.select("file", "name", "row_position", "line"), "lines")
    headers = written(file_headers(numbered).select(
        "file", "raw_names", _places().alias("__places"), _header_faults().alias("__header"), F.col("rows").alias("__rows")
    ), "headers")
    rows = numbered.where(F.col("row_position") >= 0)
    hot = headers.where(F.col("__rows") > hot_rows).drop("__rows")
    faults = _read_cells(rows.join(F.broadcast(hot), "file")).groupBy("file").agg(F.bit_or("__fault").alias("__faults"))
    read = _read_cells(attach_by_key(rows, headers, ["file"], "__rows", hot_rows, salt="__salt"))
    together = Window.partitionBy("file", "__salt")
    gathered = read.withColumn("__gathered", F.bit_or("__fault").over(together))
    frames = gathered.join(F.broadcast(faults), "file", "left").select(
        "*", once(_frame_errors(F.coalesce("__faults", "__gathered"))).alias("frame_errors")
    )
    cell = _cell_of()
    return frames.select("*", F.transform("__cells", _number).alias("__numbers")).select(
        run.alias("run_id"),
        F.regexp_extract("name", symbol, 1).alias("symbol"),
        "row_position",
        _time(cell[DATE_LABEL]).alias("ts"),
        *[F.get("__numbers", F.lit(CELLS.index(label))).alias(column) for label, column in fv.PRICE_COLUMNS.items()],
        cell[fv.ADJUSTED_LABEL].alias("adj_close"),
        _raw_cells().alias(RAW_CELLS),
        "frame_errors",
    )


def _cell_of() -> dict[str, Column]:
    return {label: F.get("__cells", F.lit(i)) for i, label in enumerate(CELLS)}


# Faults of a line as bits of a number: more cells than the header or an open quote, a date that is none, and text in the
# price columns by their order. Those of a header: a name twice, a price column or the date missing.
UNFIT, UNDATED, TEXT = 1, 2, 4
TWICE, INCOMPLETE, DATELESS = 1, 2, 4


def _bits(found: Mapping[int, Column]) -> Column:
    bits = F.lit(0)
    for bit, here in found.items():
        bits = bits.bitwiseOR(F.when(here, F.lit(bit)).otherwise(F.lit(0)))
    return bits


def _header_faults() -> Column:
    required = F.array(*[F.lit(label) for label in fv.PRICE_COLUMNS])
    return _bits({
        TWICE: F.size(F.array_distinct("raw_names")) != F.size("raw_names"),
        INCOMPLETE: F.size(F.array_except(required, "raw_names")) > 0,
        DATELESS: ~F.array_contains("raw_names", DATE_LABEL),
    })


def _read_cells(named: DataFrame) -> DataFrame:
    """Lines with their header as fields (``values``), cells of CELLS and ``__fault``."""
    split = named.select("*", once(split_fields(F.col("line"))).alias("values"))
    read = split.select("*", once(_cells()).alias("__cells"))
    # A column with any cell that is neither a number nor missing is a text column of its file.
    is_text = lambda text: (
        text.isNotNull() & number_of_text(text).isNull() & ~F.lower(text).isin("inf", "-inf", "infinity", "-infinity")
    )
    tested = read.select("*", once(F.transform("__cells", is_text)).alias("__text"))
    date = _cell_of()[DATE_LABEL]
    fault = _bits({
        UNFIT: (F.size("values") > F.size("raw_names")) | open_quote(F.col("line")),
        UNDATED: date.isNotNull() & _time(date).isNull(),
        **{TEXT << i: F.get("__text", F.lit(CELLS.index(label))) for i, label in enumerate(fv.PRICE_COLUMNS)},
    })
    return tested.withColumn("__fault", fault).drop("line", "__text")


def _frame_errors(faults: Column) -> Column:
    """Faults of a file from those of its header and of its lines; null without a header."""

    def any_of(found: Column, bit: int) -> Column:
        return found.bitwiseAND(F.lit(bit)) != 0

    header = F.col("__header")
    repeated, incomplete = any_of(header, TWICE) | any_of(faults, UNFIT), any_of(header, INCOMPLETE)
    clear = ~repeated & ~incomplete
    errors = F.array_compact(F.array(
        F.when(repeated, F.lit("ambiguous_columns")),
        F.when(~repeated & incomplete, F.lit("missing_ohlcv_columns")),
        *[F.when(clear & any_of(faults, TEXT << i), F.lit("nonnumeric_column:" + label))
          for i, label in enumerate(fv.PRICE_COLUMNS)],
        F.when(any_of(header, DATELESS) | any_of(faults, UNDATED), F.lit("not_a_datetime_index")),
    ))
    return F.when(header.isNotNull(), errors)


def _run(directory: str) -> Column:
    """Directories of a file below the scanned one; the last one where that is a pattern or holds the file itself."""
    above = F.regexp_replace("file", "/[^/]*$", "")
    below = F.substring_index(above, f"{directory.rstrip('/').split(':', 1)[-1].lstrip('/')}/", -1)
    return F.when(below != above, below).otherwise(F.element_at(F.split(above, "/"), -1))


def _raw_cells() -> Column:
    """Every cell of a line as the file has it, those beyond the header under an empty label."""
    read = F.transform("values", lambda text: F.struct(
        text.alias("text"), F.trim(text).alias("cell"), _number(F.trim(text)).isNotNull().alias("number"),
    ))
    return F.transform(read, lambda one, i: F.struct(
        F.coalesce(F.get("raw_names", i), F.lit("")).alias("column"),
        F.when(missing_text_to_null(one["cell"]).isNull(), "null").when(one["number"], "double").otherwise("string").alias("type"),
        F.when(one["cell"] == "", "NULL").when(one["number"], one["cell"])
        .otherwise(F.concat(F.lit("'"), one["text"], F.lit("'"))).alias("repr"),
    ))


def _number(text: Column) -> Column:
    infinite = F.when(F.lower(text).rlike(r"^-?inf(inity)?$"), F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
    return F.coalesce(number_of_text(text), infinite)
