"""Partition provider price rows into accepted and rejected, and judge whole frames.

A frame is the set of rows of one ``(run_id, symbol)``. Nothing is repaired: every row is either
accepted or carries every reason it was rejected for, and one rejected row keeps the whole frame
out of the published table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barledger import fixed_values as fv
from barledger.functions.market import issuer_symbol
from barledger.functions.rules import reasons_of, reasons_text, row_rules
from barledger.functions.values import once, typed_cell
from barledger.operators.skew import HOT_ROWS, attach_by_key, row_counts, spread_of

FRAME_KEYS = ("run_id", "symbol")
# Cells of a landed row as its file had them: array of (column, type, repr).
RAW_CELLS = "raw"
# The window a row was asked for belongs to the request, not to the row.
REQUEST_COLUMNS = ("request_start", "request_end")
# Names of the counters of rows by reason.
REASON_COUNTS = {reason: f"rows_{position}" for position, reason in enumerate(fv.ALL_REASONS)}


def frame_schema_errors(schema: T.StructType, time: str, labels: Mapping[str, str]) -> list[str]:
    """Frame-level faults of a table, in reporting order; any of them rejects every row.

    ``labels`` maps the required labels to the column names that must carry them.
    """
    names = schema.names
    if len(set(names)) != len(names):
        errors = ["ambiguous_columns"]
    elif not set(labels.values()) <= set(names):
        errors = ["missing_ohlcv_columns"]
    else:
        errors = [
            "nonnumeric_column:" + label
            for label, name in labels.items()
            if not isinstance(schema[name].dataType, T.NumericType)
        ]
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if not any(field.name == time and isinstance(field.dataType, times) for field in schema):
        errors.append("not_a_datetime_index")
    return errors


def audit_rows(
    frames: DataFrame,
    start: date | Column,
    end: date | Column,
    *,
    keys: Sequence[str] = FRAME_KEYS,
    time: str = "ts",
    columns: Mapping[str, str] = fv.PRICE_COLUMNS,
    adjusted: str | None = "adj_close",
    frame_errors: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``session_date``, ``reasons`` and ``accepted`` to every row.

    ``start`` and ``end`` (exclusive) are dates or columns. ``frame_errors`` names an array column
    with faults found while landing the frame's file; they replace the row rules.

    A table that fails the schema gate cannot be judged cell by cell: all its rows are rejected
    for the gate's errors.
    """
    errors = frame_schema_errors(frames.schema, time, columns)
    if errors:
        return frames.withColumns({
            "session_date": F.lit(None).cast("date"),
            "reasons": F.array(*[F.lit(error) for error in errors]),
            "accepted": F.lit(False),
        })
    dated = frames.withColumn("session_date", F.to_date(time))
    day_keys = [*keys, "session_date"]
    if frame_errors is None:
        return _judge(_mark_repeated(dated, day_keys, hot_rows), frames.schema, start, end, columns, adjusted)
    # rows with faults of their frame are counted among its days, without their cells, and judged by the faults where they are
    faulty = F.coalesce(F.size(frame_errors) > 0, F.lit(False))
    counted = {*day_keys, frame_errors}
    slim = dated.select(*[name if name in counted else F.when(~faulty, F.col(name)).alias(name) for name in dated.columns])
    marked = _mark_repeated(slim, day_keys, hot_rows).where(~faulty)
    # no list, or one that a filter for faults can be seen to refuse
    none = F.when(F.col(frame_errors).isNotNull(), F.array().cast(frames.schema[frame_errors].dataType))
    judged = _judge(marked.withColumn(frame_errors, none), frames.schema, start, end, columns, adjusted)
    return judged.unionByName(
        dated.where(F.size(frame_errors) > 0).withColumns({"reasons": F.col(frame_errors), "accepted": F.lit(False)})
    )


def _judge(
    marked: DataFrame, schema: T.StructType, start: date | Column, end: date | Column, columns: Mapping[str, str],
    adjusted: str | None,
) -> DataFrame:
    """Add ``reasons`` and ``accepted`` by the row rules to dated rows whose repeated days are marked."""
    rules = row_rules(
        schema, columns, adjusted, F.col("session_date"), _column(start), _column(end), F.col("__repeated"),
    )
    # One evaluation per row: filters on the result are not pushed below it as copies of the rules.
    judged = marked.select("*", once(reasons_text(rules)).alias("__text"))
    text = F.col("__text")
    return judged.withColumns({"reasons": reasons_of(text), "accepted": text == ""}).drop("__repeated", "__text")


def _mark_repeated(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Add ``__repeated``: whether another row has the same keys, none of them null.

    Rows are counted where those of their keys are together, which they may be already. Those of hot keys, few by counting,
    are known beforehand; they and rows without their whole key go to that place under a key of their own.
    """
    hot = row_counts(rows.dropna(subset=list(keys)), keys, "__rows").where((F.col("__rows") > 1) & (F.col("__rows") > hot_rows))
    on_hot = [f"__key_{name}" for name in keys]
    named = hot.select(*[F.col(name).alias(alias) for name, alias in zip(keys, on_hot)], F.lit(True).alias("__hot"))
    known = rows.join(F.broadcast(named), [F.col(name) == F.col(alias) for name, alias in zip(keys, on_hot)], "left").drop(*on_hot)
    alone = F.col("__hot").isNotNull()
    for name in keys:
        alone = alone | F.col(name).isNull()
    salted = known.withColumn("__salt", F.when(alone, spread_of(rows)).otherwise(F.lit(0)))
    together = Window.partitionBy(*keys, "__salt")
    repeated = F.col("__hot").isNotNull() | ((F.col("__salt") == 0) & (F.count(F.lit(1)).over(together) > 1))
    return salted.select(*rows.columns, repeated.alias("__repeated"))


def _column(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def with_faults(frame_errors: str = "frame_errors") -> Column:
    """Whether a row's frame has faults: its list is more than the empty one, which the planner knows of rows that have none."""
    return F.col(frame_errors) > F.array().cast("array<string>")


def rejected_rows(
    audited: DataFrame, *, keys: Sequence[str] = FRAME_KEYS, time: str = "ts",
    cells: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rejected rows as evidence: position, date, reasons and every cell with its type and text.

    Cells that a file landed with (``raw``) are given as they were. Otherwise they are the columns
    of the table: the labelled ones first, then every other one under its own name, a repeated
    name as often as it occurs. A time column that holds no times gives no date.
    """
    own = {*keys, "row_position", "reasons", "accepted", "session_date", "frame_errors", RAW_CELLS}
    fields = audited.schema.fields
    unique = [f"__cell_{i}" if audited.columns.count(f.name) > 1 else f.name for i, f in enumerate(fields)]
    rows = audited.toDF(*unique) if unique != audited.columns else audited
    labels = dict(cells or {**fv.PRICE_COLUMNS, fv.ADJUSTED_LABEL: "adj_close"})
    of = {name: label for label, name in labels.items()}
    places = sorted(
        (i for i, f in enumerate(fields) if f.name in of or (f.name not in own and f.name != time and cells is None
                                                             and f.name not in REQUEST_COLUMNS)),
        key=lambda i: (list(of).index(fields[i].name) if fields[i].name in of else len(of), i),
    )
    typed = [typed_cell(of.get(fields[i].name, fields[i].name), F.col(f"`{unique[i]}`"), fields[i].dataType) for i in places]
    given = F.array(*typed) if typed else F.array().cast("array<struct<column:string,type:string,repr:string>>")
    if RAW_CELLS in audited.columns:
        given = F.coalesce(RAW_CELLS, given)
    at = next((i for i, f in enumerate(fields) if f.name == time), None)
    dtype = T.StringType() if at is None else fields[at].dataType
    stamp = F.lit(None).cast("string") if at is None else F.col(f"`{unique[at]}`")
    dated = isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
    index = typed_cell("", stamp, dtype)
    return rows.where(~F.col("accepted")).select(
        *keys,
        "row_position",
        (F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss") if dated else F.lit(None).cast("string")).alias("date"),
        F.struct(index.getField("type").alias("type"), index.getField("repr").alias("repr")).alias("index"),
        "reasons",
        given.alias("cells"),
    )


def rejection_counts(audited: DataFrame) -> DataFrame:
    """Rejected rows per reason over the whole table."""
    return (
        audited.where(~F.col("accepted"))
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def frame_verdicts(audited: DataFrame, *, keys: Sequence[str] = FRAME_KEYS) -> DataFrame:
    """One row per frame: row counts, counts per reason, and whether the frame is admitted.

    The reasons are a fixed vocabulary, so each is one counter of a single aggregation whose
    partial results are combined in every task before the shuffle.
    """
    reasons = F.col("reasons")
    counted = audited.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frame_rows"),
        F.count_if(F.col("accepted")).alias("usable_rows"),
        F.count_if(~F.col("accepted") & ~numeric_only(reasons)).alias("other_rows"),
        *[F.count_if(F.array_contains(reasons, reason)).alias(name) for reason, name in REASON_COUNTS.items()],
    )
    return verdicts_of_counts(counted, keys=keys)


def frame_admissions(
    frames: DataFrame,
    start: date | Column,
    end: date | Column,
    *,
    keys: Sequence[str] = FRAME_KEYS,
    time: str = "ts",
    columns: Mapping[str, str] = fv.PRICE_COLUMNS,
    adjusted: str | None = "adj_close",
) -> DataFrame:
    """Row counts, ``passed`` and ``category`` of ``frame_verdicts`` over audited rows, without moving a row.

    Only the duplicate-day rule looks beyond a row. All dated rows of a day with several are rejected for it, so rows are
    judged by the other rules where they are read and counted per day, and days are counted per frame.
    """
    counts = ("frame_rows", "usable_rows", "rejected_rows", "passed", "category")
    if frame_schema_errors(frames.schema, time, columns):
        audited = audit_rows(frames, start, end, keys=keys, time=time, columns=columns, adjusted=adjusted)
        return frame_verdicts(audited, keys=keys).select(*keys, *counts)
    rules = row_rules(frames.schema, columns, adjusted, F.col("session_date"), _column(start), _column(end), F.lit(False))
    judged = frames.withColumn("session_date", F.to_date(time)).select(
        *keys, "session_date", once(reasons_text(rules)).alias("__text")
    )
    accepted = F.col("__text") == ""
    other = F.when(accepted, F.lit(False)).otherwise(~numeric_only(reasons_of(F.col("__text"))))
    days = judged.groupBy(*keys, "session_date").agg(
        F.count(F.lit(1)).alias("__rows"), F.count_if(accepted).alias("__usable"), F.count_if(other).alias("__other")
    )
    rows, repeated = F.col("__rows"), F.col("__rows") > 1
    # as in audit_rows, a row without its whole key repeats no other
    for name in (*keys, "session_date"):
        repeated = repeated & F.col(name).isNotNull()
    counted = days.groupBy(*keys).agg(
        F.sum(rows).alias("frame_rows"),
        F.sum(F.when(repeated, F.lit(0)).otherwise(F.col("__usable"))).alias("usable_rows"),
        F.sum(F.when(repeated, rows).otherwise(F.col("__other"))).alias("other_rows"),
    )
    # the rules of rows give no reason that is a frame's
    none = {name: F.lit(0).cast("bigint") for name in REASON_COUNTS.values()}
    return verdicts_of_counts(counted.withColumns(none), keys=keys).select(*keys, *counts)


def numeric_only(reasons: Column) -> Column:
    """Whether all reasons are about a row's numbers."""
    return F.size(F.array_except(reasons, F.array(*[F.lit(r) for r in fv.NUMERIC_REASONS]))) == 0


def verdicts_of_counts(counted: DataFrame, *, keys: Sequence[str] = FRAME_KEYS) -> DataFrame:
    """The same from counts that were kept: frame_rows, usable_rows, other_rows and REASON_COUNTS of each frame.

    ``other_rows`` are rejected rows with a reason that is not about their numbers.
    """
    counter_of = {reason: F.col(name) for reason, name in REASON_COUNTS.items()}
    frame_errors = F.array_compact(
        F.array(*[F.when(counter_of[reason] > 0, F.lit(reason)) for reason in fv.FRAME_REASONS])
    )
    counts = F.map_from_entries(
        F.array_compact(
            F.array(*[
                F.when(counter > 0, F.struct(F.lit(reason).alias("key"), counter.alias("value")))
                for reason, counter in counter_of.items()
            ])
        )
    )
    rejected = F.col("frame_rows") - F.col("usable_rows")
    row_quality = (F.size("frame_errors") == 0) & (F.col("usable_rows") > 0) & (F.col("other_rows") == 0)
    return (
        counted.withColumn("rejected_rows", rejected)
        .withColumn("frame_errors", frame_errors)
        .withColumn(
            "passed", (F.col("usable_rows") > 0) & (F.col("rejected_rows") == 0) & (F.size("frame_errors") == 0)
        )
        .withColumn(
            "category",
            F.when(F.col("passed"), F.lit(fv.ADMITTED))
            .when(row_quality, F.lit(fv.ROW_QUALITY_REJECTED))
            .otherwise(F.lit(fv.UNVERIFIED_RESPONSE)),
        )
        .withColumn("rejection_counts", counts)
        .select(
            *keys, "frame_rows", "usable_rows", "rejected_rows", "frame_errors", "passed", "category",
            "rejection_counts",
        )
    )


def requested_verdicts(
    requested: DataFrame, verdicts: DataFrame, *, keys: Sequence[str] = FRAME_KEYS, no_table: DataFrame | None = None,
) -> DataFrame:
    """Verdicts over the whole request: a frame without rows is an ``empty_frame``, not absent.

    ``no_table`` has the keys of requests whose answer was no table at all, such as a failed fetch; without rows they are
    ``not_a_dataframe``. A key may be there several times.
    """
    if no_table is not None:
        marked = no_table.select(*keys).distinct().withColumn("__no_table", F.lit(True))
        requested = requested.join(marked, list(keys), "left")
    bare = F.coalesce(F.col("__no_table"), F.lit(False)) if no_table is not None else F.lit(False)
    rows = F.coalesce(F.col("frame_rows"), F.lit(0))
    joined = requested.join(verdicts, list(keys), "left")
    empty = F.col("frame_rows").isNull()
    judged = joined.withColumns({
        "frame_errors": F.when(empty & bare, F.array(F.lit(fv.NO_TABLE))).when(empty, F.array(F.lit(fv.EMPTY_FRAME))).otherwise(
            F.col("frame_errors")
        ),
        "passed": F.coalesce(F.col("passed"), F.lit(False)),
        "category": F.coalesce(F.col("category"), F.lit(fv.UNVERIFIED_RESPONSE)),
        "frame_rows": rows,
        "usable_rows": F.coalesce(F.col("usable_rows"), F.lit(0)),
        "rejected_rows": F.coalesce(F.col("rejected_rows"), F.lit(0)),
    })
    return judged.drop("__no_table")


def admitted_rows(
    audited: DataFrame, verdicts: DataFrame, *, keys: Sequence[str] = FRAME_KEYS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of admitted frames only; the usable rows of a rejected frame stay diagnostic."""
    admitted = verdicts.where(F.col("passed")).select(*keys, "frame_rows", F.lit(True).alias("__admitted"))
    usable = audited.where(F.col("accepted"))
    return attach_by_key(usable, admitted, keys, "frame_rows", hot_rows).where(F.col("__admitted")).drop("__admitted")


def rows_of_admitted(
    frames: DataFrame, admissions: DataFrame, *, keys: Sequence[str] = FRAME_KEYS, time: str = "ts", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The same from rows that were not audited: an admitted frame has no rejected row, so all its rows are usable."""
    admitted = admissions.where(F.col("passed")).select(*keys, "frame_rows", F.lit(True).alias("__admitted"))
    dated = frames.withColumn("session_date", F.to_date(time))
    return attach_by_key(dated, admitted, keys, "frame_rows", hot_rows).where(F.col("__admitted")).drop("__admitted")


def published_prices(
    admitted: DataFrame, *, provider_version: str, retrieved_at_utc: str, symbol: str = "symbol",
) -> DataFrame:
    """Admitted rows in the published column order, each with its provenance.

    ``symbol`` holds the provider symbol. Order by symbol and date belongs to the sink, see
    ``sources.tables.save_prices``.
    """
    return admitted.select(
        F.date_format("session_date", "yyyy-MM-dd").alias("date"),
        "open", "high", "low", "close",
        *(["adj_close"] if "adj_close" in admitted.columns else []),
        "volume",
        issuer_symbol(F.col(symbol)).alias("symbol"),
        F.lit(fv.PRICE_SOURCE).alias("source"),
        F.col(symbol).alias("provider_symbol"),
        F.lit(provider_version).alias("provider_version"),
        F.lit(fv.PRICE_BASIS).alias("price_basis"),
        F.lit(retrieved_at_utc).alias("retrieved_at_utc"),
    )


def usable_positions(
    audited: DataFrame, *, keys: Sequence[str] = FRAME_KEYS, block: int = 4096,
) -> DataFrame:
    """Accepted row positions of each frame as ordered lists, one list per block of positions.

    Where positions are unique in a frame a list holds at most ``block`` of them, however large the
    frame; a repeated position is listed as often as it occurs. The lists in block order are the
    frame's whole list, so their sizes sum to its usable rows.
    """
    return (
        audited.where(F.col("accepted"))
        .withColumn("block", F.floor(F.col("row_position") / block))
        .groupBy(*keys, "block")
        .agg(F.sort_array(F.collect_list("row_position")).alias("positions"))
    )
