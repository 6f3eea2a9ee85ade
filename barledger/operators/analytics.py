"""Reports over the admitted tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from barledger.functions.values import nan_to_null
from barledger.operators.scans import ranked

BILLION = 10**9


def price_change(prices: DataFrame, *, price: str = "close", order: str = "date") -> DataFrame:
    """Percent change from a symbol's first to its last close, one aggregation for all symbols.

    A missing first or last close makes the change missing: the aggregates keep a null at the
    extreme date.
    """
    value = nan_to_null(F.col(price), prices.schema[price].dataType).cast("double")
    ends = prices.groupBy("symbol").agg(
        F.min_by(value, order).alias("first_close"), F.max_by(value, order).alias("last_close")
    )
    change = F.try_divide(F.col("last_close") - F.col("first_close"), F.col("first_close")) * 100
    return ends.withColumn("change_pct", change)


def first_symbols(prices: DataFrame, ordinal: str, k: int = 5) -> DataFrame:
    """The first ``k`` symbols in order of appearance, where ``ordinal`` records that order."""
    return prices.groupBy("symbol").agg(F.min(ordinal).alias("first_ordinal")).orderBy("first_ordinal", "symbol").limit(k)


def summary_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Long-form summary of the tables that are present: (section, metric, value) as text.

    ``bhavcopy`` reports records, symbols and date range; every other table its records.
    """
    parts = []
    for section, table in tables.items():
        if section == "bhavcopy":
            facts = table.agg(
                F.count(F.lit(1)).alias("records"),
                F.count_distinct("symbol").alias("symbols"),
                F.min("date").alias("first_date"),
                F.max("date").alias("last_date"),
            )
        else:
            facts = table.agg(F.count(F.lit(1)).alias("records"))
        text = facts.select([F.col(name).cast("string").alias(name) for name in facts.columns])
        parts.append(
            text.unpivot([], text.columns, "metric", "value").select(F.lit(section).alias("section"), "metric", "value")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def moving_average(
    prices: DataFrame, rows: int, *, price: str = "close", keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("date",), name: str | None = None,
) -> DataFrame:
    """Mean of the last ``rows`` prices of a key, missing until the span is full of present values.

    For daily bars: a key has at most one bar per calendar day, which bounds its group. Tables
    without such a bound use :func:`moving_average_split`.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    mean = _span_mean(F.col(price), prices.schema[price].dataType, by_key, rows)
    return prices.withColumn(name or f"ma_{rows}", mean)


def _span_mean(value: Column, dtype: T.DataType, by_key: Window, rows: int) -> Column:
    present = nan_to_null(value, dtype)
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        # Exact types: the span's sum is the difference of two running sums, so a row costs the
        # same however long the span is.
        running = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)

        def span(column: Column) -> Column:
            upto = F.sum(column).over(running)
            return upto - F.coalesce(F.lag(upto, rows).over(by_key), F.lit(0))

        total = span(F.coalesce(present, F.lit(0)))
        counted = span(present.isNotNull().cast("bigint"))
        return F.when(counted == rows, total.cast("double") / rows)
    last = by_key.rowsBetween(1 - rows, Window.currentRow)
    return F.when(F.count(present).over(last) == rows, F.avg(present).over(last))


def moving_average_split(
    prices: DataFrame, rows: int, *, price: str = "close", keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("date",), name: str | None = None, block: int = 100_000,
) -> DataFrame:
    """:func:`moving_average` for keys of any size: a key's rows are split over many tasks.

    Rows are ranked through the whole table by ranges, so even one key and one day may hold all of them, then cut into
    blocks of ``block`` rows. The last ``rows - 1`` rows of a block are also sent to the next one, so every block sees the
    full span of each of its own rows and the result is exact.
    """
    if rows - 1 > block:
        raise ValueError("block must hold the span")
    numbered = ranked(prices, list(keys), list(order), "__number").withColumn("__block", F.floor(F.col("__number") / block))
    is_tail = (F.col("__number") % block) > block - rows
    homes = F.when(is_tail, F.array(F.col("__block"), F.col("__block") + 1)).otherwise(F.array(F.col("__block")))
    spread = numbered.withColumn("__home", F.explode(homes))
    by_block = Window.partitionBy(*keys, "__home").orderBy("__number")
    mean = _span_mean(F.col(price), prices.schema[price].dataType, by_block, rows)
    result = name or f"ma_{rows}"
    return spread.withColumn(result, mean).where(F.col("__home") == F.col("__block")).select(*prices.columns, result)


def top_by(table: DataFrame, measure: str, k: int, *, tie: Sequence[str] = ("symbol",), largest: bool = True) -> DataFrame:
    """The ``k`` largest (or smallest) rows by a measure; missing measures rank last, ties by ``tie``."""
    value = nan_to_null(F.col(measure), table.schema[measure].dataType)
    ranked = F.desc_nulls_last(value) if largest else F.asc_nulls_last(value)
    return table.orderBy(ranked, *tie).limit(k)


def top_market_cap(snapshots: DataFrame, k: int = 5) -> DataFrame:
    """Largest companies, with the cap in billions."""
    return top_by(snapshots, "market_cap", k).select(
        "symbol", "market_cap", (F.col("market_cap") / BILLION).alias("market_cap_billions")
    )


def lowest_ratio(snapshots: DataFrame, k: int = 5) -> DataFrame:
    """Smallest present price-to-earnings ratios."""
    ratio = nan_to_null(F.col("pe_ratio"), snapshots.schema["pe_ratio"].dataType)
    return top_by(snapshots.where(ratio.isNotNull()), "pe_ratio", k, largest=False).select(
        "symbol", "pe_ratio", "dividend_yield"
    )


def top_per_group(
    table: DataFrame, group: Sequence[str], measure: str, k: int, *, tie: Sequence[str] = ("symbol",),
) -> DataFrame:
    """The ``k`` largest rows of every group. Ranks up to ``k`` are kept in each task before the
    shuffle, so a large group sends at most ``k`` rows per task."""
    value = nan_to_null(F.col(measure), table.schema[measure].dataType)
    place = Window.partitionBy(*group).orderBy(F.desc_nulls_last(value), *tie)
    return table.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
