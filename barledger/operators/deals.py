"""Dated deal files: day spine, gaps, family ledger and totals."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from barledger import fixed_values as fv
from barledger.operators.ledger import until_first_stop
from barledger.operators.skew import HOT_ROWS


def check_request(kind: str, start: date, end: date) -> None:
    if kind not in fv.DEAL_KINDS:
        raise ValueError("Unknown deal kind")
    if start > end:
        raise ValueError("start_date must not exceed end_date")


def lookback(end: date) -> tuple[date, date]:
    """The default window: 90 days back, both ends included, so 91 days."""
    return end - timedelta(days=fv.DEAL_LOOKBACK_DAYS), end


def day_spine(windows: DataFrame) -> DataFrame:
    """Every day of each window of (…, start, end), both ends included."""
    return windows.select(
        *[name for name in windows.columns if name not in ("start", "end")],
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("day"),
    )


def day_gaps(spine: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Spine days nothing was returned for. They are unverified, not days without deals."""
    return spine.join(present.select(*keys).distinct(), keys, "left_anti").withColumn(
        "status", F.lit("unverified")
    )


def deals_ledger(windows: DataFrame, fetches: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per (run_id, kind, day) obligation, in the order bulk days then block days.

    ``windows`` is (run_id, start, end); ``fetches`` is (run_id, kind, day, status, header_ok,
    rows). A 404, or a day that nothing was recorded for, stays unverified and the run goes on; any
    other failed status and an unusable or empty payload block the source for all that follows.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(k).alias("kind"))
                                for i, k in enumerate(fv.DEAL_KINDS)]))
    span = F.datediff("end", "start") + 1
    families = windows.withColumn("__span", span).select("*", kinds.alias("__family")).select(
        "run_id", "start", "end", "__span", F.col("__family.kind").alias("kind"),
        F.col("__family.rank").alias("__rank"), F.col("start").alias("__first"),
    )
    obligations = day_spine(families).select(
        "run_id", "kind", "day",
        (F.col("__rank") * F.col("__span") + F.datediff("day", "__first")).cast("bigint").alias("ordinal"),
    )
    landed = fetches.withColumn("__landed", F.lit(True))
    known = obligations.join(landed, ["run_id", "kind", "day"], "left")
    answered = F.coalesce((F.col("status") == 200) & F.col("header_ok"), F.lit(False))
    absent = F.col("__landed").isNull() | F.coalesce(F.col("status") == 404, F.lit(False))
    ledger = until_first_stop(known, ~answered & ~absent, skip=F.lit(False), hot_rows=hot_rows)
    outcome = (
        F.when(~F.col("attempted"), F.lit("not_attempted"))
        .when(answered, F.lit("observed"))
        .when(absent, F.lit("unverified"))
        .otherwise(F.lit("source_blocked"))
    )
    return ledger.select(
        "run_id", "kind", "day", "ordinal", outcome.alias("outcome"),
        F.when(F.col("attempted") & answered, F.coalesce(F.col("rows"), F.lit(0))).otherwise(F.lit(0)).alias("rows"),
    )


def deals_coverage(ledger: DataFrame) -> DataFrame:
    """One row per run and family: complete and non-empty is success; anything less is not."""
    return ledger.groupBy("run_id", "kind").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("outcome") == "observed").alias("observed"),
        F.count_if(F.col("outcome") == "unverified").alias("unverified"),
        F.count_if(F.col("outcome") == "not_attempted").alias("not_attempted"),
        F.count_if(F.col("outcome") == "source_blocked").alias("blocked"),
        F.sum("rows").alias("rows"),
    ).withColumn("success", (F.col("observed") == F.col("days")) & (F.col("rows") > 0))


def quantity_by_symbol(deals: DataFrame) -> DataFrame:
    return deals.groupBy("symbol").agg(F.sum("quantity").alias("quantity"))


def top_quantities(deals: DataFrame, k: int = 10) -> DataFrame:
    """Most active symbols by total quantity; equal totals go by symbol."""
    return quantity_by_symbol(deals).orderBy(F.desc("quantity"), "symbol").limit(k)
