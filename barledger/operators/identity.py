"""Requested identities: universe checks, deny list and effective-dated deferrals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barledger import fixed_values as fv
from barledger.functions.market import is_valid_symbol
from barledger.operators.skew import HOT_ROWS, attach_by_key, row_counts

POLICY_SCHEMA = (
    "symbol string, effective_date date, policy_id string, reason string, evidence_urls array<string>"
)


def snapshot_policies(spark: SparkSession) -> DataFrame:
    rows = [(p["symbol"], p["effective_date"], None, p["reason"], [p["evidence_url"]]) for p in fv.SNAPSHOT_POLICIES]
    return spark.createDataFrame(rows, POLICY_SCHEMA)


def price_policies(spark: SparkSession, observation_url: str | None = None) -> DataFrame:
    """``observation_url`` is the caller's own record of the reviewed run, kept as evidence."""
    extra = [observation_url] if observation_url else []
    rows = [
        (p["symbol"], p["effective_date"], p["policy_id"], p["reason"], p["evidence_urls"] + extra)
        for p in fv.PRICE_POLICIES
    ]
    return spark.createDataFrame(rows, POLICY_SCHEMA)


def known_typos(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fv.KNOWN_TYPOS.items()), "symbol string, use_instead string")


def check_universe(requested: DataFrame, typos: DataFrame, *, run: Sequence[str] = ("run_id",)) -> DataFrame:
    """One row per requested identity with its faults, in order; no fault means it may be requested.

    Identities are rejected, never rewritten: the deny list only names what to ask for instead.
    """
    keys = [*run, "symbol"]
    counted = requested.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    denied = typos.select("symbol", "use_instead")
    faults = F.array_compact(
        F.array(
            F.when(~is_valid_symbol(F.col("symbol")), F.lit("invalid_symbol")),
            F.when(F.col("times") > 1, F.lit("repeated_symbol")),
            F.when(F.col("use_instead").isNotNull(), F.lit("known_typo")),
        )
    )
    return counted.join(denied, "symbol", "left").select(*keys, "times", faults.alias("faults"), "use_instead")


def assert_universe(requested: DataFrame, typos: DataFrame, *, run: Sequence[str] = ("run_id",)) -> None:
    """Raise when the request is empty or any identity in it has a fault."""
    checked = check_universe(requested, typos, run=run)
    totals = checked.agg(
        F.count(F.lit(1)).alias("identities"), F.count_if(F.size("faults") > 0).alias("faulty")
    ).first()
    if totals["identities"] == 0:
        raise ValueError("Empty request")
    if totals["faulty"]:
        raise ValueError(f"{totals['faulty']} requested identities are repeated, malformed or known typos")


def timelines(policies: DataFrame) -> DataFrame:
    """One row per symbol: its policies as an array in order of their dates. A symbol has few, however often it is asked for."""
    facts = [name for name in policies.columns if name not in ("symbol", "effective_date")]
    return policies.where(F.col("effective_date").isNotNull()).groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("effective_date", *facts))).alias("__periods")
    )


def defer_by_policy(
    requested: DataFrame, policies: DataFrame, as_of: date | Column, *, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Requests with the policy of the exact symbol in force on ``as_of``: the last one effective by then.

    An identity without a policy stays undeferred and is not certified by that. No successor symbol is ever substituted.
    A symbol repeats over all runs, so its timeline comes to its requests through ``attach_by_key``.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    asked = requested.withColumn("__as_of", day)
    known = timelines(policies).join(row_counts(asked, ["symbol"], "__asked"), "symbol")
    found = attach_by_key(asked, known, ["symbol"], "__asked", hot_rows)
    by_then = F.filter("__periods", lambda period: period["effective_date"] <= F.col("__as_of"))
    period = F.try_element_at(by_then, F.lit(-1))
    names = ["effective_date", *[name for name in policies.columns if name not in ("symbol", "effective_date")]]
    return found.withColumn("__period", period).select(
        *requested.columns, *[F.col(f"__period.{name}").alias(name) for name in names],
        F.col("__period").isNotNull().alias("deferred"),
    )


def snapshot_deferrals(requested: DataFrame, policies: DataFrame, as_of: date | Column) -> DataFrame:
    """Requests with their current-snapshot deferral; a deferred obligation stays outstanding."""
    deferred = defer_by_policy(requested, policies, as_of)
    return deferred.select(
        *requested.columns,
        "deferred",
        F.when(F.col("deferred"), F.lit(fv.DEFERRED_STATUS)).alias("status"),
        "reason",
        "effective_date",
        "evidence_urls",
        F.when(F.col("deferred"), F.lit(True)).alias("historical_obligation_preserved"),
        F.lit(None).cast("string").alias("replacement_symbol"),
    )


def archival_worklist(
    requested: DataFrame, policies: DataFrame, as_of: date | Column, start: date | Column, end: date | Column,
) -> DataFrame:
    """Outstanding archival work: one item per deferred request, its interval never clipped.

    An empty or reversed interval of literal dates is an error.
    """
    if isinstance(start, date) and isinstance(end, date) and start >= end:
        raise ValueError("Start must precede exclusive end date")
    deferred = defer_by_policy(requested, policies, as_of).where(F.col("deferred"))
    begin = start if isinstance(start, Column) else F.lit(start)
    until = end if isinstance(end, Column) else F.lit(end)
    missing = F.lit(None).cast("string")
    return deferred.select(
        *[name for name in requested.columns if name != "symbol"],
        "policy_id",
        F.lit(fv.DEFERRED_STATUS).alias("status"),
        F.col("symbol").alias("provider_symbol"),
        F.lit(fv.PRICE_SOURCE).alias("source_adapter"),
        F.lit("daily_ohlcv").alias("data_family"),
        "reason",
        F.date_format(begin, "yyyy-MM-dd").alias("requested_start"),
        F.date_format(until, "yyyy-MM-dd").alias("requested_end_exclusive"),
        F.date_format("effective_date", "yyyy-MM-dd").alias("reviewed_on"),
        "evidence_urls",
        F.lit(True).alias("historical_obligation_preserved"),
        F.lit(fv.NOT_VERIFIED).alias("historical_completeness"),
        missing.alias("replacement_symbol"),
        missing.alias("last_trading_date"),
        missing.alias("archive_source"),
        F.lit(fv.ARCHIVE_FETCH_STATUS).alias("archive_fetch_status"),
    )


def provider_candidates(requested: DataFrame, worklist: DataFrame, *, run: Sequence[str] = ("run_id",)) -> DataFrame:
    """Requested identities without an archival work item."""
    deferred = worklist.select(*run, F.col("provider_symbol").alias("symbol"))
    return requested.join(deferred, [*run, "symbol"], "left_anti")
