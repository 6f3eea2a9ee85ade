"""Coverage ledgers: every requested identity is accounted for, whether attempted or not.

A collector works through its request in ``ordinal`` order and stops at the first fault it may
not pass. Here the stop is computed: one aggregation finds each run's first stopping ordinal,
and every request is compared with it. There is no window over a whole run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from barledger import fixed_values as fv
from barledger.functions.market import day_of_instant
from barledger.operators.skew import HOT_ROWS, attach_by_key


def until_first_stop(requests: DataFrame, stops: Column, *, skip: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``stop_ordinal``, ``attempted`` and ``is_stop`` to requests of (run_id, ordinal).

    ``skip`` marks requests that are never attempted and never stop a run. A run may hold most of
    all requests, so the per-run stop comes back through ``attach_by_key``.
    """
    marked = requests.withColumn("__skip", skip).withColumn("__stops", stops & ~F.col("__skip"))
    per_run = marked.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.min(F.when(F.col("__stops"), F.col("ordinal"))).alias("stop_ordinal"),
    )
    reached = F.col("stop_ordinal").isNull() | (F.col("ordinal") <= F.col("stop_ordinal"))
    return (
        attach_by_key(marked, per_run, ["run_id"], "__rows", hot_rows)
        .withColumn("attempted", ~F.col("__skip") & reached)
        .withColumn("is_stop", F.col("__stops") & (F.col("ordinal") == F.col("stop_ordinal")))
        .drop("__skip", "__stops")
    )


FRAME_COUNTS = ("frame_rows", "usable_rows", "rejected_rows")
FAULTS = ("tls_error", "client_error", "exhausted")


def fetch_faults(fetches: DataFrame) -> DataFrame:
    """(run_id, symbol, fault) of fetches (run_id, symbol, outcome); a denial outranks any other fault."""
    kind = F.when(F.col("outcome") == "denied", F.lit(fv.DENIED)).when(
        F.col("outcome").isin(*FAULTS), F.lit(fv.PROCESSING_ERROR)
    )
    denied = F.max(F.col("fault") == fv.DENIED)
    return fetches.select("run_id", "symbol", kind.alias("fault")).where(F.col("fault").isNotNull()).groupBy(
        "run_id", "symbol"
    ).agg(F.when(denied, F.lit(fv.DENIED)).otherwise(F.lit(fv.PROCESSING_ERROR)).alias("fault"))


def frame_outcomes(verdicts: DataFrame, fetches: DataFrame) -> DataFrame:
    """Outcome of each frame that was answered or asked for: (run_id, symbol, category, row counts).

    ``fetches`` is (run_id, symbol, outcome), the classes of ``functions.market.fetch_outcome``. A
    denial outranks any other fault, and a fault outranks the verdict: what came before it is no
    response. Attempts that were received or are worth another one say nothing.
    """
    joined = verdicts.join(fetch_faults(fetches), ["run_id", "symbol"], "full_outer")
    answered = F.col("fault").isNull()
    return joined.select(
        "run_id", "symbol", F.coalesce("fault", "category").alias("category"),
        *[F.when(answered, F.col(name)).alias(name) for name in FRAME_COUNTS],
    )


def price_ledger(
    requested: DataFrame, outcomes: DataFrame, *, continue_after_row_rejection: bool = False,
    defer_archival_prices: bool = True, carry: tuple[str, ...] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Long-form price ledger: one row per requested (run_id, ordinal, symbol).

    ``requested`` has a boolean ``deferred`` column, which counts unless ``defer_archival_prices``
    is off. ``outcomes`` is (run_id, symbol, category) and the columns to ``carry``, which are null
    for requests that were not attempted; a request without an outcome is an unverified response.
    """
    for name, flag in (
        ("continue_after_row_rejection", continue_after_row_rejection), ("defer_archival_prices", defer_archival_prices),
    ):
        if not isinstance(flag, bool):
            raise TypeError(f"{name} must be a bool")
    if not defer_archival_prices:
        requested = requested.withColumn("deferred", F.lit(False))
    joined = requested.join(outcomes.select("run_id", "symbol", "category", *carry), ["run_id", "symbol"], "left")
    known = joined.withColumn("category", F.coalesce(F.col("category"), F.lit(fv.UNVERIFIED_RESPONSE)))
    passable = [fv.ADMITTED] + ([fv.ROW_QUALITY_REJECTED] if continue_after_row_rejection else [])
    ledger = until_first_stop(
        known, ~F.col("category").isin(*passable), skip=F.col("deferred"), hot_rows=hot_rows
    )
    observed = F.when(F.col("deferred"), F.lit(fv.DEFERRED_STATUS)).when(F.col("attempted"), F.col("category"))
    return ledger.select(
        *requested.columns,
        observed.alias("category"),
        "attempted",
        (F.col("attempted") & (F.col("category") == fv.ADMITTED)).alias("returned"),
        (~F.col("attempted") & ~F.col("deferred")).alias("pending_provider"),
        (F.col("attempted") & (F.col("category") == fv.ROW_QUALITY_REJECTED)).alias("row_quality_rejected"),
        "is_stop",
        *[F.when(F.col("attempted"), F.col(name)).alias(name) for name in carry],
    )


def run_coverage(ledger: DataFrame, *, sums: tuple[str, ...] = ()) -> DataFrame:
    """One row per run over the full requested denominator.

    ``success`` needs every requested identity returned. A run without a stop reason only went
    through its list; it is not thereby complete. A denial raises in the collector. ``sums`` are
    further columns to add up. All of it is one aggregation: a run has one stop at most.
    """
    counted = ledger.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("deferred")).alias("deferred"),
        F.count_if(~F.col("deferred")).alias("provider_candidates"),
        F.count_if(F.col("attempted")).alias("attempted"),
        F.count_if(~F.col("attempted")).alias("not_attempted"),
        F.count_if(F.col("returned")).alias("returned"),
        F.count_if(~F.col("returned")).alias("not_returned"),
        F.count_if(F.col("pending_provider")).alias("pending_provider"),
        F.count_if(F.col("row_quality_rejected")).alias("row_quality_rejected"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
        F.max(F.when(F.col("is_stop"), F.struct("symbol", "category"))).alias("__stop"),
    )
    stopped = counted.withColumns({
        "stop_symbol": F.col("__stop.symbol"), "stop_category": F.col("__stop.category"),
    }).drop("__stop")
    return stopped.withColumns({
        "raised": F.coalesce(F.col("stop_category") == fv.DENIED, F.lit(False)),
        "success": (F.col("returned") > 0) & (F.col("not_returned") == 0),
        "historical_completeness": F.lit(fv.NOT_VERIFIED),
    })


def ordered_symbols(ledger: DataFrame, flag: str, *, block: int = 1000) -> DataFrame:
    """The run's symbols with ``flag`` as ordered lists, one per block of request ordinals.

    Ordinals are unique in a run, so a list never exceeds ``block`` symbols however long the
    request; the lists in block order are the run's whole list.
    """
    return (
        ledger.where(F.col(flag))
        .withColumn("block", F.floor(F.col("ordinal") / block))
        .groupBy("run_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "symbol"))).alias("__ordered"))
        .select("run_id", "block", F.col("__ordered.symbol").alias("symbols"))
    )


def snapshot_ledger(
    requested: DataFrame, outcomes: DataFrame, fetches: DataFrame | None = None, *, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fundamentals ledger: deferred identities are skipped, the first failed one stops the run.

    ``outcomes`` is (run_id, symbol, accepted) and, if given, the ``fault`` of a document that was
    not; ``fetches`` is (run_id, symbol, outcome), whose faults outrank it. No outcome is a failure.
    """
    fault = F.col("fault") if "fault" in outcomes.columns else F.lit(None).cast("string")
    given = outcomes.select("run_id", "symbol", "accepted", fault.alias("__fault"))
    joined = requested.join(given, ["run_id", "symbol"], "left")
    if fetches is None:
        joined = joined.withColumn("fault", F.lit(None).cast("string"))
    else:
        joined = joined.join(fetch_faults(fetches), ["run_id", "symbol"], "left")
    accepted = F.coalesce(F.col("accepted"), F.lit(False)) & F.col("fault").isNull()
    known = joined.withColumn("accepted", accepted).withColumn(
        "reason", F.when(~F.col("accepted"), F.coalesce("fault", "__fault", F.lit(fv.UNVERIFIED_RESPONSE)))
    )
    ledger = until_first_stop(known, ~F.col("accepted"), skip=F.col("deferred"), hot_rows=hot_rows)
    return ledger.select(
        *requested.columns, "attempted", (F.col("attempted") & F.col("accepted")).alias("returned"),
        F.when(F.col("attempted"), F.col("reason")).alias("reason"), "is_stop",
    )


def snapshot_coverage(ledger: DataFrame, retrieved_at: Column) -> DataFrame:
    """One row per run; the snapshot day is the exchange's local day of the retrieval instant."""
    counted = ledger.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("deferred")).alias("deferred"),
        F.count_if(F.col("returned")).alias("returned"),
        F.count_if(~F.col("returned")).alias("not_returned"),
        F.max(F.when(F.col("is_stop"), F.struct("symbol", "reason"))).alias("__stop"),
    )
    stopped = counted.withColumns({
        "stop_symbol": F.col("__stop.symbol"), "stop_reason": F.col("__stop.reason"),
    }).drop("__stop")
    return stopped.withColumns({
        "raised": F.coalesce(F.col("stop_reason") == fv.DENIED, F.lit(False)),
        "success": (F.col("returned") > 0) & (F.col("not_returned") == 0),
        "snapshot_as_of_date_ist": day_of_instant(retrieved_at),
        "historical_completeness": F.lit(fv.NOT_VERIFIED),
    })


def archival_plan(requested: DataFrame, worklist: DataFrame) -> DataFrame:
    """Counts of the persisted plan, one row per run; a plan downloads nothing."""
    work = worklist.groupBy("run_id").agg(F.count(F.lit(1)).alias("archival_requests"))
    return (
        requested.groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("original_requested"))
        .join(work, "run_id", "left")
        .withColumn("archival_requests", F.coalesce(F.col("archival_requests"), F.lit(0)))
        .withColumns({
            "provider_candidates": F.col("original_requested") - F.col("archival_requests"),
            "kind": F.lit("outstanding_price_archival_work_not_market_data"),
            "historical_completeness": F.lit(fv.NOT_VERIFIED),
            "downloaded_rows": F.lit(0),
        })
    )


def unplanned_coverage(requested: DataFrame, worklist: DataFrame) -> DataFrame:
    """Coverage of runs whose plan was not persisted: they stop before any lookup and defer nothing.

    Runs without archival work need no plan, go on and are not in the result.
    """
    plan = archival_plan(requested, worklist).where("archival_requests > 0")
    zero = F.lit(0).cast("bigint")
    return plan.select(
        "run_id", F.col("original_requested").alias("requested"), zero.alias("deferred"), "provider_candidates",
        zero.alias("attempted"), F.col("original_requested").alias("not_attempted"), zero.alias("returned"),
        F.col("original_requested").alias("not_returned"), F.col("provider_candidates").alias("pending_provider"),
        zero.alias("row_quality_rejected"), F.lit(None).cast("string").alias("stop_symbol"),
        F.lit(fv.PLAN_NOT_PERSISTED).alias("stop_category"), F.lit(True).alias("raised"), F.lit(False).alias("success"),
        F.lit(fv.NOT_VERIFIED).alias("historical_completeness"),
    )


def coverage_documents(coverages: Mapping[str, DataFrame], *, part: str = "kind") -> DataFrame:
    """(run_id, task, coverage, complete): coverage of different kinds, each row of a task's frame as one document.

    ``coverages`` maps a task to its coverage by run. The frames share ``run_id`` and ``success`` only, so the rest of a row
    becomes a VARIANT. A frame with a ``part`` column has several rows for a run, one for each part; their documents are
    fields of one, in which every part must have succeeded. The parts of a run are a fixed few.
    """
    found = None
    for task, coverage in coverages.items():
        content = F.struct(*[name for name in coverage.columns if name not in ("run_id", part)])
        if part in coverage.columns:
            # a map of parsed documents is a document too
            entries = F.sort_array(F.collect_list(F.struct(F.col(part), F.to_json(content, {"ignoreNullFields": "false"}).alias("text"))))
            merged = F.concat(
                F.lit("{"),
                F.array_join(F.transform(entries, lambda e: F.concat(F.lit('"'), e[part], F.lit('":'), e["text"])), ","),
                F.lit("}"),
            )
            one = coverage.groupBy("run_id").agg(
                F.parse_json(merged).alias("coverage"), F.bool_and("success").alias("complete")
            )
        else:
            one = coverage.select("run_id", F.to_variant_object(content).alias("coverage"), F.col("success").alias("complete"))
        one = one.withColumn("task", F.lit(task)).select("run_id", "task", "coverage", "complete")
        found = one if found is None else found.unionByName(one)
    return found


def task_statuses(tasks: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Status of each task of (run_id, task, succeeded, error, seconds): an error outranks the flag.

    With ``documents``, as coverage_documents makes them, a task carries its coverage, and the coverage says whether it
    succeeded: a task with one has returned all that was requested, or it failed. One without keeps its flag.
    """
    succeeded = F.coalesce(F.col("succeeded"), F.lit(False))
    if documents is not None:
        tasks = tasks.join(documents, ["run_id", "task"], "left")
        succeeded = F.coalesce("complete", succeeded)
    judged = tasks.withColumn(
        "status",
        F.when(F.col("error").isNotNull(), F.lit("ERROR"))
        .when(succeeded, F.lit("SUCCESS"))
        .otherwise(F.lit("FAILED")),
    ).withColumn("seconds", F.when(F.col("status") == "ERROR", F.lit(0)).otherwise(F.col("seconds")))
    return judged.drop("complete")


def run_summary(statuses: DataFrame) -> DataFrame:
    """One row per run: tasks succeeded and not, total time, and whether all succeeded."""
    succeeded = F.col("status") == "SUCCESS"
    return statuses.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.count_if(succeeded).alias("successful"),
        F.count_if(~succeeded).alias("failed"),
        F.sum("seconds").alias("total_seconds"),
    ).withColumns({
        "all_tasks_success": F.col("failed") == 0,
        "historical_completeness": F.lit(fv.NOT_VERIFIED),
    })


def history_audit(ledger: DataFrame) -> DataFrame:
    """One row per run: its coverage with the row accounting of the frames it attempted.

    ``ledger`` carries FRAME_COUNTS. Success is the collector's: the whole denominator returned.
    """
    return run_coverage(ledger, sums=FRAME_COUNTS).withColumn(
        "kind", F.lit("bounded_historical_diagnostic_not_full_production")
    )
