"""Registered queries: each runs one operator, or a chain of them, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barledger import fixed_values as fv
from barledger.functions.market import fetch_outcome, is_valid_window, issuer_symbol, local_midnight_epoch
from barledger.operators import analytics, artifacts, audit, deals, identity, ledger, quality, reconcile
from barledger.operators.scans import ranked
from barledger.plans import views
from barledger.sources import actions, charts, deals as deal_files, evidence, listings, prices, snapshots, tables, worklists
from barledger.sources.scratch import shared_folder, written

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

VERSION = "1"
RETRIEVED = "2026-09-22T04:30:00+00:00"


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def joined(values: str) -> F.Column:
    return F.concat_ws(",", values)


# --- analytics -----------------------------------------------------------------------------------


@query
def price_change(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.price_change(views.bars(spark, sf))


@query
def first_symbols(spark: SparkSession, sf: str) -> DataFrame:
    trades = views.table(spark, sf, "lineitem").select(
        views.provider_symbol(F.col("l_suppkey")).alias("symbol"), "l_orderkey"
    )
    return analytics.first_symbols(trades, "l_orderkey")


@query
def summary_report(spark: SparkSession, sf: str) -> DataFrame:
    deal_rows = views.deals(spark, sf)
    return analytics.summary_report({
        "bhavcopy": views.bars(spark, sf),
        "fundamentals": views.table(spark, sf, "customer"),
        "bulk_deals": deal_rows.where(F.col("kind") == "bulk"),
        "block_deals": deal_rows.where(F.col("kind") == "block"),
        "corporate_actions": views.table(spark, sf, "orders"),
    })


def _moving_average(spark: SparkSession, sf: str, rows: int) -> DataFrame:
    averaged = analytics.moving_average(views.bars(spark, sf), rows, price="close_cents", name="mean_cents")
    return averaged.select("symbol", "date", "close", (F.col("mean_cents") / 100).alias("average"))


@query
def moving_average_50(spark: SparkSession, sf: str) -> DataFrame:
    return _moving_average(spark, sf, 50)


@query
def moving_average_200(spark: SparkSession, sf: str) -> DataFrame:
    return _moving_average(spark, sf, 200)


@query
def moving_average_200_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Over single trades, whose number per symbol has no bound: split by block of rows."""
    trades = views.table(spark, sf, "lineitem").select(
        "l_suppkey", views.day(F.col("l_shipdate")).alias("day"), "l_orderkey", "l_linenumber", "l_partkey",
        views.cents(F.col("l_extendedprice")).alias("cents"), "l_quantity",
    )
    order = ("day", "l_orderkey", "l_linenumber", "l_partkey", "cents", "l_quantity")
    averaged = analytics.moving_average_split(
        trades, 200, price="cents", keys=("l_suppkey",), order=order, name="mean_cents",
    )
    return averaged.select(
        views.provider_symbol(F.col("l_suppkey")).alias("symbol"), "day", "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("mean_cents") / 100).alias("average"),
    )


@query
def sorted_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Every bar with its place in the order of the published table."""
    bars = views.bars(spark, sf).select("symbol", "date", "close")
    return ranked(bars, [], ["symbol", "date"], "place")


@query
def top_market_cap(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.top_market_cap(views.snapshots(spark, sf))


@query
def lowest_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.lowest_ratio(views.snapshots(spark, sf))


@query
def deal_quantity(spark: SparkSession, sf: str) -> DataFrame:
    return deals.quantity_by_symbol(views.deals(spark, sf))


@query
def top_deal_quantity(spark: SparkSession, sf: str) -> DataFrame:
    return deals.top_quantities(views.deals(spark, sf).where(F.col("kind") == "bulk"))


@query
def topk_per_group(spark: SparkSession, sf: str) -> DataFrame:
    deal_rows = views.table(spark, sf, "lineitem").select(
        views.provider_symbol(F.col("l_suppkey")).alias("symbol"), F.col("l_extendedprice").alias("price"),
        "l_orderkey", "l_linenumber",
    )
    top = analytics.top_per_group(deal_rows, ["symbol"], "price", 3, tie=("l_orderkey", "l_linenumber"))
    return top.select("symbol", "price", "l_orderkey", F.col("rank").cast("bigint").alias("rank"))


# --- audit ---------------------------------------------------------------------------------------


def _audited(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_rows(views.raw_frames(spark, sf), F.col("request_start"), F.col("request_end"))


def _admissions(spark: SparkSession, sf: str) -> DataFrame:
    return audit.frame_admissions(views.raw_frames(spark, sf), F.col("request_start"), F.col("request_end"))


@query
def audit_reasons(spark: SparkSession, sf: str) -> DataFrame:
    rejected = _audited(spark, sf).where(~F.col("accepted"))
    return rejected.select("run_id", "symbol", "row_position", joined("reasons").alias("reasons"))


@query
def audit_partition(spark: SparkSession, sf: str) -> DataFrame:
    return _audited(spark, sf).select(
        "run_id", "symbol", "row_position", "session_date", "accepted", joined("reasons").alias("reasons")
    )


@query
def duplicate_dates(spark: SparkSession, sf: str) -> DataFrame:
    repeated = _audited(spark, sf).where(F.array_contains("reasons", "duplicate_date"))
    return repeated.select("run_id", "symbol", "session_date", "row_position")


@query
def rejection_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.rejection_counts(_audited(spark, sf))


@query
def typed_cells(spark: SparkSession, sf: str) -> DataFrame:
    rejected = audit.rejected_rows(_audited(spark, sf))
    return rejected.select("run_id", "symbol", "row_position", "date", F.explode("cells").alias("cell")).select(
        "run_id", "symbol", "row_position", "date", F.col("cell.column").alias("field"),
        F.col("cell.type").alias("type"), F.col("cell.repr").alias("text"),
    )


@query
def frame_admission(spark: SparkSession, sf: str) -> DataFrame:
    return _admissions(spark, sf).select("run_id", "symbol", "frame_rows", "usable_rows", "rejected_rows", "passed")


@query
def failure_kind(spark: SparkSession, sf: str) -> DataFrame:
    """Over the whole request: frames nothing came back for are judged too."""
    verdicts = audit.requested_verdicts(
        views.requests(spark, sf).select("run_id", "symbol"), audit.frame_verdicts(_audited(spark, sf)),
        no_table=views.tableless(spark, sf),
    )
    return verdicts.select("run_id", "symbol", "category", joined("frame_errors").alias("frame_errors"))


@query
def evidence_manifest(spark: SparkSession, sf: str) -> DataFrame:
    counts = F.transform(
        F.sort_array(F.map_entries("rejection_counts")),
        lambda entry: F.concat(entry["key"], F.lit("="), entry["value"].cast("string")),
    )
    rejected = audit.frame_verdicts(_audited(spark, sf)).where(~F.col("passed"))
    return rejected.select(
        "run_id", "symbol", "frame_rows", "usable_rows", "rejected_rows",
        F.concat_ws(",", counts).alias("rejection_counts"), F.lit(fv.NOT_VERIFIED).alias("historical_completeness"),
    )


@query
def usable_positions(spark: SparkSession, sf: str) -> DataFrame:
    blocks = audit.usable_positions(_audited(spark, sf))
    text = F.concat_ws(",", F.transform("positions", lambda position: position.cast("string")))
    return blocks.select("run_id", "symbol", "block", text.alias("positions"))


@query
def admitted_prices(spark: SparkSession, sf: str) -> DataFrame:
    admitted = audit.rows_of_admitted(views.raw_frames(spark, sf), _admissions(spark, sf))
    return audit.published_prices(admitted, provider_version=VERSION, retrieved_at_utc=RETRIEVED)


# --- table quality ---------------------------------------------------------------------------------


@query
def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.raw_frames(spark, sf).select("symbol", "adj_close", "volume", "request_start")
    return quality.clean_rows(rows)


@query
def validate_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.raw_frames(spark, sf).select("symbol", "ts", "open", "volume", "adj_close")
    return quality.validate_table(rows)


@query
def standardize_columns(spark: SparkSession, sf: str) -> DataFrame:
    provider = views.bars(spark, sf).select(
        F.col("date").alias("Date"), F.col("open").alias("Open"), F.col("close").alias("Close"),
        F.col("volume").alias("Volume"), F.col("symbol").alias("Symbol"),
    )
    return quality.standardize_columns(provider, fv.PUBLISHED_COLUMNS)


@query
def deals_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.deals(spark, sf)
    bulk = rows.where(F.col("kind") == "bulk").drop("client")
    block = rows.where(F.col("kind") == "block").drop("price")
    return quality.append_tables(bulk, block)


# --- identity and ledgers ----------------------------------------------------------------------------


@query
def universe_check(spark: SparkSession, sf: str) -> DataFrame:
    symbol = views.provider_symbol(F.col("o_custkey"), "C")
    odd = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    requested = views.table(spark, sf, "orders").select(
        views.month(F.col("o_orderdate")).alias("run_id"),
        F.when(odd, F.lower(symbol)).otherwise(symbol).alias("symbol"),
    )
    typos = views.table(spark, sf, "nation").select(
        views.provider_symbol(F.col("n_nationkey"), "C").alias("symbol"), F.col("n_name").alias("use_instead")
    )
    checked = identity.check_universe(requested, typos)
    return checked.select("run_id", "symbol", "times", joined("faults").alias("faults"), "use_instead")


@query
def snapshot_deferral(spark: SparkSession, sf: str) -> DataFrame:
    found = identity.snapshot_deferrals(views.requests(spark, sf), views.policies(spark, sf), F.col("start"))
    return found.select(
        "run_id", "symbol", "deferred", "status", "reason", "effective_date",
        joined("evidence_urls").alias("evidence_urls"), "replacement_symbol",
    )


def _worklist(spark: SparkSession, sf: str) -> DataFrame:
    return identity.archival_worklist(
        views.requests(spark, sf), views.policies(spark, sf), F.col("start"), F.col("start"), F.col("end")
    )


@query
def archival_worklist(spark: SparkSession, sf: str) -> DataFrame:
    return _worklist(spark, sf).select(
        "run_id", "policy_id", "status", "provider_symbol", "source_adapter", "data_family", "reason",
        "requested_start", "requested_end_exclusive", "reviewed_on", joined("evidence_urls").alias("evidence_urls"),
        "historical_obligation_preserved", "historical_completeness", "replacement_symbol", "last_trading_date",
        "archive_source", "archive_fetch_status",
    )


@query
def archival_plan(spark: SparkSession, sf: str) -> DataFrame:
    plan = ledger.archival_plan(views.requests(spark, sf), _worklist(spark, sf))
    return plan.withColumn("downloaded_rows", F.col("downloaded_rows").cast("bigint"))


@query
def provider_candidates(spark: SparkSession, sf: str) -> DataFrame:
    requested = views.requests(spark, sf).select("run_id", "ordinal", "symbol")
    return identity.provider_candidates(requested, _worklist(spark, sf))


PLAN = {"run_attempt": "1", "commit_sha": "c0ffee", "planned_at_utc": RETRIEVED}


def _written_plan(spark: SparkSession, sf: str) -> str:
    root = shared_folder(spark, "plan")
    return worklists.plan_or_stop(views.requests(spark, sf).select("run_id", "ordinal", "symbol"), _worklist(spark, sf), root, PLAN)


@query
def persisted_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a plan that was written and committed, with what its manifest says of their run."""
    rows, manifest = worklists.read_plan(spark, _written_plan(spark, sf))
    return rows.join(manifest, "run_id").select(
        "run_id", "ordinal", "provider_symbol", "policy_id", "requested_start", "requested_end_exclusive",
        "archival_requests", "original_requested", manifest["provider_candidates"], manifest["kind"], "planned_at_utc",
    )


@query
def planned_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The price ledger of runs that defer what their committed plan holds, and nothing else."""
    requested = views.requests(spark, sf).select("run_id", "ordinal", "symbol")
    return worklists.planned_ledger(
        requested, _price_outcomes(spark, sf), _written_plan(spark, sf), continue_after_row_rejection=True
    )


@query
def unplanned_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage of the runs if their plan could not be written."""
    return ledger.unplanned_coverage(views.requests(spark, sf), _worklist(spark, sf))


def _price_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    outcome = fetch_outcome(F.col("status"), F.col("error_kind"), F.col("attempt")).alias("outcome")
    return ledger.frame_outcomes(_admissions(spark, sf), views.price_fetches(spark, sf).select("run_id", "symbol", outcome))


def _price_ledger(spark: SparkSession, sf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    requested = identity.defer_by_policy(views.requests(spark, sf), views.policies(spark, sf), F.col("start"))
    return ledger.price_ledger(
        requested.select("run_id", "ordinal", "symbol", "deferred"), _price_outcomes(spark, sf),
        continue_after_row_rejection=True, carry=carry,
    )


@query
def price_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return _price_ledger(spark, sf)


@query
def price_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.run_coverage(_price_ledger(spark, sf))


@query
def returned_symbols(spark: SparkSession, sf: str) -> DataFrame:
    rows = ledger.ordered_symbols(_price_ledger(spark, sf), "returned")
    return rows.select("run_id", "block", joined("symbols").alias("symbols"))


@query
def history_audit(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.history_audit(_price_ledger(spark, sf, ledger.FRAME_COUNTS)).select(
        "run_id", "kind", "requested", "attempted", "returned", "not_returned", "stop_symbol", "stop_category",
        "frame_rows", "usable_rows", "rejected_rows", "success",
    )


def _gated(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.snapshot_gate(snapshots.parse_snapshots(views.snapshot_documents(spark, sf)))


@query
def fundamentals_coverage(spark: SparkSession, sf: str) -> DataFrame:
    gated = _gated(spark, sf)
    outcomes = gated.select("run_id", "symbol", F.col("fault").isNull().alias("accepted"), "fault")
    customers = views.table(spark, sf, "customer")
    requested = customers.select(
        F.col("c_nationkey").cast("string").alias("run_id"), F.col("c_custkey").alias("ordinal"),
        views.provider_symbol(F.col("c_custkey"), "C").alias("symbol"),
    )
    merged = customers.where(F.col("c_acctbal") < -900).select(
        views.provider_symbol(F.col("c_custkey"), "C").alias("symbol"),
        F.lit("2023-07-01").cast("date").alias("effective_date"),
    )
    deferred = identity.defer_by_policy(requested, merged, F.lit("2023-07-01").cast("date"))
    outcome = fetch_outcome(F.col("status"), F.col("error_kind"), F.col("attempt")).alias("outcome")
    fetches = views.snapshot_fetches(spark, sf).select("run_id", "symbol", outcome)
    rows = ledger.snapshot_ledger(deferred.select("run_id", "ordinal", "symbol", "deferred"), outcomes, fetches)
    return ledger.snapshot_coverage(rows, F.lit("2026-09-21 20:00:00+00:00").cast("timestamp"))


def _task_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks of users' runs by their flags; price, fundamentals and deal tasks by the coverage attached to them."""
    coverages = {
        "prices": price_coverage(spark, sf), "fundamentals": fundamentals_coverage(spark, sf),
        "deals": deals_coverage(spark, sf),
    }
    seconds = F.col("seconds").cast("decimal(18,2)").alias("seconds")
    tasks = views.run_tasks(spark, sf).select("run_id", "task", "succeeded", "error", seconds)
    for task, coverage in coverages.items():
        raised = F.when(F.col("raised"), F.lit("denied")) if "raised" in coverage.columns else F.lit(None).cast("string")
        size = F.col("requested" if "requested" in coverage.columns else "days")
        one = coverage.select("run_id", raised.alias("error"), size.alias("size")).groupBy("run_id").agg(
            F.max("error").alias("error"), (F.sum("size") / 100).alias("seconds")
        )
        tasks = tasks.unionByName(one.select(
            "run_id", F.lit(task).alias("task"), F.lit(None).cast("boolean").alias("succeeded"), "error", seconds
        ))
    return ledger.task_statuses(tasks, ledger.coverage_documents(coverages))


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.run_summary(_task_statuses(spark, sf)).withColumn(
        "total_seconds", F.col("total_seconds").cast("double")
    )


@query
def task_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Each task with its coverage as a document."""
    return _task_statuses(spark, sf).select(
        "run_id", "task", "status", F.col("seconds").cast("double").alias("seconds"), F.to_json("coverage").alias("coverage")
    )


# --- deals -------------------------------------------------------------------------------------------


@query
def deal_day_gaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.deals(spark, sf)
    windows = rows.groupBy("symbol").agg(F.min("deal_date").alias("start"), F.max("deal_date").alias("end"))
    present = rows.select("symbol", F.col("deal_date").alias("day"))
    return deals.day_gaps(deals.day_spine(windows), present, ["symbol", "day"])


@query
def deals_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return deals.deals_ledger(views.deal_windows(spark, sf), views.deal_fetches(spark, sf))


@query
def deals_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return deals.deals_coverage(deals_ledger(spark, sf))


@query
def fetch_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    event = views.event_number(spark, sf)
    error = F.when(F.col("event_type") == "signup", F.when(F.col("k") < 30, F.lit("tls")).when(F.col("k") < 60, F.lit("timeout")))
    status = (
        F.when(error.isNotNull(), F.lit(None))
        .when(F.col("event_type") == "error", F.lit(400) + F.col("k"))
        .when((F.col("event_type") == "click") & (F.col("k") < 20), F.lit(503))
        .otherwise(F.lit(200))
    )
    attempt = F.when(F.col("value") < 50, 1).when(F.col("value") < 100, 2).otherwise(3)
    return event.select("event_id", fetch_outcome(status, error, attempt).alias("outcome"))


# --- documents -----------------------------------------------------------------------------------------


@query
def listing_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return listings.flatten_listings(views.listing_documents(spark, sf))


@query
def action_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = listings.count_actions(views.action_documents(spark, sf))
    return counted.withColumn("actions", F.col("actions").cast("bigint"))


@query
def html_actions(spark: SparkSession, sf: str) -> DataFrame:
    found = actions.with_ex_day(actions.extract_actions(views.action_pages(spark, sf), "page_id"))
    return found.select("page_id", "symbol", "type", "ex_date", "value", "ex_day")


@query
def payload_shape(spark: SparkSession, sf: str) -> DataFrame:
    parsed = snapshots.parse_snapshots(views.snapshot_documents(spark, sf).drop("run_id", "ordinal"))
    shape = snapshots.response_shape(parsed)
    return shape.withColumn("fields", joined("fields")).withColumn("field_count", F.col("field_count").cast("bigint"))


@query
def fundamentals_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _gated(spark, sf).select("symbol", "fault")


@query
def fundamentals_table(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.snapshot_table(_gated(spark, sf), provider_version=VERSION, retrieved_at_utc=RETRIEVED)


@query
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "documents").select(
        "doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("bytes")
    )


@query
def checksum_verification(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of one source were never stored, those of another never recorded, and those
    with a toxic label were changed after they were recorded."""
    text = views.table(spark, sf, "documents")
    toxic = views.table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id").distinct()
    changed = text.join(toxic.withColumn("changed", F.lit(True)), "doc_id", "left")
    stored = F.when(F.col("changed"), F.concat("text", F.lit("!"))).otherwise(F.col("text"))

    def digests(rows: DataFrame, content: F.Column) -> DataFrame:
        return rows.select(
            F.col("doc_id").alias("file"), F.sha2(content, 256).alias("sha256"), F.octet_length(content).alias("bytes")
        )

    recorded = digests(text.where(F.col("source") != "src1"), F.col("text"))
    actual = digests(changed.where(F.col("source") != "src0"), stored)
    return artifacts.verify_checksums(recorded, actual)


@query
def artifact_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Per run and symbol: the returned sample, its files, its producer and its coverage must be what the run expected."""
    requested = views.table(spark, sf, "lineitem").select(
        views.month(F.col("l_shipdate")).alias("run_id"),
        views.provider_symbol(F.col("l_suppkey")).alias("symbol"), views.day(F.col("l_shipdate")).alias("date"),
    )
    foreign = F.col("adj_close") == "50"
    prices = views.raw_frames(spark, sf).select(
        "run_id", "symbol", views.day(F.col("ts")).alias("date"),
        F.when(foreign, F.lit("other")).otherwise(F.lit(fv.PRICE_SOURCE)).alias("source"),
        F.col("symbol").alias("provider_symbol"),
    )
    caps = views.table(spark, sf, "supplier").select(
        views.provider_symbol(F.col("s_suppkey")).alias("symbol"), F.col("s_acctbal").alias("market_cap"),
        F.when(F.col("s_nationkey") == 3, F.lit("USD")).otherwise(F.lit("INR")).alias("market_cap_currency"),
        F.col("s_name").alias("name"),
    )
    keys = ["run_id", "symbol"]
    expected = {"commit_sha": F.lit("c0ffee"), "producer_run": F.col("run_id"), "synthetic": F.lit(False)}
    return artifacts.accept(
        artifacts.price_sample_checks(requested, prices, keys, F.col("symbol")),
        artifacts.snapshot_sample_checks(caps, ["symbol"], "SUPPLIER#00000000"),
        artifacts.identity_checks(views.sample_manifests(spark, sf), expected, keys),
        artifacts.listed_inventory_checks(views.sample_files(spark, sf), keys),
        artifacts.coverage_checks(views.sample_coverage(spark, sf), keys, ("prices", "fundamentals")),
        keys=keys,
    )


# --- charts and reconciliation ---------------------------------------------------------------------------


@query
def window_epochs(spark: SparkSession, sf: str) -> DataFrame:
    start = views.day(F.col("o_orderdate"))
    days = F.substring("o_orderpriority", 1, 1).cast("int") * 3
    windows = views.table(spark, sf, "orders").select("o_orderkey", start.alias("start"), F.date_add(start, days).alias("end"))
    return windows.select(
        "o_orderkey", local_midnight_epoch(F.col("start")).alias("period1"),
        local_midnight_epoch(F.col("end")).alias("period2"), is_valid_window(F.col("start"), F.col("end")).alias("valid"),
    )


@query
def request_match(spark: SparkSession, sf: str) -> DataFrame:
    # read by the log, by its counts and by the match
    scopes = written(charts.request_scopes(views.chart_scopes(spark, sf)), "scopes")
    matched = charts.match_requests(views.fetch_log(spark, sf, scopes), scopes)
    return matched.select("symbol", "start", "end", "period1", "period2", "url")


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    return charts.decode_charts(views.chart_documents(spark, sf))


@query
def chart_decode(spark: SparkSession, sf: str) -> DataFrame:
    """One row per session of a valid document and one row with its code per broken one."""
    rows = _decoded(spark, sf).select("symbol", "start", "chart_code", F.explode_outer("sessions").alias("s"))
    return rows.select("symbol", "start", "chart_code", *[F.col(f"s.{n}").alias(n) for n in ("date", *fv.CHART_FIELDS)])


@query
def kept_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Which bodies stay, with the sessions in them; some windows' fetches failed though a body came with them."""
    status = F.when(F.dayofmonth("start") == 11, F.lit(503)).otherwise(F.lit(200))
    kept = charts.keep_valid_bodies(_decoded(spark, sf).withColumn("status_code", status))
    stamps = F.from_json(F.get_json_object("body", "$.chart.result[0].timestamp"), "array<bigint>")
    return kept.select(
        "symbol", "start", "chart_code", F.col("body").isNotNull().alias("kept"),
        F.when(F.col("body").isNotNull(), F.size(stamps)).cast("bigint").alias("sessions"),
    )


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Source rows of the valid documents, and all adapter rows."""
    return charts.chart_rows(_decoded(spark, sf), outer=True), views.adapter_bars(spark, sf)


@query
def reconcile_dates(spark: SparkSession, sf: str) -> DataFrame:
    source, adapter = _sides(spark, sf)
    return reconcile.reconcile_dates(source, adapter, known_only=True)


@query
def reconcile_cells(spark: SparkSession, sf: str) -> DataFrame:
    source, adapter = _sides(spark, sf)
    return reconcile.reconcile_cells(source, adapter, known_only=True)


@query
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    source, adapter = _sides(spark, sf)
    return reconcile.comparison_counts(reconcile.reconcile_cells(source, adapter, known_only=True))


@query
def adapter_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Raw monthly frames as adapter frames: undated or repeated rows make a frame ambiguous."""
    frames = views.raw_frames(spark, sf).withColumn("adj_close", F.col("volume"))
    return reconcile.adapter_frame_errors(frames, keys=audit.FRAME_KEYS)


@query
def boundary_probe(spark: SparkSession, sf: str) -> DataFrame:
    # read by the comparison and twice by the answers, so decoded once
    decoded = written(_decoded(spark, sf).drop("body"), "decoded")
    # the adapter's bars of a window are together; its sessions are brought there before they are spread
    keys = list(reconcile.SCOPE_KEYS)
    source, adapter = charts.chart_rows(decoded.repartition(*keys), outer=True), views.adapter_bars(spark, sf)
    # some windows were answered twice or with a failed status, some adapter frames hold an infinite cell
    day = F.dayofmonth("start")
    answers = decoded.withColumn("status_code", F.when(day == 11, F.lit(503)).otherwise(F.col("status_code")))
    answers = answers.unionByName(answers.where(day == 21))
    adapter = adapter.withColumn("close", F.when(F.col("volume") == 17, F.lit(float("inf"))).otherwise(F.col("close")))
    frames = adapter
    audited = audit.audit_rows(frames, F.col("start"), F.date_add("start", views.WINDOW_DAYS), keys=keys)
    return reconcile.boundary_probe(
        views.chart_scopes(spark, sf),
        answers,
        reconcile.adapter_frame_errors(frames),
        audit.frame_verdicts(audited, keys=keys),
        reconcile.reconcile_cells(source, adapter, known_only=True),
    )


@query
def provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Every bar with its issuer symbol and the provenance columns."""
    rows = views.bars(spark, sf).select("symbol", "open", "high", "low", "close", "volume", F.col("date").alias("session_date"))
    published = audit.published_prices(rows, provider_version=VERSION, retrieved_at_utc=RETRIEVED)
    return published.where(issuer_symbol(F.col("provider_symbol")) == F.col("symbol"))


# --- landed files ------------------------------------------------------------------------------


@query
def bundle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Per frame what the manifest of a bundle says that this query wrote, with the rows and state of the bundle's files."""
    root = evidence.write_bundle(_audited(spark, sf), shared_folder(spark, "bundle"), {"run_attempt": "1", "retrieved_at_utc": RETRIEVED})
    manifest = spark.read.json(f"{root}/manifest")
    part = F.substring_index("file", "/", 1)
    files = spark.read.json(f"{root}/files").agg(
        F.sum(F.when(part == "frame", F.col("rows"))).alias("frame_part_rows"),
        F.sum(F.when(part == "rejected", F.col("rows"))).alias("rejected_part_rows"),
    ).first()
    status = evidence.verify_bundle(spark, root).agg(F.bool_and(F.col("status") == "verified").alias("files_verified")).first()
    facts = {**files.asDict(), **status.asDict()}
    return manifest.select(
        "run_id", "symbol", "frame_rows", "usable_rows", "rejected_rows", "passed", "run_attempt", "historical_completeness",
        *[F.lit(facts[name]).alias(name) for name in ("frame_part_rows", "rejected_part_rows", "files_verified")],
    )


@query
def rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The rejected rows as they stand in the JSON lines of a bundle that this query wrote."""
    root = evidence.write_bundle(_audited(spark, sf), shared_folder(spark, "bundle"), {"run_attempt": "1"})
    lines = spark.read.schema(
        "run_id string, symbol string, row_position bigint, reasons array<string>, cells array<struct<column:string,type:string,repr:string>>"
    ).json(f"{root}/rejected")
    return lines.select("run_id", "symbol", "row_position", joined("reasons").alias("reasons"), F.size("cells").alias("cells"))


@query
def loaded_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table saved as CSV and loaded again: exact numbers, breaks and quotes in fields, tokens of missing values."""
    number = F.col("l_linenumber")
    saved = views.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + number).alias("id"),
        F.concat(number.cast("string"), F.lit("."), F.lpad(F.col("l_orderkey").cast("string"), 19, "0")).alias("exact"),
        F.col("l_quantity").alias("quantity"),
        F.when(number == 3, F.concat(F.lit('first\n\n"'), "l_returnflag", F.lit('", last'))).when(number == 4, F.lit("a, b"))
        .when(number == 5, F.lit("N/A")).otherwise(F.col("l_linestatus")).alias("note"),
    )
    path = shared_folder(spark, "csv")
    tables.save_csv(saved, path)
    loaded = tables.load_csv(spark, path)
    return loaded.select("id", F.col("exact").cast("string").alias("exact"), "quantity", "note")


def _landed_frames(spark: SparkSession, sf: str) -> DataFrame:
    run = F.element_at(F.split("file", "/"), -2)
    return prices.frames_of_lines(views.landed_price_lines(spark, sf), run)


@query
def frame_gate(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with each landed price file as a whole."""
    return _landed_frames(spark, sf).groupBy("run_id", "symbol").agg(
        F.count(F.lit(1)).alias("frame_rows"), F.first(joined("frame_errors")).alias("frame_errors")
    )


@query
def landed_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell, as its file had it, of the rows of files that failed the gate."""
    audited = audit.audit_rows(
        _landed_frames(spark, sf), F.lit("1900-01-01").cast("date"), F.lit("2100-01-01").cast("date"),
        frame_errors="frame_errors",
    )
    rejected = audit.rejected_rows(audited.where(audit.with_faults()))
    return rejected.select("run_id", "symbol", "row_position", F.posexplode("cells").alias("place", "cell")).select(
        "run_id", "symbol", "row_position", "place", F.col("cell.column").alias("field"),
        F.col("cell.type").alias("type"), F.col("cell.repr").alias("text"),
    )


@query
def deal_headers(spark: SparkSession, sf: str) -> DataFrame:
    found = deal_files.deal_headers(views.landed_deal_lines(spark, sf))
    return found.select("kind", "day", "rows", joined("names").alias("names"), "header_ok")


@query
def landed_deals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of usable deal files: typed values beside their texts, other columns as name=value."""
    rows, _ = deal_files.deals_of_lines(views.landed_deal_lines(spark, sf))
    extras = F.transform(F.sort_array(F.map_entries("extras")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.select(
        "kind", "file_day", "deal_date", "symbol", "quantity", (F.col("price") * 1000).cast("bigint").alias("price_mills"),
        "client", "date_text", "quantity_text", "price_text", F.concat_ws(",", extras).alias("extras"),
    )
