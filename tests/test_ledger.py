from datetime import date

import pytest
from pyspark.sql import functions as F

from barledger import fixed_values as fv
from barledger.operators import identity, ledger


def requested(spark, symbols, deferred=(), run="r"):
    rows = [(run, i, s, s in deferred) for i, s in enumerate(symbols)]
    return spark.createDataFrame(rows, "run_id string, ordinal bigint, symbol string, deferred boolean")


def outcomes(spark, categories, run="r"):
    return spark.createDataFrame([(run, s, c) for s, c in categories.items()], "run_id string, symbol string, category string")


def coverage(spark, sequence, flag=True, deferred=(), hot_rows=1000):
    symbols = [f"S{i}.NS" for i in range(len(sequence))]
    given = {s: c for s, c in zip(symbols, sequence) if c}
    rows = ledger.price_ledger(
        requested(spark, symbols, deferred), outcomes(spark, given or {"none": "x"}),
        continue_after_row_rejection=flag, hot_rows=hot_rows,
    )
    return rows, ledger.run_coverage(rows).first()


ADMITTED, MIXED = fv.ADMITTED, fv.ROW_QUALITY_REJECTED


@pytest.mark.parametrize("sequence, flag, attempted, returned, stop, raised, success", [
    ([MIXED, ADMITTED], True, 2, 1, None, False, False),
    ([MIXED, MIXED], True, 2, 0, None, False, False),
    ([ADMITTED, ADMITTED], True, 2, 2, None, False, True),
    ([MIXED, ADMITTED], False, 1, 0, MIXED, False, False),
    ([None, ADMITTED], True, 1, 0, fv.UNVERIFIED_RESPONSE, False, False),
    ([MIXED, fv.DENIED, ADMITTED], True, 2, 0, fv.DENIED, True, False),
    ([MIXED, fv.PROCESSING_ERROR, ADMITTED], True, 2, 0, fv.PROCESSING_ERROR, False, False),
])
def test_stop_and_continue(spark, sequence, flag, attempted, returned, stop, raised, success):
    for hot_rows in (1, 1000):
        _, run = coverage(spark, sequence, flag, hot_rows=hot_rows)
        assert (run.attempted, run.returned, run.stop_category, run.raised, run.success) == (
            attempted, returned, stop, raised, success
        )
        assert run.requested == len(sequence) == run.attempted + run.not_attempted
        assert run.historical_completeness == "not_verified"


def test_deferred_is_neither_attempted_nor_dropped(spark):
    rows, run = coverage(spark, [None, ADMITTED, ADMITTED], deferred=("S0.NS",))
    assert (run.requested, run.attempted, run.returned, run.not_returned, run.success) == (3, 2, 2, 1, False)
    assert (run.pending_provider, run.stop_symbol) == (0, None)
    assert rows.where("deferred").first().category == "archival_required"


def test_runs_do_not_stop_each_other(spark):
    wanted = requested(spark, ["A.NS", "B.NS"]).unionByName(requested(spark, ["A.NS", "B.NS"], run="q"))
    given = outcomes(spark, {"A.NS": fv.UNVERIFIED_RESPONSE, "B.NS": ADMITTED}).unionByName(
        outcomes(spark, {"A.NS": ADMITTED, "B.NS": ADMITTED}, run="q")
    )
    rows = {r.run_id: r for r in ledger.run_coverage(ledger.price_ledger(wanted, given)).collect()}
    assert rows["q"].success and not rows["r"].success and rows["r"].attempted == 1


def test_flag_must_be_boolean(spark):
    with pytest.raises(TypeError):
        ledger.price_ledger(requested(spark, ["A.NS"]), outcomes(spark, {"A.NS": ADMITTED}), continue_after_row_rejection=1)


def test_returned_list_keeps_request_order(spark):
    rows, _ = coverage(spark, [ADMITTED] * 5)
    blocks = ledger.ordered_symbols(rows, "returned", block=2).orderBy("block").collect()
    assert [b.symbols for b in blocks] == [["S0.NS", "S1.NS"], ["S2.NS", "S3.NS"], ["S4.NS"]]


def test_original_twenty_are_nineteen_requests(spark):
    rows = [("r", i, s) for i, s in enumerate(fv.PRICE_UNIVERSE)]
    wanted = spark.createDataFrame(rows, "run_id string, ordinal bigint, symbol string")
    deferred = identity.defer_by_policy(wanted, identity.price_policies(spark), date(2026, 9, 22))
    given = outcomes(spark, {s: ADMITTED for s in fv.PRICE_UNIVERSE})
    run = ledger.run_coverage(ledger.price_ledger(deferred.select("run_id", "ordinal", "symbol", "deferred"), given)).first()
    assert (run.requested, run.attempted, run.returned, run.deferred, run.success) == (20, 19, 19, 1, False)


def test_snapshot_ledger_stops_at_first_failure(spark):
    given = spark.createDataFrame([("r", "A.NS", True), ("r", "C.NS", True)], "run_id string, symbol string, accepted boolean")
    rows = ledger.snapshot_ledger(requested(spark, ["A.NS", "B.NS", "C.NS"]), given)
    run = ledger.snapshot_coverage(rows, F.lit("2026-09-21 20:00:00").cast("timestamp")).first()
    assert (run.returned, run.not_returned, run.success) == (1, 2, False)
    assert run.snapshot_as_of_date_ist == date(2026, 9, 22)
    assert (run.stop_symbol, run.stop_reason, run.raised) == ("B.NS", fv.UNVERIFIED_RESPONSE, False)
    fetches = spark.createDataFrame([("r", "A.NS", "denied")], "run_id string, symbol string, outcome string")
    rows = ledger.snapshot_ledger(requested(spark, ["A.NS", "B.NS", "C.NS"]), given, fetches)
    run = ledger.snapshot_coverage(rows, F.lit("2026-09-21 20:00:00").cast("timestamp")).first()
    assert (run.returned, run.stop_symbol, run.stop_reason, run.raised) == (0, "A.NS", fv.DENIED, True)


def test_run_summary(spark):
    schema = "run_id string, task string, succeeded boolean, error string, seconds double"
    names = ["prices", "companies", "fundamentals", "deals", "actions"]
    for first, status, success in [((True, None), "SUCCESS", True), ((False, None), "FAILED", False), ((None, "x"), "ERROR", False)]:
        tasks = [("r", n, True, None, 1.5) for n in names[1:]] + [("r", names[0], *first, 1.5)]
        statuses = ledger.task_statuses(spark.createDataFrame(tasks, schema))
        assert statuses.where("task = 'prices'").first().status == status
        run = ledger.run_summary(statuses).first()
        assert run.all_tasks_success is success and run.historical_completeness == "not_verified"
        assert run.successful + run.failed == 5
        assert run.total_seconds == (6.0 if status == "ERROR" else 7.5)


def test_universe(spark):
    typos = identity.known_typos(spark)

    def check(*symbols):
        table = spark.createDataFrame([("r", s) for s in symbols], "run_id string, symbol string")
        return {row.symbol: row.faults for row in identity.check_universe(table, typos).collect()}

    assert check("INFY.NS", "M&M.NS") == {"INFY.NS": [], "M&M.NS": []}
    assert check("INFOSY.NS") == {"INFOSY.NS": ["known_typo"]}
    assert check("infy.NS", "INFY.BO", "INFY.NS", "INFY.NS") == {
        "infy.NS": ["invalid_symbol"], "INFY.BO": ["invalid_symbol"], "INFY.NS": ["repeated_symbol"],
    }
    with pytest.raises(ValueError):
        identity.assert_universe(spark.createDataFrame([], "run_id string, symbol string"), typos)
    with pytest.raises(ValueError):
        identity.assert_universe(spark.createDataFrame([("r", "INFOSY.NS")], "run_id string, symbol string"), typos)


def test_snapshot_deferral_starts_on_its_day(spark):
    wanted = spark.createDataFrame([("HDFC.NS",), ("HDFCBANK.NS",)], "symbol string")
    policies = identity.snapshot_policies(spark)
    for day, status in [(date(2023, 6, 30), None), (date(2023, 7, 1), "archival_required")]:
        rows = {r.symbol: r for r in identity.snapshot_deferrals(wanted, policies, day).collect()}
        assert rows["HDFC.NS"].status == status and rows["HDFC.NS"].replacement_symbol is None
        assert rows["HDFCBANK.NS"].status is None


def test_worklist_interval_is_never_clipped(spark):
    wanted = spark.createDataFrame([("HDFC.NS",), ("HDFC.BO",), ("INFY.NS",)], "symbol string")
    policies = identity.price_policies(spark, "https://example.org/run")
    start, end = date(2000, 1, 1), date(2023, 6, 30)
    assert identity.archival_worklist(wanted, policies, date(2026, 9, 21), start, end).count() == 0
    item = identity.archival_worklist(wanted, policies, date(2026, 9, 22), start, end).collect()
    assert len(item) == 1
    item = item[0]
    assert (item.requested_start, item.requested_end_exclusive) == ("2000-01-01", "2023-06-30")
    assert len(item.evidence_urls) == 2 and item.archive_fetch_status == "awaiting_verified_source"
    assert item.replacement_symbol is None and item.last_trading_date is None and item.archive_source is None
    with pytest.raises(ValueError):
        identity.archival_worklist(wanted, policies, end, end, end)


def test_latest_policy_in_force_applies_once(spark):
    schema = identity.POLICY_SCHEMA
    rows = [("A.NS", date(2020, 1, 1), "p1", "x", []), ("A.NS", date(2021, 1, 1), "p2", "x", [])]
    found = identity.defer_by_policy(
        spark.createDataFrame([("A.NS",)], "symbol string"), spark.createDataFrame(rows, schema), date(2022, 1, 1)
    ).collect()
    assert [row.policy_id for row in found] == ["p2"]


def test_fetch_faults_outrank_verdicts(spark):
    verdicts = spark.createDataFrame(
        [("r", s, ADMITTED, 2, 2, 0) for s in ("A", "B", "C")],
        "run_id string, symbol string, category string, frame_rows bigint, usable_rows bigint, rejected_rows bigint",
    )
    fetches = spark.createDataFrame(
        [("r", "A", "received"), ("r", "A", "retry"), ("r", "B", "exhausted"), ("r", "B", "denied"), ("r", "D", "tls_error")],
        "run_id string, symbol string, outcome string",
    )
    found = {r.symbol: (r.category, r.frame_rows) for r in ledger.frame_outcomes(verdicts, fetches).collect()}
    assert found == {"A": (ADMITTED, 2), "B": (fv.DENIED, None), "C": (ADMITTED, 2), "D": (fv.PROCESSING_ERROR, None)}
    rows = ledger.price_ledger(
        requested(spark, ["A", "B", "C"]), ledger.frame_outcomes(verdicts, fetches), carry=ledger.FRAME_COUNTS
    )
    run = ledger.history_audit(rows).first()
    assert (run.attempted, run.frame_rows, run.stop_symbol, run.raised) == (2, 2, "B", True)


def test_deferral_can_be_off_and_flags_are_boolean(spark):
    wanted, given = requested(spark, ["A.NS"], deferred=("A.NS",)), outcomes(spark, {"A.NS": ADMITTED})
    assert ledger.run_coverage(ledger.price_ledger(wanted, given)).first().returned == 0
    assert ledger.run_coverage(ledger.price_ledger(wanted, given, defer_archival_prices=False)).first().success
    with pytest.raises(TypeError):
        ledger.price_ledger(wanted, given, defer_archival_prices="yes")


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_one_symbol_may_hold_all_requests(spark, hot_rows):
    asked = spark.createDataFrame(
        [(f"r{i}", i, "A.NS", date(2020, 1, 1 + i % 28)) for i in range(200)] + [("r", 0, "B.NS", date(2020, 1, 1)), ("r", 1, None, None)],
        "run_id string, ordinal int, symbol string, day date",
    )
    rules = spark.createDataFrame(
        [("A.NS", date(2020, 1, 10), "p1", "first"), ("A.NS", date(2020, 1, 20), "p2", "second"), ("C.NS", date(2020, 1, 1), "p3", "x"),
         ("A.NS", None, "p4", "undated")],
        "symbol string, effective_date date, policy_id string, reason string",
    )
    got = identity.defer_by_policy(asked, rules, F.col("day"), hot_rows=hot_rows).collect()
    assert len(got) == 202
    for r in got:
        want = (None if r.symbol != "A.NS" or r.day < date(2020, 1, 10) else "p1" if r.day < date(2020, 1, 20) else "p2")
        assert (r.policy_id, r.deferred) == (want, want is not None)
