"""A plan defers lookups only if it was committed; what is attached to tasks decides their status."""

import json
import os

import pytest
from pyspark.sql import functions as F

from barledger import fixed_values as fv
from barledger.operators import ledger
from barledger.sources import evidence, worklists

META = {"commit_sha": "c0ffee", "planned_at_utc": "t"}


def requested(spark, symbols=("A.NS", "B.NS", "C.NS"), runs=("r",)):
    return spark.createDataFrame([(r, i, s) for r in runs for i, s in enumerate(symbols)], "run_id string, ordinal bigint, symbol string")


def worklist(spark, symbols=("A.NS",), run="r"):
    return spark.createDataFrame([(run, s, "p1") for s in symbols], "run_id string, provider_symbol string, policy_id string")


def outcomes(spark):
    return spark.createDataFrame([("r", s, fv.ADMITTED) for s in ("A.NS", "B.NS", "C.NS")], "run_id string, symbol string, category string")


def test_committed_plan_defers_what_it_holds(spark, tmp_path):
    root = worklists.write_plan(requested(spark), worklist(spark), str(tmp_path / "plan"), META)
    rows, manifest = worklists.read_plan(spark, root)
    assert [tuple(r) for r in rows.collect()] == [("r", "A.NS", "p1")]
    row = manifest.first()
    assert (row.original_requested, row.archival_requests, row.provider_candidates, row.downloaded_rows) == (3, 1, 2, 0)
    assert (row.commit_sha, row.kind) == ("c0ffee", "outstanding_price_archival_work_not_market_data")
    run = ledger.run_coverage(worklists.planned_ledger(requested(spark), outcomes(spark), root)).first()
    assert (run.deferred, run.attempted, run.returned, run.success) == (1, 2, 2, False)


def test_empty_plan_defers_nothing(spark, tmp_path):
    root = worklists.write_plan(requested(spark), worklist(spark).limit(0), str(tmp_path / "plan"), META)
    run = ledger.run_coverage(worklists.planned_ledger(requested(spark), outcomes(spark), root)).first()
    assert (run.deferred, run.success) == (0, True)


def test_plan_without_marker_is_refused(spark, tmp_path):
    with pytest.raises(worklists.PlanNotCommitted):
        worklists.planned_ledger(requested(spark), outcomes(spark), str(tmp_path / "nothing"))
    root = worklists.write_plan(requested(spark), worklist(spark), str(tmp_path / "plan"), META)
    os.rename(f"{root}/manifest/_SUCCESS", f"{root}/manifest/.taken")
    with pytest.raises(worklists.PlanNotCommitted):
        worklists.planned_ledger(requested(spark), outcomes(spark), root)


def test_plan_with_changed_files_is_refused(spark, tmp_path):
    root = worklists.write_plan(requested(spark), worklist(spark), str(tmp_path / "plan"), META)
    worklist(spark, ("B.NS",)).write.mode("append").parquet(f"{root}/requests")
    with pytest.raises(worklists.PlanNotCommitted):
        worklists.read_plan(spark, root)


@pytest.mark.parametrize("symbols", [("D.NS",), ("A.NS", "A.NS")])
def test_failed_write_stops_the_run_and_defers_nothing(spark, tmp_path, symbols):
    root = str(tmp_path / "plan")
    with pytest.raises(worklists.PlanPersistenceFailed) as failed:
        worklists.plan_or_stop(requested(spark, runs=("r", "q")), worklist(spark, symbols), root, META)
    with pytest.raises(worklists.PlanNotCommitted):
        worklists.read_plan(spark, root)
    (run,) = failed.value.coverage.collect()
    assert (run.run_id, run.stop_category, run.raised, run.success) == ("r", fv.PLAN_NOT_PERSISTED, True, False)
    assert (run.requested, run.deferred, run.attempted, run.not_attempted, run.not_returned) == (3, 0, 0, 3, 3)


def test_existing_plan_is_never_replaced(spark, tmp_path):
    root = worklists.write_plan(requested(spark), worklist(spark), str(tmp_path / "plan"), META)
    with pytest.raises(worklists.PlanPersistenceFailed):
        worklists.plan_or_stop(requested(spark), worklist(spark, ("B.NS",)), root, META)
    assert worklists.read_plan(spark, root)[0].first().provider_symbol == "A.NS"


def test_coverage_of_different_kinds_decides_status(spark, tmp_path):
    tasks = spark.createDataFrame(
        [("1", "prices", True, None, 1.0), ("2", "prices", None, None, 1.0), ("1", "deals", None, None, 2.0),
         ("2", "deals", True, None, 2.0), ("1", "listings", True, None, 3.0), ("2", "listings", None, "fault", 3.0)],
        "run_id string, task string, succeeded boolean, error string, seconds double",
    )
    prices = spark.createDataFrame(
        [("1", 2, 1, "x", False), ("2", 2, 2, None, True)], "run_id string, requested int, returned int, stop string, success boolean"
    )
    sold = spark.createDataFrame(
        [("1", "bulk", 3, True), ("1", "block", 3, True), ("2", "bulk", 3, True), ("2", "block", 1, False)],
        "run_id string, kind string, days int, success boolean",
    )
    documents = ledger.coverage_documents({"prices": prices, "deals": sold})
    rows = ledger.task_statuses(tasks, documents)
    got = {(r.run_id, r.task): (r.status, r.text and json.loads(r.text)) for r in rows.withColumn("text", F.to_json("coverage")).collect()}
    assert got["1", "prices"] == ("FAILED", {"requested": 2, "returned": 1, "stop": "x", "success": False})
    assert got["2", "prices"] == ("SUCCESS", {"requested": 2, "returned": 2, "stop": None, "success": True})
    assert got["1", "deals"] == ("SUCCESS", {"block": {"days": 3, "success": True}, "bulk": {"days": 3, "success": True}})
    assert got["2", "deals"][0] == "FAILED" and got["2", "deals"][1]["block"] == {"days": 1, "success": False}
    assert got["1", "listings"] == ("SUCCESS", None) and got["2", "listings"] == ("ERROR", None)
    summary = {r.run_id: r for r in ledger.run_summary(rows.drop("coverage")).collect()}
    assert (summary["1"].successful, summary["1"].failed, summary["2"].all_tasks_success) == (2, 1, False)
    # a summary is written once, and the documents come back as they were
    evidence.write_manifest(rows.withColumn("coverage", F.to_json("coverage")), str(tmp_path / "summary"))
    back = spark.read.json(str(tmp_path / "summary")).where("task = 'deals' AND run_id = '1'").first()
    assert json.loads(back.coverage) == got["1", "deals"][1]
