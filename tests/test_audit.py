from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barledger import fixed_values as fv
from barledger.operators import audit

START, END = date(2026, 9, 14), date(2026, 9, 19)
NAN, INF = float("nan"), float("inf")
SCHEMA = (
    "run_id string, symbol string, row_position bigint, ts timestamp_ntz, open double, high double, low double, "
    "close double, adj_close double, volume double"
)
FIRST = dict(ts=datetime(2026, 9, 14), open=10.0, high=12.0, low=9.0, close=11.0, adj_close=5.5, volume=100.0)
SECOND = dict(ts=datetime(2026, 9, 15), open=11.0, high=13.0, low=10.0, close=12.0, adj_close=6.0, volume=200.0)


def frame(spark, *rows, schema=SCHEMA, symbol="RELIANCE.NS"):
    names = [part.split()[0] for part in schema.split(", ")]
    records = [
        tuple({"run_id": "r", "symbol": symbol, "row_position": i, **row}.get(name) for name in names)
        for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(records, schema)


def reasons(spark, *rows, **kwargs):
    audited = audit.audit_rows(frame(spark, *rows, **kwargs), START, END)
    collected = sorted(audited.collect(), key=lambda row: row.row_position)
    # Every row is on exactly one side, and only rejected rows have reasons.
    assert [row.row_position for row in collected] == list(range(len(rows)))
    assert all(row.accepted == (not row.reasons) for row in collected)
    return [row.reasons for row in collected]


CASES = [
    ({"open": NAN}, ["missing:Open"]),
    ({"open": None}, ["missing:Open"]),
    ({"open": NAN, "high": INF, "low": -1.0, "volume": -2.0},
     ["missing:Open", "nonfinite:High", "nonpositive:Low", "negative:Volume"]),
    ({"open": 0.0, "volume": 0.0}, ["nonpositive:Open"]),
    ({"volume": 1.5}, ["fractional:Volume"]),
    ({"volume": -1.5}, ["negative:Volume"]),
    ({"volume": -INF}, ["nonfinite:Volume"]),
    ({"ts": None}, ["missing_date"]),
    ({"ts": datetime(2026, 9, 19)}, ["date_outside_request"]),
    ({"ts": datetime(2026, 9, 13, 23)}, ["date_outside_request"]),
    ({"high": 1.0}, ["ohlc_order"]),
    ({"low": 11.5}, ["ohlc_order"]),
    ({"adj_close": NAN}, []),
    ({"adj_close": None}, []),
    ({"adj_close": 0.0}, ["invalid:Adj Close"]),
    ({"adj_close": INF}, ["invalid:Adj Close"]),
]


@pytest.mark.parametrize("change, expected", CASES, ids=lambda value: str(value))
def test_one_changed_row(spark, change, expected):
    assert reasons(spark, {**FIRST, **change}, SECOND) == [expected, []]


def test_both_copies_of_a_day_are_rejected(spark):
    assert reasons(spark, FIRST, SECOND, FIRST) == [["duplicate_date"], [], ["duplicate_date"]]


def test_a_day_is_a_day_whatever_the_time(spark):
    later = {**SECOND, "ts": datetime(2026, 9, 14, 1)}
    assert reasons(spark, FIRST, later) == [["duplicate_date"], ["duplicate_date"]]


def test_undated_rows_are_not_copies_of_each_other(spark):
    assert reasons(spark, {**FIRST, "ts": None}, {**SECOND, "ts": None}) == [["missing_date"], ["missing_date"]]


def test_duplicates_of_hot_days(spark):
    """The split of hot keys gives the same rows as the plain path."""
    rows = [FIRST] * 40 + [SECOND] + [{**SECOND, "ts": datetime(2026, 9, 16)}] * 2
    table = frame(spark, *rows)
    want = sorted(map(tuple, audit.audit_rows(table, START, END).select("row_position", "reasons").collect()))
    hot = audit.audit_rows(table, START, END, hot_rows=5).select("row_position", "reasons")
    assert sorted(map(tuple, hot.collect())) == want
    assert sum(found == ["duplicate_date"] for _, found in want) == 42


def test_text_adjusted_close(spark):
    text = SCHEMA.replace("adj_close double", "adj_close string")
    rows = [{**FIRST, "adj_close": "bad"}, {**SECOND, "adj_close": "6.0"}]
    assert reasons(spark, *rows, schema=text) == [["invalid:Adj Close"], []]
    for value in ("nan", "inf", "1d", "0", ""):
        assert reasons(spark, {**FIRST, "adj_close": value}, schema=text) == [["invalid:Adj Close"]]


def test_boolean_adjusted_close_is_never_valid(spark):
    flag = SCHEMA.replace("adj_close double", "adj_close boolean")
    assert reasons(spark, {**FIRST, "adj_close": True}, {**SECOND, "adj_close": None}, schema=flag) == [
        ["invalid:Adj Close"], []
    ]


def test_schema_gate(spark):
    table = frame(spark, FIRST, SECOND)
    for changed, expected in [
        (table.drop("close"), ["missing_ohlcv_columns"]),
        (table.withColumn("open", F.col("open").cast("string")), ["nonnumeric_column:Open"]),
        (table.withColumn("volume", F.lit(True)), ["nonnumeric_column:Volume"]),
        (table.withColumn("ts", F.col("ts").cast("string")), ["not_a_datetime_index"]),
        (table.drop("close").withColumn("ts", F.lit(1)), ["missing_ohlcv_columns", "not_a_datetime_index"]),
    ]:
        rows = audit.audit_rows(changed, START, END).collect()
        assert [row.reasons for row in rows] == [expected, expected]
    doubled = table.select("*", F.col("open").alias("open"))
    assert audit.frame_schema_errors(doubled.schema, "ts", fv.PRICE_COLUMNS) == ["ambiguous_columns"]


def test_landed_frame_errors_replace_row_rules(spark):
    table = frame(spark, {**FIRST, "open": NAN}, SECOND).withColumn("faults", F.array(F.lit("ambiguous_columns")))
    rows = audit.audit_rows(table, START, END, frame_errors="faults").collect()
    assert [row.reasons for row in rows] == [["ambiguous_columns"]] * 2


def verdict(spark, *rows):
    return audit.frame_verdicts(audit.audit_rows(frame(spark, *rows), START, END)).first()


def test_whole_frame_admission(spark):
    good = verdict(spark, FIRST, SECOND)
    assert (good.passed, good.category, good.frame_rows, good.rejection_counts) == (True, "admitted_frame", 2, {})
    mixed = verdict(spark, {**FIRST, "open": NAN, "high": NAN}, SECOND)
    assert (mixed.passed, mixed.category, mixed.usable_rows, mixed.rejected_rows) == (False, "row_quality_rejected", 1, 1)
    assert mixed.rejection_counts == {"missing:Open": 1, "missing:High": 1}
    assert verdict(spark, {**FIRST, "open": NAN}).category == "unverified_response"
    assert verdict(spark, FIRST, SECOND, FIRST).category == "unverified_response"
    assert verdict(spark, {**FIRST, "ts": None}, SECOND).category == "unverified_response"


def test_empty_frames_stay_in_the_request(spark):
    requested = spark.createDataFrame([("r", "RELIANCE.NS"), ("r", "TCS.NS")], "run_id string, symbol string")
    verdicts = audit.frame_verdicts(audit.audit_rows(frame(spark, FIRST), START, END))
    rows = {row.symbol: row for row in audit.requested_verdicts(requested, verdicts).collect()}
    assert rows["TCS.NS"].frame_errors == ["empty_frame"] and not rows["TCS.NS"].passed
    assert rows["RELIANCE.NS"].passed and rows["TCS.NS"].frame_rows == 0
    # a request that was answered without a table, several times; one with rows is judged by them
    rows = audit.requested_verdicts(requested, verdicts, no_table=requested.unionByName(requested)).collect()
    errors = {row.symbol: row.frame_errors for row in rows}
    assert len(rows) == 2 and errors == {"TCS.NS": ["not_a_dataframe"], "RELIANCE.NS": []}


def test_only_admitted_frames_are_published(spark):
    table = frame(spark, FIRST, SECOND).unionByName(frame(spark, {**FIRST, "low": 0.0}, SECOND, symbol="TCS.NS"))
    for hot_rows in (1, 1000):
        audited = audit.audit_rows(table, START, END)
        admitted = audit.admitted_rows(audited, audit.frame_verdicts(audited), hot_rows=hot_rows)
        rows = audit.published_prices(admitted, provider_version="1", retrieved_at_utc="t").orderBy("date").collect()
        assert [(row.symbol, row.date, row.provider_symbol) for row in rows] == [
            ("RELIANCE", "2026-09-14", "RELIANCE.NS"), ("RELIANCE", "2026-09-15", "RELIANCE.NS"),
        ]
        assert rows[0].price_basis == fv.PRICE_BASIS


def test_rejected_cells_keep_missing_zero_and_text_apart(spark):
    table = frame(spark, {**FIRST, "open": NAN, "high": INF, "low": 0.0, "close": None})
    cells = {c.column: (c.type, c.repr) for c in audit.rejected_rows(audit.audit_rows(table, START, END)).first().cells}
    assert cells["Open"] == ("double", "NaN") and cells["High"] == ("double", "Infinity")
    assert cells["Low"] == ("double", "0.0") and cells["Close"] == ("null", "NULL")
    assert len(cells) == 6


def test_positions_are_whole_in_blocks(spark):
    days = [{**FIRST, "ts": datetime(2026, 9, 14 + i)} for i in range(5)]
    rows = audit.usable_positions(audit.audit_rows(frame(spark, *days), START, END), block=2).orderBy("block").collect()
    assert [row.positions for row in rows] == [[0, 1], [2, 3], [4]]


def test_result_does_not_depend_on_order_or_partitions(spark):
    rows = [FIRST, SECOND, FIRST, {**SECOND, "ts": datetime(2026, 9, 17), "open": NAN}]
    table = frame(spark, *rows)
    want = None
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        for order in ("row_position", F.desc("row_position")):
            shuffled = table.repartition(3).orderBy(order)
            got = sorted(map(tuple, audit.audit_rows(shuffled, START, END).select("row_position", "reasons").collect()))
            want = want or got
            assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_admissions_are_the_verdicts_without_the_audit(spark):
    """Days with several rows, undated rows, faults with and without a repeated day, null keys."""
    days = [FIRST, SECOND, {**FIRST, "run_id": "two"}, {**FIRST, "run_id": "two", "open": None}, {**SECOND, "run_id": "two"}]
    days += [{**row, "run_id": "days"} for row in (FIRST, {**SECOND, "volume": 1.5}, {**SECOND, "ts": None}, {**SECOND, "ts": None})]
    days += [{**FIRST, "run_id": "numbers", "open": NAN}, {**SECOND, "run_id": "numbers"}, {**FIRST, "run_id": None}, {**FIRST, "run_id": None}]
    frames = frame(spark, *days)
    audited = audit.audit_rows(frames, START, END)
    verdicts = audit.frame_verdicts(audited)
    admissions = audit.frame_admissions(frames, START, END)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(admissions.collect()) == order(verdicts.select(*admissions.columns).collect())
    admitted = audit.rows_of_admitted(frames, admissions)
    assert order(admitted.collect()) == order(audit.admitted_rows(audited, verdicts).select(*admitted.columns).collect())
    assert admitted.count() == 2
    text = frames.withColumn("open", F.col("open").cast("string"))
    assert not any(row.passed for row in audit.frame_admissions(text, START, END).collect())


def test_frames_that_are_together_are_not_moved(spark):
    table = frame(spark, FIRST, FIRST).repartition(*audit.FRAME_KEYS)
    audited = audit.audit_rows(table, START, END)
    plan = audit.frame_verdicts(audited)._jdf.queryExecution().executedPlan().toString()
    # once for the rows, once for the count of hot days
    assert plan.count("Exchange hashpartitioning") == 2
    assert [row.reasons for row in audited.collect()] == [["duplicate_date"]] * 2


def test_rows_with_frame_errors_are_counted_but_not_moved(spark):
    fault = F.when(F.col("row_position") == 0, F.array(F.lit("ambiguous_columns"))).when(
        F.col("row_position") == 1, F.array().cast("array<string>")
    )
    table = frame(spark, FIRST, FIRST, SECOND, {**SECOND, "ts": None}).withColumn("faults", fault)
    for hot_rows in (5, 1):
        audited = audit.audit_rows(table, START, END, frame_errors="faults", hot_rows=hot_rows)
        rows = audited.orderBy("row_position").collect()
        assert [row.reasons for row in rows] == [["ambiguous_columns"], ["duplicate_date"], [], ["missing_date"]]
        assert [row.accepted for row in rows] == [False, False, True, False]
        assert [row.faults for row in rows] == [["ambiguous_columns"], [], None, None]
        assert [row.volume for row in rows] == [FIRST["volume"], FIRST["volume"], SECOND["volume"], SECOND["volume"]]
    faulty = audit.rejected_rows(audited.where(audit.with_faults("faults")))
    assert "Exchange" not in faulty._jdf.queryExecution().executedPlan().toString()
    assert [row.reasons for row in faulty.collect()] == [["ambiguous_columns"]]
