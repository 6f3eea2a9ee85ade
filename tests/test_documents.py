import json
import random
from datetime import date

import pytest

from barledger import fixed_values as fv
from barledger.functions.market import is_valid_window, local_day, local_midnight_epoch
from barledger.operators import reconcile
from barledger.sources import actions, charts, listings, snapshots
from pyspark.sql import functions as F

START, END = date(2026, 9, 18), date(2026, 9, 22)
PERIOD1 = 1789669800


def document():
    return {"chart": {"error": None, "result": [{
        "meta": {"symbol": "RELIANCE.NS", "currency": "INR", "exchangeTimezoneName": "Asia/Kolkata",
                 "instrumentType": "EQUITY", "dataGranularity": "1d"},
        "timestamp": [PERIOD1 + 33300, PERIOD1 + 3 * 86400 + 33300],
        "indicators": {
            "quote": [{"open": [10, 12], "high": [12, 14], "low": [9, 11], "close": [11, None], "volume": [100, 200]}],
            "adjclose": [{"adjclose": [11, None]}],
        },
    }]}}


def changed(path, value):
    doc = document()
    target = doc
    for step in path[:-1]:
        target = target[step]
    target[path[-1]] = value
    return json.dumps(doc)


RESULT = ["chart", "result", 0]
QUOTE = [*RESULT, "indicators", "quote"]
BROKEN = [
    (changed([*RESULT, "meta", "symbol"], "TCS.NS"), "chart_identity_mismatch"),
    (changed([*RESULT, "meta", "currency"], "USD"), "chart_identity_mismatch"),
    (changed([*RESULT, "meta", "exchangeTimezoneName"], "UTC"), "chart_identity_mismatch"),
    (changed([*RESULT, "meta", "instrumentType"], "ETF"), "chart_identity_mismatch"),
    (changed([*RESULT, "meta", "dataGranularity"], "1wk"), "chart_identity_mismatch"),
    (changed(["chart", "result"], [document()["chart"]["result"][0]] * 2), "ambiguous_chart_results"),
    (changed(["chart", "result"], None), "ambiguous_chart_results"),
    (changed(["chart", "error"], {"code": "x"}), "chart_error_or_missing"),
    ('{"other": 1}', "chart_error_or_missing"),
    ("[1]", "chart_error_or_missing"),
    (changed([*QUOTE, 0, "open"], [10]), "chart_array_length_mismatch"),
    (changed([*QUOTE, 0, "low"], None), "chart_array_length_mismatch"),
    (changed(QUOTE, []), "ambiguous_chart_indicators"),
    (changed([*RESULT, "timestamp"], [PERIOD1, PERIOD1]), "invalid_chart_timestamps"),
    (changed([*RESULT, "timestamp"], [True, PERIOD1]), "invalid_chart_timestamps"),
    (changed([*RESULT, "timestamp"], [PERIOD1 + 0.5, PERIOD1]), "invalid_chart_timestamps"),
    (changed([*RESULT, "timestamp"], [None, PERIOD1]), "invalid_chart_timestamps"),
    (changed([*RESULT, "timestamp"], []), "invalid_chart_timestamps"),
    (changed([*RESULT, "timestamp"], [PERIOD1, PERIOD1 + 9 * 86400]), "chart_date_scope_or_duplicate"),
    (changed([*RESULT, "timestamp"], [PERIOD1, PERIOD1 + 60]), "chart_date_scope_or_duplicate"),
    (changed([*QUOTE, 0, "close"], ["11", 12]), "invalid_chart_cell_type"),
    (changed([*QUOTE, 0, "close"], [True, 12]), "invalid_chart_cell_type"),
    (changed([*QUOTE, 0, "close"], [11, 12]).replace("[11, 12]", "[1e999, 12]"), "invalid_chart_cell_type"),
    (changed([*QUOTE, 0, "close"], [float("nan"), 12]), "nonstandard_json_number"),
    (changed([*QUOTE, 0, "close"], [float("inf"), 12]), "nonstandard_json_number"),
    ("<html>busy</html>", "malformed_json"),
    (changed([*RESULT, "meta", "note"], "x" * 2_000_000), "chart_body_too_large"),
]


def documents(spark, *bodies):
    rows = [(i, "RELIANCE.NS", START, END, 200, body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "n int, symbol string, start date, end date, status_code int, body string")


def test_broken_documents_have_their_code(spark):
    bodies = [body for body, _ in BROKEN] + [json.dumps(document())]
    rows = charts.decode_charts(documents(spark, *bodies)).orderBy("n").collect()
    assert [row.chart_code for row in rows] == [code for _, code in BROKEN] + [None]
    assert all(row.sessions is None and row.body is None for row in rows[:-1])


def test_reconcile_source_with_adapter(spark):
    source = charts.chart_rows(charts.decode_charts(documents(spark, json.dumps(document()))))
    schema = "symbol string, start date, date date, open double, high double, low double, close double, adj_close double, volume double"
    rows = [
        ("RELIANCE.NS", START, date(2026, 9, 18), 10.0, 12.0, 9.0, 11.0, 11.0, 100.0),
        ("RELIANCE.NS", START, date(2026, 9, 21), 12.0, 14.0, 11.0, float("nan"), None, 200.0),
    ]

    def counts(table):
        compared = reconcile.reconcile_cells(source, spark.createDataFrame(table, schema))
        return {r.classification: r.cells for r in reconcile.comparison_counts(compared).collect()}

    assert counts(rows) == {"agree": 10, "missing_in_source_and_frame": 2}
    moved = [rows[0], (*rows[1][:2], date(2026, 9, 19), *rows[1][3:])]
    assert counts(moved) == {"agree": 6, "source_only_date": 1, "adapter_only_date": 1}
    odd = [(*rows[0][:3], 99.0, None, *rows[0][5:]), (*rows[1][:6], 5.0, *rows[1][7:])]
    assert counts(odd) == {"value_changed": 1, "adapter_only_missing": 1, "source_missing_adapter_changed": 1,
                           "missing_in_source_and_frame": 1, "agree": 8}
    infinite = reconcile.reconcile_cells(source, spark.createDataFrame([(*rows[0][:3], float("inf"), *rows[0][4:])], schema))
    assert reconcile.nonfinite_frames(infinite).count() == 1


def test_adapter_frame_gate(spark):
    schema = "symbol string, start date, ts timestamp_ntz, open double, high double, low double, close double, adj_close double, volume double"
    from datetime import datetime
    one, two = datetime(2026, 9, 18), datetime(2026, 9, 18, 1)

    def error(*stamps):
        rows = [("A", START, stamp, *[1.0] * 6) for stamp in stamps]
        return reconcile.adapter_frame_errors(spark.createDataFrame(rows, schema)).first().adapter_error

    assert error(one) is None
    assert error(one, one) == "ambiguous_adapter_frame"
    assert error(one, None) == "ambiguous_adapter_frame"
    assert error(one, two) == "duplicate_adapter_dates"


def test_adapter_frames_by_their_days(spark):
    from datetime import datetime, timedelta

    first = datetime(1969, 10, 20)
    days = [first + timedelta(days=n) for n in range(150)]
    frames = {
        "whole": days, "copy": [*days, days[70]], "hours": [*days, days[149] + timedelta(hours=1)], "undated": [*days[:3], None],
        None: days[:2], "none": [None, None],
    }
    schema = "symbol string, ts timestamp_ntz, open double, high double, low double, close double, adj_close double, volume double"
    table = spark.createDataFrame([(k, ts, *[1.0] * 6) for k, stamps in frames.items() for ts in stamps], schema)
    errors = reconcile.adapter_frame_errors(table, keys=["symbol"])
    assert {r.symbol: (r.adapter_rows, r.adapter_error) for r in errors.collect()} == {
        "whole": (150, None), "copy": (151, "ambiguous_adapter_frame"), "hours": (151, "duplicate_adapter_dates"),
        "undated": (4, "ambiguous_adapter_frame"), None: (2, None), "none": (2, "ambiguous_adapter_frame"),
    }
    # of the instants only those with copies are aggregated any further
    assert "Filter (__copies" in errors._jdf.queryExecution().optimizedPlan().toString()


def test_window_and_request(spark):
    days = spark.createDataFrame([(START, END), (START, START), (START, date(2026, 9, 29))], "start date, end date")
    rows = days.select(local_midnight_epoch(F.col("start")).alias("e"), is_valid_window(F.col("start"), F.col("end")).alias("v")).collect()
    assert rows[0].e == PERIOD1 and [r.v for r in rows] == [True, False, False]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        epochs = days.select(local_midnight_epoch(F.col("start")).alias("e"), local_day(F.lit(PERIOD1)).alias("d"),
                             local_day(F.lit(PERIOD1 - 1)).alias("before")).first()
        assert epochs.e == PERIOD1 and (epochs.d, epochs.before) == (START, date(2026, 9, 17))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    scopes = charts.request_scopes(spark.createDataFrame([("RELIANCE.NS", START, END)], "symbol string, start date, end date"))
    good = {"period1": str(PERIOD1), "period2": str(PERIOD1 + 4 * 86400), "interval": "1d"}
    base = "query1.finance.yahoo.com/v8/finance/chart/RELIANCE.NS"
    log = [
        ("https://" + base, good), ("http://" + base, good), ("https://" + base.replace("query1", "query3"), good),
        ("https://" + base, {**good, "interval": "1h"}), ("https://" + base, {**good, "period1": "1"}),
        ("https://" + base + "X", good), ("https://" + base, None), ("not a url", good),
        ("https://" + base.replace("query1", "query2"), {**good, "other": "x"}),
    ]
    matched = charts.match_requests(spark.createDataFrame(log, "url string, params map<string,string>"), scopes)
    assert sorted(r.url for r in matched.collect()) == sorted([log[0][0], log[-1][0]])


def test_repeated_requests_meet_their_scopes(spark):
    rows = [("A.NS", START, END, 1), ("A.NS", START, END, 2), ("B.NS", START, END, 3), ("C.NS", START, END, 4), (None, START, END, 5)]
    scopes = charts.request_scopes(spark.createDataFrame(rows, "symbol string, start date, end date, scope int"))
    good = {"period1": str(PERIOD1), "period2": str(PERIOD1 + 4 * 86400), "interval": "1d"}
    base = "https://query1.finance.yahoo.com/v8/finance/chart/"
    log = [
        *[(base + "A.NS", good)] * 3, (base + "B.NS?range=/v8/finance/chart/A.NS", good), (base + "B.NS#/v8/finance/chart/", good),
        (base + "/v8/finance/chart/C.NS", good), (base + "C.NS", {**good, "period1": "0" + good["period1"]}),
        ("https://example.com/?u=" + base + "C.NS", good), (base + "C .NS", good), (base, good), (None, good),
    ]
    fetches = spark.createDataFrame(log, "url string, params map<string,string>")
    for hot_rows in (1, 2, 100):
        matched = charts.match_requests(fetches, scopes, hot_rows=hot_rows)
        assert matched.columns == ["url", "params", *scopes.columns]
        assert sorted(r.scope for r in matched.collect()) == [1] * 3 + [2] * 3 + [3] * 2


def test_only_valid_bodies_are_kept(spark):
    docs = documents(spark, json.dumps(document()), "<html>").withColumn(
        "status_code", F.when(F.col("n") == 1, 503).otherwise(F.col("status_code"))
    )
    rows = charts.keep_valid_bodies(charts.decode_charts(docs)).orderBy("n").collect()
    assert rows[0].body and rows[1].body is None and rows[1].chart_code is None


GOOD = {"symbol": "RELIANCE.NS", "longName": "Fixture issuer", "marketCap": 1000000, "currency": "INR",
        "financialCurrency": "INR", "trailingPE": 20.0}


def gate(spark, *bodies):
    table = spark.createDataFrame([(i, "RELIANCE.NS", b) for i, b in enumerate(bodies)], "n int, symbol string, body string")
    return snapshots.snapshot_gate(snapshots.parse_snapshots(table))


def test_snapshot_gate(spark):
    cases = [(json.dumps(GOOD), None)]
    cases += [(json.dumps({**GOOD, "marketCap": cap}), "no_valid_market_cap")
              for cap in (None, "N/A", "1000", 0, -10, True)]
    cases += [(json.dumps({**GOOD, "marketCap": cap}), "issuer_identity_mismatch") for cap in (float("nan"), float("inf"))]
    cases += [(json.dumps({**GOOD, "marketCap": 1}).replace(": 1,", ": 1e999,"), "no_valid_market_cap")]
    cases += [("{}", "issuer_identity_mismatch"), ("null", "issuer_identity_mismatch"), ("[]", "issuer_identity_mismatch"),
              (json.dumps({**GOOD, "symbol": "TCS.NS"}), "issuer_identity_mismatch"),
              (json.dumps({**GOOD, "currency": "USD"}), "currency_not_verified"),
              (json.dumps({**GOOD, "currency": None}), "currency_not_verified")]
    rows = gate(spark, *[body for body, _ in cases]).orderBy("n").collect()
    assert [row.fault for row in rows] == [fault for _, fault in cases]
    table = snapshots.snapshot_table(gate(spark, json.dumps(GOOD)), provider_version="1", retrieved_at_utc="t")
    row = table.first()
    assert len(table.columns) == 23 and row.symbol == "RELIANCE" and row.market_cap == 1000000.0
    assert row.pe_ratio == 20.0 and row.sector is None and row["52_week_high"] is None


def test_response_shape_has_no_values(spark):
    table = spark.createDataFrame(
        [("RELIANCE.NS", '{"symbol":"RELIANCE.NS","currency":"INR"}'), ("TCS.NS", "[1]")], "symbol string, body string"
    )
    rows = {r.requested_symbol: r for r in snapshots.response_shape(snapshots.parse_snapshots(table)).collect()}
    shape = rows["RELIANCE.NS"]
    assert (shape.payload_type, shape.field_count, shape.fields) == ("object", 2, ["currency", "symbol"])
    assert (shape.market_cap_present, shape.market_cap_type, shape.symbol_matches) == (False, None, True)
    assert rows["TCS.NS"].payload_type == "array" and rows["TCS.NS"].fields == []


def test_listings(spark):
    body = '{"Table":[{"Scrip Code":500325,"Scrip Name":"X","Group":"A","Status":"Active","ISIN":"I"},{"Scrip Code":"2"}]}'
    table = spark.createDataFrame([(body,), ("{}",), ("<html>",)], "body string")
    rows = listings.flatten_listings(table).orderBy("code").collect()
    assert [tuple(r) for r in rows] == [("2", None, None, None, None), ("500325", "X", "A", "Active", "I")]
    counted = listings.count_actions(spark.createDataFrame([("[1,2,3]",), ("[]",)], "body string"))
    assert sorted(r.actions for r in counted.collect()) == [0, 3]


HTML = (
    "<table><tr><th>h</th></tr><tr><td> A </td><td>Dividend</td><td>2024-01-02</td></tr><tr><td>B</td><td>Split</td>"
    "<td>2024-02-03</td><td>2:1</td></tr><tr><td>x</td><td>y</td></tr></table>"
)


@pytest.mark.parametrize("html, expected", [
    (HTML, [("A", "Dividend", "2024-01-02", "N/A"), ("B", "Split", "2024-02-03", "2:1")]),
    ("<p>no table", []),
    ("<table><tr><td>1<td>2<td>3</table>", []),
    # A cell that is not closed holds the next one: three cells, the first with both texts.
    ("<table><tr></tr><tr><td>A&amp;B<br>C<td><b>t</b></td></td><td>d</td></tr></table>", [("A&BCt", "t", "d", "N/A")]),
    ("<table><tr></tr><tr><td>A&amp;B<br/>C</td><td><b>t</b><script>s</script></td><td>d<!-- c --></td></tr></table>",
     [("A&BC", "t", "d", "N/A")]),
    ("<TABLE><TR><TR><TD>a</TD><TD>b</TD><TD>c</TD></TR></TABLE>", [("a", "b", "c", "N/A")]),
    ("<table><tr></tr><tr><td>o<table><tr></tr><tr><td>1</td><td>2</td><td>3</td></tr></table></td></tr></table>",
     [("o123", "1", "2", "3"), ("1", "2", "3", "N/A"), ("1", "2", "3", "N/A")]),
])
def test_html_tables(html, expected):
    assert actions.actions_of(html) == expected


def test_actions_over_pages(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "<p>"), (3, HTML.upper())], "page_id bigint, html string")
    rows = actions.with_ex_day(actions.extract_actions(pages, "page_id")).orderBy("page_id", "symbol").collect()
    assert [(r.page_id, r.symbol, r.value) for r in rows] == [(1, "A", "N/A"), (1, "B", "2:1"), (3, "A", "N/A"), (3, "B", "2:1")]
    assert rows[0].ex_day == date(2024, 1, 2)


def test_valid_documents_are_read_by_schema(spark):
    """Only documents that break a rule, or whose symbol could be a number, are walked part by part."""
    numeric = changed([*RESULT, "meta", "symbol"], 5)
    whole = changed([*QUOTE, 0, "open"], [1e15, 0.1234567890123456789])
    oddities = [json.dumps(document()).replace('"', "'"), json.dumps(document()).replace('{"chart"', '{"chart": 1, "chart"')]
    docs = documents(spark, *[body for body, _ in BROKEN], *oddities, whole, json.dumps(document()))
    read = charts._read_by_schema(docs, "body").orderBy("n").collect()
    broken = len(BROKEN) + len(oddities)
    assert [row["__sessions"] is None for row in read] == [True] * broken + [False] * 2
    assert all(row["__json"] is None for row in read[broken:])
    assert [s["open"] for s in read[broken]["__sessions"]] == [1e15, 0.1234567890123456789]
    rows = charts.decode_charts(docs.where(f"n >= {len(BROKEN)}")).orderBy("n").collect()
    assert [row.chart_code for row in rows] == ["malformed_json"] * 2 + [None] * 2
    five = charts.decode_charts(documents(spark, numeric, numeric.replace('"symbol": 5', '"symbol": 5.0')).withColumn("symbol", F.lit("5")))
    assert [row.chart_code for row in five.orderBy("n").collect()] == [None, None]


def test_sides_meet_as_in_an_outer_join(spark):
    days = [None, START, date(2026, 9, 19), date(2026, 9, 20)]
    draw = random.Random(5)

    def rows(n):
        return [(draw.choice(["A", "B", "C", None]), draw.choice([START, None]), draw.choice(days), float(i)) for i in range(n)]

    for n, m in ((40, 60), (3, 60), (60, 3), (0, 20), (20, 0)):
        source = spark.createDataFrame(rows(n), "symbol string, start date, date date, v double")
        adapter = spark.createDataFrame(rows(m), "symbol string, start date, date date, v double")
        source = source.select("symbol", "start", "date", *[F.col("v").alias(name) for name in fv.CHART_FIELDS])
        adapter = adapter.select("symbol", "start", "date", *[F.col("v").alias(name) for name in reconcile.ADAPTER_COLUMNS.values()])
        keys = ["symbol", "start", "date"]
        joined = source.select(*keys, F.col("open").alias("s")).join(adapter.select(*keys, F.col("open").alias("a")), keys, "full_outer")
        known = set(map(tuple, source.select("symbol", "start").distinct().collect()))
        kept = [row for row in joined.collect() if (row.symbol, row.start) in known and row.date is not None]
        classes = {(False, False): "both", (False, True): "source_only_date", (True, False): "adapter_only_date"}
        for known_only, want in ((False, joined.collect()), (True, kept)):
            want = [(r.symbol, r.start, r.date, r.s, r.a, classes[r.s is None, r.a is None]) for r in want]
            seen = reconcile.reconcile_dates(source, adapter, known_only=known_only).collect()
            assert sorted(map(tuple, seen), key=str) == sorted(((*w[:3], w[5]) for w in want), key=str)
            cells = reconcile.reconcile_cells(source, adapter, known_only=known_only).where("field = 'open'")
            pairs = cells.select(*keys, "source_value", "adapter_value").collect()
            assert sorted(map(tuple, pairs), key=str) == sorted((w[:5] for w in want if w[5] == "both"), key=str)


def test_sides_whose_frames_are_together_are_not_moved(spark):
    keys = list(reconcile.SCOPE_KEYS)
    source = spark.createDataFrame([("A", START, START, 1.0)], "symbol string, start date, date date, v double")
    source = source.select(*keys, "date", *[F.col("v").alias(name) for name in fv.CHART_FIELDS]).repartition(*keys)
    adapter = source.select(*keys, "date", *[F.col(f).alias(c) for f, c in reconcile.ADAPTER_COLUMNS.items()]).repartition(*keys)
    counted = reconcile.comparison_counts(reconcile.reconcile_cells(source, adapter, known_only=True), keys=keys)
    plan = spark.createDataFrame([("A", START)], "symbol string, start date").repartition(*keys).join(counted, keys, "left")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    assert plan.select("classification", "cells").collect() == [("agree", 6)]
