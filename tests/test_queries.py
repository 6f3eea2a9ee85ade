"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest
from compare import connect, difference

from barledger.operators import reconcile
from barledger.plans import views
from barledger.plans.oracle import ORACLES
from barledger.plans.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no tables")
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, connection, name):
    fault, _ = difference(REGISTRY[name](spark, SF_DIR), ORACLES[name], connection)
    assert fault is None


def test_clean_rows_keeps_kinds_of_missing_apart(spark, tmp_path):
    path = f"{tmp_path}/lineitem.parquet"
    duckdb.sql(
        "COPY (SELECT n AS l_orderkey, 1 AS l_partkey, 2 AS l_suppkey, 1 AS l_linenumber, q AS l_quantity, 9.0 AS l_extendedprice, "
        "0.0 AS l_discount, 0.0 AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP '1995-01-02' AS l_shipdate "
        f"FROM (VALUES (1, 'NaN'::DOUBLE), (2, NULL), (3, 'NaN'), (4, NULL), (5, 7)) t(n, q)) TO '{path}' (FORMAT parquet)"
    )
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{path}'")
    assert difference(REGISTRY["clean_rows"](spark, str(tmp_path)), ORACLES["clean_rows"], connection) == (None, 3)


def test_probe_decodes_its_documents_once(spark):
    plan = REGISTRY["boundary_probe"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan.lower() and "parsejson" not in plan.lower()


def test_gate_reads_the_lines_once_for_each_check(spark):
    plan = REGISTRY["artifact_gate"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 5


def test_scopes_are_built_once(spark):
    plan = REGISTRY["request_match"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_suppkey" not in plan


def moved(frame):
    """Shuffles that ran, and how often one of them was read again."""
    frame.collect()
    ran = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moves = ["ReusedExchange" in line for line in ran.splitlines() if "Exchange hashpartitioning" in line]
    return len(moves) - sum(moves), sum(moves)


def test_probe_moves_its_lines_once(spark):
    shuffles, again = moved(REGISTRY["boundary_probe"](spark, SF_DIR))
    # the lines, the scopes twice, the responses, the sessions
    assert shuffles <= 5 and again >= 3


def test_bars_of_a_window_stay_together(spark):
    bars = views.chart_bars(spark, SF_DIR)
    assert moved(bars.groupBy("symbol", "start").count()) == (1, 0)
    assert moved(reconcile.adapter_frame_errors(views.adapter_bars(spark, SF_DIR))) == (1, 1)


def test_landed_lines_move_once_to_their_header(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        # the lines and the headers
        assert moved(REGISTRY["landed_cells"](spark, SF_DIR)) == (2, 0)
    finally:
        for name in names:
            spark.conf.unset(name)


def test_numbered_lines_of_odd_rows(spark, tmp_path):
    """Every file has its header and its rows in order; rows in no file have their headers too."""
    path = f"{tmp_path}/lineitem.parquet"
    duckdb.sql(
        "COPY (SELECT n % 3 AS l_orderkey, n AS l_partkey, CASE WHEN n % 4 > 0 THEN n % 2 END AS l_suppkey, 1 AS l_linenumber, "
        "1.0 AS l_quantity, 9.0 AS l_extendedprice, 0.0 AS l_discount, 0.0 AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, "
        "CASE WHEN n % 5 > 0 THEN TIMESTAMP '1995-01-02' + to_months((n % 2)::INTEGER) END AS l_shipdate "
        f"FROM range(40) t(n)) TO '{path}' (FORMAT parquet)"
    )
    lines = views.landed_price_lines(spark, str(tmp_path)).collect()
    files = {}
    for row in lines:
        files.setdefault(row.file, []).append(row)
    assert set(files) == {None, "/landing/1995-02/S1.NS.csv", "/landing/1995-01/S0.NS.csv"}
    for file, rows in files.items():
        heads = [(row.name, row.line) for row in rows if row.row_position == -1]
        body = sorted((row for row in rows if row.row_position >= 0), key=lambda row: row.row_position)
        assert [row.row_position for row in body] == list(range(len(body)))
        assert len(heads) == len(set(heads)) == (1 if file else 3)
        assert {row.name for row in rows} == ({file.rsplit("/", 1)[-1]} if file else {None, "S0.NS.csv", "S1.NS.csv"})
    assert len(lines) == 40 + 1 + 1 + 3
