import random

import pytest
from pyspark.sql import functions as F

from barledger.operators import analytics
from barledger.operators.skew import attach_by_key, row_counts


def prices(spark, kind="double"):
    rng = random.Random(7)
    rows = []
    for symbol, size in [("HOT", 400), ("A", 30), ("B", 3)]:
        for day in range(size):
            value = None if rng.random() < 0.03 else rng.randrange(1, 10_000)
            rows.append((symbol, day, value if value is None or kind == "bigint" else value / 100))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, f"symbol string, date bigint, close {kind}")


def brute_mean(rows, span):
    want = {}
    for symbol in {row[0] for row in rows}:
        series = sorted((row[1], row[2]) for row in rows if row[0] == symbol)
        for i, (day, _) in enumerate(series):
            values = [value for _, value in series[max(0, i - span + 1): i + 1]]
            whole = len(values) == span and None not in values
            want[(symbol, day)] = sum(values) / span if whole else None
    return want


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_moving_average_against_brute_force(spark, kind):
    rows, table = prices(spark, kind)
    want = brute_mean(rows, 7)
    plain = analytics.moving_average(table, 7)
    split = analytics.moving_average_split(table, 7, block=16)
    tight = analytics.moving_average_split(table, 7, block=6)
    for result in (plain, split, tight):
        have = {(r.symbol, r.date): r.ma_7 for r in result.collect()}
        assert have.keys() == want.keys()
        for key, value in want.items():
            assert have[key] == (value if value is None else pytest.approx(value, rel=1e-12))


def test_attach_by_key_equals_a_plain_join(spark):
    rows = [("HOT", i % 3) for i in range(300)] + [("A", 1), ("B", 2), (None, 3), (None, 3)]
    table = spark.createDataFrame(rows, "k string, v bigint").repartition(5)
    facts = row_counts(table.where("k IS NOT NULL AND k <> 'B'"), ["k"], "n").withColumn("seen", F.col("n") * 10)
    want = sorted(table.join(facts.drop("n"), "k", "left").select("k", "v", "seen").collect(), key=str)
    for hot_rows in (0, 5, 1000):
        assert sorted(attach_by_key(table, facts, ["k"], "n", hot_rows).collect(), key=str) == want


def test_change_keeps_a_missing_end_missing(spark):
    table = spark.createDataFrame(
        [("A", 1, 100.0), ("A", 2, 110.0), ("B", 1, None), ("B", 2, 5.0), ("C", 1, 0.0), ("C", 2, 5.0),
         ("D", 1, float("nan")), ("D", 2, 1.0)], "symbol string, date int, close double")
    have = {r.symbol: r.change_pct for r in analytics.price_change(table).collect()}
    assert have == {"A": 10.0, "B": None, "C": None, "D": None}


def test_rankings_put_missing_last(spark):
    schema = "symbol string, market_cap double, pe_ratio double, dividend_yield double"
    rows = [("A", 1e9, 5.0, 1.0), ("B", float("nan"), float("nan"), 1.0), ("C", 2e9, None, 1.0), ("D", None, 2.0, 1.0), ("E", 1e9, 2.0, 1.0)]
    table = spark.createDataFrame(rows, schema)
    assert [r.symbol for r in analytics.top_market_cap(table, 4).collect()] == ["C", "A", "E", "B"]
    assert analytics.top_market_cap(table, 1).first().market_cap_billions == 2.0
    assert [r.symbol for r in analytics.lowest_ratio(table).collect()] == ["D", "E", "A"]
    grouped = analytics.top_per_group(table, ["dividend_yield"], "market_cap", 2)
    assert sorted(r.symbol for r in grouped.collect()) == ["A", "C"]


def test_first_symbols_follow_appearance(spark):
    table = spark.createDataFrame([("Z", 1), ("A", 2), ("Z", 3), ("B", 4)], "symbol string, n bigint")
    assert [r.symbol for r in analytics.first_symbols(table, "n", 2).collect()] == ["Z", "A"]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_one_key_and_day_may_hold_all_rows(spark, partitions):
    rows = [("A", 1, i, (i * 37) % 101) for i in range(3000)]
    table = spark.createDataFrame(rows, "symbol string, date int, trade int, close bigint").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        split = analytics.moving_average_split(table, 50, order=("date", "trade"), block=200)
        have = {r.trade: r.ma_50 for r in split.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert have == {i: None if i < 49 else sum(r[3] for r in rows[i - 49 : i + 1]) / 50 for i in range(3000)}
