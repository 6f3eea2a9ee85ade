"""Ranks and running totals of keys that lie in many pieces."""

import random

import pytest

from barledger.operators import scans


def rows(spark, n=3000, hot=0.7):
    chance = random.Random(1)
    data = [(None if i % 50 == 0 else "hot" if chance.random() < hot else f"k{i % 9}", chance.choice([None, *range(40)]), i) for i in range(n)]
    return spark.createDataFrame(data, "key string, value int, id int"), data


@pytest.mark.parametrize("parts", [1, 8])
@pytest.mark.parametrize("descending", [(), ("value",)])
def test_ranks_of_a_hot_key(spark, parts, descending):
    frame, data = rows(spark)
    for keys in ([], ["key"]):
        got = scans.ranked(frame, keys, ["value", "id"], descending=descending, parts=parts).collect()
        assert len(got) == len(data)
        groups = {}
        for key, value, i in data:
            groups.setdefault(key if keys else 0, []).append((value is not None, value or 0, i))
        for key, values in groups.items():
            if descending:
                values.sort(key=lambda v: (not v[0], -v[1], v[2]))
            else:
                values.sort()
            mine = sorted((r.rank, r.id) for r in got if not keys or r.key == key)
            assert mine == [(n, v[2]) for n, v in enumerate(values)]


def test_ranks_of_ties_are_distinct(spark):
    frame = spark.range(500).selectExpr("1 AS key", "2 AS value")
    assert sorted(r.rank for r in scans.ranked(frame, ["key"], ["value"], parts=8).collect()) == list(range(500))
    assert scans.ranked(frame.limit(0), ["key"], ["value"]).collect() == []


@pytest.mark.parametrize("span", [1, 7, 4096])
def test_running_totals_over_spans(spark, span):
    chance = random.Random(2)
    data = [(k, p, chance.choice([None, *range(-9, 10)])) for k in ("a", "b", None) for p in random.Random(3).sample(range(-200, 200), 90)]
    frame = spark.createDataFrame(data, "key string, at int, value bigint")
    got = {(r.key, r.at): (r.total, r.parity) for r in scans.running(frame, ["key"], "at", {"total": "value"}, {"parity": "value"}, span).collect()}
    want = {}
    for key in ("a", "b", None):
        total = parity = 0
        for _, at, value in sorted(d for d in data if d[0] == key) if key else sorted((d for d in data if d[0] is None), key=lambda d: d[1]):
            total, parity = total + (value or 0), parity ^ (value or 0)
            want[key, at] = (total, parity)
    assert got == want
