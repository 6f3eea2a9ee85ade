"""The URL filter against brute force, on clashing digests and odd rows."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from barledger.llm import url_filter

from .conftest import LOWER

RULES = [
    ("net/", "block"), ("example.net/en/", "allow"), ("Example.com/de/", "block"), ("org/fr/", "allow"), ("a.b.c/x", "allow"),
    ("c/x/yyy", "block"), ("b.c/x/é", "allow"), ("nopath.org", "block"), ("twice.io/", "allow"), ("twice.io/", "block"),
    (None, "block"), ("net/", None), ("net/zzz", "perhaps"),
]
URLS = [
    None, "", "no scheme.net/", "http://x.net", "http://x.net/", "HTTP://X.NeT/en/1", "https://m.example.net/en/5?x=1",
    "https://example.net/en", "https://notexample.net/en/", "http://example.com/de/1#top", "http://example.com/fr/1",
    "http://a.b.c/x/yyy", "http://b.c/x/éa", "http://c/x/yyy/z", "http://www.nopath.org", "http://nopath.org/any",
    "://net/", "a://b://c.net/", "http://twice.io/", "http://u:p@x.net:80/", "http://x.net./", "http://.net/",
    "http://" + "a." * 3000 + "net/", "http://x.net/" + "y" * 50_000, "http://x.net/a\nb?c", "ftp://x.org/fr/\n",
]


def brute(url, rules, otherwise):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:end].translate(LOWER), rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fit = []
    for rule, verdict in rules:
        if rule is None or verdict not in ("allow", "block"):
            continue
        cut = rule.find("/") if "/" in rule else len(rule)
        h, p = rule[:cut].translate(LOWER), rule[cut:]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len((h + p).encode()), len(h.encode()), verdict, h + p))
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else otherwise


def test_urls_against_brute_force(spark):
    rows = [(i, u, "rule", "x") for i, u in enumerate(URLS)] + [(None, "http://x.net/", "", None), (1, "http://x.net/", "", None)]
    pages = spark.createDataFrame(rows, "page_id int, url string, rule string, verdict string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    for otherwise in ("allow", "block"):
        got = sorted((tuple(r) for r in url_filter.judge(pages, rules, otherwise=otherwise).collect()), key=str)
        assert got == sorted(((r[0], *brute(r[1], RULES, otherwise)) for r in rows), key=str)
    assert url_filter.judge(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_many_rules_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "FILE_ENTRIES", 50)
    rules = [(f"h{i % 40}.org/p{i}/", "block" if i % 3 else "allow") for i in range(300)]
    urls = [(i, f"http://w.h{i % 45}.org/p{i % 330}/{i}") for i in range(2000)]
    pages = spark.createDataFrame(urls, "page_id int, url string")
    got = {tuple(r) for r in url_filter.judge(pages, spark.createDataFrame(rules, "rule string, verdict string")).collect()}
    assert got == {(i, *brute(u, rules, "allow")) for i, u in urls}
    assert len({g[3] for g in got}) > 100


def test_digests_are_those_of_spark_and_collisions_are_told_apart(spark, tmp_path):
    text = "example.net/é"
    digest = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert np.uint64(xxhash.xxh64_intdigest(text.encode(), url_filter.SEED)).view(np.int64) == digest
    rows = {
        "text": pa.array(["one", "two", "three"]), "digest": pa.array([7, 7, 7]), "lengths": pa.array([[], [1], [2, 3]]),
        "code": pa.array([1, 2, 0]), "host_bytes": pa.array([3, 3, 5]),
    }
    (tmp_path / "x").write_bytes(url_filter.packed(rows))
    mapped = url_filter.Mapped(str(tmp_path / "x"))
    found = mapped.find(np.array([7, 7, 7, 7, 8]), [b"three", b"two", b"four", b"one", b"one"])
    assert found.tolist() == [2, 1, -1, 0, -1]
