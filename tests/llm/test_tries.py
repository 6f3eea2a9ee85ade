"""The prefix trie of conversations against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from barledger.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, members int, alone boolean"


def brute_turns(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in found.items()}


def brute_rebuilt(own):
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    lender = {c: c - (abs(c) % 5) * (1 if c >= 0 else -1) for c in own}
    return {c: own.get(lender[c], [])[: heads[c]] + own[c][heads[c]:] for c in own}


def brute_trie(whole):
    members = defaultdict(list)
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in kids[node])
    rows = set()
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(whole[c]) == len(node)))
        rows.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]), leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, True) for r in rows], SCHEMA)


def result(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def odd_rows():
    chance = random.Random(5)
    rows = [
        (None, 1, "user", "nobody's"), (0, None, None, None), (0, 1, "user", "é😀"), (0, 1, "assistant", "tied"), (0, 1, "user", "é😀"),
        (-3, 5, "user", ""), (-1, 0, "a", "bc"), (-2, 0, "ab", "c"), (2**62, 1, "user", "x" * 100_000), (70, None, "user", "late"),
    ]
    stem = [("user" if i % 2 else "assistant", f"line {i}") for i in range(60)]
    for conv in range(1, 60):  # copies, prefixes of one another, branches within and at the ends of blocks, a caterpillar
        length = chance.choice([1, 7, 8, 9, 16, 17, 30, conv])
        turns = list(stem[:length])
        if conv % 3 == 0 and turns:
            turns[-1] = ("user", f"own {conv % 7}")
        rows += [(conv, i * 2, r, t) for i, (r, t) in enumerate(turns)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("borrow", [False, True])
def test_trie_against_brute_force(spark, borrow):
    rows = odd_rows()
    own = brute_turns(rows)
    got = result(prefix_trie.conversation_trie(table(spark, rows), borrow=borrow))
    assert got == brute_trie(brute_rebuilt(own) if borrow else own)
    assert any(r[3] > 10 and r[4] > 2 for r in got)


def test_long_conversation_and_copies_over_many_spans(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "END_BITS", 2)
    long = [(7, i, "user", str(i % 5)) for i in range(5000)]
    copies = [(c, i, "user", str(i % 5)) for c in range(20, 60) for i in range(11)]
    rows = long + copies
    got = result(prefix_trie.conversation_trie(table(spark, rows)))
    own = brute_turns(rows)
    want = {(r[0], r[1], r[2], r[3], r[4], r[5], r[6]): r[7] for r in brute_chain(own, 7)}
    assert {r[:7]: r[7] for r in got} == want


def brute_chain(own, long):
    """As brute_trie, for conversations that are all prefixes of one."""
    turns = own[long]
    below = 0
    rows = []
    for d in range(len(turns), -1, -1):
        convs = sorted(c for c, t in own.items() if len(t) >= d)
        ends = ",".join(str(c) for c in convs if len(own[c]) == d)
        below += (len(convs) - 1) * (len(turns[d - 1][1].encode()) if d else 0)
        up = min(c for c, t in own.items() if len(t) >= d - 1) if d else None
        rows.append((convs[0], d, up, len(convs), int(d < len(turns)), 1, below, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def test_empty_table(spark):
    assert prefix_trie.conversation_trie(table(spark, []), borrow=True).collect() == []
    only_null = table(spark, [(None, 1, "user", "x")])
    assert prefix_trie.conversation_trie(only_null).collect() == []
