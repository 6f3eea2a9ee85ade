"""Words one edit apart against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barledger.llm import spelling

from .conftest import LOWER, ODD

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, noise, letters=6, times=5):
    found = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= letters and n >= times}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and a != b and one_edit(a, b):
                near[a].append(b)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return rows


def family(chance, letters, size):
    """Words within few edits of each other, so that many are one edit apart."""
    stem = "".join(chance.choice(letters) for _ in range(8))
    words = {stem}
    while len(words) < size:
        word = list(chance.choice(sorted(words)))
        at = chance.randrange(len(word))
        edit = chance.randrange(3)
        if edit == 0:
            word[at] = chance.choice(letters)
        elif edit == 1:
            word.insert(at, chance.choice(letters))
        elif len(word) > 6:
            del word[at]
        words.add("".join(word))
    return words


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "éßaü"])
def test_variants_against_brute_force(spark, letters):
    chance = random.Random(len(letters))
    words = set()
    for _ in range(4):
        words |= family(chance, letters, 120)
    words |= {letters[0] * n for n in range(6, 30)} | {"x" * 500, "x" * 501, "x" * 250 + "y" + "x" * 250}
    words = {w: chance.choice([5, 6, 30, 150, 800, 5000]) for w in sorted(words)}
    got = [tuple(r) for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n bigint")).collect()]
    assert len(got) == len(words) and set(got) == brute_variants(words)
    assert sum(r[4] for r in got) > 500


@pytest.mark.parametrize("noise", [None, 3])
def test_counts_of_odd_rows(spark, odd, noise):
    chance = random.Random(7)
    rows = [(i, " ".join(chance.choice(["Wordlike", "wördlike", "ÀÉÎÕÜß", "ab", "x" * 70, "sévère×÷"]) for _ in range(30))) for i in range(40)]
    rows += [(1000 + i, "Verylongruns" * 3000) for i in range(5)]
    both = odd.select("doc_id", "text", "n").union(spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, n int"))
    got = {r.word: r.n for r in spelling.vocabulary(both, noise=noise).collect()}
    assert got == brute_words([*ODD, *rows], noise)
    assert spelling.spelling_groups(odd.limit(0)).collect() == []


def test_groups_of_the_given_documents(spark, documents, texts):
    got = {tuple(r) for r in spelling.spelling_groups(documents, noise=199).collect()}
    assert got == brute_variants(brute_words(texts.items(), 199))


def test_pivots_are_the_cheapest_disjoint_pair():
    places = np.array([[0, 1, 2], [0, 2, 5], [3, 4, 6]])
    costs = np.array([[1.0, 0.0, 9.0], [5.0, 1.0, 2.0], [1.0, 4.0, 4.0]])
    left, right = spelling.pivots(places, costs)
    assert list(zip(left.tolist(), right.tolist())) == [(0, 2), (1, 2), (0, 2)]
