"""Spelling variants: words one letter apart, grouped under a far commoner form.

Words are counted in Arrow batches and summed by Spark. Each word's bigrams are ordered from rare to common; its prefix is
the first three (and all that tie with the third), and two of them that don't overlap, the cheapest by dynamic programming
over their positions, are its pivots. One edit leaves a pivot whole: the left one with all before it, or the right one
with all behind it. That pivot then stands in the other word's prefix if the other word's third bigram is not rarer than
one's own. So the prefix bigrams of all words are indexed twice, by their place from the start with the letters up to them
and by their place from the end with the letters from them on; pivots probe these indexes, lengths differ by one at most,
and an exact edit distance confirms each pair inside the join.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import U64, Texts, bounded, mixed, release, worker_cache
from barledger.llm.shared import bound_batches, stored

LEAST_LETTERS = 6
LEAST_TIMES = 5
#: A word's form is at least so many times as frequent as the word.
FORM_TIMES = 5
#: Bigrams are told apart by so many bits of a hash, which bounds the table of their counts for any alphabet.
GRAM_BITS = 16
#: One edit destroys one of two disjoint bigrams, and two of three are disjoint.
PREFIX = 3
#: Runs up to so many bytes get their checksums by tables.
TABLE_BYTES = 64


def letter_runs(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of A-Z, a-z and U+00C0 to U+00FF (in UTF-8: C3 and the byte after it)."""
    table = np.zeros(256, dtype=bool)
    table[[*range(65, 91), *range(97, 123)]] = True
    lead = texts.bytes == 0xC3
    inside = table[texts.bytes] | lead
    inside[1:] |= lead[:-1]
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def shift_tables() -> np.ndarray:
    """By length and place of a byte in a crc32 value: what the value becomes if so many bytes follow, which is linear."""
    kept = worker_cache("spelling")
    if "shifts" not in kept:
        tables = np.zeros((TABLE_BYTES + 1, 4, 256), dtype=np.uint32)
        for length in range(TABLE_BYTES + 1):
            zeros = bytes(length)
            empty = zlib.crc32(zeros)
            for place in range(4):
                tables[length, place] = [zlib.crc32(zeros, b << (8 * place)) ^ empty for b in range(256)]
        kept["shifts"] = tables
    return kept["shifts"]


def joined_crc(before: np.ndarray, runs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of strings joined from a head, of which the crc32 is given, and a run of known crc32 and length."""
    tables = shift_tables()
    out = runs.copy()
    for place in range(4):
        out ^= tables[lengths, place, (before >> np.uint32(8 * place)) & np.uint32(255)]
    return out


def counted(ids: list[str | None], column: pa.Array, noise: int | None, least: int) -> Counter:
    """How often each word of the texts occurs."""
    texts = Texts(column, lower=True)
    starts, ends = letter_runs(texts)
    points = texts.count_before((texts.bytes & 0xC0) != 0x80)
    letters = points[ends] - points[starts]
    long = letters >= least
    starts, ends, letters = starts[long], ends[long], letters[long]
    codes, unique = pd.factorize(texts.hashes(starts, ends))
    first = np.zeros(len(unique), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    raw = texts.bytes.tobytes()
    words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    out: Counter = Counter()
    left = np.ones(len(codes), dtype=bool)
    if noise:
        heads = np.array([zlib.crc32(f"{i or ''}:".encode()) for i in ids], dtype=np.uint32)
        head = heads[np.searchsorted(texts.starts, starts, side="right") - 1]
        own = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        size = ends - starts
        h = joined_crc(head, own[codes], np.minimum(size, TABLE_BYTES))
        for at in np.flatnonzero(size > TABLE_BYTES):
            h[at] = zlib.crc32(words[codes[at]], int(head[at]))
        left = h % noise != 0
        for at in np.flatnonzero(~left & (letters > least)):
            word, cut = words[codes[at]].decode(), int(h[at]) % int(letters[at])
            out[word[:cut] + word[cut + 1 :]] += 1
    for word, n in zip(words, np.bincount(codes[left], minlength=len(words)).tolist(), strict=True):
        if n:
            out[word.decode()] += n
    return out


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None,
    least_letters: int = LEAST_LETTERS, least_times: int = LEAST_TIMES,
) -> DataFrame:
    """word, n: runs of letters in whole texts, A-Z in lower case, of at least so many code points and occurrences.

    With noise, let h be crc32 of `<id>:<run>`; where noise divides h, the run loses its code point h % length before it is
    counted. Null texts have no words, a null id counts as an empty one; repeated rows count again.
    """
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))

    def count(batches):
        release("packing")
        for batch in bounded(batches, 1):
            found = counted(batch.column(0).to_pylist(), batch.column(1), noise, least_letters)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"]
            )

    found = picked.mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


class Grams:
    """Bigrams of a batch of words: for each its word, its place, and the bytes of its two letters."""

    def __init__(self, words: pa.Array):
        self.texts = Texts(words)
        points = np.flatnonzero((self.texts.bytes & 0xC0) != 0x80)
        owner = np.searchsorted(self.texts.starts, points, side="right") - 1
        self.first = np.searchsorted(points, self.texts.starts[:-1])
        self.sizes = np.diff(np.append(self.first, len(points))) - 1  # without the line feed after each
        inner = np.zeros(len(points), dtype=bool)
        inner[:-2] = (owner[:-2] == owner[1:-1]) & (owner[:-2] == owner[2:])  # two letters, and more or the line feed
        at = np.flatnonzero(inner)
        self.word, self.place = owner[at], at - self.first[owner[at]]
        self.start, self.end = points[at], points[at + 2]
        self.code = (self.texts.hashes(self.start, self.end) >> U64(64 - GRAM_BITS)).astype(np.int64)


def gram_counts(words: DataFrame) -> np.ndarray:
    """Occurrences of each code of a bigram in the vocabulary; at most 2 ** GRAM_BITS rows come to the driver."""

    def count(batches):
        total = np.zeros(1 << GRAM_BITS, dtype=np.int64)
        for batch in bounded(batches, 0):
            total += np.bincount(Grams(batch.column(0)).code, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    summed = words.select("word").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << GRAM_BITS, dtype=np.int64)
    for row in summed.collect():
        out[row["code"]] = row["n"]
    return out


def pivots(places: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the two columns (places ascending) of the disjoint bigrams with the least total cost, left one first.

    best[i] is the cheapest single choice among the columns up to i, pair[i] the cheapest pair that ends at i.
    """
    n, width = places.shape
    rows = np.arange(n)
    total, left, right = np.full(n, np.inf), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i in range(1, width):
        best, which = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
        for k in range(i):
            better = (places[rows, i] - places[rows, k] >= 2) & (costs[:, k] < best)
            best[better], which[better] = costs[better, k], k
        better = best + costs[:, i] < total
        total[better], left[better], right[better] = (best + costs[:, i])[better], which[better], i
    return left, right


def keyed(words: pa.Array, counts: np.ndarray) -> list[np.ndarray]:
    """The index entries of a batch: word, key, whether it is a pivot's, rank of the word's third bigram, letters."""
    grams = Grams(words)
    ranks = np.empty(len(counts), dtype=np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    rank = ranks[grams.code]
    order = np.lexsort((grams.place, rank, grams.word))
    n = grams.texts.n
    first = np.searchsorted(grams.word[order], np.arange(n))
    able = np.diff(np.append(first, len(order))) >= PREFIX
    third = np.full(n, -1, dtype=np.int64)
    third[able] = rank[order[first[able] + PREFIX - 1]]
    three = np.sort(order[first[able][:, None] + np.arange(PREFIX)], axis=1)  # by place, as bigrams are in text order
    left, right = pivots(grams.place[three], counts[grams.code[three]].astype(np.float64))
    rows = np.arange(len(three))
    lefts, rights = three[rows, left], three[rows, right]
    inside = np.flatnonzero(rank <= third[grams.word])
    begin, end = grams.texts.starts[:-1], grams.texts.starts[1:] - 1
    head = lambda at: mixed(grams.texts.hashes(begin[grams.word[at]], grams.end[at]))
    tail = lambda at: mixed(grams.texts.hashes(grams.start[at], end[grams.word[at]]) + U64(1))
    word = np.concatenate([grams.word[lefts], grams.word[rights], grams.word[inside], grams.word[inside]])
    key = np.concatenate([head(lefts), tail(rights), head(inside), tail(inside)]).view(np.int64)
    pivot = np.arange(len(key)) < 2 * len(three)
    return [word, key, pivot, third[word], grams.sizes[word]]


def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n: both directions of every pair of words (word, n; at least four letters) one edit apart."""
    bound_batches(words.sparkSession, 1024)
    counts = gram_counts(words)

    def index(batches):
        release("packing")
        for batch in bounded(batches, 0):
            word, key, pivot, third, letters = keyed(batch.column(0), counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(word)), batch.column(1).take(pa.array(word)), pa.array(key), pa.array(pivot),
                    pa.array(third), pa.array(letters),
                ],
                ["word", "n", "key", "pivot", "third", "letters"],
            )

    entries = stored(
        words.select("word", "n").mapInArrow(
            index, "word string, n bigint, key bigint, pivot boolean, third bigint, letters bigint"
        ),
        "entries",
    )
    probes = entries.where("pivot").select("key", *(F.col(c).alias(f"p_{c}") for c in ("word", "n", "third", "letters")))
    apart = (
        (F.col("p_third") <= F.col("third")) & (F.abs(F.col("p_letters") - F.col("letters")) <= 1)
        & (F.col("p_word") != F.col("word")) & (F.levenshtein("p_word", "word", 1) == 1)
    )
    held = entries.where(~F.col("pivot")).drop("pivot")
    met = probes.join(held.withColumnRenamed("key", "at"), (F.col("key") == F.col("at")) & apart)
    sides = F.explode(F.array(
        F.struct(F.col("word"), F.col("p_word").alias("near"), F.col("p_n").alias("near_n")),
        F.struct(F.col("p_word").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    ))
    return met.select(sides.alias("s")).select("s.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form) followed to the last. Counts grow FORM_TIMES a step, so a few doublings do."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if not reached.join(further, "root", "left_semi").limit(1).count():
            return reached
        reached = stored(
            reached.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots"
        )


def variants(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words with their counts n.

    form is the commonest word one edit away (of equally common ones the first by code points) if it occurs at least
    `times` (2 or more) as often, else null; root is the last of the forms that follow each other, the word itself without one.
    """
    if times < 2:
        raise ValueError("times must be at least 2, or forms could follow each other in a circle")
    words = stored(words.select("word", "n"), "words")
    best = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    far = -F.col("best.less") >= F.col("n") * times
    found = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(found.where("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None) -> DataFrame:
    """variants() of the vocabulary() of docs. An empty table has no words; other columns are not read."""
    return variants(vocabulary(docs, id_col, text_col, noise))
