"""Toxicity by the nearest labelled examples.

Examples are a bounded, documented sample of the labelled rows. The vector space is that of all their words: every document
becomes the sparse TF-IDF vector of its words in it (document frequencies over all documents) and is compared with the
examples by exact cosine. Words that the examples' classes use more differently than chance explains among so many words
weigh more; no word is left out. An inverted index holds for each term its postings and the largest weight in each block
of examples. A document's blocks with the largest bounds are scored first; others are scored only if their bound reaches
the nearest examples found. Votes weighted by similarity are calibrated on the examples themselves, each without its own;
there an example counts for all labelled rows of its class.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.llm.bytework import PLAIN_WORDS, Texts, U64, Words, bounded, mixed, worker_cache
from barledger.llm.calibration import calibrated, isotonic
from barledger.llm.near_dedup import shingle_sets
from barledger.llm.shared import bound_batches, remainder, stored

#: Examples of each class at most: a bounded sample of the labelled rows, chosen by a hash of their ids.
EXAMPLES = 2000
#: Words in more than one of so many examples have a column of a dense table; the others have postings.
DENSE = 24
COPY_MARKS = 4
NEIGHBOURS = 15
#: Words of the documents that are compared at a time.
ENTRIES = 100_000
BLOCK = 64
EVIDENCE = 3
BINS = 200
#: Weight of the prior share that is spread over the bins before calibration, in rows.
PRIOR_ROWS = 2.0
MODULUS, HELD = 4, 2
THRESHOLD = 0.3


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word hashes of each text with the text's index and their counts, in order of text."""
    texts = Texts(column, lower=True)
    words = Words(texts, PLAIN_WORDS)
    order = np.lexsort((words.hashes, words.doc))
    doc, term = words.doc[order], words.hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])])) if len(doc) else order
    return term[first], doc[first], np.diff(np.concatenate([first, [len(doc)]]))


def without_copies(rows: DataFrame) -> DataFrame:
    """rows (doc_id, label, text) without near copies of a row with the same label and a smaller id.

    Copies of one toxic text would make its harmless words look toxic. Rows that agree in one of COPY_MARKS smallest
    hashes of five-word shingles are compared with the first of them, on their full sets; 0.8 makes a copy.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def mark(batches):
        for batch in bounded(batches, 2):
            sets, counts = shingle_sets(batch.column(2), 5)
            ends = np.cumsum(counts).astype(np.int32)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(sets.view(np.int64)))
            full = np.flatnonzero(counts)
            low = np.zeros((batch.num_rows, COPY_MARKS), dtype=U64)
            for j in range(COPY_MARKS if len(full) else 0):
                hashed = mixed(sets ^ mixed(np.full(1, j + 1, dtype=U64)))
                low[full, j] = mixed(np.minimum.reduceat(hashed, (ends - counts)[full]) + U64(j))
            marks = [low[i].view(np.int64).tolist() if counts[i] else [] for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists, pa.array(marks, pa.list_(pa.int64()))],
                ["doc_id", "label", "shingles", "marks"],
            )

    sets = stored(
        rows.select("doc_id", "label", "text").mapInArrow(
            mark, f"doc_id {kind}, label int, shingles array<bigint>, marks array<bigint>"
        ),
        "sets",
    )
    marked = sets.select("doc_id", "label", F.explode("marks").alias("mark"))
    first = marked.groupBy("label", "mark").agg(F.min("doc_id").alias("first"))
    pairs = marked.join(first, ["label", "mark"]).where("doc_id > first").select("doc_id", "first").distinct()
    one = sets.select("doc_id", F.col("shingles").alias("mine"))
    other = sets.select(F.col("doc_id").alias("first"), F.col("shingles").alias("theirs"))
    shared = F.size(F.array_intersect("mine", "theirs"))
    close = shared * 10 >= (F.size("mine") + F.size("theirs") - shared) * 8
    copies = pairs.join(one, "doc_id").join(other, "first").where(close).select("doc_id").distinct()
    return stored(rows.join(copies, "doc_id", "left_anti"), "examples")


def example_rows(docs: DataFrame, labels: DataFrame, label_col: str, examples: int) -> tuple[DataFrame, dict[int, float]]:
    """doc_id, label and text of the sample, a text once; and how many labelled rows stand behind an example of a class.

    Equal texts are one example with the smallest id and the label of their majority, ties toxic.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy("doc_id").agg(
        (F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("label")
    )
    known = stored(known, "labels")
    order = F.xxhash64("doc_id", F.lit(7))
    parts = [known.where(F.col("label") == c).orderBy(order, "doc_id").limit(examples) for c in (0, 1)]
    chosen = stored(parts[0].unionByName(parts[1]), "chosen")
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy(F.sha2("text", 256).alias("digest")).agg(
        F.min("doc_id").alias("doc_id"), (F.avg("label") >= 0.5).cast("int").alias("label"), F.any_value("text").alias("text")
    )
    rows = without_copies(stored(texts.select("doc_id", "label", "text"), "texts"))
    total = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    have = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    return rows, {c: total.get(c, 0) / max(have.get(c, 0), 1) for c in (0, 1)}


def example_terms(examples: DataFrame) -> tuple[list, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Ids, labels, word hashes and their counts of the examples, in order of id: the bounded sample comes to the driver."""
    kind = examples.schema["doc_id"].dataType.simpleString()

    def find(batches):
        for batch in bounded(batches, 2):
            term, doc, count = text_terms(batch.column(2))
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (term.view(np.int64), count.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], ["doc_id", "label", "terms", "times"])

    found = examples.select("doc_id", "label", "text").mapInArrow(
        find, f"doc_id {kind}, label int, terms array<bigint>, times array<int>"
    ).toPandas()
    found = found.sort_values("doc_id", kind="stable")
    return (
        found["doc_id"].tolist(), found["label"].to_numpy(dtype=np.int64),
        [np.array(x, dtype=np.int64).view(U64) for x in found["terms"]], [np.array(x, dtype=np.int64) for x in found["times"]],
    )


def class_gain(at: list[np.ndarray], label: np.ndarray, terms: int) -> np.ndarray:
    """For each term 1, and more if its use differs between the classes by more than the largest of so many chance values.

    The difference is in standard errors (the root of chi-square of its two by two table); the largest of n normal values
    is about the root of 2 ln n.
    """
    n, p = float(len(label)), float(label.sum())
    if not 0 < p < n:
        return np.ones(terms)
    where = np.concatenate([*at, np.zeros(0, np.int64)]).astype(np.int64)
    have = np.bincount(where, minlength=terms).astype(float)
    toxic = np.bincount(where, np.repeat(label, [len(a) for a in at]), terms)
    spread = have * (n - have) * p * (n - p)
    error = np.zeros(terms)
    np.divide(np.abs(toxic * n - have * p) * np.sqrt(n), np.sqrt(spread), out=error, where=spread > 0)
    return 1 + np.maximum(error - np.sqrt(2 * np.log(max(terms, 2))), 0)


def term_rows(docs: DataFrame, terms: np.ndarray, keep: list[str]) -> DataFrame:
    """The kept columns, and for each text the indices of its words among `terms` (sorted hashes) and their counts."""
    shared = by_value(docs.sparkSession, terms)

    def find(batches):
        terms = received(shared)
        for batch in bounded(batches, 0):
            term, doc, count = text_terms(batch.column(0))
            at = np.searchsorted(terms, term)
            known = at < len(terms)
            known[known] = terms[at[known]] == term[known]
            at, doc, count = at[known], doc[known], count[known]
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (at, count)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *lists], [*keep, "at", "times"])

    kinds = [f"{name} {docs.schema[name].dataType.simpleString()}" for name in keep]
    return docs.select("text", *keep).mapInArrow(find, ", ".join([*kinds, "at array<int>", "times array<int>"]))


def document_frequencies(rows: DataFrame, terms: int) -> np.ndarray:
    """How many rows have each term, counted in every task before they are added up."""

    def count(batches):
        total = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    summed = rows.select("at").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms)
    for row in summed.toLocalIterator():
        out[row["term"]] = row["n"]
    return out


class Vectors:
    """Unit vectors of a batch: `doc`, `term` and `weight` of their entries, (1 + ln tf) times the term's weight, scaled."""

    def __init__(self, counts: np.ndarray, term: np.ndarray, times: np.ndarray, weights: np.ndarray):
        self.n = len(counts)
        self.doc = np.repeat(np.arange(self.n), counts)
        self.term = term.astype(np.int64)
        weight = (1 + np.log(times)) * weights[self.term]
        norm = np.sqrt(np.bincount(self.doc, weight * weight, self.n))
        self.weight = weight / np.maximum(norm, 1e-12)[self.doc]

    @classmethod
    def of_lists(cls, at: pa.ListArray, times: pa.ListArray, weights: np.ndarray) -> Vectors:
        counts = pa.compute.fill_null(pa.compute.list_value_length(at), 0).to_numpy()
        return cls(counts, at.flatten().to_numpy(), times.flatten().to_numpy(), weights)


def by_entries(batches, lists: int, most: int = ENTRIES):
    """The record batches, cut so that the lists of a column have at most so many entries together, or are one."""
    for batch in batches:
        ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(batch.column(lists)), 0).to_numpy())
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + most, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all the given ranges, one after the other."""
    out = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return out + np.arange(len(out))


class BlockMaxIndex:
    """Postings of the examples' unit vectors, with each term's largest weight in each block of examples.

    Terms of many examples have a column in a dense table instead of postings, and their block maxima in another.
    """

    def __init__(self, vectors: Vectors, terms: int):
        self.n = vectors.n
        self.blocks = max(-(-self.n // BLOCK), 1)
        self.order = self.arranged(vectors)
        place = np.empty(self.n, dtype=np.int64)
        place[self.order] = np.arange(self.n)
        where, term, weight = place[vectors.doc], vectors.term, vectors.weight
        have = np.bincount(term, minlength=terms)
        common = np.flatnonzero(have * DENSE > self.n)
        self.column = np.full(terms, -1, dtype=np.int64)
        self.column[common] = np.arange(len(common))
        dense = self.column[term] >= 0
        self.table = np.zeros((self.blocks * BLOCK, len(common)))
        self.table[where[dense], self.column[term[dense]]] = weight[dense]
        self.table_best = self.table.reshape(self.blocks, BLOCK, -1).max(axis=1).T
        by = np.lexsort((where[~dense], term[~dense]))
        term, self.where, self.weight = term[~dense][by], where[~dense][by], weight[~dense][by]
        block = self.where // BLOCK
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else term
        self.block, self.start = block[new], new
        self.count = np.diff(np.append(new, len(term)))
        self.best = np.maximum.reduceat(self.weight, new) if len(new) else self.weight
        self.first = np.searchsorted(term[new], np.arange(terms + 1))

    @staticmethod
    def arranged(vectors: Vectors) -> np.ndarray:
        """Similar examples in one block: in order of their heaviest terms."""
        by = np.lexsort((vectors.term, -vectors.weight, vectors.doc))
        starts = np.searchsorted(vectors.doc[by], np.arange(vectors.n + 1))
        lead = [tuple(vectors.term[by[a : min(a + 3, b)]]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        return np.array(sorted(range(vectors.n), key=lambda i: (lead[i], i)), dtype=np.int64)

    def nearest(self, vectors: Vectors, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the examples with the k largest cosines, ties by place in the index; -1 beyond positive ones."""
        n, width = vectors.n, self.blocks * BLOCK
        column = self.column[vectors.term]
        dense = column >= 0
        table = np.zeros((n, self.table.shape[1]))
        table[vectors.doc[dense], column[dense]] = vectors.weight[dense]
        rare = np.flatnonzero(~dense)
        counts = self.first[vectors.term[rare] + 1] - self.first[vectors.term[rare]]
        met = spans(self.first[vectors.term[rare]], counts)
        doc, weight = np.repeat(vectors.doc[rare], counts), np.repeat(vectors.weight[rare], counts)
        bound = np.bincount(doc * self.blocks + self.block[met], weight * self.best[met], n * self.blocks)
        bound = bound.reshape(n, self.blocks) + table @ self.table_best
        score = np.zeros((n, width))

        def fill(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)):
                rows = np.flatnonzero(wanted[:, b])
                score[rows, b * BLOCK : (b + 1) * BLOCK] += table[rows] @ self.table[b * BLOCK : (b + 1) * BLOCK].T
            mine = np.flatnonzero(wanted[doc, self.block[met]])
            postings = spans(self.start[met[mine]], self.count[met[mine]])
            times = self.count[met[mine]]
            cell = np.repeat(doc[mine], times) * width + self.where[postings]
            score.reshape(-1)[:] += np.bincount(cell, np.repeat(weight[mine], times) * self.weight[postings], n * width)

        take = min(-(-2 * k // BLOCK) + 1, self.blocks)
        wanted = np.zeros((n, self.blocks), dtype=bool)
        np.put_along_axis(wanted, np.argpartition(-bound, take - 1, axis=1)[:, :take], True, axis=1)
        fill(wanted)
        k = min(k, width)
        least = np.partition(score, width - k, axis=1)[:, width - k]
        # rounding must not hide a block that could hold a tie
        fill(~wanted & (bound > 0) & (bound >= least[:, None] - 1e-9))
        least = np.partition(score, width - k, axis=1)[:, width - k]
        near, cosine = np.full((n, k), -1, dtype=np.int64), np.zeros((n, k))
        row, place = np.nonzero((score >= least[:, None]) & (score > 0))
        by = np.lexsort((place, -score[row, place], row))
        row, place = row[by], place[by]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, place, rank = row[rank < k], place[rank < k], rank[rank < k]
        near[row, rank], cosine[row, rank] = self.order[place], score[row, place]
        return near, cosine


def remade(kind: type, given: tuple, points: tuple) -> Voters:
    voters = kind(*given)
    voters.points = points
    return voters


class Voters:
    """The index, the examples' labels and weights, and the calibration."""

    def __init__(
        self, ids: list, label: np.ndarray, behind: dict[int, float], counts: np.ndarray, at: np.ndarray, times: np.ndarray,
        weights: np.ndarray,
    ):
        self.given = ids, label, behind, counts, at.astype(np.int32), times.astype(np.int32), weights
        self.ids, self.label, self.weights = ids, label, weights
        vectors = Vectors(counts, at, times, weights)
        self.stand = np.array([behind[int(c)] for c in label]) if len(label) else np.zeros(0)
        self.index = BlockMaxIndex(vectors, len(weights)) if len(vectors.term) else None
        self.points = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
        none = np.bincount(vectors.doc, minlength=len(label)) == 0
        weight, toxic = self.stand[none].sum(), (self.stand * label)[none].sum()
        share = (self.stand * label).sum() / self.stand.sum() if len(label) else 0.5
        #: Of texts without any word of the examples: the share among examples without words.
        self.alone = float((toxic + PRIOR_ROWS * share) / (weight + PRIOR_ROWS))

    def __reduce__(self):
        """Examples travel as counts of words; the index is made again from them."""
        return remade, (type(self), self.given, self.points)

    def votes(self, vectors: Vectors, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The weighted share of toxic neighbours (nan without any), and the nearest examples and cosines of each vector."""
        if self.index is None:
            return np.full(vectors.n, np.nan), np.full((vectors.n, 1), -1), np.zeros((vectors.n, 1))
        near, cosine = self.index.nearest(vectors, NEIGHBOURS + (without is not None))
        if without is not None:
            cosine = np.where(near == without[:, None], 0, cosine)
            last = (cosine > 0).sum(axis=1) > NEIGHBOURS  # its own example was not among them
            cosine[last, -1] = 0
        weight = np.where(cosine > 0, cosine / (1.05 - np.minimum(cosine, 1)), 0)
        total = weight.sum(axis=1)
        share = np.full(vectors.n, np.nan)
        np.divide((weight * self.label[near]).sum(axis=1), total, out=share, where=total > 0)
        return share, np.where(cosine > 0, near, -1), cosine


def by_value(spark: SparkSession, value):
    """A broadcast that workers without this package can read; the examples bound its size."""
    return spark.sparkContext.broadcast(zlib.compress(cloudpickle.dumps(value), 1))


def received(shared):
    """What by_value() sent, made once in each worker."""
    kept = worker_cache("toxicity")
    key = zlib.crc32(shared.value)
    if key not in kept:
        kept.clear()
        kept[key] = cloudpickle.loads(zlib.decompress(shared.value))
    return kept[key]


def calibrate(spark: SparkSession, voters: Voters, rows: DataFrame) -> None:
    """Isotonic points from votes of the other examples for each example."""
    shared = by_value(spark, voters)

    def vote(batches):
        known = received(shared)
        for batch in by_entries(batches, 1):
            vectors = Vectors.of_lists(batch.column(1), batch.column(2), known.weights)
            share, _, _ = known.votes(vectors, batch.column(0).to_numpy())
            found = np.where(np.isnan(share), -1, np.minimum(np.nan_to_num(share) * BINS, BINS - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column(0)], ["bin", "number"])

    votes = rows.select("number", "at", "times").mapInArrow(vote, "bin int, number int").toPandas()
    shared.destroy()
    votes = votes[votes["bin"] >= 0]
    number, at = votes["number"].to_numpy(), votes["bin"].to_numpy()
    stand, toxic = voters.stand[number], (voters.stand * voters.label)[number]
    share = voters.alone if not stand.sum() else toxic.sum() / stand.sum()
    weight = np.bincount(at, stand, BINS) + PRIOR_ROWS / BINS
    positive = np.bincount(at, toxic, BINS) + PRIOR_ROWS / BINS * share
    voters.points = isotonic((np.arange(BINS) + 0.5) / BINS, weight, positive)


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    modulus: int = MODULUS, held: int = HELD, threshold: float = THRESHOLD, examples: int = EXAMPLES,
) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (doc_id, similarity, label of the nearest examples) of each row.

    Learns from rows with a label whose crc32(doc_id as text) mod modulus is not `held`; labels of a document count by
    their majority, ties as toxic, and so do those of equal texts, which are one example. A document's vector has all its
    words that some example has. Null and empty texts, and texts without such a word, get the share of toxic rows among
    such examples. Equal cosines are in order of the index. Repeated rows are scored one by one; a null doc_id has no
    label and is not held out. Only the text makes the score. An empty table gives no rows; without labels every score
    is a half.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.where(remainder("doc_id", modulus) != held)
    sample, behind = example_rows(picked, known, label_col, examples)
    ids, label, hashes, times = example_terms(sample)
    terms = np.unique(np.concatenate([*hashes, np.zeros(0, dtype=U64)]))
    at = [np.searchsorted(terms, h) for h in hashes]
    rows = stored(term_rows(picked, terms, ["doc_id"]), "terms")
    total = rows.count()
    idf = np.log((1 + total) / (1 + document_frequencies(rows, len(terms)))) + 1
    weights = idf * class_gain(at, label, len(terms))
    flat = [np.concatenate([*x, np.zeros(0, dtype=np.int64)]) for x in (at, times)]
    voters = Voters(ids, label, behind, np.array([len(a) for a in at], dtype=np.int64), *flat, weights)
    if len(ids):
        again = spark.createDataFrame(
            [(i, a.tolist(), t.tolist()) for i, (a, t) in enumerate(zip(at, times, strict=True))],
            "number int, at array<int>, times array<int>",
        )
        calibrate(spark, voters, again)
    shared = by_value(spark, voters)
    kind = rows.schema["doc_id"].dataType
    evidence = f"array<struct<doc_id:{kind.simpleString()},similarity:double,label:int>>"

    def apply(batches):
        voters = received(shared)
        for batch in by_entries(batches, 1):
            share, near, cosine = voters.votes(Vectors.of_lists(batch.column(1), batch.column(2), voters.weights))
            found = np.where(np.isnan(share), voters.alone, calibrated(np.nan_to_num(share), voters.points))
            reasons = [
                [
                    {"doc_id": voters.ids[i], "similarity": min(c, 1.0), "label": int(voters.label[i])}
                    for i, c in zip(numbers, values, strict=True) if i >= 0
                ]
                for numbers, values in zip(near[:, :EVIDENCE].tolist(), cosine[:, :EVIDENCE].tolist(), strict=True)
            ]
            struct = pa.list_(pa.struct([
                ("doc_id", batch.schema.field(0).type), ("similarity", pa.float64()), ("label", pa.int32())
            ]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64()), pa.array(reasons, struct)], ["doc_id", "score", "evidence"]
            )

    scored = rows.mapInArrow(apply, f"doc_id {kind.simpleString()}, score double, evidence {evidence}")
    return scored.select(
        "doc_id", F.coalesce(remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence",
    )
