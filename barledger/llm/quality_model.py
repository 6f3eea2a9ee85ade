"""A quality classifier on document statistics.

Statistics of each text are computed once and stored. Random Fourier features of the standardised statistics approximate
a Gaussian kernel; every partition sums its part of the normal equations of a ridge regression over the labelled rows,
Spark adds the parts, and the driver solves a system of fixed size. Raw scores are calibrated by isotonic regression
over counts in bins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import SPACE_WORDS, Texts, U64, Words, bounded, mixed, repeated, sums_by
from barledger.llm.calibration import calibrated, isotonic
from barledger.llm.shared import bound_batches, remainder, stored

FEATURES = 192
#: Width of the kernel, in standard deviations of a statistic times the root of their number.
KERNEL_WIDTH = 1.0
RIDGE = 1e-3
BINS = 400
#: Raw scores are binned between these.
LOW, HIGH = -0.5, 1.5
#: Weight of the prior share that is spread over the bins before calibration, in rows.
PRIOR_ROWS = 2.0
MODULUS, HELD = 5, 0
THRESHOLD = 0.3
STATISTICS = (
    "log_words", "word_length", "long_words", "distinct_words", "top_word", "repeated_pairs", "upper", "digits", "signs",
    "stops", "marks", "line_words", "repeated_lines", "beyond_ascii", "capital_words", "signed_words",
)


def byte_flags(values: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(values, dtype=np.uint8)] = True
    return table


UPPER = byte_flags(bytes(range(65, 91)))
DIGITS = byte_flags(bytes(range(48, 58)))
SIGNS = byte_flags(b"#*$%&|<>{}[]~^_=+@\\/")
STOPS = byte_flags(b".,;:")
MARKS = byte_flags(b"!?")


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; an empty text's are zero."""
    texts = Texts(column)
    words = Words(texts, SPACE_WORDS)
    n = texts.n
    count = np.maximum(words.counts, 1)
    size = np.maximum(texts.lengths, 1)
    letters = (words.ends - words.starts).astype(np.float64)

    def share(table: np.ndarray) -> np.ndarray:
        return np.diff(texts.count_before(table[texts.bytes])[texts.starts]) / size

    with np.errstate(over="ignore"):
        keys = mixed(words.hashes + words.doc.astype(U64) * U64(0x9E3779B97F4A7C15))
        pairs = mixed(words.hashes[:-1] * U64(3) + words.hashes[1:]) if len(keys) else keys
        pair_doc = words.doc[:-1][words.doc[:-1] == words.doc[1:]] if len(keys) else words.doc
        pairs = pairs[words.doc[:-1] == words.doc[1:]] if len(keys) else pairs
        pairs = mixed(pairs + pair_doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(keys) else order
    times = np.diff(np.concatenate([first, [len(keys)]]))
    top = np.zeros(n)
    np.maximum.at(top, words.doc[order][first], times)
    distinct = np.bincount(words.doc[order][first], minlength=n)
    breaks = np.flatnonzero(texts.bytes == 10)
    line_starts = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks
    line_doc = np.searchsorted(texts.starts, line_starts, side="right") - 1
    full = np.searchsorted(words.starts, breaks) > np.searchsorted(words.starts, line_starts)
    lines = np.maximum(np.bincount(line_doc[full], minlength=n), 1)
    with np.errstate(over="ignore"):
        line_keys = mixed(texts.hashes(line_starts[full], breaks[full]) + line_doc[full].astype(U64) * U64(0xD6E8FEB86659FD93))
    upper, signs = texts.count_before(UPPER[texts.bytes]), texts.count_before(SIGNS[texts.bytes])
    capital = upper[words.ends] - upper[words.starts] >= 2
    signed = signs[words.ends] > signs[words.starts]
    beyond = np.diff(texts.count_before(texts.bytes >= 0x80)[texts.starts]) / size
    table = [
        np.log1p(words.counts), np.bincount(words.doc, letters, n) / count,
        sums_by(words.doc, letters > 12, n) / count, distinct / count, top / count,
        sums_by(pair_doc, repeated(pairs)[1], n) / count, share(UPPER), share(DIGITS), share(SIGNS), share(STOPS),
        share(MARKS), np.log1p(words.counts / lines), sums_by(line_doc[full], repeated(line_keys)[1], n) / lines, beyond,
        sums_by(words.doc, capital, n) / count, sums_by(words.doc, signed, n) / count,
    ]
    return np.stack(table, axis=1)


def statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the array `stats` of each row of docs."""
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def count(batches):
        for batch in bounded(batches, 1):
            if not batch.num_rows:
                continue
            table = text_statistics(batch.column(1))
            offsets = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
            stats = pa.ListArray.from_arrays(offsets, table.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["doc_id", "stats"])

    return picked.mapInArrow(count, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy()[column.offsets[0].as_py():].reshape(len(column), -1)


class Fourier:
    """Random Fourier features of standardised rows, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        draw = np.random.default_rng(5)
        self.mean, self.spread = mean, np.maximum(spread, 1e-6)
        width = KERNEL_WIDTH * np.sqrt(len(mean))
        self.weights = draw.standard_normal((len(mean), FEATURES)) / width
        self.phases = draw.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.spread, -8, 8)
        waves = np.sqrt(2 / FEATURES) * np.cos(scaled @ self.weights + self.phases)
        return np.concatenate([waves, np.ones((len(rows), 1))], axis=1)


def normal_equations(labelled: DataFrame, features: Fourier) -> tuple[np.ndarray, np.ndarray, float]:
    """The sums x xT, x y and the number of rows of labelled (stats, label): one row for each cell comes to the driver."""

    def part(batches):
        size = FEATURES + 2
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                rows = np.concatenate([features(matrix(batch.column(0))), batch.column(1).to_numpy()[:, None]], axis=1)
                total += rows.T @ rows
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "value"]
        )

    cells = labelled.select("stats", "label").mapInArrow(part, "i int, j int, value double")
    found = cells.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((FEATURES + 2, FEATURES + 2))
    total[found["i"], found["j"]] = found["value"]
    total = np.triu(total) + np.triu(total, 1).T
    return total[:-1, :-1], total[:-1, -1], total[-2, -2]


class Model:
    """Features, ridge weights and calibration points."""

    def __init__(self, features: Fourier | None, weights: np.ndarray | None, points: tuple[np.ndarray, np.ndarray]):
        self.features, self.weights, self.points = features, weights, points

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.zeros(len(rows)) if self.features is None else self.features(rows) @ self.weights

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return calibrated(self.raw(rows), self.points)


def fit(labelled: DataFrame) -> Model:
    """The model of labelled (stats, label between 0 and 1); without rows every score is a half."""
    size = len(STATISTICS)
    sums = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(F.col("stats")[i]).alias(f"mean{i}") for i in range(size)),
        *(F.stddev_pop(F.col("stats")[i]).alias(f"spread{i}") for i in range(size)),
    ).first()
    if not sums["n"]:
        return Model(None, None, isotonic(np.zeros(0), np.zeros(0), np.zeros(0)))
    features = Fourier(*(np.array([sums[f"{name}{i}"] for i in range(size)]) for name in ("mean", "spread")))
    squares, products, rows = normal_equations(labelled, features)
    weights = np.linalg.solve(squares + RIDGE * rows / FEATURES * np.eye(len(squares)), products)
    model = Model(features, weights, (np.zeros(1), np.zeros(1)))

    def binned(batches):
        for batch in batches:
            if batch.num_rows:
                share = (model.raw(matrix(batch.column(0))) - LOW) / (HIGH - LOW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.clip((share * BINS).astype(np.int32), 0, BINS - 1)), batch.column(1)], ["bin", "label"]
                )

    bins = labelled.select("stats", "label").mapInArrow(binned, "bin int, label double")
    found = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")).toPandas()
    n, positive = np.full(BINS, PRIOR_ROWS / BINS), np.full(BINS, PRIOR_ROWS / BINS * products[-1] / rows)
    n[found["bin"]] += found["n"]
    positive[found["bin"]] += found["positive"]
    centres = LOW + (np.arange(BINS) + 0.5) * (HIGH - LOW) / BINS
    model.points = isotonic(centres, n, positive)
    return model


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    modulus: int = MODULUS, held: int = HELD, threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of docs.

    Learns from rows with a label whose crc32(doc_id as text) mod modulus is not `held`; several labels of a document
    count as their mean. Null and empty texts have statistics of zero and are scored by them. Repeated rows are scored
    one by one; a null doc_id has no label and is not held out. Only the text makes the score. An empty table gives no
    rows; without labels every score is a half.
    """
    stats = stored(statistics(docs, id_col, text_col), "statistics")
    known = labels.where(F.col(label_col).isNotNull() & (remainder("doc_id", modulus) != held))
    known = known.groupBy("doc_id").agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    labelled = stored(stats.join(known, "doc_id").select("stats", "label"), "labelled")
    model = fit(labelled)

    def apply(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model(matrix(batch.column(1))), pa.float64())], ["doc_id", "score"]
                )

    kind = stats.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(apply, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", F.coalesce(remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
