"""Quality rules for documents and for the hosts they come from.

A text's signals are counted in Arrow batches. Failures of the document rules are then summed by host; a host's failure
rate is shrunk towards all hosts' by a beta prior fitted to the hosts' rates by moments, and a host whose shrunken rate
exceeds a limit is rejected with all its documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import (
    SPACE_WORDS, Texts, U64, Words, bounded, covered, mixed, release, repeated, sums_by, windows,
)
from barledger.llm.shared import bound_batches, join_small, stored

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
#: A host is rejected if its shrunken failure rate is above this.
HOST_LIMIT = 0.6
PRIOR_LEAST = 4.0
SYMBOLS = b"#*$%&|<>"
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_signals(column: pa.Array) -> dict[str, np.ndarray]:
    """The five counts for each text of a batch."""
    texts = Texts(column)
    words = Words(texts, SPACE_WORDS)
    n = texts.n
    points = texts.count_before((texts.bytes & 0xC0) != 0x80)
    symbols = texts.count_before(np.isin(texts.bytes, np.frombuffer(SYMBOLS, dtype=np.uint8)))
    breaks = np.flatnonzero(texts.bytes == 10)
    line_starts = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks
    line_doc = np.searchsorted(texts.starts, line_starts, side="right") - 1
    wordy = np.searchsorted(words.starts, breaks) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends, line_doc = line_starts[wordy], breaks[wordy], line_doc[wordy]
    with np.errstate(over="ignore"):
        line_key = mixed(texts.hashes(line_starts, line_ends) + line_doc.astype(U64) * U64(0xD6E8FEB86659FD93))
        window = windows(words.hashes, REPEAT_WINDOW)
        inside = words.doc[: len(window)] == words.doc[REPEAT_WINDOW - 1 :] if len(window) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        window_key = mixed(window[at] + words.doc[at].astype(U64) * U64(0xD6E8FEB86659FD93))
    again = covered(at[repeated(window_key)[0]], REPEAT_WINDOW, len(words.doc))
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": sums_by(words.doc, points[words.ends] - points[words.starts], n),
        "n_symbols": np.diff(symbols[texts.starts]),
        "n_dup_lines": sums_by(line_doc, repeated(line_key)[1], n),
        "n_repeat_words": sums_by(words.doc, again, n),
    }


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """id, host and the five counts of every document, as columns doc_id, host and SIGNALS."""
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))

    def count(batches):
        release("packing")
        for batch in bounded(batches, 2):
            found = text_signals(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(found[k], pa.int64()) for k in SIGNALS)],
                ["doc_id", "host", *SIGNALS],
            )

    types = {f.name: f.dataType.simpleString() for f in picked.schema}
    fields = [f"doc_id {types['doc_id']}", f"host {types['host']}", *(f"{k} bigint" for k in SIGNALS)]
    return picked.mapInArrow(count, ", ".join(fields))


def base_failure() -> Column:
    """Too few words, or too many in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """alpha and beta by moments over the hosts' rates, each host weighted by its documents.

    The prior has the weight of at least PRIOR_LEAST documents, so that a host of a few is not rejected for itself, and
    of at most 1000. One row comes to the driver. Without hosts the prior is uniform.
    """
    sums = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.count(F.lit(1)).alias("hosts")).first()
    if not sums["n"]:
        return 1.0, 1.0
    mean = min(max(sums["failed"] / sums["n"], 1e-4), 1 - 1e-4)
    gap = F.col("failed") / F.col("n") - F.lit(mean)
    variance = hosts.agg(F.sum(F.col("n") * gap * gap).alias("v")).first()["v"] / sums["n"]
    spread = mean * (1 - mean)
    between = max(variance - spread * sums["hosts"] / sums["n"], spread / 1001)
    weight = max(spread / between - 1, PRIOR_LEAST)
    return mean * weight, (1 - mean) * weight


def host_verdicts(judged: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, n, failed, host_rate (shrunken) and host_rejected for every host that is not null."""
    hosts = stored(
        judged.where("host IS NOT NULL").groupBy("host").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
        ),
        "hosts",
    )
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    return hosts.withColumn("host_rate", rate).withColumn("host_rejected", rate > F.lit(limit))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """doc_id, host, SIGNALS, base_failed, host_rate, kept: one row for each row of docs.

    Null and empty texts have no words and fail. A null host gives no host verdict. Repeated rows are judged one by one,
    each counting for its host. Other columns of docs are not read. An empty table gives an empty result.
    """
    judged = stored(signals(docs, id_col, text_col, host_col).withColumn("base_failed", base_failure()), "signals")
    verdicts = host_verdicts(judged, limit).select("host", "host_rate", "host_rejected")
    joined = join_small(judged, verdicts, ["host"], "left")
    kept = ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))
    return joined.select("doc_id", "host", *SIGNALS, "base_failed", "host_rate", kept.alias("kept"))
