"""Toxicity against brute-force nearest neighbours over all words."""

import zlib
from collections import Counter

import numpy as np
import pytest

from barledger.llm import toxicity
from barledger.llm.calibration import calibrated, isotonic

from .conftest import LOWER, PLAIN, SF_DIR, SPACED


def words(text):
    return Counter(PLAIN.findall((text or "").translate(LOWER)))


def shingles(text):
    found = SPACED.findall((text or "").translate(LOWER))
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} - {()}


def brute_examples(texts, labels):
    """One for each text, without near copies under the same label."""
    by_text = {}
    for doc, label in labels.items():
        if texts.get(doc) is not None and zlib.crc32(str(doc).encode()) % 4 != 2:
            by_text.setdefault(texts[doc], []).append((doc, label))
    rows = [(min(d for d, _ in v), int(np.mean([x for _, x in v]) >= 0.5), t) for t, v in by_text.items()]
    sets = {d: shingles(t) for d, _, t in rows}
    near = lambda a, b: 10 * len(a & b) >= 8 * len(a | b) > 0
    return sorted(
        (d, y, t) for d, y, t in rows if not any(e < d and y == z and near(sets[d], sets[e]) for e, z, _ in rows)
    )


def brute_scores(texts, labels):
    examples = brute_examples(texts, labels)
    y = np.array([x[1] for x in examples])
    counts = [words(t) for _, _, t in examples]
    terms = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(terms)}
    every = {d: words(t) for d, t in texts.items()}
    df = np.zeros(len(terms))
    for found in every.values():
        for t in found:
            if t in number:
                df[number[t]] += 1
    n, p = len(y), y.sum()
    have, toxic = np.zeros(len(terms)), np.zeros(len(terms))
    for found, label in zip(counts, y):
        for t in found:
            have[number[t]] += 1
            toxic[number[t]] += label
    with np.errstate(all="ignore"):
        error = np.abs(toxic * n - have * p) * np.sqrt(n) / np.sqrt(have * (n - have) * p * (n - p))
    gain = 1 + np.maximum(np.nan_to_num(error, posinf=0) - np.sqrt(2 * np.log(len(terms))), 0)
    weights = (np.log((1 + len(texts)) / (1 + df)) + 1) * gain

    def vector(found):
        out = np.zeros(len(terms))
        for t, k in found.items():
            if t in number:
                out[number[t]] = (1 + np.log(k)) * weights[number[t]]
        return out / max(np.linalg.norm(out), 1e-12)

    table = np.array([vector(c) for c in counts])
    of_class = Counter(label for doc, label in labels.items() if zlib.crc32(str(doc).encode()) % 4 != 2)
    stand = np.array([of_class[label] / max((y == label).sum(), 1) for label in y])

    def share(cosines):
        best = np.argsort(-cosines, kind="stable")[: toxicity.NEIGHBOURS]
        best = best[cosines[best] > 0]
        w = cosines[best] / (1.05 - np.minimum(cosines[best], 1))
        return (w * y[best]).sum() / w.sum() if len(best) else None

    own = []
    for i in range(len(y)):
        cosines = table @ table[i]
        cosines[i] = 0
        own.append(share(cosines))
    bins = toxicity.BINS
    weight, positive = np.zeros(bins), np.zeros(bins)
    for s, k, label in zip(own, stand, y):
        if s is not None:
            weight[min(int(s * bins), bins - 1)] += k
            positive[min(int(s * bins), bins - 1)] += k * label
    mean = sum(k * label for s, k, label in zip(own, stand, y) if s is not None) / weight.sum()
    points = isotonic((np.arange(bins) + 0.5) / bins, weight + toxicity.PRIOR_ROWS / bins, positive + toxicity.PRIOR_ROWS / bins * mean)
    scores = {}
    for doc, found in every.items():
        cosines = table @ vector(found)
        s = share(cosines)
        scores[doc] = None if s is None else float(calibrated(np.array([s]), points)[0]), np.sort(cosines)[::-1][:3]
    return scores, examples


def test_scores_and_evidence_of_all_documents(spark, documents, texts):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    want, examples = brute_scores(texts, known)
    got = {r.doc_id: r for r in toxicity.score(documents, labels).collect()}
    assert len(got) == len(texts) and any(y for _, y, _ in examples)
    for doc, (score, cosines) in want.items():
        found = [e["similarity"] for e in got[doc].evidence]
        assert np.allclose(found, cosines[: len(found)], atol=1e-9) and len(found) == (cosines > 1e-12).sum()
        if score is not None:
            assert abs(got[doc].score - score) < 1e-6
    for doc, _, _ in examples:  # each is its own nearest example
        assert got[doc].evidence[0]["similarity"] > 1 - 1e-9


def test_copies_of_examples_with_words_of_their_own_are_found(spark):
    texts = [(i, f"own{i}a own{i}b own{i}c shared words here") for i in range(40)]
    labels = [(i, int(i % 2 == 0)) for i in range(40)]
    copies = [(1000 + i, t.upper()) for i, t in texts]
    docs = spark.createDataFrame(texts + copies, "doc_id bigint, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    for i, _ in texts:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            nearest = got[1000 + i].evidence[0]
            assert (nearest["doc_id"], nearest["label"]) == (i, int(i % 2 == 0)) and nearest["similarity"] > 1 - 1e-9


def test_equal_texts_and_near_copies_among_examples(spark):
    long = [f"w{i}" for i in range(60)]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(ids[0], " ".join(long), 0), (ids[1], " ".join(long), 1), (ids[2], " ".join(long), 1)]
    rows += [(ids[3], " ".join([*long, "more"]), 1), (ids[4], " ".join([*long, "other"]), 0), (ids[5], " ".join(long[:30] + ["x"] * 30), 1)]
    rows += [(ids[6], "", 1), (ids[7], None, 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    sample, _ = toxicity.example_rows(docs, labels, "toxic", 100)
    kept = {r.doc_id: r.label for r in sample.collect() if r.text}
    # equal texts are one toxic example, of which the next is a near copy; the clean one stays, and what is half alike
    assert kept == {ids[0]: 1, ids[4]: 0, ids[5]: 1}


@pytest.mark.parametrize("dense", [1, 24, 10**9])
def test_nearest_is_exact(monkeypatch, dense):
    monkeypatch.setattr(toxicity, "DENSE", dense)
    rng = np.random.default_rng(2)
    at = [np.sort(rng.choice(40, int(rng.integers(0, 8)), replace=False)) for _ in range(1000)]
    times = [rng.integers(1, 5, len(a)) for a in at]
    vectors = toxicity.Vectors(np.array([len(a) for a in at]), np.concatenate(at), np.concatenate(times), rng.uniform(1, 5, 40))
    index = toxicity.BlockMaxIndex(vectors, 40)
    table = np.zeros((1000, 40))
    table[vectors.doc, vectors.term] = vectors.weight
    near, cosine = index.nearest(vectors, 15)
    exact = table @ table.T
    for i in range(1000):
        want = np.sort(exact[i])[::-1][:15]
        assert np.allclose(cosine[i], np.where(want > 0, want, 0))
        assert np.allclose(exact[i][near[i][near[i] >= 0]], cosine[i][near[i] >= 0]) and len(set(near[i][near[i] >= 0])) == (near[i] >= 0).sum()
