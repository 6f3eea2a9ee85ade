"""Each stage of the pipeline, and run(), against brute force on whole rows."""

import os

import pytest

import corpus_pipeline
from barledger.llm import quality_rules
from barledger.llm.queries import tokenizer_path
from barledger.llm.shared import stored

from .conftest import LOWER, PLAIN, SF_DIR
from .test_dedup import brute_groups
from .test_models import check_packing
from .test_scans import brute_secrets

REDACTED = "[redacted]"


def collected(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=lambda r: r[0])


def brute_clean(text, phrases):
    """text without the characters from a hit run's first to its last word."""
    found = list(PLAIN.finditer((text or "").translate(LOWER)))
    words = [m[0] for m in found]
    hit = [False] * len(words)
    for width, known in phrases.items():
        for i in range(len(words) - width + 1):
            if tuple(words[i : i + width]) in known:
                hit[i : i + width] = [True] * width
    out, at = [], 0
    for i in range(len(words)):
        if hit[i] and (i == 0 or not hit[i - 1]):
            out.append(text[at : found[i].start()])
        if hit[i] and (i + 1 == len(words) or not hit[i + 1]):
            at = found[i].end()
    return "".join([*out, text[at:]]) if text is not None else None


def brute_redact(text):
    spans = sorted((int(s.split(":")[1]), int(s.split(":")[2])) for s in brute_secrets(text)[4].split(",") if s)
    out, at = [], 0
    for start, stop in spans:
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, stop)
    return "".join([*out, text[at:]]) if spans else text


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage but the last, and the pieces of the last."""
    if not os.path.isdir(SF_DIR):
        pytest.skip("no tables")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = [collected(docs)]
    judged = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name)
        rows.append(collected(docs))
    return rows, judged, corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()


def test_quality_keeps_what_the_rules_keep(stages):
    rows, judged, _ = stages
    assert rows[1] == [r for r in rows[0] if r[0] in judged] and 0 < len(rows[1]) < len(rows[0])


def test_one_of_each_near_duplicate_group_stays(stages):
    rows, _, _ = stages
    groups = brute_groups([(r[0], r[1]) for r in rows[1]], 5, 80)
    assert rows[2] == [r for r in rows[1] if groups[r[0]][2]] and len(rows[2]) < len(rows[1])


def test_benchmark_passages_are_cut_out(spark, stages):
    rows, _, _ = stages
    phrases = {}
    for item in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        words = PLAIN.findall((item.text or "").translate(LOWER))
        width = min(10, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            phrases.setdefault(width, set()).add(tuple(words[i : i + width]))
    want = [(r[0], t := brute_clean(r[1], phrases), r[2], r[3], len(t)) for r in rows[2]]
    assert rows[3] == want and any(a[1] != b[1] for a, b in zip(rows[2], rows[3]))


def test_secrets_are_redacted(stages):
    rows, _, _ = stages
    assert rows[4] == [(r[0], t := brute_redact(r[1]), r[2], r[3], len(t)) for r in rows[3]]
    assert any(REDACTED in r[1] for r in rows[4])


def test_pieces_hold_the_last_texts(spark, stages):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    rows, _, pieces = stages
    texts = {r[0]: r[1] for r in rows[4]}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    check_packing(pieces, texts, tokenizer, 4096)
    check_packing(corpus_pipeline.run(spark, SF_DIR).collect(), texts, tokenizer, 4096)
