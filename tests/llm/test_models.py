"""Packing, archives, both classifiers and the pipeline."""

import hashlib
import signal
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from barledger.llm import calibration, packing, quality_model, toxicity, warc
from barledger.llm.queries import tokenizer_path
from barledger.llm.shared import stored

from .conftest import ODD, SF_DIR


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def brute_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def check_packing(rows, texts, tokenizer, sequence):
    """Every id once, sequences without gaps, full but for the last."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = brute_ids(tokenizer, texts[doc]), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.offset + r.length <= sequence
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for number, pieces in by_sequence.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == sequence or number == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_packing_round_trip(documents, texts, tokenizer):
    check_packing(packing.pack(documents, tokenizer_path()).collect(), texts, tokenizer, 4096)


def test_packing_of_odd_rows(odd, tokenizer):
    rows = packing.pack(odd, tokenizer_path(), sequence=64).collect()
    assert sum(r.length for r in rows) == sum(len(brute_ids(tokenizer, t)) for _, t in ODD)
    single = {i: t for i, t in ODD if i not in (1,)}
    assert {r.doc_id: r.doc_tokens for r in rows if r.doc_id != 1} == {i: len(brute_ids(tokenizer, t)) for i, t in single.items()}
    assert packing.pack(odd.limit(0), tokenizer_path()).collect() == []


def test_words_encode_as_whole_texts(tokenizer):
    words = packing.WordIds(tokenizer_path())
    for text in ["it's we'll !'s ÀÉÖ ß÷× ª º don'T", "İstanbul ΣΑΣ ς é ẖ x\x1cy\x0bz\x85q", "a<|endoftext|>b <|ENDOFTEXT|>", "1234 12a!!", ""]:
        [ids] = words.texts([text.encode()], 2)
        assert ids.tolist() == brute_ids(tokenizer, text).tolist()
    words.table.held = 1 << 22  # full: emptied
    assert [x.tolist() for x in words.texts([None, b"new words", b""], 2)] == [[2], brute_ids(tokenizer, "new words").tolist(), [2]]


def test_text_with_more_chunks_than_the_table_has_slots(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SLOTS", 64)

    def stop(*_):
        raise TimeoutError("the table is full")

    before = signal.signal(signal.SIGALRM, stop)
    signal.alarm(20)
    try:
        column = ["a few words", " ".join(f"w{i}" for i in range(500)), "", "w1 w499 é other", " ".join(f"v{i % 90}" for i in range(300))]
        got = packing.WordIds(tokenizer_path()).texts([x.encode() for x in column], 2)
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)
    assert [x.tolist() for x in got] == [brute_ids(tokenizer, x).tolist() for x in column]


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_keys(grid, 3)
    walk = grid[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_archives_round_trip(spark, tmp_path):
    same = "<p>" + "same page " * 20 + "</p>"
    rows = [(7, "http://a/ü?q=1 2", same), (3, "http://b/\r\nX: y", same), (9, None, same), (4, "u", "tiny"), (5, "u", "tiny")]
    rows += [(20, "http://a/x%2Fy?q=100%25", None), (21, "http://a/%20 %", ""), (22, "", "nothing at the address"), (None, "u", same), (30, "u", "é" * 200_000)]
    rows += [(100 + i, f"http://c/{i}", f"<html>{i} " + "word " * (i % 50)) for i in range(200)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, size int").repartition(3)
    folder = f"file://{tmp_path}/archives"
    got = {r.page_id: r for r in warc.round_trip(pages, folder).collect()}
    assert len(got) == len(rows)
    first = {}
    for page, url, html in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (html or "").encode()
        original = first.setdefault(raw, page) if len(raw) >= 100 else page
        row = got[page]
        assert (row.payload_bytes, row.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest()) and row.url == (url or "")
        assert (row.record_type, row.refers_to) == (("response", None) if original == page else ("revisit", original))
    content = {r.page_id: r.payload for r in warc.read_archives(spark, folder).collect() if r.record_type == "response"}
    assert content["3"] == same.encode() and content["30"] == ("é" * 200_000).encode() and content["21"] == b""
    assert warc.round_trip(pages.limit(0), f"file://{tmp_path}/none").collect() == []


def test_isotonic_pools_violators():
    x, y = calibration.isotonic(np.array([0.0, 1, 2, 3]), np.ones(4), np.array([0, 1, 0, 1.0]))
    assert x.tolist() == [0, 1.5, 3] and y.tolist() == [0, 0.5, 1]
    assert calibration.calibrated(np.array([-1.0, 0.75, 9]), (x, y)).tolist() == [0, 0.25, 1]


def held_out(scored, labels, name):
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    return [(r.predicted, r.score, r[name]) for r in rows]


def labelled(spark):
    rng = np.random.default_rng(0)
    insults = ["scoundrel", "villain", "rascal", "knave"]
    rows = []
    for i in range(600):
        words = [f"w{x}" for x in rng.integers(0, 300, 60)]
        kind = i % 3
        if kind == 0:
            words[int(rng.integers(0, 59))], words[59] = rng.choice(insults, 2)
        if kind == 1:
            words = [w.upper() + "###" for w in words]
        rows.append((i, " ".join(words), int(kind == 0), int(kind != 1)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic", "quality")


def test_classifiers_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    for module, name in ((toxicity, "toxic"), (quality_model, "quality")):
        rows = held_out(stored(module.score(docs, labels)), labels, name)
        assert len(rows) > 80 and all(0 <= s <= 1 and p == int(s >= 0.3) for p, s, _ in rows)
        assert np.mean([p == y for p, _, y in rows]) > 0.97


@pytest.mark.parametrize("module,name", [(toxicity, "toxic"), (quality_model, "quality")])
def test_classifiers_on_odd_rows(spark, odd, module, name):
    labels = spark.createDataFrame([(8, 1), (8, 0), (20, 1), (22, None), (24, 0), (None, 1)], f"doc_id long, {name} int")
    for known in (labels, labels.limit(0)):
        rows = module.score(odd, known).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert module.score(odd.limit(0), labels).collect() == []


def test_statistics_of_empty_and_repeated_texts():
    rows = quality_model.text_statistics(pa.array(["", None, "a a a a", "A b\nA b\n"]))
    assert rows.shape == (4, len(quality_model.STATISTICS)) and not rows[:2].any() and np.isfinite(rows).all()
    assert rows[2][quality_model.STATISTICS.index("top_word")] == 1
    assert rows[3][quality_model.STATISTICS.index("repeated_lines")] == 0.5


def test_pipeline_stages(spark, documents, odd):
    for docs in (documents, odd, odd.limit(0)):
        docs = docs.select(*corpus_pipeline.COLUMNS)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stored(stage(spark, docs, SF_DIR), name)
            assert after.columns == list(corpus_pipeline.COLUMNS) and after.count() <= docs.count()
            if name in ("decontamination", "secret_scan"):
                assert after.count() == docs.count()
            docs = after
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_rows_are_dropped_by_their_own_verdict(spark):
    """Clean rows under a null or repeated id stay when another row of that id is rejected or a near copy."""
    clean = [" ".join(f"c{k}x{i}" for i in range(60)) for k in range(6)]
    near = clean[0] + " end"
    rows = [(0, clean[0]), (None, clean[1]), (None, "too short"), (None, None), (7, clean[2]), (7, ""), (7, near)]
    rows += [(7, clean[3]), (9, near), (8, clean[4]), (8, clean[4]), (None, clean[5])]
    docs = spark.createDataFrame(
        [(i, t, "en", None if k % 3 else "host", len(t or "")) for k, (i, t) in enumerate(rows)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    ).repartition(3)
    judged = stored(corpus_pipeline.quality(spark, docs, SF_DIR), "judged")
    order = lambda found: sorted(found, key=str)
    wanted = [(i, t) for i, t in rows if t and len(t.split()) >= 20]
    assert order(tuple(r) for r in judged.select("doc_id", "text").collect()) == order(wanted)
    left = corpus_pipeline.near_duplicates(spark, judged, SF_DIR).select("doc_id", "text").collect()
    assert order(tuple(r) for r in left) == order(x for x in wanted if x[1] != near)


def test_archives_of_repeated_and_empty_ids(spark, tmp_path):
    same = "<p>" + "same page " * 20 + "</p>"
    rows = [("", "u", same), ("", "u", same), ("b", "v", same), (None, "w", same), ("a", None, "x")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = sorted((r.page_id or "", r.page_id is None, r.url, r.record_type, r.refers_to) for r in warc.round_trip(pages, f"file://{tmp_path}/odd").collect())
    assert got == [
        ("", False, "u", "response", None), ("", False, "u", "response", None), ("", True, "w", "response", None),
        ("a", False, "", "response", None), ("b", False, "v", "revisit", ""),
    ]
