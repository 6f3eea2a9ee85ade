"""Packing of documents into token sequences along a space-filling curve.

Texts become token ids once, in Arrow batches, and are stored. A document's ids, hashed into buckets, are projected to a
few dimensions; the cell of its point on a Hilbert curve is its key. Keys (without ids) are range-sorted, running token
counts along the curve give every document its place, and documents are cut where sequences end, so only the very last
sequence is padded.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import Texts, U64, Words, bounded, byte_table, mixed, worker_cache
from barledger.llm.shared import bound_batches, partitions, stored

SEQUENCE = 4096
END_ID = 2
DIMENSIONS = 4
BITS = 12
BUCKETS = 1024
#: Slots for chunks and pieces of a generation whose ids a worker remembers.
SLOTS, REMEMBERED = 1 << 21, 60_000
#: The rules of the tokenizers for which chunks may be encoded one by one: fixed values.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ],
}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Characters that neither NFC nor a neighbour changes; the pieces are SPLIT's for them in lower case.
LATIN = [chr(x) for x in (*range(0x21, 0x7F), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))]
CHUNKS = byte_table([0x20, 0x09, 0x0A, 0x0D])
PLAIN_CHUNK = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PLAIN_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+"
)

PIECES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
)


class Remembered(dict):
    """Values of a function by argument; of two generations the older one is forgotten when the newer is full."""

    def __init__(self, function):
        super().__init__()
        self.function, self.old = function, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.function(key)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class ChunkTable:
    """Ids of chunks by a 64-bit hash of their bytes: a hash table in arrays, emptied when it is two thirds full."""

    def __init__(self, kind: str):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, dtype=U64)
        self.starts = np.zeros(SLOTS, dtype=np.int64)
        self.counts = np.zeros(SLOTS, dtype=np.int32)
        self.pool = np.zeros(1 << 20, dtype=self.kind)
        self.used = self.held = 0

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, or the complement of the free slot where it belongs."""
        at = (hashes & U64(SLOTS - 1)).astype(np.int64)
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        while len(left):
            here = self.keys[at]
            found, free = here == hashes[left], here == 0
            out[left[found]] = at[found]
            out[left[free]] = ~at[free]
            on = ~(found | free)
            left, at = left[on], (at[on] + 1) & (SLOTS - 1)
        return out

    def add(self, hashes: np.ndarray, ids: list[bytes]) -> None:
        """Different hashes that are not in the table yet."""
        width = np.dtype(self.kind).itemsize
        counts = np.array([len(x) // width for x in ids], dtype=np.int32)
        more = np.frombuffer(b"".join(ids), dtype=self.kind)
        while self.used + len(more) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), dtype=self.kind)])
        self.pool[self.used : self.used + len(more)] = more
        starts = self.used + np.cumsum(counts) - counts
        self.used += len(more)
        self.held += len(ids)
        left = np.arange(len(hashes))
        while len(left):  # of several that want one free slot one gets it
            slot = ~self.slots(hashes[left])
            self.keys[slot] = hashes[left]
            mine = self.keys[slot] == hashes[left]
            self.starts[slot[mine]], self.counts[slot[mine]] = starts[left[mine]], counts[left[mine]]
            left = left[~mine]


class WordIds:
    """Ids of texts, the same as of each whole text.

    No token of a tokenizer with the rules below crosses white space, so chunks between white space are encoded once and
    remembered by hash; those of plain Latin letters and signs are cut by the tokenizer's own rule, and the pieces
    remembered. Texts with special tokens, and tokenizers with other rules, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() < 1 << 16 else "<u4"
        rules = json.loads(self.tokenizer.to_str())
        self.known = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(x): level.pre_tokenize_str(x)[0][0] for x in LATIN}
        ids = np.arange(self.tokenizer.get_vocab_size(), dtype=self.kind).tobytes()
        width = int(self.kind[-1])
        self.id_bytes = [ids[i : i + width] for i in range(0, len(ids), width)]
        self.pieces, self.table = Remembered(self.piece), ChunkTable(self.kind)

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def piece(self, piece: str) -> bytes:
        tokens = self.tokenizer.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))
        return b"".join([self.id_bytes[x.id] for x in tokens])

    def chunk(self, chunk: str) -> bytes:
        if not PLAIN_CHUNK.fullmatch(chunk):
            return self.encode(chunk)
        return b"".join(map(self.pieces.__getitem__, PLAIN_PIECES.findall(chunk.lower())))

    def texts(self, column: list[bytes | None], end_id: int) -> list[np.ndarray]:
        """The ids of each text, with the closing id."""
        whole = {i: text for i, text in enumerate(column) if text and (not self.known or b"<|" in text)}
        rest = [b"" if i in whole or not text else text.lower() if text.isascii() else text for i, text in enumerate(column)]
        out = self.joined(rest, end_id)
        end = np.array([end_id], dtype=self.kind)
        for i, text in whole.items():
            out[i] = np.concatenate([np.frombuffer(self.encode(text.decode()), dtype=self.kind), end])
        return out

    def chunk_ids(
        self, raw: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each chunk raw[start : end] has, and the ids; no more chunks than half the table's slots."""
        slots = self.table.slots(hashes)
        if (slots < 0).any():
            if self.table.held > SLOTS * 2 // 3 - len(slots):
                self.table.clear()
                slots = self.table.slots(hashes)
            missing = np.flatnonzero(slots < 0)
            new, first = np.unique(hashes[missing], return_index=True)
            spans = zip(starts[missing[first]].tolist(), ends[missing[first]].tolist(), strict=True)
            self.table.add(new, [self.chunk(raw[a:b].decode()) for a, b in spans])
            slots = self.table.slots(hashes)
        counts = self.table.counts[slots].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.table.starts[slots] - before[:-1], counts) + np.arange(before[-1])
        return counts, self.table.pool[at]

    def joined(self, column: list[bytes], end_id: int) -> list[np.ndarray]:
        texts = Texts(column)
        chunks = Words(texts, CHUNKS)
        hashes = chunks.hashes | U64(1)  # zero is a free slot
        raw = texts.bytes.tobytes()
        counts, ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=self.kind)]
        for low in range(0, len(hashes), SLOTS // 2):  # an emptied table has room for so many
            part = slice(low, low + SLOTS // 2)
            found = self.chunk_ids(raw, hashes[part], chunks.starts[part], chunks.ends[part])
            counts.append(found[0])
            ids.append(found[1])
        ids = np.concatenate(ids)
        before = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        cuts = before[chunks.first]
        out = np.full(len(ids) + texts.n, end_id, dtype=self.kind)
        out[np.arange(len(ids)) + np.repeat(np.arange(texts.n), np.diff(cuts))] = ids
        return np.split(out, (cuts[1:] + np.arange(1, texts.n + 1))[:-1]) if texts.n else []


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, once for each worker."""
    loaded = worker_cache("packing")
    if path not in loaded:
        loaded[path] = WordIds(path)
    return loaded[path]


def projection(dimensions: int = DIMENSIONS) -> np.ndarray:
    """Fixed pseudo-random normal numbers, one row for each bucket."""
    return np.random.default_rng(11).standard_normal((BUCKETS, dimensions)).astype(np.float32)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer points (one row each, `bits` bits a coordinate)."""
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    high = 1 << (bits - 1)
    q = high
    while q > 1:
        low = q - 1
        for i in range(len(axes)):
            inverted = (axes[i] & q) != 0
            swap = np.where(inverted, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(inverted, axes[0] ^ low, axes[0] ^ swap)
            axes[i] = axes[i] ^ swap
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(cells), dtype=np.int64)
    q = high
    while q > 1:
        turn = np.where((axes[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros(len(cells), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> bit) & 1)
    return key


def id_buckets() -> np.ndarray:
    """The bucket of each id below 2 ** 18."""
    known = worker_cache("packing")
    if "buckets" not in known:
        known["buckets"] = (mixed(np.arange(1 << 18, dtype=U64)) % U64(BUCKETS)).astype(np.int16)
    return known["buckets"]


def curve_keys(ids: list[np.ndarray], dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """The Hilbert key of each list of ids: hashed counts, dampened and normalised, projected, spread over the cells."""
    lengths = np.array([len(x) for x in ids])
    doc = np.repeat(np.arange(len(ids)), lengths)
    bucket = id_buckets()[np.concatenate(ids)].astype(np.int64)
    counts = np.log1p(np.bincount(doc * BUCKETS + bucket, minlength=len(ids) * BUCKETS).reshape(len(ids), BUCKETS))
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    points = counts.astype(np.float32) @ projection(dimensions)
    share = 1 / (1 + np.exp(-1.702 * points.astype(np.float64)))
    return hilbert_keys(np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """row_key, doc_id, curve_key, n_tokens, ids; row_key is unique even where doc_id is not."""
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def encode(batches):
        words = word_ids(tokenizer_path)
        width = np.dtype(words.kind).itemsize
        key = TaskContext.get().partitionId() << 40
        for batch in bounded(batches, 1):
            ids = words.texts(batch.column(1).cast(pa.binary()).to_pylist(), end_id)
            blobs = [x.tobytes() for x in ids]
            keys = curve_keys(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(key, key + len(blobs)), pa.int64()), batch.column(0), pa.array(keys, pa.int64()),
                    pa.array([len(blob) // width for blob in blobs], pa.int64()), pa.array(blobs, pa.binary()),
                    pa.array([width] * len(blobs), pa.int32()),
                ],
                ["row_key", "doc_id", "curve_key", "n_tokens", "ids", "width"],
            )
            key += len(blobs)

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        encode, f"row_key bigint, doc_id {kind}, curve_key bigint, n_tokens bigint, ids binary, width int"
    )


def places(keys: DataFrame) -> DataFrame:
    """row_key and the number of ids before the document along the curve (`place`).

    Equal keys follow doc_id and row_key, which are part of the range key, so that many copies of one document are dealt
    to many ranges. One number for each range comes to the driver.
    """

    def running(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(1).to_numpy(zero_copy_only=False)
            total = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.full(len(sizes), part), pa.int32()),
                    pa.array(before + total - sizes, pa.int64()), batch.column(1),
                ],
                ["row_key", "part", "inside", "n_tokens"],
            )
            before += int(total[-1]) if len(total) else 0

    order = ["curve_key", "doc_id", "row_key"]
    ranged = keys.select(*order, "n_tokens").repartitionByRange(partitions(keys.sparkSession), *order)
    ordered = ranged.sortWithinPartitions(*order).select("row_key", "n_tokens")
    placed = stored(ordered.mapInArrow(running, "row_key bigint, part int, inside bigint, n_tokens bigint"), "places")
    before, offsets = 0, {}
    for part, total in sorted(placed.groupBy("part").agg(F.sum("n_tokens")).toLocalIterator()):
        offsets[part] = before
        before += total
    if not offsets:
        return placed.select("row_key", F.col("inside").alias("place"))
    base = F.create_map(*(F.lit(x) for pair in offsets.items() for x in pair))
    return placed.select("row_key", (F.element_at(base, F.col("part")) + F.col("inside")).alias("place"))


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """doc_id and the columns PIECES, one row for each piece of a document; `ids` holds its ids, 32 bits each.

    Null and empty texts have the closing id alone. Repeated rows are packed one by one, equal keys by doc_id. Only the
    last sequence is shorter than `sequence`. Other columns of docs are not read. An empty table has no pieces.
    """
    tokens = stored(tokenized(docs, tokenizer_path, id_col, text_col, end_id), "tokens")
    # places has a row for each document, so it is never broadcast
    placed = tokens.select("row_key", "doc_id", "ids", "width").join(places(tokens).hint("merge"), "row_key")

    def cut(batches):
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in PIECE_NAMES}
            for doc_id, blob, width, place in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids = np.frombuffer(blob, dtype=f"<u{width}").astype("<u4")
                start = 0
                while start < len(ids):
                    at = place + start
                    piece = ids[start : start + sequence - at % sequence].tobytes()
                    length = len(piece) // 4
                    values = (doc_id, start, length, zlib.crc32(piece), len(ids), at // sequence, at % sequence, piece)
                    for name, value in zip(PIECE_NAMES, values, strict=True):
                        rows[name].append(value)
                    start += length
            arrays = [pa.array(rows["doc_id"], batch.schema.field(0).type)]
            arrays += [pa.array(rows[name], pa.int64()) for name in PIECE_NAMES[1:-1]]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(rows["ids"], pa.binary())], list(PIECE_NAMES))

    kind = docs.schema[id_col].dataType.simpleString()
    return placed.select("doc_id", "ids", "width", "place").mapInArrow(cut, f"doc_id {kind}, {PIECES}")


PIECE_NAMES = ("doc_id", *(x.split()[0] for x in PIECES.split(", ")))
