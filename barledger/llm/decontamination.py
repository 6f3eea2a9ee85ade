"""Benchmark decontamination by an FM-index of each training shard.

A shard is some hundred thousand words of whole documents. Its suffixes are sorted by prefix doubling, the
Burrows-Wheeler transform is kept as a wavelet matrix with rank counts, and every SAMPLE-th text position is kept for
locating. Test phrases are searched backwards, all phrases of a block of items at once; occurrences are located and
merged to spans of words. The index is a table with one row for each shard, whatever the number of item blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import PLAIN_WORDS, Texts, U64, Words, bounded, covered, mixed, release, runs, windows
from barledger.llm.shared import bound_batches, join_small, stored

WINDOW = 10
SHARD_WORDS = 250_000
SAMPLE = 16
#: Bytes of item text that are searched for at once; items beyond it are searched in further blocks.
BLOCK_BYTES = 8 << 20
#: Phrases that are searched at a time.
CHUNK = 50_000
END, BREAK, FIRST = 0, 1, 2
PARTS = ("symbols", "bits", "zeros", "smaller", "marks", "samples", "starts")
INDEX = ", ".join(["shard string", "doc_ids array<{kind}>", "levels int", "size int", *(f"{p} binary" for p in PARTS)])


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of small non-negative integers in lexicographic order (a shorter one before a longer)."""
    n = len(text)
    width = max(int(text.max()) + 2, 2).bit_length()
    depth = max(1, 62 // width)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(depth, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for j in range(depth):
        key = (key << width) | padded[j : j + n]
    order = np.argsort(key)
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    slot_rank = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.zeros(n + 1, dtype=np.int64)  # 0 is the end of the text
    rank[order] = slot_rank + 1
    slots = np.arange(n)
    while True:
        alone = fresh & np.concatenate([fresh[1:], [True]])
        keep = ~alone
        slots, held = slots[keep], slot_rank[keep]
        if not len(slots):
            return order
        suffixes = order[slots]
        key = held * (n + 2) + rank[np.minimum(suffixes + depth, n)]
        within = np.argsort(key)
        suffixes, key, held = suffixes[within], key[within], held[within]
        order[slots] = suffixes
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        slot_rank = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[suffixes] = slot_rank + 1
        depth *= 2


def packed(flags: np.ndarray) -> np.ndarray:
    """Flags as 64-bit words, the first flag lowest."""
    whole = np.zeros(-(-len(flags) // 64) * 64 + 64, dtype=np.uint8)
    whole[: len(flags)] = flags
    return np.packbits(whole, bitorder="little").view(U64)


class Bits:
    """Counts of set flags before positions."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(U64)) & U64(1)).astype(bool)


def build_shard(hashes: list[np.ndarray], counts: np.ndarray) -> dict:
    """Index of documents given as word hashes; `counts` are the words of each document."""
    flat = np.concatenate(hashes) if hashes else np.zeros(0, dtype=U64)
    symbols, word_symbol = np.unique(flat, return_inverse=True)
    starts = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts + 1, out=starts[1:])
    text = np.full(starts[-1] + 1, BREAK, dtype=np.int64)
    text[-1] = END
    doc = np.repeat(np.arange(len(counts)), counts)
    text[np.arange(len(flat)) + doc] = word_symbol + FIRST
    order = suffix_order(text)
    last = text[order - 1]
    levels = max(1, int(len(symbols) + FIRST - 1).bit_length())
    rows, zeros, current = [], [], last
    for level in range(levels - 1, -1, -1):
        bit = ((current >> level) & 1).astype(bool)
        rows.append(packed(bit))
        zeros.append(len(bit) - int(bit.sum()))
        current = np.concatenate([current[~bit], current[bit]])
    smaller = np.zeros(len(symbols) + FIRST + 1, dtype=np.int64)
    np.cumsum(np.bincount(text, minlength=len(symbols) + FIRST), out=smaller[1:])
    marked = order % SAMPLE == 0
    return {
        "levels": levels, "size": len(text), "symbols": symbols, "bits": np.concatenate(rows),
        "zeros": np.array(zeros, dtype=np.int64), "smaller": smaller.astype(np.int32), "marks": packed(marked),
        "samples": order[marked].astype(np.int32), "starts": starts.astype(np.int32),
    }


class Shard:
    """A shard's index, as it is searched."""

    def __init__(self, row: dict):
        get = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.symbols, self.zeros = get("symbols", U64), get("zeros", np.int64)
        self.smaller = get("smaller", np.int32).astype(np.int64)
        self.samples, self.starts = get("samples", np.int32), get("starts", np.int32).astype(np.int64)
        self.levels, self.size = row["levels"], row["size"]
        self.bits = [Bits(x) for x in np.split(get("bits", U64), self.levels)]
        self.marks = Bits(get("marks", U64))

    def rank(self, symbol: np.ndarray, *ats: np.ndarray) -> list[np.ndarray]:
        """How often each symbol occurs before each position of the transform."""
        base, ats = np.zeros(len(symbol), dtype=np.int64), list(ats)
        for level, bits in enumerate(self.bits):
            one = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            for i, at in enumerate([base, *ats]):
                ones = bits.rank(at)
                moved = np.where(one, self.zeros[level] + ones, at - ones)
                if i:
                    ats[i - 1] = moved
                else:
                    base = moved
        return [at - base for at in ats]

    def symbol_at(self, at: np.ndarray) -> np.ndarray:
        """The transform's symbol at each position."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for level, bits in enumerate(self.bits):
            one, ones = bits.get(at), bits.rank(at)
            symbol = (symbol << 1) | one
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return symbol

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (a row of word hashes each) that occur: their index and range of rows."""
        none = np.zeros(0, dtype=np.int64)
        if not len(self.symbols):
            return none, none, none
        at = np.searchsorted(self.symbols, phrases)
        known = (at < len(self.symbols)) & (self.symbols[np.minimum(at, len(self.symbols) - 1)] == phrases)
        alive = np.flatnonzero(known.all(axis=1))
        symbols = at[alive] + FIRST
        low, high = np.zeros(len(alive), dtype=np.int64), np.full(len(alive), self.size, dtype=np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            symbol = symbols[:, j]
            low, high = self.rank(symbol, low, high)
            low, high = low + self.smaller[symbol], high + self.smaller[symbol]
            found = low < high
            alive, symbols, low, high = alive[found], symbols[found], low[found], high[found]
        return alive, low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """The text position of each row, by steps back to a sampled one."""
        out = np.zeros(len(row), dtype=np.int64)
        left, steps = np.arange(len(row)), 0
        while len(left):
            here = self.marks.get(row)
            done = left[here]
            out[done] = self.samples[self.marks.rank(row[here])] + steps
            left, row = left[~here], row[~here]
            if len(left):
                symbol = self.symbol_at(row)
                row = self.smaller[symbol] + self.rank(symbol, row)[0]
            steps += 1
        return out


def shards(batches):
    """Name, ids and index of each shard of whole documents in batches of (doc_id, text)."""
    release("packing")
    context = TaskContext.get()
    task, number = context.partitionId() if context else 0, 0
    ids, hashes, counts, size = [], [], [], 0
    for batch in bounded(batches, 1):
        texts = Texts(batch.column(1), lower=True)
        words = Words(texts, PLAIN_WORDS)
        at = 0
        while at < texts.n:  # as many documents as the shard still has room for, one at least
            room = words.first[at] + max(SHARD_WORDS - size, 0)
            to = max(int(np.searchsorted(words.first, room, side="right")) - 1, at + 1)
            ids.append(batch.column(0).slice(at, to - at))
            hashes.append(words.hashes[words.first[at] : words.first[to]])
            counts.append(words.counts[at:to])
            size += int(words.first[to] - words.first[at])
            at = to
            if size >= SHARD_WORDS or at < texts.n:
                yield f"{task}-{number}", pa.concat_arrays(ids), build_shard(hashes, np.concatenate(counts))
                number, ids, hashes, counts, size = number + 1, [], [], [], 0
    if ids:
        yield f"{task}-{number}", pa.concat_arrays(ids), build_shard(hashes, np.concatenate(counts))


def id_text(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    bound_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked, picked.schema["doc_id"].dataType.simpleString()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each shard of docs, as INDEX says."""
    picked, kind = id_text(docs, id_col, text_col)

    def build(batches):
        for name, ids, row in shards(batches):
            arrays = {
                "shard": pa.array([name]), "doc_ids": pa.ListArray.from_arrays([0, len(ids)], ids),
                "levels": pa.array([row["levels"]], pa.int32()), "size": pa.array([row["size"]], pa.int32()),
                **{p: pa.array([row[p].tobytes()], pa.binary()) for p in PARTS},
            }
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    return picked.mapInArrow(build, INDEX.format(kind=kind))


class Phrases:
    """The different phrases of a block of items: places in one stream of word hashes, and the items that each belongs to.

    `widths` has for each width the places, and the owners (numbers of `names`, which ascend) in one array with their ends.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        words = Words(Texts([None if t is None else t.encode() for _, t in items], lower=True), PLAIN_WORDS)
        self.stream = words.hashes
        self.names = sorted({item for item, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        owner = np.array([number[item] for item, _ in items], dtype=np.int64)
        size = np.minimum(words.counts, window)
        self.widths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in np.unique(size[size > 0]).tolist():
            mine = np.flatnonzero(size == width)
            times = words.counts[mine] - width + 1
            place = np.repeat(words.first[mine] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            of = np.repeat(owner[mine], times)
            keys = [windows(x, width)[place] for x in (self.stream, mixed(self.stream ^ U64(width)))]
            by = np.lexsort((of, *keys))
            place, of, keys = place[by], of[by], [k[by] for k in keys]
            new = np.ones(len(by), dtype=bool)
            new[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
            again = np.zeros(len(by), dtype=bool)
            again[1:] = ~new[1:] & (of[1:] == of[:-1])  # an item that has the phrase twice
            ends = np.append(np.flatnonzero(new[~again]), (~again).sum())
            self.widths[width] = place[new], ends, of[~again]

    def rows(self, width: int, least: int, most: int) -> np.ndarray:
        """Word hashes of the phrases from the one number to the other."""
        return self.stream[self.widths[width][0][least:most, None] + np.arange(width)]


FOUND = "shard string, ordinal int, doc_id {kind}, n_words bigint, starts array<int>, ends array<int>, items array<string>"


def found_in(name: str, ids: pa.Array, row: dict, phrases: Phrases) -> pa.RecordBatch:
    """FOUND of a shard's documents: merged spans of hit words (ends exclusive).

    A phrase is searched and located once, whatever number of items has it: a position starts one phrase of a width at most.
    """
    shard = Shard(row)
    n = len(shard.starts) - 1
    hit = np.zeros(shard.size, dtype=bool)
    owned = [np.zeros(0, dtype=np.int64)]
    for width, (places, ends, owners) in phrases.widths.items():
        for least in range(0, len(places), CHUNK):
            found, low, high = shard.search(phrases.rows(width, least, least + CHUNK))
            times = high - low
            which = np.repeat(found + least, times)
            offset = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            position = shard.locate(np.repeat(low, times) + offset)
            hit |= covered(position, width, shard.size)
            doc = np.searchsorted(shard.starts, position, side="right") - 1
            pair = np.unique(doc * len(places) + which)
            doc, which = pair // len(places), pair % len(places)
            times = ends[which + 1] - ends[which]
            of = owners[np.repeat(ends[which] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
            owned.append(np.unique(np.repeat(doc, times) * len(phrases.names) + of))
    begin, end = runs(hit)
    doc = np.searchsorted(shard.starts, begin, side="right") - 1
    cut = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    spans = [pa.ListArray.from_arrays(cut, pa.array((x - shard.starts[doc]).astype(np.int32))) for x in (begin, end)]
    pair = np.unique(np.concatenate(owned))
    cut = np.searchsorted(pair, np.arange(n + 1) * max(len(phrases.names), 1)).astype(np.int32)
    items = pa.array(phrases.names, pa.string()).take(pa.array(pair % max(len(phrases.names), 1)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * n, pa.string()), pa.array(np.arange(n), pa.int32()), ids,
            pa.array(np.diff(shard.starts) - 1, pa.int64()), *spans, pa.ListArray.from_arrays(cut, items),
        ],
        ["shard", "ordinal", "doc_id", "n_words", "starts", "ends", "items"],
    )


def search_index(index: DataFrame, items: list[tuple[str, str | None]], window: int = WINDOW) -> DataFrame:
    """FOUND of every indexed document for one block of items."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    phrases = index.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Phrases(items, window)))

    def search(batches):
        known = cloudpickle.loads(phrases.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("levels", "size", *PARTS)}
                yield found_in(batch.column("shard")[i].as_py(), batch.column("doc_ids")[i].values, row, known)

    return index.mapInArrow(search, FOUND.format(kind=kind))


def index_and_search(
    docs: DataFrame, items: list[tuple[str, str | None]], id_col: str, text_col: str, window: int
) -> DataFrame:
    """The same where one block holds all items: each shard is searched where it is built and not stored."""
    picked, kind = id_text(docs, id_col, text_col)
    phrases = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Phrases(items, window)))

    def search(batches):
        known = cloudpickle.loads(phrases.value)
        for name, ids, row in shards(batches):
            yield found_in(name, ids, row, known)

    return picked.mapInArrow(search, FOUND.format(kind=kind))


def merged(found: DataFrame) -> DataFrame:
    """One row for each document from the rows that several blocks gave: spans united, items joined."""
    spans = F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))
    grouped = found.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(spans).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    begin = F.struct(
        F.array().cast("array<struct<starts:int,ends:int>>").alias("closed"), F.lit(-1).alias("s"), F.lit(-1).alias("e")
    )
    open_span = lambda acc: F.struct(acc["s"].alias("starts"), acc["e"].alias("ends"))
    step = lambda acc, x: F.when(
        x["starts"] <= acc["e"],
        F.struct(acc["closed"].alias("closed"), acc["s"].alias("s"), F.greatest(acc["e"], x["ends"]).alias("e")),
    ).otherwise(
        F.struct(
            F.when(acc["s"] < 0, acc["closed"]).otherwise(F.concat(acc["closed"], F.array(open_span(acc)))).alias("closed"),
            x["starts"].alias("s"), x["ends"].alias("e"),
        )
    )
    close = lambda acc: F.when(acc["s"] < 0, acc["closed"]).otherwise(
        F.concat(acc["closed"], F.array(open_span(acc)))
    )
    united = grouped.withColumn("spans", F.aggregate("spans", begin, step, close))
    return united.select(
        "shard", "ordinal", "doc_id", "n_words", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"),
        "items",
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, starts, ends (spans of hit words) and items of each row of docs.

    benchmark has item_id and text; its size is measured, and beyond block_bytes the index is stored once and searched
    in blocks of items. Null and empty texts have no words and no hits; items without words have no windows; items that
    share an id count as one, a null id is the empty string. Repeated rows are judged one by one. Other columns are not
    read. An empty docs gives no rows, an empty benchmark no hits.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks == 1:
        rows = [tuple(r) for r in items.collect()]
        return index_and_search(docs, rows, id_col, text_col, window).drop("shard", "ordinal")
    index = stored(build_index(docs, id_col, text_col), "index")
    numbered = stored(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))), "items")
    found = None
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).select("item", "text").collect()
        part = search_index(index, [tuple(r) for r in rows], window)
        found = part if found is None else found.unionByName(part)
    return merged(found).drop("shard", "ordinal")


def report(found: DataFrame) -> DataFrame:
    """Numbers and digests of contamination()."""
    words = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0), lambda a, x: a + x).cast("long")
    items = F.array_sort("items")
    return found.select(
        "doc_id", "n_words", words.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (words > 0).alias("contaminated"),
    )


def cleaned(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs, all columns, with the hit spans cut out of the text."""
    key = F.sha2(F.coalesce(text_col, F.lit("")), 256)
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    found = contamination(keyed, benchmark, "key", "text", **options).where(F.size("starts") > 0)
    cuts = stored(found.select(F.col("doc_id").alias("key"), "starts", "ends").dropDuplicates(["key"]), "cuts")
    columns = docs.columns
    joined = join_small(docs.select(F.struct(*columns).alias("row"), key.alias("key")), cuts, ["key"], "left")
    rest = [f"row.`{c}`" for c in columns]
    names = ["text", "starts", "ends", "row"]

    def cut(batches):
        for batch in batches:
            values = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            texts = [without_spans(text, starts, ends) for text, starts, ends in values]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(3)], ["cut", "row"])

    changed = joined.where("starts IS NOT NULL").select(F.col(f"row.`{text_col}`").alias("text"), "starts", "ends", "row")
    kind = changed.schema["row"].dataType.simpleString()
    changed = changed.select(*names).mapInArrow(cut, f"cut string, row {kind}")
    changed = changed.select(*(F.col("cut").alias(c) if c == text_col else F.col(r).alias(c) for c, r in zip(columns, rest)))
    same = joined.where("starts IS NULL").select(*(F.col(r).alias(c) for c, r in zip(columns, rest)))
    return same.unionByName(changed)


def without_spans(text: str | None, starts: list[int] | None, ends: list[int] | None) -> str | None:
    """text without the bytes from a span's first to its last word."""
    if not text or not starts:
        return text
    texts = Texts([text.encode()], lower=True)
    words = Words(texts, PLAIN_WORDS)
    raw, kept, at = text.encode(), [], 0
    for s, e in zip(starts, ends, strict=True):
        kept.append(raw[at : words.starts[s]])
        at = int(words.ends[e - 1])
    return b"".join([*kept, raw[at:]]).decode()
