"""Removal of repeated passages by suffix arrays of shards that are dealt by content.

Every window of `length` bytes has an anchor, its smallest hashed K-gram, so equal windows have equal anchors. The
windows of one anchor make a context of the document. Contexts are dealt by anchor: equal ones are aggregated to the
first of them, and those of anchors with several different contexts are sorted, shard by shard, into a suffix array by
induced sorting. Suffixes that share `length` bytes with a neighbour (by permuted common prefixes) are equal windows; all
but the first are removed. A window occurs in the shard of its anchor only, so the result is that of one array of all
texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import BASE, Texts, U64, bounded, mixed, powers, runs
from barledger.llm.shared import bound_batches, stored

LENGTH = 100
#: Bytes of an anchor; half a window where windows are shorter than two anchors.
GRAM = 32
#: A context's first window start and its number of windows share a number; so many bits are for the windows.
WINDOW_BITS = 20
SHARD_BYTES = 1 << 20
#: Different contexts of one anchor beyond which its windows are dealt one by one.
HOT_CONTEXTS = 20_000
#: Symbols up to which a bucket is induced at a time, in vectorised rounds.
SMALL_ALPHABET = 1024


def sliding_first_min(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost of the values with the smallest upper halves in each run of `width` values."""
    low = (values & U64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=U64)
    have = 1
    while have < width:  # the minimum of two overlapping narrower runs
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return (low & U64(0xFFFFFFFF)).astype(np.int64)


def gram_of(length: int) -> int:
    """Bytes of an anchor for windows of `length` bytes, which may be 2 to 2 ** WINDOW_BITS."""
    if not 2 <= length <= 1 << WINDOW_BITS:
        raise ValueError(f"length must be between 2 and {1 << WINDOW_BITS}")
    return min(GRAM, length // 2)


def contexts_of(texts: Texts, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Anchor, content hash, text and range of window starts (within the batch) of each context."""
    gram = gram_of(length)
    empty = {k: np.zeros(0, dtype=np.int64) for k in ("anchor", "content", "doc", "first", "last")}
    if len(texts.bytes) < length:
        return empty
    with np.errstate(over="ignore"):
        grams = texts.sums[gram:] - texts.sums[:-gram]
        grams *= powers(pow(BASE, -1, 1 << 64), len(grams))
    grams = mixed(grams)
    at = sliding_first_min(grams, length - gram + 1)
    doc = np.repeat(np.arange(texts.n), texts.lengths + 1)[: len(at)]
    window = np.flatnonzero(np.arange(length, length + len(at)) < texts.starts[1:][doc])
    at, doc = at[window], doc[window]
    if not len(window):
        return empty
    fresh = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    first, last = window[fresh], window[np.concatenate([fresh[1:] - 1, [len(window) - 1]])]
    content = mixed(texts.hashes(first, last + length) + (at[fresh] - first).astype(U64))
    return {
        "anchor": grams[at[fresh]].view(np.int64), "content": content.view(np.int64), "doc": doc[fresh],
        "first": first - texts.starts[doc[fresh]], "last": last - texts.starts[doc[fresh]],
    }


def types_of(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one; the last suffix, a unique smallest symbol, is."""
    change = np.flatnonzero(text[1:] != text[:-1])
    out = np.ones(len(text), dtype=bool)
    if len(change):
        out[: change[-1] + 1] = np.repeat(text[change] < text[change + 1], np.diff(change, prepend=-1))
    return out


def named(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the leftmost-smaller substrings (each to the start of the next) and how many differ."""
    bits = int(text.max() * 2 + 2).bit_length()
    depth = 62 // bits
    symbol = np.concatenate([text.astype(np.int64) * 2 + smaller + 1, np.zeros(depth, dtype=np.int64)])
    ends = np.concatenate([lms[1:] + 1, [len(text)]])
    order, slots = np.arange(len(lms)), np.arange(len(lms))
    group = np.zeros(len(lms), dtype=np.int64)
    fresh_at = np.zeros(len(lms), dtype=bool)
    fresh_at[0] = True
    done = 0
    while len(slots):
        who = order[slots]
        key = np.zeros(len(who), dtype=np.int64)
        for j in range(depth):
            at = lms[who] + done + j
            key = (key << bits) | np.where(at < ends[who], symbol[np.minimum(at, len(symbol) - 1)], 0)
        within = np.lexsort((key, group[slots])) if done else np.argsort(key, kind="stable")
        held, key, who = group[slots][within] if done else group[slots], key[within], who[within]
        order[slots] = who
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (held[1:] != held[:-1])])
        fresh_at[slots[fresh]] = True
        group[slots] = np.maximum.accumulate(np.where(fresh, slots, 0))
        done += depth
        tied = ~(fresh & np.concatenate([fresh[1:], [True]]))
        slots = slots[tied & (lms[who] + done < ends[who])]
    name = np.empty(len(lms), dtype=np.int64)
    name[order] = np.cumsum(fresh_at) - 1
    return name, int(fresh_at.sum())


def induced(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array from the sorted leftmost-smaller suffixes, one bucket of equal first symbols at a time."""
    size = int(text.max()) + 1
    ends = np.cumsum(np.bincount(text, minlength=size))
    starts = np.concatenate([[0], ends[:-1]])
    out = np.full(len(text), -1, dtype=np.int64)
    by_symbol = np.split(lms, np.searchsorted(text[lms], np.arange(1, size)))
    head = starts.copy()
    for c in range(size):  # larger suffixes, from left to right
        done = starts[c]
        while done < head[c]:
            front, done = out[done : head[c]], head[c]
            deal(text, front[front > 0] - 1, ~smaller, head, out, 1)
        if len(by_symbol[c]):
            deal(text, by_symbol[c][by_symbol[c] > 0] - 1, ~smaller, head, out, 1)
    tail = ends.copy()
    for c in range(size - 1, -1, -1):  # smaller suffixes, from right to left
        done = ends[c]
        while done > tail[c]:
            front, done = out[tail[c] : done][::-1], tail[c]
            deal(text, front[front > 0] - 1, smaller, tail, out, -1)
        front = out[starts[c] : head[c]][::-1]
        deal(text, front[front > 0] - 1, smaller, tail, out, -1)
    out[0] = len(text) - 1
    return out


def deal(text: np.ndarray, before: np.ndarray, wanted: np.ndarray, ends: np.ndarray, out: np.ndarray, step: int) -> None:
    """Puts those suffixes that are wanted to their buckets' ends, in order."""
    before = before[wanted[before]]
    if not len(before):
        return
    symbol = text[before]
    order = np.argsort(symbol, kind="stable")
    before, symbol = before[order], symbol[order]
    first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
    counts = np.diff(np.concatenate([first, [len(symbol)]]))
    within = np.arange(len(symbol)) - np.repeat(first, counts)
    at = ends[symbol] + within if step > 0 else ends[symbol] - 1 - within
    out[at] = before
    ends[symbol[first]] += step * counts


def induced_singly(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The same for many symbols, one suffix at a time."""
    ends = np.cumsum(np.bincount(text))
    head, tail = [0, *ends[:-1].tolist()], ends.tolist()
    fill = ends.copy()
    symbol = text[lms]
    last = np.cumsum(np.bincount(symbol, minlength=len(ends)))
    slot = fill[symbol] - (last[symbol] - np.arange(len(lms)))
    out = np.full(len(text), -1, dtype=np.int64)
    out[slot] = lms
    sa, symbols, small = out.tolist(), text.tolist(), smaller.tolist()
    for i in range(len(sa)):
        j = sa[i] - 1
        if j >= 0 and not small[j]:
            c = symbols[j]
            sa[head[c]] = j
            head[c] += 1
    for i in range(len(sa) - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and small[j]:
            c = symbols[j]
            tail[c] -= 1
            sa[tail[c]] = j
    return np.array(sa, dtype=np.int64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; text ends with 0, which it has nowhere else."""
    if len(text) == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = types_of(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    names, distinct = named(text, smaller, lms)
    order = np.argsort(names) if distinct == len(lms) else suffix_array(names)
    small = int(text.max()) < SMALL_ALPHABET
    return (induced if small else induced_singly)(text, smaller, lms[order])


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each position in order, the symbols (at most `most`) its suffix shares with that before it in order."""
    with np.errstate(over="ignore"):
        codes = mixed(np.arange(int(text.max()) + 1, dtype=U64) + U64(1))[text] * powers(BASE, len(text))
        sums = np.concatenate([[U64(0)], np.cumsum(codes)])
        scale = powers(pow(BASE, -1, 1 << 64), len(text) + 1)
        here, there = order[1:], order[:-1]
        shared = np.zeros(len(here), dtype=np.int64)
        step = 1 << (most.bit_length() - 1)
        while step:
            a, b = here + shared, there + shared
            width = np.where((np.maximum(a, b) + step <= len(text)) & (shared + step <= most), step, 0)
            same = (sums[a + width] - sums[a]) * scale[a] == (sums[b + width] - sums[b]) * scale[b]
            shared += width * same
            step >>= 1
    out = np.zeros(len(text), dtype=np.uint8 if most < 256 else np.int64)
    out[here] = shared
    return out


def repeats_in(contexts: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spans (starts, ends) of each context that repeat windows of it or of contexts before it in the list."""
    sizes = np.array([len(x) for x in contexts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    # two symbols more than bytes: 1 ends a context, 0 ends all
    raw = np.frombuffer(b"\0".join([*contexts, b""]), dtype=np.uint8)
    text = np.append(raw.astype(np.int64) + 2, 0)
    text[starts[1:] - 1] = 1
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    order = suffix_array(text)
    whole = np.zeros(len(text), dtype=bool)  # suffixes that are windows; only windows share `length` symbols with one
    whole[:-1] = np.arange(len(text) - 1) + length <= starts[owner + 1] - 1
    position = order[whole[order]]
    group = np.cumsum(permuted_prefixes(text, position, length)[position] < length)
    by_group = np.lexsort((position, group))
    group, position = group[by_group], position[by_group]
    later = position[np.concatenate([[False], group[1:] == group[:-1]])]
    flags = np.zeros(len(text), dtype=bool)
    flags[later] = True
    begin, end = runs(flags)
    of = owner[begin]
    begin, end = begin - starts[of], end - starts[of] + length - 1
    cut = np.searchsorted(of, np.arange(len(contexts) + 1))
    return [(begin[a:b], end[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def with_identity(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """doc and text, with a hash `same` of the text if ids are repeated, and the columns that tell documents apart."""
    picked = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    if picked.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1):
        return picked.withColumn("same", F.xxhash64("text")), ["doc", "same"]
    return picked, ["doc"]


def types(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"{name} {df.schema[name].dataType.simpleString()}" for name in names)


def context_rows(texts: DataFrame, ids: list[str], length: int) -> DataFrame:
    """anchor, content, ids, at (first window start above WINDOW_BITS bits of the other windows' number) of every context."""

    def find(batches):
        for batch in bounded(batches, 0):
            found = contexts_of(Texts(batch.column(0)), length)
            of = pa.array(found["doc"])
            at = (found["first"] << WINDOW_BITS) + found["last"] - found["first"]
            named = [batch.column(name).take(of) for name in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["anchor"]), pa.array(found["content"]), *named, pa.array(at)],
                ["anchor", "content", *ids, "at"],
            )

    return texts.select("text", *ids).mapInArrow(find, f"anchor bigint, content bigint, {types(texts, ids)}, at bigint")


def fetched(texts: DataFrame, ids: list[str], needed: DataFrame, length: int) -> DataFrame:
    """anchor, hot, ids, first and bytes of each needed context (anchor, hot, ids, at)."""
    lists = needed.groupBy(*ids).agg(F.collect_list(F.struct("anchor", "hot", "at")).alias("found"))
    single = texts if len(ids) == 1 else texts.dropDuplicates(ids)
    names = ["anchor", "hot", *ids, "first", "bytes"]

    def cut(batches):
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("of", "anchor", "hot", "first", "bytes")}
            for i, (text, found) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                raw = text.encode()
                for one in found:
                    first, more = one["at"] >> WINDOW_BITS, one["at"] & ((1 << WINDOW_BITS) - 1)
                    values = (i, one["anchor"], one["hot"], first, raw[first : first + more + length])
                    for key, value in zip(rows, values, strict=True):
                        rows[key].append(value)
            of = pa.array(rows["of"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["anchor"], pa.int64()), pa.array(rows["hot"], pa.bool_()),
                    *(batch.column(name).take(of) for name in ids), pa.array(rows["first"], pa.int64()),
                    pa.array(rows["bytes"], pa.binary()),
                ],
                names,
            )

    return single.join(lists, ids).select("text", "found", *ids).mapInArrow(
        cut, f"anchor bigint, hot boolean, {types(texts, ids)}, first bigint, bytes binary"
    )


def sorted_spans(contexts: DataFrame, ids: list[str], length: int) -> DataFrame:
    """ids, start, end of what the shards' suffix arrays find in the contexts' windows."""
    size = contexts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))

    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by([(name, "ascending") for name in (*ids, "first")])
        found = repeats_in(table.column("bytes").to_pylist(), length)
        first = table.column("first").to_numpy()
        of = pa.array(np.repeat(np.arange(len(found)), [len(s) for s, _ in found]))
        starts = [s + f for (s, _), f in zip(found, first, strict=True)]
        ends = [e + f for (_, e), f in zip(found, first, strict=True)]
        return pa.table({
            **{name: table.column(name).take(of) for name in ids},
            "start": pa.array(np.concatenate(starts)), "end": pa.array(np.concatenate(ends)),
        })

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    return contexts.select(shard, *ids, "first", "bytes").groupBy("shard").applyInArrow(
        find, f"{types(contexts, ids)}, start bigint, end bigint"
    )


#: Two independent hashes, of an anchor and of all that surrounds it: contexts that agree in both are taken for equal.
SAME = ["anchor", "content"]


def single_windows(contexts: DataFrame, ids: list[str], length: int) -> DataFrame:
    """anchor, content, ids, at of each window of contexts of hot anchors."""

    def find(batches):
        for batch in batches:
            texts = Texts(batch.column(0))
            windows = np.maximum(texts.lengths - length + 1, 0)
            of = np.repeat(np.arange(texts.n), windows)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            starts = texts.starts[of] + inside
            first = batch.column(1).to_numpy()[of] + inside
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2).take(pa.array(of)), pa.array(texts.hashes(starts, starts + length).view(np.int64)),
                    *(batch.column(name).take(pa.array(of)) for name in ids), pa.array(first << WINDOW_BITS),
                ],
                ["anchor", "content", *ids, "at"],
            )

    return contexts.select("bytes", "first", "anchor", *ids).mapInArrow(
        find, f"anchor bigint, content bigint, {types(contexts, ids)}, at bigint"
    )


def later_copies(rows: DataFrame, ids: list[str], firsts: DataFrame, length: int) -> DataFrame:
    """ids, start, end of rows (SAME, ids, at) that are not the first of their content; firsts has `one`."""
    joined = rows.select(*SAME, *ids, "at").join(firsts, SAME).where(F.struct(*ids, "at") != F.col("one"))
    start = F.shiftright("at", WINDOW_BITS)
    more = F.col("at").bitwiseAND((1 << WINDOW_BITS) - 1)
    return joined.select(*ids, start.alias("start"), (start + more + length).alias("end"))


def repeated_spans(texts: DataFrame, ids: list[str], length: int = LENGTH) -> DataFrame:
    """ids and spans (start, end; possibly overlapping) that occur earlier, for documents with any."""
    count = F.count(F.lit(1)).alias("n")
    one = F.min(F.struct(*ids, "at")).alias("one")
    rows = context_rows(texts, ids, length)
    shared = stored(rows.groupBy("anchor").agg(count).where("n > 1").select("anchor"), "shared")
    rows = stored(rows.join(shared, "anchor", "left_semi"), "contexts")
    firsts = stored(rows.groupBy(*SAME).agg(count, one), "firsts")
    several = firsts.groupBy("anchor").agg(count).where("n > 1").select("anchor", (F.col("n") > HOT_CONTEXTS).alias("hot"))
    needed = firsts.select("anchor", "one").join(stored(several, "several"), "anchor").select("anchor", "hot", "one.*")
    contexts = stored(fetched(texts, ids, needed, length), "bytes")
    single = stored(single_windows(contexts.where("hot"), ids, length), "windows")
    spans = (
        later_copies(rows, ids, firsts.where("n > 1").select(*SAME, "one"), length)
        .unionByName(sorted_spans(contexts.where(~F.col("hot")), ids, length))
        .unionByName(later_copies(single, ids, stored(single.groupBy(*SAME).agg(one), "singles"), length))
    )
    return spans.groupBy(*ids).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, starts, ends (maximal removed runs), kept (remaining bytes), a row for each of docs.

    Removed is each byte of a `length`-byte string that also starts earlier: in a smaller doc_id, or before in the same
    text; strings are judged on the texts as they came. Null texts are empty and shorter texts whole. Rows that repeat
    an id and its text are one document and all get its result; different texts of one id are ordered by a hash. Null
    ids come first. Other columns are not read. An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    gram_of(length)
    texts, ids = with_identity(docs, id_col, text_col)
    # a null id that no other row has needs a name that joins
    known = texts.withColumn("doc", F.struct("doc")) if texts.where("doc IS NULL").take(1) else texts
    spans = stored(repeated_spans(known, ids, length), "spans")
    kind = texts.schema["doc"].dataType.simpleString()
    joined = known.join(spans, ids, "left").select("doc" if known is texts else F.col("doc.doc").alias("doc"), "text", "spans")

    def cut(batches):
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "starts", "ends", "kept")}
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode()
                begin, end = merged([(s["start"], s["end"]) for s in spans or ()])
                edges = [0, *(x for pair in zip(begin, end, strict=True) for x in pair), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for key, value in zip(rows, (len(raw), len(raw) - len(kept), begin, end, kept), strict=True):
                    rows[key].append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(rows["n_bytes"], pa.int64()), pa.array(rows["n_removed"], pa.int64()),
                    pa.array(rows["starts"], pa.list_(pa.int64())), pa.array(rows["ends"], pa.list_(pa.int64())),
                    pa.array(rows["kept"], pa.binary()),
                ],
                ["doc_id", *rows],
            )

    return joined.mapInArrow(
        cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, starts array<bigint>, ends array<bigint>, kept binary"
    )


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of spans."""
    begin, end = [], []
    for s, e in sorted(spans):
        if end and s <= end[-1]:
            end[-1] = max(end[-1], e)
        else:
            begin.append(s)
            end.append(e)
    return begin, end


def report(cut: DataFrame) -> DataFrame:
    """Numbers and digests of cut_texts()."""
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
