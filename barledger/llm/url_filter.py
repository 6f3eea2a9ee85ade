"""URL rules looked up in sorted arrays of 64-bit digests.

A rule is a host and a path prefix; it fits its host and every subdomain. Each text that can be asked for (a rule, or the
host of one with the lengths of its paths) becomes an entry of a sorted array of xxhash64 digests, with the text itself
beside it. Spark sorts the entries by range and writes one file for each range; every executor gets the files once and its
tasks map them into memory, so workers share their pages and a list may be as large as an executor's disk. A URL's hosts
and prefixes are probed by vectorised binary search, and a digest that is found counts only if the stored text is equal.
URLs are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm.bytework import bounded, release, worker_cache
from barledger.llm.shared import bound_batches, shared_folder, stored
from barledger.llm.warc import put

#: Entries of one file.
FILE_ENTRIES = 2_000_000
#: Spark's seed of xxhash64, a fixed value.
SEED = 42
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = (None, "allow", "block")


def url_host(url: str | Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    column = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract(F.coalesce(column, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: str | Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    column = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(F.coalesce(column, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def entries(rules: DataFrame) -> DataFrame:
    """text, digest, lengths (bytes of the paths of a host's rules), code (of a rule's verdict, else 0), host_bytes.

    rules has `rule`, a host and a path from its first / on, and `verdict`, allow or block. Hosts are compared in lower
    case. Rules with a null in either column, or another verdict, are left out; of equal rules that clash block wins.
    """
    slash = F.instr("rule", "/")
    host = F.when(slash > 0, F.col("rule").substr(F.lit(1), slash - 1)).otherwise(F.col("rule"))
    split = rules.where(F.col("rule").isNotNull() & F.col("verdict").isin(*VERDICTS[1:])).select(
        F.translate(host, UPPER, LOWER).alias("host"),
        F.when(slash > 0, F.col("rule").substr(slash, F.length("rule"))).otherwise("").alias("path"),
        F.when(F.col("verdict") == "block", 2).otherwise(1).alias("code"),
    )
    asked = split.select(
        F.concat("host", "path").alias("text"), F.lit(None).cast("int").alias("length"), "code",
        F.octet_length("host").alias("host_bytes"),
    ).unionByName(split.select(
        F.col("host").alias("text"), F.octet_length("path").alias("length"), F.lit(0).alias("code"),
        F.octet_length("host").alias("host_bytes"),
    ))
    merged = asked.groupBy("text", "host_bytes").agg(
        F.array_sort(F.collect_set("length")).alias("lengths"), F.max("code").alias("code")
    )
    return merged.select("text", F.xxhash64("text").alias("digest"), "lengths", "code", "host_bytes")


def packed(rows: dict[str, pa.Array]) -> bytes:
    """A file: five sizes, then keys, ends of texts, ends of length lists, lengths, codes, host bytes and the texts."""
    texts = [x.encode() for x in rows["text"].to_pylist()]
    lists = rows["lengths"].to_pylist()
    parts = [
        rows["digest"].to_numpy().astype("<i8"), np.cumsum([0, *map(len, texts)]).astype("<i8"),
        np.cumsum([0, *map(len, lists)]).astype("<i8"), np.array([x for one in lists for x in one], dtype="<i8"),
        rows["code"].to_numpy().astype("<i8"), rows["host_bytes"].to_numpy().astype("<i8"),
    ]
    head = np.array([len(texts), len(parts[3])], dtype="<i8")
    return b"".join(x.tobytes() for x in (head, *parts)) + b"".join(texts)


class Mapped:
    """One file of entries, mapped into memory."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        n, m = (int(x) for x in raw[:16].view("<i8"))
        at = 16

        def take(size):
            nonlocal at
            at += 8 * size
            return raw[at - 8 * size : at].view("<i8")

        self.keys, self.text_ends, self.list_ends = take(n), take(n + 1), take(n + 1)
        self.lengths, self.codes, self.host_bytes = take(m), take(n), take(n)
        self.texts = raw[at:]

    def text(self, entry: int) -> bytes:
        return self.texts[self.text_ends[entry] : self.text_ends[entry + 1]].tobytes()

    def find(self, digests: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """The entry of each text, or -1: binary search for its digest, then comparison with the stored texts."""
        found = np.full(len(texts), -1, dtype=np.int64)
        at = np.searchsorted(self.keys, digests)
        asked = np.arange(len(texts))
        while len(asked):
            inside = at[asked] < len(self.keys)
            asked = asked[inside]
            asked = asked[self.keys[at[asked]] == digests[asked]]
            equal = np.fromiter((self.text(at[i]) == texts[i] for i in asked), dtype=bool, count=len(asked))
            found[asked[equal]] = at[asked[equal]]
            asked = asked[~equal]
            at[asked] += 1
        return found


class Index:
    """All files of a list; files cover ascending ranges of digests."""

    def __init__(self, names: list[str], least: list[int]):
        kept = worker_cache("url_filter")
        for name in names:
            if name not in kept:
                kept[name] = Mapped(SparkFiles.get(name))
        self.files = [kept[name] for name in names]
        self.least = np.array(least, dtype=np.int64)

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """File and entry of each text, -1 where there is none."""
        digests = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in texts), dtype=np.uint64, count=len(texts))
        digests = digests.view(np.int64)
        file = np.searchsorted(self.least, digests, side="right") - 1
        entry = np.full(len(texts), -1, dtype=np.int64)
        for k in np.unique(file[file >= 0]):
            at = np.flatnonzero(file == k)
            entry[at] = self.files[k].find(digests[at], [texts[i] for i in at])
        return file, entry


def fitting(index: Index, hosts: pa.Array, paths: pa.Array, most: int) -> list[tuple[str, int] | None]:
    """For each host and path (binary) the longest rule that fits, and its code; of equally long ones that of the longer host."""
    coded = hosts.dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    suffixes, owners = [], []
    for number, host in enumerate(coded.dictionary.to_pylist()):
        at = 0 if len(host) <= most else host.find(b".", len(host) - most - 1) + 1
        while at or len(host) <= most:
            suffixes.append(host[at:])
            owners.append(number)
            at = host.find(b".", at) + 1
            if not at:
                break
    file, entry = index.find(suffixes)
    asked: dict[int, list[tuple[int, bytes]]] = {}
    for i in np.flatnonzero(entry >= 0):
        one = index.files[file[i]]
        for length in one.lengths[one.list_ends[entry[i]] : one.list_ends[entry[i] + 1]].tolist():
            asked.setdefault(length, []).append((owners[i], suffixes[i]))
    sizes = pc.binary_length(paths).to_numpy()
    best: list[tuple[str, int] | None] = [None] * len(paths)
    ranks = np.full(len(paths), -1, dtype=np.int64)
    for length, places in asked.items():
        rows = np.concatenate([order[bounds[h] : bounds[h + 1]] for h, _ in places])
        of = np.repeat(np.arange(len(places)), [bounds[h + 1] - bounds[h] for h, _ in places])
        long = sizes[rows] >= length
        rows, of = rows[long], of[long]
        heads = pa.array([x for _, x in places], pa.binary()).take(pa.array(of))
        tails = pc.binary_slice(paths.take(pa.array(rows)), 0, length)
        texts = pc.binary_join_element_wise(heads, tails, b"").dictionary_encode()
        file, entry = index.find(texts.dictionary.to_pylist())
        which = texts.indices.to_numpy()
        for i in np.flatnonzero(entry >= 0):
            one = index.files[file[i]]
            code = int(one.codes[entry[i]])
            if code:
                text = one.text(entry[i])
                rank = (len(text) << 32) + int(one.host_bytes[entry[i]])
                hit = rows[(which == i)]
                hit = hit[ranks[hit] < rank]
                ranks[hit] = rank
                for row in hit:
                    best[row] = (text.decode(), code)
    return best


def write_index(rules: DataFrame) -> tuple[list[str], list[int], int]:
    """Writes the files to the shared folder and hands them to the executors: names, least digests, longest host.

    A task writes its range as one file, named by its attempt; the table of the attempts that succeeded names the files.
    Names and one number for each file come to the driver, no entry does.
    """
    spark = rules.sparkSession
    folder = shared_folder(spark)
    listed = stored(entries(rules), "entries")
    facts = listed.agg(F.count(F.lit(1)).alias("n"), F.max("host_bytes").alias("most")).first()
    if not facts["n"]:
        return [], [], 0

    def write(batches):
        release("packing")
        held = [x for x in batches if x.num_rows]
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            columns = {name: rows.column(name).combine_chunks() for name in rows.column_names}
            name = f"{folder.rsplit('/', 1)[-1]}-{TaskContext.get().taskAttemptId()}.digests"
            put(folder, name, packed(columns))
            yield pa.RecordBatch.from_pydict({"name": [name], "least": columns["digest"][:1]})

    ranged = listed.repartitionByRange(1 + facts["n"] // FILE_ENTRIES, "digest").sortWithinPartitions("digest", "text")
    written = stored(ranged.mapInArrow(write, "name string, least bigint"), "files").orderBy("least").collect()
    for row in written:
        spark.sparkContext.addFile(f"{folder}/{row['name']}")
    return [r["name"] for r in written], [r["least"] for r in written], facts["most"]


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule, verdict: one row for each row of pages.

    The longest fitting rule (in bytes; of equally long ones that with the longer host) decides, `otherwise` where none
    fits. Null URLs and those without :// have an empty host and path. Null and repeated ids and repeated URLs are judged
    row by row; other columns are not read. Without rules every URL gets `otherwise`; an empty table gives no rows.
    """
    bound_batches(pages.sparkSession)
    picked = pages.select(F.col(id_col).alias("page_id"), url_host(url_col).alias("host"), url_path(url_col).alias("path"))
    names, least, most = write_index(rules)
    if not names:
        return picked.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(otherwise))

    def probe(batches):
        release("packing")
        index = Index(names, least)
        for batch in bounded(batches, 2):
            hosts, paths = (batch.column(k).cast(pa.binary()) for k in (1, 2))
            best = fitting(index, hosts, paths, most)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array([x and x[0] for x in best], pa.string()),
                    pa.array([VERDICTS[x[1]] if x else otherwise for x in best], pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    kind = picked.schema["page_id"].dataType.simpleString()
    return picked.mapInArrow(probe, f"page_id {kind}, host string, path string, rule string, verdict string")
