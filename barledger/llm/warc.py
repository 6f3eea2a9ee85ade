"""WARC archives with dictionary-compressed records.

Records are dealt to archives of bounded size. A Zstandard dictionary is built from the archive's own records and
embedded in a leading skippable frame; each record is a frame of its own, so a reader can start at any of them. Of equal
payloads one is written as a response, the others as revisits of it. Archives are files in a folder of any file system
that the executors share, named by task attempt; a manifest table lists those of the attempts that succeeded.
"""

from __future__ import annotations

import hashlib
import re
import struct
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.llm.shared import bound_batches, join_small, shared_folder

#: Payloads below this are never written as revisits.
MIN_REVISIT = 100
#: Uncompressed bytes of records after which a new archive begins.
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 32 << 10
#: Bytes of records that a dictionary is trained on, spread over the archive.
TRAINING_BYTES = 2 << 20
MIN_TRAINING = 16
#: Magic number of the skippable frame that holds a dictionary, and of a dictionary: fixed values.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
LEVEL = 3
#: Compressed bytes that are fed to the reader at a time.
SLICE = 16 << 10
MANIFEST = "_manifest"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_FIELDS = (
    "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, "
    "payload binary, archive string, position bigint"
)


#: What a header line can't hold, or readers may fold: control characters and spaces.
UNFIT = re.compile("[\\x00-\\x20\\x7f-\\xa0\\u2028\\u2029]")


def record_id(page_id: str | None) -> str:
    return "<urn:no-page>" if page_id is None else f"<urn:page:{quote(page_id, safe='')}>"


def address_lines(url: str) -> list[str]:
    """The address as it is; one with characters that don't fit is quoted, percent signs too, and says so."""
    if not UNFIT.search(url):
        return [f"WARC-Target-URI: {url}"]
    return [f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~')}", "Target-URI-Quoted: yes"]


def record(page_id: str | None, url: str, date: str, payload: bytes, size: int, digest: str, original: str | None) -> bytes:
    """One record with its HTTP head; a revisit (of `original`) has the head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if original is not None else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}",
        *address_lines(url), f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if original is not None:
        lines += [f"WARC-Refers-To: {record_id(original)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Fields of one record; the payload of a response is digested anew."""
    from urllib.parse import unquote

    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a record: {first[:40]}")
    fields = {k: v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    name = lambda key: unquote(x[len("<urn:page:"):-1]) if (x := fields.get(key, "")).startswith("<urn:page:") else None
    url = fields["WARC-Target-URI"]
    kind = fields["WARC-Type"]
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else fields["WARC-Payload-Digest"][7:]
    if kind == "response" and (size != len(payload) or fields["WARC-Payload-Digest"] != f"sha256:{digest}"):
        raise ValueError("a payload differs from its digest or length")
    return {
        "page_id": name("WARC-Record-ID"), "url": unquote(url) if "Target-URI-Quoted" in fields else url, "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": name("WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def archive(records: list[bytes]) -> bytes:
    """The dictionary's frame, then a frame for each record; too few records get an empty dictionary frame's place."""
    import zstandard

    size = sum(map(len, records))
    step = max(1, -(-size // TRAINING_BYTES))
    samples = [x[:DICTIONARY_BYTES * 4] for x in records[::step]]
    dictionary = None
    if len(samples) >= MIN_TRAINING:
        try:
            dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
        except zstandard.ZstdError:  # samples too small or too much alike to train on
            dictionary = None
    if dictionary is None:  # a dictionary of raw content: the first record's head
        content = records[0][:DICTIONARY_BYTES].ljust(8, b" ")
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    stored = dictionary.as_bytes()
    frames = [struct.pack("<II", DICTIONARY_FRAME, len(stored)) + stored]
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
    frames += map(compressor.compress, records)
    return b"".join(frames)


def read_archive(content: bytes):
    """Position and bytes of each record of an archive."""
    import zstandard

    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive has no dictionary frame")
    raw = content[8 : 8 + size]
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == DICTIONARY_MAGIC else zstandard.DICT_TYPE_RAWCONTENT
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    at = 8 + size
    view = memoryview(content)
    while at < len(content):
        one, taken, end = reader.decompressobj(), [], at
        while not one.eof:
            if end >= len(content):
                raise ValueError("the last record is cut off")
            taken.append(one.decompress(view[end : end + SLICE]))
            end = min(end + SLICE, len(content))
        yield at, b"".join(taken)
        at = end - len(one.unused_data)


def put(folder: str, name: str, content: bytes) -> None:
    """A file of the folder, complete or absent."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/.{name}", compression=None) as out:
        out.write(content)
    system.move(f"{path}/.{name}", f"{path}/{name}")


def with_originals(pages: DataFrame, min_revisit: int) -> DataFrame:
    """page_id, url, payload, digest, size and `original`, the smallest page_id of the payload."""
    rows = pages.withColumn("payload", F.coalesce(F.col("html").cast("binary"), F.lit(b""))).drop("html")
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    first = (
        rows.where(F.col("size") >= min_revisit).groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    return rows.join(first, "digest", "left")


def write_archives(
    pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", min_revisit: int = MIN_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Writes a record for each row of pages (page_id, url, html) into archives of the folder."""
    bound_batches(pages.sparkSession)
    picked = with_originals(pages.select("page_id", "url", "html"), min_revisit)
    is_first = F.col("original").isNull() | F.col("page_id").isNull() | (F.col("page_id") == F.col("original"))
    ready = picked.select(
        F.col("page_id").cast("string").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"), F.when(is_first, F.col("payload")).alias("payload"), "digest",
        "size", F.when(~is_first, F.col("original").cast("string")).alias("original"),
    )

    def write(batches):
        held, size, number = [], 0, 0
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()

        def done():
            nonlocal held, size, number
            name = f"part-{task:06d}-{attempt}-{number:05d}.warc.zst"
            put(folder, name, archive(held))
            counted = pa.RecordBatch.from_pylist([{"archive": name, "records": len(held)}])
            held, size, number = [], 0, number + 1
            return counted

        for batch in batches:
            for row in batch.to_pylist():
                one = record(
                    row["page_id"], row["url"], date, row["payload"] or b"", row["size"], row["digest"], row["original"]
                )
                held.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield done()
        if held:
            yield done()

    ready.mapInArrow(write, "archive string, records bigint").write.parquet(f"{folder}/{MANIFEST}")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """RECORD_FIELDS of every record of the archives that the folder's manifest lists."""
    listed = spark.read.schema("archive string, records bigint").parquet(f"{folder}/{MANIFEST}")
    if not listed.take(1):
        return spark.createDataFrame([], RECORD_FIELDS)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = join_small(
        files.withColumn("archive", F.element_at(F.split("path", "/"), -1)), listed.select("archive"), ["archive"],
        "left_semi",
    )
    schema = pa.schema([
        pa.field(name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (x.split() for x in RECORD_FIELDS.split(", "))
    ])

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held, size = [], 0
                for position, raw in read_archive(content):
                    held.append(parsed(raw) | {"archive": path.rsplit("/", 1)[-1], "position": position})
                    size += len(raw)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    return files.select("path", "content").mapInArrow(read, RECORD_FIELDS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes pages and reads the archives back: page_id, url, sizes, digests, types and places of all records.

    Payloads are UTF-8 of html; null is the empty payload. Of equal payloads of at least 100 bytes the one with the
    smallest page_id is the response (rows that repeat that very page_id are responses too); rows without page_id are
    responses and come back with a null one, a null url comes back empty. Other columns of pages are not written. An
    empty table writes no archive and gives no rows.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/archives"
    write_archives(pages, folder)
    kind = pages.schema["page_id"].dataType
    back = read_archives(spark, folder)
    identity = lambda name: F.col(name).cast(kind).alias(name)
    return back.select(
        identity("page_id"), "payload_bytes", "payload_digest", "record_type", identity("refers_to"), "url", "archive",
        "position",
    )
