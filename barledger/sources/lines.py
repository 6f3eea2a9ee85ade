"""CSV files with a header of their own each, read as lines by one job.

Spark's CSV reader takes one schema for all files and renames repeated headers, so files whose
headers must be judged are read as text and every line is joined to the header of its file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barledger.operators.skew import HOT_ROWS, attach_by_key
from barledger.sources.scratch import written

# Lines of a record at most; what is longer is taken for a quote that was not meant.
RECORD_LINES = 10_000
OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def split_fields(line: Column) -> Column:
    """Fields of one CSV line, quotes removed."""
    ended = F.when(line.contains("\r"), F.regexp_replace(line, r"\r$", "")).otherwise(line)
    quoted = F.transform(
        F.split(ended, OUTSIDE_QUOTES, -1), lambda text: F.regexp_replace(F.regexp_replace(text, r'^\s*"|"\s*$', ""), '""', '"')
    )
    # looking ahead for quotes at every comma takes the square of a line's length
    return F.when(line.contains('"'), quoted).otherwise(F.split(ended, ",", -1))


def open_quote(line: Column) -> Column:
    """Whether a line ends inside a quoted field: its record goes on in the next line."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def plain_path(file: Column) -> Column:
    """A file's path with one slash after its scheme: listings and scans write it differently."""
    return F.regexp_replace(file, "^([A-Za-z0-9]+):/+", "$1:/")


def read_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """``file``, ``name`` and ``bytes`` of every matching file, empty ones too: an inventory, no content is read.

    No scan yields a row for an empty file; its path is in the listing that the scan was planned from.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(directory)
    scanned = found.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    listed = spark.createDataFrame([(path,) for path in found.inputFiles()], "file string")
    empty = listed.join(scanned, plain_path(listed["file"]) == plain_path(scanned["file"]), "left_anti").withColumn(
        "bytes", F.lit(0).cast("bigint")
    )
    files = scanned.unionByName(empty)
    return files.select("file", F.url_decode(F.substring_index("file", "/", -1)).alias("name"), "bytes")


def read_lines(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """Lines of the matching files, blank ones too: ``file``, ``name``, ``block``, ``line``.

    ``block`` is where the line's part of the file starts.
    """
    return located(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(directory))


def located(text: DataFrame) -> DataFrame:
    """A text source's lines with their file and block."""
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def number_lines(lines: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Records with ``row_position`` in their file: the header is -1, the first one after it is 0.

    A record is a line that is not blank, or several if they are joined by quotes around their breaks, at most
    RECORD_LINES of them. A file with a longer one, or with a quote that never ends, keeps single lines, some of which then
    end inside quotes. Positions and quotes in a block of a file are offset by the sums of the blocks before it, so no file
    is numbered or parsed by one task.
    """
    numbered = lines.where(F.trim("line") != "").withColumn("number", F.monotonically_increasing_id())
    sizes = written(numbered.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("__size"), F.min("number").alias("__first"), F.count_if(open_quote(F.col("line"))).alias("__odd"),
    ), "blocks")
    # one line that ends inside quotes makes its file's records span lines, or is a fault
    quoted = sizes.groupBy("file").agg(F.sum("__odd").alias("__odd")).where("__odd > 0 AND __odd % 2 = 0").select("file")
    records = None
    if not quoted.isEmpty():
        records, spanning = _records(lines, quoted, hot_rows)
        numbered = numbered.join(spanning, "file", "left_anti")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "file", "block", "__size", (F.coalesce(F.sum("__size").over(earlier), F.lit(0)) - F.col("__first") - 1).alias("__shift")
    )
    placed = attach_by_key(numbered, offsets, ["file", "block"], "__size", hot_rows)
    placed = placed.withColumn("row_position", F.col("number") + F.col("__shift")).select("file", "name", "line", "row_position")
    return placed if records is None else placed.unionByName(records)


def _records(lines: DataFrame, quoted: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Records of the ``quoted`` files whose quotes all end, and these files."""
    mine = lines.join(quoted, "file", "left_semi").withColumn("number", F.monotonically_increasing_id())
    mine = written(mine.withColumn("__odd", open_quote(F.col("line")).cast("int")), "quoted")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "block").orderBy("number")
    upto, until = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)

    def offset(rows: DataFrame, name: str) -> DataFrame:
        """rows with the sum of ``name`` over the blocks before theirs, as ``__earlier``."""
        sums = rows.groupBy("file", "block").agg(F.sum(name).alias("__sum"), F.count(F.lit(1)).alias("__size"))
        sums = sums.withColumn("__earlier", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
        return attach_by_key(rows, sums, ["file", "block"], "__size", hot_rows)

    marked = offset(mine, "__odd").withColumn("__in", (F.col("__earlier") + F.coalesce(F.sum("__odd").over(upto), F.lit(0))) % 2 == 1)
    marked = written(marked.where(F.col("__in") | (F.trim("line") != "")).drop("__earlier").withColumn(
        "__begins", (~F.col("__in")).cast("int")
    ), "marked")
    counted = offset(marked, "__begins").withColumn("record", F.col("__earlier") + F.sum("__begins").over(until))
    counted = written(counted.select("file", "name", "block", "number", "line", "record"), "records")
    long = counted.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > RECORD_LINES)
    spanning = quoted.join(long.select("file").distinct(), "file", "left_anti")
    parts = F.sort_array(F.collect_list(F.struct("block", "number", "line")))
    joined = counted.join(spanning, "file", "left_semi").groupBy("file", "name", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line")
    )
    return joined.select("file", "name", "line", (F.col("record") - 2).alias("row_position")), spanning


def data_records(lines: DataFrame) -> DataFrame | None:
    """Records (``line``) after the header of each file, or None if a quote does not end within RECORD_LINES.

    Lines stay in the task that reads them: it needs to know of its block only whether that begins inside quotes, which the
    quotes of the blocks before say. Records over the border of two blocks come in pieces, at most two a block, which are
    joined by file. The records are written once.
    """
    blocks = written(lines.groupBy("file", "block").agg(
        F.sum(open_quote(F.col("line")).cast("int")).alias("odd"), F.max(F.trim("line") != "").alias("content"),
    ), "blocks")
    if not blocks.groupBy("file").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").isEmpty():
        return None
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.select(
        "file", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("inside"),
        (F.col("content") & ~F.coalesce(F.max("content").over(earlier), F.lit(False))).alias("leads"),
    ).where("inside OR (leads AND block > 0)")
    # fewer than one row for each full block of the input
    marked = lines.join(F.broadcast(begun), ["file", "block"], "left").select(
        "file", "block", "line", F.coalesce("inside", F.lit(False)).alias("inside"),
        F.coalesce("leads", F.col("block") == 0).alias("leads"),
    )
    pieces = written(marked.mapInArrow(_pieces, "file string, block bigint, part int, first boolean, lines bigint, line string"), "pieces")
    upto = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, 0)
    parts = F.sort_array(F.collect_list(F.struct("block", "line")))
    crossing = pieces.where(F.col("part") != WHOLE).withColumn("record", F.count_if(F.col("part") == TAIL).over(upto))
    joined = crossing.groupBy("file", "record").agg(
        F.max("first").alias("first"), F.sum("lines").alias("lines"),
        F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line"),
    )
    whole = pieces.where(F.col("part") == WHOLE)
    if not whole.select("lines").unionByName(joined.select("lines")).where(F.col("lines") > RECORD_LINES).isEmpty():
        return None
    return whole.where(~F.col("first")).select("line").unionByName(joined.where(~F.col("first")).select("line"))


# Pieces of a record in a block, in their order there: all of it, its end, its middle, its beginning.
WHOLE, HEAD, THROUGH, TAIL = range(4)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the blocks of a task. What is kept between batches is one record of at most RECORD_LINES lines."""
    key, held, count, inside, head, first = None, [], 0, False, False, False

    def out(part: int, counts: list[int], texts: pa.Array, firsts: list[bool]) -> pa.RecordBatch:
        n = len(texts)
        file, block = (key if part != WHOLE else (None, None))
        return pa.RecordBatch.from_arrays([
            pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array([part] * n, pa.int32()),
            pa.array(firsts, pa.bool_()), pa.array(counts, pa.int64()), texts.cast(pa.string()),
        ], ["file", "block", "part", "first", "lines", "line"])

    def rest(part: int) -> pa.RecordBatch:
        return out(part, [count], pa.array(["\n".join(held)], pa.string()), [first and part in (WHOLE, TAIL)])

    for batch in batches:
        files, starts = batch.column("file"), batch.column("block")
        n = batch.num_rows
        if not n:
            continue
        changes = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1])).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
        for low, high in zip(edges, edges[1:]):
            at = (files[low].as_py(), starts[low].as_py())
            if at != key:
                if inside:
                    yield rest(THROUGH if head else TAIL)
                key, held, count = at, [], 0
                inside = head = batch.column("inside")[low].as_py()
                first = batch.column("leads")[low].as_py()
            line = batch.column("line")[low:high]
            odd = pc.count_substring(line, '"').to_numpy(zero_copy_only=False) % 2
            after = (np.cumsum(odd) + inside) % 2 == 1
            before = np.concatenate(([inside], after[:-1]))
            keep = before | (pc.utf8_trim(line, " ").to_numpy(zero_copy_only=False) != "")
            line, after, before = line.filter(pa.array(keep)), after[keep], before[keep]
            if not len(line):
                continue
            begins = np.flatnonzero(~before)
            lead = int(begins[0]) if len(begins) else len(line)
            if lead:
                held += line[: min(lead, max(0, RECORD_LINES + 1 - len(held)))].to_pylist()
                count += lead
                if not after[lead - 1]:
                    yield rest(HEAD if head else WHOLE)
                    first = first and head
                    held, count, head = [], 0, False
            if len(begins):
                ends = np.append(begins, len(line))
                if after[-1]:
                    ends = ends[:-1]
                if len(ends) > 1:
                    whole = pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), line[int(ends[0]) : int(ends[-1])])
                    yield out(WHOLE, np.diff(ends).tolist(), pc.binary_join(whole, "\n"), [first] + [False] * (len(ends) - 2))
                    first = False
                if after[-1]:
                    held, count, head = line[int(begins[-1]) :].to_pylist(), len(line) - int(begins[-1]), False
            inside = bool(after[-1])
    if inside:
        yield rest(THROUGH if head else TAIL)


def file_headers(numbered: DataFrame) -> DataFrame:
    """One row per file: ``raw_names`` of its header line and the number of its data ``rows``."""
    names = F.transform(split_fields(F.col("line")), lambda name: F.trim(name))
    headers = numbered.where(F.col("row_position") == -1).select("file", "name", names.alias("raw_names"))
    counts = numbered.groupBy("file").agg((F.count(F.lit(1)) - 1).alias("rows"))
    return headers.join(counts, "file")
