"""Dated deal files ``{kind}deals_ddMonYYYY.csv`` in a landing directory.

Files of any mix of columns are read by one job: known columns become columns (of several with one
folded name the first), the others a map.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barledger import fixed_values as fv
from barledger.functions.values import once
from barledger.operators.deals import check_request
from barledger.operators.quality import clean_rows
from barledger.operators.skew import HOT_ROWS, attach_by_key
from barledger.sources.lines import file_headers, number_lines, open_quote, plain_path, read_files, read_lines, split_fields
from barledger.sources.scratch import written

FILE_NAME = r"(bulk|block)deals_([0-9]{2}[A-Za-z]{3}[0-9]{4})\.csv$"
KNOWN_COLUMNS = ("date", "symbol", "quantity", "price", "client")
# Prices of more decimals than the type has are kept as text only.
PRICE_TYPE, EXACT_PRICE = "decimal(38,12)", r"^[+-]?[0-9]*(\.[0-9]{0,12})?$"


def landed_lines(spark: SparkSession, directory: str, kind: str, start: date, end: date) -> DataFrame:
    """Lines of the family's files dated in the inclusive range; a file's name gives its day."""
    check_request(kind, start, end)
    day = F.try_to_date(F.regexp_extract("name", FILE_NAME, 2), "ddMMMyyyy")
    lines = read_lines(spark, directory, f"{kind}deals_*.csv")
    return lines.where((F.regexp_extract("name", FILE_NAME, 1) == kind) & day.between(F.lit(start), F.lit(end)))


def landed_files(spark: SparkSession, directory: str, kind: str, start: date, end: date) -> DataFrame:
    """``file`` and ``day`` of the family's files dated in the inclusive range, empty files too."""
    check_request(kind, start, end)
    day = F.try_to_date(F.regexp_extract("name", FILE_NAME, 2), "ddMMMyyyy")
    files = read_files(spark, directory, f"{kind}deals_*.csv").where(F.regexp_extract("name", FILE_NAME, 1) == kind)
    return files.select(plain_path(F.col("file")).alias("file"), day.alias("day")).where(F.col("day").between(F.lit(start), F.lit(end)))


def deal_headers(numbered: DataFrame) -> DataFrame:
    """Per file: family, day, its names and whether they include date and symbol.

    Names are made distinct the way a repeated column is told apart: ``name``, then the first of
    ``name.1``, ``name.2``, … that no column before has.
    """

    def added(names: Column, name: Column) -> Column:
        more = F.transform(
            F.sequence(F.lit(0), F.size(names)),
            lambda i: F.when(i == 0, name).otherwise(F.concat(name, F.lit("."), i.cast("string"))),
        )
        return F.array_append(names, F.get(F.filter(more, lambda one: ~F.array_contains(names, one)), F.lit(0)))

    distinct = F.aggregate("raw_names", F.array().cast("array<string>"), added)
    folded = F.transform("raw_names", lambda name: F.lower(name))
    return file_headers(numbered).select(
        "file",
        F.regexp_extract("name", FILE_NAME, 1).alias("kind"),
        F.try_to_date(F.regexp_extract("name", FILE_NAME, 2), "ddMMMyyyy").alias("day"),
        "rows",
        folded.alias("folded"),
        distinct.alias("names"),
        (F.size(F.array_except(F.array(*map(F.lit, fv.DEAL_REQUIRED)), folded)) == 0).alias("header_ok"),
    )


def scan_deals(
    spark: SparkSession, directory: str, kind: str, start: date, end: date, *, hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Deal rows of the range and one fetch record per file, for the family ledger.

    A file without date and symbol columns, with a row of more fields than its header, or with a
    line that ends inside quotes gives no rows and is recorded as unusable; so is a file without any
    line. ``deal_date`` is the row's own date and null where it has none that parses; ``file_day`` is
    the file's. Dates, quantities and prices keep their text beside the typed value, which is null
    rather than rounded.
    """
    numbered = number_lines(landed_lines(spark, directory, kind, start, end), hot_rows=hot_rows)
    rows, files = deals_of_lines(numbered, hot_rows=hot_rows)
    judged = files.select(plain_path(F.col("file")).alias("file"), "header_ok", "rows")
    listed = landed_files(spark, directory, kind, start, end)
    fetches = listed.join(judged, "file", "left").select(
        F.lit(kind).alias("kind"), "day", F.lit(200).alias("status"),
        F.coalesce("header_ok", F.lit(False)).alias("header_ok"), F.coalesce("rows", F.lit(0)).alias("rows"),
    )
    return rows, fetches


def deals_of_lines(numbered: DataFrame, *, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Deal rows, and one judged row per file, of numbered lines (file, name, row_position, line).

    The lines are written once: headers, counts and rows are read from there.
    """
    numbered = written(numbered.select("file", "name", "row_position", "line"), "lines")
    headers = deal_headers(numbered)
    rows = numbered.where(F.col("row_position") >= 0)
    named = attach_by_key(rows, headers.withColumn("__rows", F.col("rows")).drop("rows"), ["file"], "__rows", hot_rows)
    split = named.select("*", once(split_fields(F.col("line"))).alias("values")).withColumn(
        "too_long", (F.size("values") > F.size("names")) | open_quote(F.col("line"))
    )
    broken = split.groupBy("file").agg(F.count(F.lit(1)).alias("__lines"), F.max("too_long").alias("broken"))
    files = headers.join(broken.select("file", "broken"), "file", "left").withColumn(
        "header_ok", F.col("header_ok") & ~F.coalesce(F.col("broken"), F.lit(False))
    )
    usable = attach_by_key(split, broken, ["file"], "__lines", hot_rows).where(F.col("header_ok") & ~F.col("broken"))
    return _deal_columns(usable), files


def _deal_columns(split: DataFrame) -> DataFrame:
    """Known columns by case-folded name, every other one in ``extras``."""
    short = F.size("names") - F.size("values")
    filled = F.concat("values", F.array_repeat(F.lit(None).cast("string"), short))
    cells = split.withColumn("__cells", filled)
    place = {name: F.array_position("folded", name).cast("int") for name in KNOWN_COLUMNS}
    taken = F.array(*place.values())
    others = F.filter(
        F.transform("__cells", lambda value, i: F.struct(F.get("names", i).alias("name"), value.alias("value"), i.alias("i"))),
        lambda cell: ~F.array_contains(taken, cell["i"] + 1),
    )
    text = {name: F.nullif(F.trim(F.when(at > 0, F.get("__cells", at - 1))), F.lit("")) for name, at in place.items()}
    number = F.regexp_replace(text["quantity"], ",", "")
    price = F.regexp_replace(text["price"], ",", "")
    return cells.select(
        "kind",
        F.col("day").alias("file_day"),
        F.coalesce(F.try_to_date(text["date"], "yyyy-MM-dd"), F.try_to_date(text["date"], "dd-MMM-yyyy")).alias("deal_date"),
        text["symbol"].alias("symbol"),
        number.try_cast("bigint").alias("quantity"),
        F.when(price.rlike(EXACT_PRICE), price.try_cast(PRICE_TYPE)).alias("price"),
        text["client"].alias("client"),
        *[text[name].alias(f"{name}_text") for name in ("date", "quantity", "price")],
        F.map_from_entries(F.transform(others, lambda cell: F.struct(cell["name"], cell["value"]))).alias("extras"),
    )


def save_deals(deals: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Write cleaned deals partitioned by family; True only when there was something to write.

    A map column cannot take part in whole-row comparison, so extras are compared as sorted
    entries and written as such.
    """
    entries = F.sort_array(F.map_entries("extras"))
    cleaned = clean_rows(deals.withColumn("extras", entries))
    cleaned.write.mode(mode).partitionBy("kind").parquet(path)
    return not deals.sparkSession.read.schema(cleaned.schema).parquet(path).isEmpty()
