"""CSV, catalog and database tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from barledger import fixed_values as fv
from barledger.functions.values import DECIMAL_TEXT, missing_text_to_null, number_of_text
from barledger.sources.lines import data_records, located, open_quote, split_fields

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
CORRUPT = "__record"
# Decimal digits that every double holds, and that the widest decimal has.
DOUBLE_DIGITS, DECIMAL_DIGITS = 15, 38


def load_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, *, unparsed: str | None = None,
) -> DataFrame | None:
    """A CSV table with its header, or None when there is nothing at ``path`` or it is no table.

    A row with more cells than the header has is no row of it, so such a file is not read at all. Records with line breaks
    in quotes are joined from their lines by many tasks. Text is read first and the tokens of a missing value become null.
    With a schema the columns are then cast; a cell that does not parse is null, and ``unparsed`` names a further column
    with the label and text of every such cell of the row. Without a schema each column gets the narrowest of bigint,
    double, decimal and string that holds all its cells unchanged. What that takes is found in one pass over the lines.
    """
    try:
        names = spark.read.csv(path, header=True, inferSchema=False, escape='"').columns
        lines = spark.read.text(path)
    except AnalysisException:
        return None
    if not names:
        return None
    fields = T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])
    cells = lambda line: F.from_csv(line, fields.toDDL(), {"escape": '"', "columnNameOfCorruptRecord": CORRUPT})
    head = lines.first()[0]
    read = lines.where(F.trim("value") != "").select(
        "value", F.col("_metadata.file_path").alias("__file"), (F.col("value") == head).alias("__head"), cells(F.col("value")).alias("__cells"),
    )
    facts = read.agg(
        F.count_if(open_quote(F.col("value"))).alias("open"), F.count_if("__head").alias("heads"),
        F.count_distinct("__file").alias("files"),
        F.count_if(F.size(split_fields(F.col(f"__cells.{CORRUPT}"))) > len(names)).alias("long"),
        *(_tests(names, lambda name: F.when(~F.col("__head"), missing_text_to_null(F.col(f"__cells.`{name}`")))) if schema is None else []),
    ).first()
    if facts["open"]:
        records = data_records(located(lines))
        if records is None:
            return None
        text = records.select(cells(F.col("line")).alias("__cells")).select("__cells.*")
        facts = text.agg(
            F.count_if(F.size(split_fields(F.col(CORRUPT))) > len(names)).alias("long"),
            *(_tests(names, lambda name: missing_text_to_null(F.col(f"`{name}`"))) if schema is None else []),
        ).first()
    else:
        text = spark.read.csv(
            path, fields, header=True, escape='"', columnNameOfCorruptRecord=CORRUPT, enforceSchema=True,
        )
    if facts["long"]:
        return None
    clean = text.select([missing_text_to_null(F.col(f"`{name}`")).alias(name) for name in names])
    # a row that reads like the header has text in every column
    like_header = "heads" in facts and facts["heads"] > facts["files"]
    types = _declared(schema) if schema is not None else {} if like_header else _types(names, facts)
    cast = {name: _cast(name, types.get(name, T.StringType())) for name in names}
    columns = list(cast.values())
    if unparsed:
        lost = [
            F.when(F.col(f"`{name}`").isNotNull() & value.isNull(), F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").alias("text")))
            for name, value in cast.items()
        ]
        columns.append(F.array_compact(F.array(*lost)).alias(unparsed))
    return clean.select(columns)


def _declared(schema: str | T.StructType) -> dict[str, T.DataType]:
    parsed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return {field.name: field.dataType for field in parsed}


def _tests(names: list[str], cell: Callable[[str], Column]) -> list[Column]:
    """Counts and digits of the cells of each column, for one aggregation."""
    tests = []
    for position, name in enumerate(names):
        value = cell(name)
        number = F.trim(value)
        plain = value.rlike(DECIMAL_TEXT) & ~value.rlike("[eE]")
        mantissa = F.regexp_replace(F.regexp_replace(number, "[eE].*$", ""), "[^0-9]", "")
        digits = F.length(F.regexp_replace(mantissa, "^0+", ""))
        text = number_of_text(value).cast("string")
        wide = f"decimal({DECIMAL_DIGITS},{DECIMAL_DIGITS // 2})"
        held = (digits <= DOUBLE_DIGITS) | F.coalesce((text == number) | (text.try_cast(wide) == number.try_cast(wide)), F.lit(False))
        tests += [
            F.count(value).alias(f"present_{position}"),
            F.count_if(value.rlike(INTEGER_TEXT)).alias(f"whole_{position}"),
            F.count_if(value.rlike(INTEGER_TEXT) & number.try_cast("bigint").isNotNull()).alias(f"long_{position}"),
            F.count_if(value.rlike(DECIMAL_TEXT) & held).alias(f"double_{position}"),
            F.count_if(plain).alias(f"plain_{position}"),
            F.max(F.when(plain, F.length(F.regexp_extract(number, r"^[+-]?0*([0-9]*)", 1)))).alias(f"before_{position}"),
            F.max(F.when(plain, F.length(F.regexp_extract(number, r"\.([0-9]*)", 1)))).alias(f"after_{position}"),
        ]
    return tests


def _types(names: list[str], facts: Row) -> dict[str, T.DataType]:
    """Column types of what _tests found. Whole numbers that no bigint holds stay whole: beside fractions they are text."""
    types = {}
    for position, name in enumerate(names):
        present, whole, fits, double, plain, before, after = (
            facts[f"{fact}_{position}"] for fact in ("present", "whole", "long", "double", "plain", "before", "after")
        )
        if not present:
            continue
        if fits == present:
            types[name] = T.LongType()
        elif fits < whole:
            if whole == present and before <= DECIMAL_DIGITS:
                types[name] = T.DecimalType(DECIMAL_DIGITS, 0)
        elif double == present and (after or plain < present):
            types[name] = T.DoubleType()
        elif plain == present and before + after <= DECIMAL_DIGITS:
            types[name] = T.DecimalType(max(before + after, after + 1), after)
    return types


def _cast(name: str, dtype: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        return value.alias(name)
    if isinstance(dtype, T.DoubleType):
        return number_of_text(value).alias(name)
    return F.trim(value).try_cast(dtype).alias(name)


def save_csv(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A header and no row index; the directory's ``_SUCCESS`` marks a finished write."""
    table.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def save_prices(published: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Published prices in symbol and date order.

    A range sort, so a symbol of any size is cut by date over as many tasks as it needs.
    """
    ordered = published.orderBy("symbol", "date")
    writer = ordered.write.mode(mode).format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def load_catalog(spark: SparkSession, directory: str, files: Mapping[str, str] = fv.CATALOG_FILES) -> dict[str, DataFrame]:
    """The optional tables found in a directory, also registered as views for SQL.

    An absent file is an absent table, not an error.
    """
    found = {}
    for name, filename in files.items():
        table = load_csv(spark, f"{directory.rstrip('/')}/{filename}")
        if table is not None:
            table.createOrReplaceTempView(name)
            found[name] = table
    return found


def save_table(table: DataFrame, name: str, *, keys: tuple[str, ...] = (), buckets: int = 0, mode: str = "errorifexists") -> None:
    """Save to the session catalog, bucketed by ``keys`` when later joins share them."""
    writer = table.write.mode(mode).format("parquet")
    if buckets and keys:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The whole table from the session catalog."""
    return spark.table(name)


def read_database(
    spark: SparkSession, url: str, table: str, *, split_by: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 1, **options: str,
) -> DataFrame:
    """The whole of a database table through JDBC.

    With ``split_by`` and ``bounds`` the rows are read by ``partitions`` tasks; the bounds only
    set the strides, rows outside them are read too.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_by and bounds:
        reader = reader.options(
            partitionColumn=split_by, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()
