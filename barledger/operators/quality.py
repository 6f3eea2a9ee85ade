"""Whole-table quality: de-duplication, validation, renaming, alignment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from barledger.functions.values import is_missing


def clean_rows(table: DataFrame) -> DataFrame:
    """Drop rows that repeat a whole row. Missing values stay missing; nothing is filled in."""
    return table.dropDuplicates()


def validate_table(table: DataFrame) -> DataFrame:
    """One row: row count, missing cells, repeated rows and the overall verdict.

    Equal rows are counted together before the shuffle, so copies of one row cost one record
    per task, and the missing cells are counted once per distinct row and weighted.
    """
    missing = sum(
        (F.when(is_missing(F.col(field.name), field.dataType), 1).otherwise(0) for field in table.schema),
        start=F.lit(0),
    )
    distinct = table.groupBy(*table.columns).agg(F.count(F.lit(1)).alias("__copies"))
    totals = distinct.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(missing * F.col("__copies")), F.lit(0)).alias("null_cells"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    return totals.withColumn(
        "valid", (F.col("rows") > 0) & (F.col("null_cells") == 0) & (F.col("duplicate_rows") == 0)
    )


def standardize_columns(table: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names the table does not have are ignored."""
    return table.withColumnsRenamed(dict(mapping))


def append_tables(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append by column name; a column a table lacks is null in its rows."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
