"""Joining rows to per-key facts when one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot above this many rows. There can be at most (all rows / HOT_ROWS) such keys, which
# bounds what is broadcast: 10^12 rows have at most 200,000 hot keys, some tens of megabytes.
HOT_ROWS = 5_000_000


def attach_by_key(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], size: str, hot_rows: int = HOT_ROWS, *, salt: str | None = None,
) -> DataFrame:
    """Left join ``rows`` to ``per_key``, which has one row per key and its row count ``size``.

    Hot keys are few by counting, so they are broadcast and their facts are found without moving a
    row. Every other key has at most ``hot_rows`` rows and is joined on the key; rows of hot keys
    and rows with a null in their key pass through that join under a key of their own, a hash of
    the whole row, which spreads any number of them over the tasks and matches nothing.
    ``size`` itself is not part of the result. ``salt`` names a column for the key of their own, zero for all other rows:
    those of equal keys and salt are together then.
    """
    payload = [name for name in per_key.columns if name not in (*keys, size)]
    on_hot = [f"__key_{name}" for name in keys]

    hot = per_key.where(F.col(size) > hot_rows).select(
        *[F.col(name).alias(alias) for name, alias in zip(keys, on_hot)],
        F.struct(*[F.col(name) for name in payload]).alias("__hot"),
    )
    matched = rows.join(
        F.broadcast(hot), [F.col(name) == F.col(alias) for name, alias in zip(keys, on_hot)], "left"
    ).drop(*on_hot)

    spread = spread_of(rows)
    unmatched = F.col("__hot").isNotNull()
    for name in keys:
        unmatched = unmatched | F.col(name).isNull()
    salted = matched.withColumn("__salt", F.when(unmatched, spread).otherwise(F.lit(0)))
    cold = per_key.where(F.col(size) <= hot_rows).select(
        *keys, F.lit(0).cast("bigint").alias("__salt"), F.struct(*[F.col(name) for name in payload]).alias("__cold")
    )
    found = F.coalesce(F.col("__hot"), F.col("__cold"))
    return salted.join(cold, [*keys, "__salt"], "left").select(
        *rows.columns, *[found.getField(name).alias(name) for name in payload],
        *([F.col("__salt").alias(salt)] if salt else []),
    )


def spread_of(rows: DataFrame) -> Column:
    """A hash of the whole row that spreads rows of one key; odd, so never the zero of the others."""
    return F.xxhash64(F.spark_partition_id(), *[F.col(name) for name in _hashable(rows)]).bitwiseOR(F.lit(1))


def _hashable(rows: DataFrame) -> list[str]:
    return [name for name, dtype in rows.dtypes if "map<" not in dtype and "variant" not in dtype]


def row_counts(rows: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Rows per key, counted in every task before the shuffle."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(size))
