"""Ranks and running totals within keys of any size: no key is held by one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barledger.sources.scratch import written

#: Consecutive positions of a key that one task accumulates.
SPAN = 4096


def ranked(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str = "rank", descending: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """rows with their 0-based rank among the rows of their key, by ``order``; without keys, in the whole table.

    Nulls come first, in ``descending`` columns last. The table is dealt by range of (keys, order) into ``parts`` pieces and
    written, so a key may lie in many of them. Rows are numbered within a piece; a key that began in an earlier piece adds
    its rows there. Each border between pieces is crossed by one key at most, so there are fewer such additions than
    pieces, and they are broadcast. A row number breaks ties, which spreads any number of equal rows; their ranks are
    distinct, in an order that is fixed once the pieces are written.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.withColumn("__tie", F.monotonically_increasing_id())
    by = [*(F.col(c).desc() if c in descending else F.col(c).asc() for c in order), F.col("__tie")]
    dealt = numbered.repartitionByRange(parts, *(F.col(k).asc() for k in keys), *by).withColumn("__part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    inside = Window.partitionBy("__part", *keys).orderBy(*by)
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        dealt.groupBy("__part", *keys).agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(before)).where("__before > 0")
        .select(F.col("__part").alias("__of"), *[F.col(k).alias(f"__of_{k}") for k in keys], "__before")
    )
    match = F.col("__part") == F.col("__of")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    placed = dealt.withColumn("__rank", F.row_number().over(inside).cast("bigint") - 1)
    return placed.join(F.broadcast(carried), match, "left").select(
        *rows.columns, (F.col("__rank") + F.coalesce("__before", F.lit(0))).alias(rank)
    )


def running(
    rows: DataFrame, keys: Sequence[str], position: str, sums: Mapping[str, str], xors: Mapping[str, str] = {},
    span: int = SPAN,
) -> DataFrame:
    """rows with running totals, each row's own value included: ``sums`` and ``xors`` name {result: column}.

    ``position`` is a whole number, distinct within a key. A task totals ``span`` positions of a key; the totals of earlier
    spans are added to them, one row for each span. Nulls count as 0. ``rows`` is read twice, so it should be a table.
    """
    piece = F.floor(F.col(position) / span)
    wanted = [*((F.sum, r, c) for r, c in sums.items()), *((F.bit_xor, r, c) for r, c in xors.items())]
    kept = rows.withColumn("__span", piece)
    inside = Window.partitionBy(*keys, "__span").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    earlier = kept.groupBy(*keys, "__span").agg(*(f(zero(c)).alias(f"__{r}") for f, r, c in wanted))
    earlier = earlier.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__span").alias("__of"),
        F.lag("__span").over(Window.partitionBy(*keys).orderBy("__span")).alias("__last"),
        *(f(F.col(f"__{r}")).over(before).alias(f"__{r}") for f, r, _ in wanted),
    ).where("__last IS NOT NULL").drop("__last")
    match = F.col("__span") == F.col("__of")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    totalled = kept
    for f, result, column in wanted:
        totalled = totalled.withColumn(f"__in_{result}", f(zero(column)).over(inside))
    joined = totalled.join(earlier, match, "left")
    results = [
        *((F.col(f"__in_{r}") + zero(f"__{r}")).alias(r) for r in sums),
        *(F.col(f"__in_{r}").bitwiseXOR(zero(f"__{r}")).alias(r) for r in xors),
    ]
    return joined.select(*rows.columns, *results)
