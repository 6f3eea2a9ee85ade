"""Acceptance checks of a finished bundle: files, checksums, dates, provenance, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barledger import fixed_values as fv
from barledger.functions.market import day_bit

FILE_CONTENT = "struct<bytes:bigint,sha256:string>"


def verify_checksums(manifest: DataFrame, actual: DataFrame, *, key: str = "file") -> DataFrame:
    """Full outer join of recorded and actual (key, sha256, bytes), one status per file."""
    recorded = manifest.select(key, F.col("sha256").alias("__recorded"), F.col("bytes").alias("__recorded_bytes"))
    found = actual.select(key, F.col("sha256").alias("__actual"), F.col("bytes").alias("__actual_bytes"))
    same = (F.col("__recorded") == F.col("__actual")) & (F.col("__recorded_bytes") == F.col("__actual_bytes"))
    status = (
        F.when(F.col("__actual").isNull(), F.lit("missing_file"))
        .when(F.col("__recorded").isNull(), F.lit("unexpected_file"))
        .when(same, F.lit("verified"))
        .otherwise(F.lit("checksum_mismatch"))
    )
    return recorded.join(found, key, "full_outer").select(key, status.alias("status"))


def date_set_difference(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key, how many expected dates are missing and how many dates were not expected."""
    keys = list(keys)
    both = [*keys, "date"]
    left = expected.select(*both).distinct().withColumn("__expected", F.lit(True))
    right = actual.select(*both).distinct().withColumn("__actual", F.lit(True))
    return left.join(right, both, "full_outer").groupBy(*keys).agg(
        F.count_if(F.col("__actual").isNull()).alias("missing_dates"),
        F.count_if(F.col("__expected").isNull()).alias("unexpected_dates"),
    )


def price_sample_checks(
    expected: DataFrame, prices: DataFrame, keys: Sequence[str], provider_symbol: Column,
) -> DataFrame:
    """Per key: the exact expected date set, one row per date, and single-valued provenance.

    Both sides meet in one aggregation, in which a key's dates are bits of one number for every 64 days. A row without a
    date matches nothing.
    """
    keys = list(keys)
    wanted = expected.select(*keys, "date", F.lit(True).alias("__expected"), F.lit(False).alias("__source"), F.lit(False).alias("__symbol"))
    found = prices.select(
        *keys, "date", F.lit(False).alias("__expected"),
        (F.col("source").isNull() | (F.col("source") != fv.PRICE_SOURCE)).alias("__source"),
        (F.col("provider_symbol").isNull() | (F.col("provider_symbol") != provider_symbol)).alias("__symbol"),
    )
    block, bit = day_bit(F.col("date"))
    asked = F.col("__expected")
    blocks = wanted.unionByName(found).groupBy(*keys, block.alias("__block")).agg(
        F.coalesce(F.bit_or(F.when(asked, bit)), F.lit(0)).alias("__wanted"),
        F.coalesce(F.bit_or(F.when(~asked, bit)), F.lit(0)).alias("__found"),
        F.count_if(asked & F.col("date").isNull()).alias("__dateless"),
        F.count_if(~asked).alias("__rows"), F.count_if("__source").alias("__source"), F.count_if("__symbol").alias("__symbol"),
    )
    facts = blocks.groupBy(*keys).agg(
        F.bool_and((F.col("__wanted") == F.col("__found")) & F.col("__block").isNotNull()).alias("dates_match"),
        (F.sum(F.bit_count("__wanted")) + F.count_if(F.col("__dateless") > 0)).alias("expected_rows"),
        F.sum("__rows").alias("rows"), F.sum("__source").alias("foreign_source"), F.sum("__symbol").alias("foreign_symbol"),
    )
    return facts.select(
        *keys, "dates_match",
        ((F.col("rows") > 0) & (F.col("rows") == F.col("expected_rows"))).alias("count_matches"),
        ((F.col("rows") > 0) & (F.col("foreign_source") == 0) & (F.col("foreign_symbol") == 0)).alias("provenance_matches"),
    )


def snapshot_sample_checks(
    snapshots: DataFrame, keys: Sequence[str], name_contains: str | None = None,
) -> DataFrame:
    """Per key: one snapshot, positive cap, verified currency and, where asked, the issuer's name."""
    cap_ok = F.coalesce(F.col("market_cap") > 0, F.lit(False))
    currency_ok = F.coalesce(F.col("market_cap_currency") == fv.SNAPSHOT_CURRENCY, F.lit(False))
    named = F.lit(True)
    if name_contains is not None:
        named = F.coalesce(F.lower("name").contains(name_contains.lower()), F.lit(False))
    return snapshots.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count_if(~cap_ok).alias("__caps"),
        F.count_if(~currency_ok).alias("__currencies"),
        F.count_if(~named).alias("__names"),
    ).select(
        *keys,
        (F.col("__rows") == 1).alias("one_snapshot"),
        (F.col("__caps") == 0).alias("cap_positive"),
        (F.col("__currencies") == 0).alias("currency_verified"),
        (F.col("__names") == 0).alias("name_matches"),
    )


def identity_checks(manifests: DataFrame, expected: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Per key: one manifest there is, and it names the producer, source and scope that were expected."""
    same = F.lit(True)
    for name, value in expected.items():
        same = same & F.coalesce(F.col(name) == value, F.lit(False))
    return manifests.groupBy(*keys).agg(F.count(F.lit(1)).alias("__manifests"), F.count_if(~same).alias("__foreign")).select(
        *keys, (F.col("__manifests") == 1).alias("one_manifest"), (F.col("__foreign") == 0).alias("producer_matches")
    )


def inventory_checks(
    wanted: DataFrame, recorded: DataFrame, actual: DataFrame, keys: Sequence[str], *, file: str = "file",
) -> DataFrame:
    """Per key: the sets of files that should be there, that the manifest lists and that lie there are one set.

    ``wanted`` has the keys and ``file``; ``recorded`` and ``actual`` have ``sha256`` and ``bytes`` besides.
    """
    keys = list(keys)
    listed = None
    for side, rows in (("wanted", wanted), ("recorded", recorded), ("actual", actual)):
        content = {name: F.lit(None).cast(FILE_CONTENT).alias(name) for name in ("recorded", "actual")}
        if side in content:
            content[side] = F.struct(F.col("bytes").cast("bigint"), "sha256").cast(FILE_CONTENT).alias(side)
        one = rows.select(*keys, F.col(file).alias("file"), F.lit(side == "wanted").alias("wanted"), *content.values())
        listed = one if listed is None else listed.unionByName(one)
    return listed_inventory_checks(listed, keys)


def listed_inventory_checks(listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """inventory_checks of one table: the keys, ``file``, ``wanted``, and as FILE_CONTENT ``recorded`` and ``actual``.

    A row says what it knows of its file: false or null stands for no entry. The rows are dealt once by key and file and
    counted there, then the files of a key are counted in every task before they meet. A file that one side has twice with
    different contents fails its checksum. A key without files is not in the result.
    """
    keys = list(keys)
    contents = [
        F.when(F.col(side).isNotNull(), F.concat_ws(":", F.col(f"{side}.bytes").cast("string"), f"{side}.sha256"))
        for side in ("recorded", "actual")
    ]
    # of the contents recorded and found there is one, or something differs
    files = listed.groupBy(*keys, "file").agg(
        F.bool_or("wanted").alias("wanted"), (F.count("recorded") > 0).alias("recorded"), (F.count("actual") > 0).alias("actual"),
        F.coalesce(F.min(F.least(*contents)) == F.max(F.greatest(*contents)), F.lit(False)).alias("same"),
    )
    return files.groupBy(*keys).agg(
        F.bool_and(F.col("recorded") == F.col("wanted")).alias("manifest_files_exact"),
        F.bool_and(F.col("actual") | ~F.col("wanted")).alias("no_file_missing"),
        F.bool_and(F.col("wanted") | ~F.col("actual")).alias("no_file_extra"),
        F.bool_and(F.col("same") & F.col("actual") | ~F.col("recorded")).alias("checksums_match"),
    )


def coverage_checks(coverage: DataFrame, keys: Sequence[str], families: Sequence[str]) -> DataFrame:
    """Per key: every family has requests, and all of them were returned.

    ``coverage`` has the keys, ``family``, and ``requested`` and ``returned`` as numbers; a key's rows of a family add up.
    """
    checks = []
    for family in families:
        mine = F.col("family") == family
        asked, back = (F.sum(F.when(mine, F.col(name))) for name in ("requested", "returned"))
        checks.append(F.coalesce((asked > 0) & (asked == back), F.lit(False)))
    complete = checks[0]
    for check in checks[1:]:
        complete = complete & check
    return coverage.groupBy(*keys).agg(complete.alias("coverage_complete"))


def accept(checks: DataFrame, *others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join check tables over all keys of the first; a missing check is a failed one.

    Another table may be keyed by fewer of the keys; it then holds for all keys that extend them.
    """
    keys = list(keys)
    joined = checks
    for other in others:
        joined = joined.join(other, [key for key in keys if key in other.columns], "left")
    names = [name for name in joined.columns if name not in keys]
    passed = F.lit(True)
    for name in names:
        passed = passed & F.coalesce(F.col(name), F.lit(False))
    return joined.select(
        *keys, *[F.coalesce(F.col(name), F.lit(False)).alias(name) for name in names], passed.alias("accepted")
    )
