"""Fundamentals documents: response shape, acceptance gate and the 23-column snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barledger import fixed_values as fv
from barledger.functions.market import issuer_symbol
from barledger.functions.values import once

NUMBER_TYPE = r"^(BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))$"


def parse_snapshots(documents: DataFrame, *, body: str = "body") -> DataFrame:
    """Parse each document once; its values keep the types the source gave them."""
    return documents.select("*", once(F.try_parse_json(body)).alias("payload")).drop(body)


def _at(path: str, kind: str = "variant") -> Column:
    return F.try_variant_get("payload", path, kind)


def _type_name(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    return F.lower(F.regexp_extract(shape, "^[A-Z]+", 0))


def response_shape(parsed: DataFrame) -> DataFrame:
    """Shape of every response without any of its values, except the quoted currency."""
    fields = F.map_keys(_at("$", "map<string,variant>"))
    return parsed.select(
        *[name for name in parsed.columns if name not in ("payload", "symbol")],
        F.col("symbol").alias("requested_symbol"),
        F.coalesce(_type_name(F.col("payload")), F.lit("missing")).alias("payload_type"),
        F.size(fields).alias("field_count"),
        F.coalesce(F.sort_array(fields), F.array().cast("array<string>")).alias("fields"),
        _type_name(_at("$.marketCap")).alias("market_cap_type"),
        F.coalesce(F.array_contains(fields, "marketCap"), F.lit(False)).alias("market_cap_present"),
        _at("$.currency", "string").alias("currency"),
        F.coalesce(_at("$.symbol", "string") == F.col("symbol"), F.lit(False)).alias("symbol_matches"),
    )


def snapshot_gate(parsed: DataFrame) -> DataFrame:
    """Add ``fault``: null when the identity, the market cap and its currency all hold.

    The cap must be a number in the document: text and booleans are not converted.
    """
    identity = F.schema_of_variant("payload").startswith("OBJECT") & (_at("$.symbol", "string") == F.col("symbol"))
    cap = _at("$.marketCap", "double")
    numeric = F.schema_of_variant(_at("$.marketCap")).rlike(NUMBER_TYPE)
    cap_ok = numeric & ~F.isnan(cap) & (F.abs(cap) != float("inf")) & (cap > 0)
    currency = F.schema_of_variant(_at("$.currency")).startswith("STRING") & (
        _at("$.currency", "string") == fv.SNAPSHOT_CURRENCY
    )
    return parsed.withColumn(
        "fault",
        F.when(~F.coalesce(identity, F.lit(False)), F.lit("issuer_identity_mismatch"))
        .when(~F.coalesce(cap_ok, F.lit(False)), F.lit("no_valid_market_cap"))
        .when(~F.coalesce(currency, F.lit(False)), F.lit("currency_not_verified")),
    )


def snapshot_table(gated: DataFrame, *, provider_version: str, retrieved_at_utc: str) -> DataFrame:
    """The 23-column snapshot of every accepted document, provenance first."""
    text = {name: _at(f"$.{key}", "string").alias(name) for name, key in fv.SNAPSHOT_TEXT.items()}
    numbers = [_at(f"$.{key}", "double").alias(name) for name, key in fv.SNAPSHOT_NUMBERS.items()]
    return gated.where(F.col("fault").isNull()).select(
        issuer_symbol(F.col("symbol")).alias("symbol"),
        F.col("symbol").alias("provider_symbol"),
        F.lit(fv.PRICE_SOURCE).alias("source"),
        F.lit(provider_version).alias("provider_version"),
        F.lit(retrieved_at_utc).alias("retrieved_at_utc"),
        F.lit(True).alias("snapshot_only"),
        _at("$.currency", "string").alias("market_cap_currency"),
        *text.values(),
        *numbers,
    )
