"""Listing documents and corporate-action arrays in JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barledger import fixed_values as fv


def flatten_listings(documents: DataFrame, *, body: str = "body") -> DataFrame:
    """``{"Table": [{…}]}`` documents to one row per company; absent keys are null.

    A document without a ``Table`` has no companies.
    """
    items = F.from_json(body, "Table array<map<string,string>>").getField("Table")
    return documents.select(F.explode(items).alias("__item")).select(
        *[F.try_element_at("__item", F.lit(key)).alias(name) for key, name in fv.LISTING_COLUMNS.items()]
    )


def count_actions(documents: DataFrame, *, body: str = "body") -> DataFrame:
    """Number of records of each corporate-action document, null when it is not JSON."""
    size = F.coalesce(F.json_array_length(body), F.size(F.json_object_keys(body)))
    return documents.withColumn("actions", size).drop(body)
