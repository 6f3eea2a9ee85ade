"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Session dates are zone-less; instants are shown in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Whole web pages travel to Python workers; this bounds a batch of them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app: str = "barledger", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session, or reuse the running one; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
