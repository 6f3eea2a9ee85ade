"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
OWN = "barledger.scratch.folder"


def shared_folder(spark: SparkSession, prefix: str = "table") -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir.

    A session on one machine without the setting gets a temporary folder, once. A cluster without it is an error: executors
    would write where others can't read.
    """
    root = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY, None) or spark.conf.get(OWN, None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{KEY} must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="barledger-")
        spark.conf.set(OWN, root)
    return f"{root.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str = "table") -> DataFrame:
    """rows, written once to the shared folder and read back; lineage ends there."""
    path = f"{shared_folder(rows.sparkSession)}/{name}"
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
