"""Table scans by name (the models' ``source()`` / ``ref()``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet`` (a file or a partitioned folder)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
