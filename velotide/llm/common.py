"""Helpers shared by the training-data operators.

Intermediate tables are written to the shared folder the cluster names in
``spark.checkpoint.dir`` and read back: they survive the loss of an executor
and cut the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.session import scratch_path

# the white space of the word definition [^\x20\x09-\x0D]+
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_key(col) -> F.Column:
    """Null ids sort last and count as one id."""
    return F.coalesce(F.col(col).cast("long"), F.lit((1 << 63) - 1))
