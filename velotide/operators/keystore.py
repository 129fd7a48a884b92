"""Uniqueness against history without shuffling the history.

The store is a table of (key, n) per batch in hash buckets, sorted by key.  A new
batch groups its own keys, and only these are shuffled, into the store's buckets:
Spark joins them with the stored files bucket by bucket, without an exchange of
the stored side.

The store is a catalog table over a folder, since Spark keeps a bucketing in the
catalog only.  A batch's partition is overwritten when it runs again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyStore:
    def __init__(self, spark: SparkSession, name: str, path: str, key_type: str = "string", buckets: int = 16):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key {key_type}, n BIGINT, batch STRING) USING parquet "
                  f"PARTITIONED BY (batch) CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}'")

    def add(self, rows: DataFrame, column: str, batch: str) -> DataFrame:
        """Store a batch's keys with how often each occurs; returns them."""
        keys = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        dealt = keys.repartition(self.buckets, "key").sortWithinPartitions("key").withColumn("batch", F.lit(batch))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return self.batch(batch)

    def batch(self, batch: str) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("batch") == batch).select("key", "n")

    def others(self, batch: str) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("batch") != batch).select("key", "n")

    def repeated(self, batch: str) -> DataFrame:
        """(key, n): the batch's keys that occur more than once in all batches."""
        mine = self.batch(batch)
        # the stored side keeps its buckets; what is left of it are the batch's own keys
        met = self.others(batch).join(mine.select("key").hint("shuffle_merge"), "key", "left_semi")
        return mine.union(met).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
