"""Replay dedup on the stream: which Kafka offsets have been seen.

A set of offsets is kept as intervals per (topic, partition), next to the batches
and without a watermark: an offset that comes late but for the first time is
new, however old it is, and a replay is dropped, however late.  Contiguous offsets
are one interval, so the set stays small.

Intervals end at multiples of ``CHUNK``.  Offsets are looked up in one pass over a
chunk in offset order: one is seen if an interval that begins before it reaches it.
So the work grows with offsets and intervals, not with their product, also where
offsets have gaps and every one is an interval of its own.  Each micro-batch
publishes its own intervals under its batch id; a batch that is replayed after a
crash is compared with the batches before it, not with itself.  ``compact`` merges
the intervals of closed batches and publishes them as one entry.

Rows without topic, partition or offset cannot be told apart and pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velotide.operators.dedup import first_by
from velotide.operators.versions import VersionedTable

CHUNK = 1 << 16
KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]
GROUP = ["kafka_topic", "kafka_partition", "chunk"]
INTERVALS = "kafka_topic string, kafka_partition long, chunk long, first long, last long, batch_id long"


def with_chunk(df: DataFrame) -> DataFrame:
    return df.withColumn("chunk", F.floor(F.col("kafka_offset") / CHUNK))


def merged(intervals: DataFrame) -> DataFrame:
    """Intervals with touching and overlapping ones joined."""
    before = Window.partitionBy(*GROUP).orderBy("first", "last")
    reach = F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1))
    start = F.when(F.col("first") <= reach + 1, 0).otherwise(1)
    island = F.sum("start").over(before.rowsBetween(Window.unboundedPreceding, 0))
    return intervals.withColumn("start", start).withColumn("island", island).groupBy(*GROUP, "island").agg(
        F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def intervals_of(rows: DataFrame) -> DataFrame:
    seen = with_chunk(rows.select(*KEY)).filter(" AND ".join(f"{c} IS NOT NULL" for c in KEY))
    return merged(seen.select(*GROUP, F.col("kafka_offset").alias("first"), F.col("kafka_offset").alias("last")))


class SeenOffsets:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, VersionedTable(spark, path, "batch_id")

    def before(self, batch_id: int) -> DataFrame:
        if not self.table.exists():
            return self.spark.createDataFrame([], INTERVALS)
        return self.table.read().filter(F.col("batch_id") < batch_id)

    def first_copies(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of a micro-batch whose offset no earlier batch has, each offset once."""
        known = " AND ".join(f"{c} IS NOT NULL" for c in KEY)
        fresh = first_by(batch.filter(known), KEY, ["kafka_timestamp"])
        fresh = with_chunk(fresh).withColumn("at", F.col("kafka_offset")).withColumn("last", F.lit(None).cast("long"))
        seen = self.before(batch_id).select(*GROUP, F.col("first").alias("at"), "last")
        # intervals before the offsets they may hold; an interval's row has no offset
        upto = Window.partitionBy(*GROUP).orderBy("at", F.col("last").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        met = fresh.unionByName(seen, allowMissingColumns=True).withColumn("reach", F.max("last").over(upto))
        new = met.filter(F.col("kafka_offset").isNotNull() & (F.col("reach").isNull() | (F.col("reach") < F.col("at"))))
        return new.select(*batch.columns).unionByName(batch.filter(f"NOT ({known})"))

    def record(self, rows: DataFrame, batch_id: int) -> None:
        """Publish the offsets of what the batch has written."""
        self.table.replace(intervals_of(rows).withColumn("batch_id", F.lit(batch_id).cast("long")), [batch_id])

    def compact(self, upto: int) -> None:
        """Merge the intervals of the batches up to ``upto``, which the stream is past."""
        old = self.table.read().filter(F.col("batch_id") <= upto)
        self.table.replace(merged(old).withColumn("batch_id", F.lit(upto).cast("long")), lambda b: int(b) <= upto)
