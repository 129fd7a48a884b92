"""Station-status stream: Kafka (or files of the same shape) -> raw table.

    source -> parse_status -> structural_filter -> foreachBatch(write_status_batch)

* ``parse_status`` keeps the Kafka coordinates (topic, partition, offset,
  timestamp as ``kafka_*``) and parses the JSON value with the explicit
  13-field schema; a malformed value becomes a null struct and is dropped by
  the structural filter (counts that are not integers parse as null too).
* ``write_status_batch`` stamps ``ingested_at`` and overwrites the folders
  ``poll_day=<d>/batch_id=<n>``: a micro-batch replayed after a crash rewrites the same
  folder instead of appending a second copy (the technical dedup downstream
  stays as the second line).
* Progress is the checkpoint's; the trigger is a parameter (default: as fast
  as possible; ``availableNow`` for tests and catch-up runs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from velotide.operators.broadcast import materialise
from velotide.operators.incremental import drop_partitions, replace_whole
from velotide.streaming.offsets import SeenOffsets

STATUS_EVENT_SCHEMA = StructType([
    StructField("station_id", StringType()),
    StructField("num_bikes_available", LongType()),
    StructField("num_bikes_disabled", LongType()),
    StructField("num_docks_available", LongType()),
    StructField("num_docks_disabled", LongType()),
    StructField("is_installed", LongType()),
    StructField("is_renting", LongType()),
    StructField("is_returning", LongType()),
    StructField("last_reported", LongType()),
    StructField("snapshot_id", StringType()),
    StructField("poll_time", StringType()),
    StructField("feed_last_updated", LongType()),
    StructField("feed_ttl", LongType()),
])

# columns of a Kafka source (the file source used in tests has the same ones)
KAFKA_RECORD_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

REQUIRED = ["last_reported", "num_bikes_available", "num_docks_available", "is_installed", "is_renting",
            "is_returning"]


def read_status_stream(spark: SparkSession, source: str = "kafka", options: dict | None = None) -> DataFrame:
    """``source='kafka'``: options need ``kafka.bootstrap.servers`` and
    ``subscribe``; reading starts at the earliest offsets.  ``source='files'``:
    options need ``path`` (parquet files with the Kafka record columns)."""
    opts = dict(options or {})
    if source == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        return spark.readStream.format("kafka").options(**opts).load()
    path = opts.pop("path")
    return spark.readStream.schema(KAFKA_RECORD_SCHEMA).options(**opts).parquet(path)


def parse_status(records: DataFrame) -> DataFrame:
    """The value is parsed as the output of a one-element generator: the tests of
    the structural filter are then made on the parsed fields, instead of each of
    them parsing the value again."""
    return records.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("bigint").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(F.from_json(F.col("value").cast("string"), STATUS_EVENT_SCHEMA))),
    )


def structural_filter(df: DataFrame) -> DataFrame:
    """Required fields present and a non-blank station id; business rules
    are left to the batch models."""
    cond = F.col("station_id").isNotNull() & (F.trim(F.col("station_id")) != "")
    for c in REQUIRED:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


RAW_STATUS_COLS = [
    "station_id", "num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
    "is_installed", "is_renting", "is_returning", "last_reported", "snapshot_id", "poll_time",
    "feed_last_updated", "feed_ttl", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
    "ingested_at",
]


def to_raw(batch: DataFrame, ingested_at=None) -> DataFrame:
    """Parsed events -> raw station_status rows (poll_time parsed, stamped)."""
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return (batch.withColumn("poll_time", F.try_to_timestamp(F.col("poll_time")))
            .withColumn("ingested_at", stamp).select(*RAW_STATUS_COLS))


def write_status_batch(root: str, ingested_at=None, seen_path: str | None = None):
    """foreachBatch function: overwrite ``<root>/poll_day=<d>/batch_id=<n>``.
    With ``seen_path`` replayed offsets are dropped (``streaming/offsets.py``).
    The day comes from each row, so a retried batch replaces the same folders;
    it is outermost, so the daily models list and read only the days they need.
    A day's rows are brought together before the write (one file, or several of
    advisory size)."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        seen = SeenOffsets(batch_df.sparkSession, seen_path) if seen_path else None
        rows = seen.first_copies(batch_df, batch_id) if seen else batch_df
        raw = to_raw(rows, ingested_at).withColumn("poll_day", F.to_date("poll_time")).withColumn("batch_id", F.lit(batch_id))
        (raw.hint("rebalance", "poll_day").sortWithinPartitions("poll_day", "station_id").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("poll_day", "batch_id").parquet(root.rstrip("/")))
        if seen:  # what was written; a crash before this line replays the batch into the same folders
            seen.record(_batch_rows(batch_df.sparkSession, root, batch_id), batch_id)
    return write


def _batch_rows(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The rows a micro-batch has written (one folder per day)."""
    layout = StructType([*(StructField(c, t) for c, t in (("kafka_topic", StringType()), ("kafka_partition", LongType()), ("kafka_offset", LongType()))),
                         StructField("poll_day", StringType()), StructField("batch_id", LongType())])
    return spark.read.schema(layout).parquet(root.rstrip("/")).filter(F.col("batch_id") == batch_id)


def compact_closed_days(spark: SparkSession, root: str, before) -> list:
    """Merge the batch folders of each day before ``before`` into the day's last
    batch folder; returns the days merged.  The stream must be past these days
    (it replays its last batch only).  The merged rows are written before the
    other folders go: a crash in between leaves copies, which the technical
    dedup of the batch models removes."""
    root, done = root.rstrip("/"), []
    raw = spark.read.parquet(root)
    days = raw.filter(F.col("poll_day") < F.lit(before).cast("date")).select("poll_day", "batch_id").distinct()
    folders: dict = {}
    for r in days.collect():  # partition values only
        folders.setdefault(r.poll_day, []).append(r.batch_id)
    for day, batches in sorted(folders.items()):
        if len(batches) > 1:
            copy = materialise(raw.filter(F.col("poll_day") == F.lit(day)).drop("poll_day", "batch_id"), "closed-day")
            replace_whole(copy.withColumn("batch_id", F.lit(max(batches))), f"{root}/poll_day={day}", "batch_id", max(batches))
            drop_partitions(spark, f"{root}/poll_day={day}", "batch_id", sorted(set(batches) - {max(batches)}))
            done.append(day)
    return done


def start_status_stream(events: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                        ingested_at=None, seen_path: str | None = None):
    w = (events.writeStream.foreachBatch(write_status_batch(root, ingested_at, seen_path))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def status_stream(spark: SparkSession, source: str, options: dict) -> DataFrame:
    """Source -> parse -> structural filter.  Replayed messages are dropped by the
    writer if it is given a ``seen_path`` (no watermark: that would drop late first
    copies too), else by the technical dedup of the batch models.  A rate limit is an option of the source
    (``maxOffsetsPerTrigger`` for Kafka, ``maxFilesPerTrigger`` for files)."""
    return structural_filter(parse_status(read_status_stream(spark, source, options)))
