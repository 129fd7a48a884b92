"""Feed responses as a stream: the poller's checks as a Structured
Streaming job.

    responses (files or any streaming source) -> classify_feed ->
        events: Kafka-shaped records (key = station id, value = JSON event)
        dlq:    JSON dead-letter records

Each micro-batch is parsed and classified once (the classified rows are
persisted for their two outputs) and both outputs overwrite ``batch_id=<n>`` folders, so a batch
replayed after a crash does not duplicate records.  With ``sink='kafka'``
the same records go to two topics instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from velotide.sources.feed import classified, dlq_records, feed_dlq, feed_events, publish

RESPONSE_SCHEMA = StructType([
    StructField("source_url", StringType()),
    StructField("http_status", IntegerType()),
    StructField("body", StringType()),
    StructField("fetched_at", TimestampType()),
])


def read_responses(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    return spark.readStream.schema(RESPONSE_SCHEMA).options(**(options or {})).parquet(path)


def write_feed_batch(out_root: str, producer_id: str = "velotide-feed", sink: str = "files",
                     kafka_options: dict | None = None, events_topic: str | None = None,
                     dlq_topic: str | None = None):
    root = out_root.rstrip("/")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        # a micro-batch is a few files, each read by one task: the responses are dealt
        # to all cores before they are parsed
        cores = batch_df.sparkSession.sparkContext.defaultParallelism
        rows = classified(batch_df.repartition(cores, *batch_df.columns)).persist()
        try:
            ev, dl = publish(feed_events(rows)), dlq_records(feed_dlq(rows, producer_id))
            if sink == "kafka":
                opts = dict(kafka_options or {})
                ev.write.format("kafka").options(**opts).option("topic", events_topic).save()
                dl.write.format("kafka").options(**opts).option("topic", dlq_topic).save()
            else:
                ev.write.mode("overwrite").parquet(f"{root}/events/batch_id={batch_id}")
                dl.write.mode("overwrite").parquet(f"{root}/dlq/batch_id={batch_id}")
        finally:
            rows.unpersist()
    return write


def start_feed_stream(responses: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None, **kw):
    w = responses.writeStream.foreachBatch(write_feed_batch(out_root, **kw)).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
