"""Staging views: trim text, normalise types, rename.  Nothing is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import trim_ws


def stg_trip(raw: DataFrame) -> DataFrame:
    return raw.select(
        trim_ws("ride_id").alias("ride_id"),
        trim_ws("rideable_type").alias("rideable_type"),
        F.col("started_at"),
        F.col("ended_at"),
        trim_ws("start_station_name").alias("start_station_name"),
        trim_ws("start_station_id").alias("start_station_id"),
        trim_ws("end_station_name").alias("end_station_name"),
        trim_ws("end_station_id").alias("end_station_id"),
        F.col("start_lat").cast("double").alias("start_latitude"),
        F.col("start_lng").cast("double").alias("start_longitude"),
        F.col("end_lat").cast("double").alias("end_latitude"),
        F.col("end_lng").cast("double").alias("end_longitude"),
        F.lower(trim_ws("member_casual")).alias("member_casual"),
        F.col("source_month"),
        F.col("batch_id"),
    )


def stg_station(raw: DataFrame) -> DataFrame:
    return raw.select(
        trim_ws("station_id").alias("station_id"),
        trim_ws("name").alias("station_name"),
        trim_ws("short_name").alias("short_name"),
        trim_ws("region_id").alias("region_id"),
        F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
        F.col("capacity").cast("bigint").alias("capacity"),
        trim_ws("station_type").alias("station_type"),
        F.col("snapshot_date"),
        F.col("batch_id"),
    )


def stg_status(raw: DataFrame) -> DataFrame:
    longs = ["num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
             "is_installed", "is_renting", "is_returning", "last_reported"]
    return raw.select(
        trim_ws("station_id").alias("station_id"),
        *[F.col(c).cast("bigint").alias(c) for c in longs],
        trim_ws("snapshot_id").alias("snapshot_id"),
        F.col("poll_time").cast("timestamp").alias("poll_time"),
        F.col("feed_last_updated").cast("bigint").alias("feed_last_updated"),
        F.col("feed_ttl").cast("bigint").alias("feed_ttl"),
        F.col("kafka_topic"),
        F.col("kafka_partition").cast("bigint").alias("kafka_partition"),
        F.col("kafka_offset").cast("bigint").alias("kafka_offset"),
        F.col("kafka_timestamp").cast("timestamp").alias("kafka_timestamp"),
        F.col("ingested_at"),
    )
