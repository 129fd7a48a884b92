"""int_station_status, fct_station_status and the status quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import date_key
from velotide.functions.rules import STATUS_RULES, passes, rejections
from velotide.operators.broadcast import bounded_broadcast
from velotide.operators.dedup import first_by

KAFKA_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]
OBSERVATION_KEY = ["station_id", "snapshot_id"]

STATUS_COLS = [
    "station_id", "num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
    "is_installed", "is_renting", "is_returning", "last_reported", "snapshot_id", "poll_time",
    "feed_last_updated", "feed_ttl", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
    "ingested_at",
]


def dedup_technical(stg: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Drop Kafka replays: first ingested copy of each (topic, partition,
    offset).  Rows with null coordinates form one group (as in SQL)."""
    return first_by(stg, [*KAFKA_KEY, *within], ["ingested_at"])


def dedup_logical(df: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """One observation per (station, snapshot): earliest poll, then Kafka
    time, then ingestion time."""
    return first_by(df, [*OBSERVATION_KEY, *within], ["poll_time", "kafka_timestamp", "ingested_at"])


def classify_status(df: DataFrame) -> DataFrame:
    return (df.select(*STATUS_COLS)
            .withColumn("rejection_reasons", rejections(STATUS_RULES))
            .withColumn("is_valid", passes(STATUS_RULES))
            .withColumn("is_active_station", F.col("is_installed") == 1)
            .withColumn("is_empty", F.col("num_bikes_available") == 0)
            .withColumn("is_full", F.col("num_docks_available") == 0))


def station_status(stg: DataFrame, since_day=None) -> DataFrame:
    """Deduplicated, classified observations.  ``since_day`` (the high-water
    day of the target) restricts the input to that day and later."""
    s = stg
    if since_day is not None:
        s = s.filter(F.col("poll_time") >= F.lit(since_day).cast("date").cast("timestamp"))
    return classify_status(dedup_logical(dedup_technical(s)))


def status_by_day(raw: DataFrame) -> DataFrame:
    """Observations of whole days, each day by itself: copies meet within their day
    only, so a day can be computed again without the others."""
    from velotide.plans.staging import stg_status

    days = stg_status(raw).withColumn("poll_day", F.to_date("poll_time"))
    once = dedup_logical(dedup_technical(days, ("poll_day",)), ("poll_day",))
    return classify_status(once).withColumn("poll_day", F.to_date("poll_time"))


FCT_STATUS_COLS = [
    "station_id", "station_key", "snapshot_id", "poll_time", "observation_date_key", "last_reported",
    "num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled", "is_installed",
    "is_renting", "is_returning", "is_active_station", "is_empty", "is_full", "feed_last_updated", "feed_ttl",
    "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at",
]


def fct_station_status(status: DataFrame, dim_station: DataFrame, broadcast_dim: bool = True) -> DataFrame:
    s = status.filter(F.col("is_valid"))
    dim = dim_station.select("station_id", "station_key").filter(F.col("station_id").isNotNull())
    if broadcast_dim:
        dim = bounded_broadcast(dim)
    return (s.join(dim, "station_id", "left")
            .withColumn("observation_date_key", date_key(F.to_date("poll_time")))
            .select(*FCT_STATUS_COLS))


def quarantine_id() -> Column:
    basis = F.concat_ws(
        "|",
        F.coalesce(F.col("station_id"), F.lit("<NULL>")),
        F.coalesce(F.col("snapshot_id"), F.lit("<NULL>")),
        F.coalesce(F.col("kafka_topic"), F.lit("<NULL>")),
        F.coalesce(F.col("kafka_partition"), F.lit(-1)).cast("string"),
        F.coalesce(F.col("kafka_offset"), F.lit(-1)).cast("string"))
    return F.md5(basis)


def quarantine_status(status: DataFrame) -> DataFrame:
    """Rejected observations; the id is an md5 of station, snapshot and Kafka
    coordinates, so a rerun produces the same ids."""
    bad = status.filter(~F.col("is_valid"))
    return bad.select(
        quarantine_id().alias("quarantine_id"), "station_id", "snapshot_id", "last_reported", "poll_time",
        "kafka_topic", "kafka_partition", "kafka_offset",
        F.col("rejection_reasons").alias("rejections"),
        F.size("rejection_reasons").cast("bigint").alias("rejection_count"),
        F.col("poll_time").alias("invalid_at"))
