"""Declared schemas of the raw tables and landing files (never inferred)."""

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)

# the 13 columns of a monthly trip CSV, in file order
TRIP_CSV = StructType([
    StructField("ride_id", StringType()),
    StructField("rideable_type", StringType()),
    StructField("started_at", TimestampNTZType()),
    StructField("ended_at", TimestampNTZType()),
    StructField("start_station_name", StringType()),
    StructField("start_station_id", StringType()),
    StructField("end_station_name", StringType()),
    StructField("end_station_id", StringType()),
    StructField("start_lat", DoubleType()),
    StructField("start_lng", DoubleType()),
    StructField("end_lat", DoubleType()),
    StructField("end_lng", DoubleType()),
    StructField("member_casual", StringType()),
])
TRIP_RAW = StructType(TRIP_CSV.fields + [
    StructField("source_month", DateType(), False),
    StructField("batch_id", StringType(), False),
])

# one element of data.stations[] in the station_information feed
STATION_INFO = StructType([
    StructField("station_id", StringType()),
    StructField("name", StringType()),
    StructField("short_name", StringType()),
    StructField("region_id", StringType()),
    StructField("lat", DoubleType()),
    StructField("lon", DoubleType()),
    StructField("capacity", LongType()),
    StructField("rental_uris", StringType()),          # JSON, kept as text, never read downstream
    StructField("rental_methods", ArrayType(StringType())),
    StructField("has_kiosk", BooleanType()),
    StructField("station_type", StringType()),
    StructField("external_id", StringType()),
    StructField("electric_bike_surcharge_waiver", BooleanType()),
    StructField("eightd_station_services", StringType()),  # JSON, kept as text
    StructField("eightd_has_key_dispenser", BooleanType()),
])
STATION_RAW = StructType(STATION_INFO.fields + [
    StructField("snapshot_date", DateType(), False),
    StructField("batch_id", StringType(), False),
])
STATION_FEED = StructType([
    StructField("last_updated", LongType()),
    StructField("ttl", LongType()),
    StructField("data", StructType([StructField("stations", ArrayType(STATION_INFO))])),
])

STATUS_RAW = StructType([
    StructField("station_id", StringType()),
    *[StructField(c, LongType()) for c in ("num_bikes_available", "num_bikes_disabled", "num_docks_available",
                                           "num_docks_disabled", "is_installed", "is_renting", "is_returning",
                                           "last_reported")],
    StructField("snapshot_id", StringType()),
    StructField("poll_time", TimestampType()),
    StructField("feed_last_updated", LongType()),
    StructField("feed_ttl", LongType()),
    StructField("kafka_topic", StringType()),
    StructField("kafka_partition", LongType()),
    StructField("kafka_offset", LongType()),
    StructField("kafka_timestamp", TimestampType()),
    StructField("ingested_at", TimestampType(), False),
])

RUN_LOG = StructType([
    StructField("run_id", StringType()),
    StructField("dag_id", StringType()),
    StructField("batch_id", StringType()),
    StructField("task_id", StringType()),
    StructField("try_number", LongType()),
    StructField("start_time", TimestampType()),
    StructField("end_time", TimestampType()),
    StructField("status", StringType()),
    StructField("error_message", StringType()),
])
