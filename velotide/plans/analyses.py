"""Analyses over the star schema.  Each starts from an aggregate or a fact
and reduces before anything is sorted; top-k reports keep their limit (the
limit is the feature) and plan as a per-task top-k merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velotide.operators.topk import top_k


def demand(agg_daily: DataFrame, dim_date: DataFrame, grain: str = "month") -> DataFrame:
    """Trips and minutes per month (or ISO week) and rider type, with each
    rider type's share of the period's trips."""
    period = ["year", "month"] if grain == "month" else ["iso_year", "week"]
    cal = F.broadcast(dim_date.select("date_key", *period))
    g = (agg_daily.join(cal, "date_key").groupBy(*period, "member_casual")
         .agg(F.sum("trip_count").cast("bigint").alias("trip_count"),
              F.sum("total_duration_minutes").cast("bigint").alias("total_duration_minutes")))
    w = Window.partitionBy(*period)
    return g.withColumn("trip_share", F.round(F.col("trip_count") / F.sum("trip_count").over(w), 6))


def busiest_stations(activity: DataFrame, dim_station: DataFrame, k: int = 10) -> DataFrame:
    """Top-k stations by trips started + ended, with activity per dock."""
    st = dim_station.filter(F.col("station_key").isNotNull()).select("station_key", "station_name", "capacity")
    j = activity.join(st, "station_key", "left").withColumn(
        "activity_per_dock", F.round(F.col("total_trip_activity") / F.col("capacity"), 6))
    return top_k(j, ["total_trip_activity"], k, tie=["station_key"])


def hour_profile(fct_trip: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Trips per weekday and start hour (days inside the calendar)."""
    pre = fct_trip.groupBy("start_date_key", "start_hour").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration_minutes").alias("minutes"))
    cal = F.broadcast(dim_date.select(F.col("date_key").alias("start_date_key"), "day_name", "day_of_week"))
    return (pre.join(cal, "start_date_key").groupBy("day_of_week", "day_name", "start_hour")
            .agg(F.sum("n").cast("bigint").alias("trip_count"),
                 F.round(F.sum("minutes") / F.sum("n"), 6).alias("avg_duration_minutes")))


def availability(fct_status: DataFrame) -> DataFrame:
    """Bikes and docks per station and hour of day."""
    return (fct_status.filter(F.col("station_key").isNotNull())
            .groupBy("station_key", F.hour("poll_time").cast("bigint").alias("hour_of_day"))
            .agg(F.round(F.avg("num_bikes_available"), 6).alias("avg_bikes_available"),
                 F.min("num_bikes_available").alias("min_bikes_available"),
                 F.round(F.avg("num_docks_available"), 6).alias("avg_docks_available"),
                 F.count(F.lit(1)).alias("observations")))


def empty_or_full(station_daily: DataFrame, k: int = 10) -> DataFrame:
    """Top-k stations by the share of observations with no bike."""
    g = (station_daily.groupBy("station_key", "station_name")
         .agg(F.sum("status_observations").cast("bigint").alias("status_observations"),
              F.sum("empty_observations").cast("bigint").alias("empty_observations"),
              F.sum("full_observations").cast("bigint").alias("full_observations"))
         .filter(F.col("status_observations") > 0)
         .withColumn("empty_share", F.round(F.col("empty_observations") / F.col("status_observations"), 6))
         .withColumn("full_share", F.round(F.col("full_observations") / F.col("status_observations"), 6)))
    return top_k(g, ["empty_share", "full_share"], k, tie=["station_key"])


def activity_vs_availability(station_daily: DataFrame) -> DataFrame:
    """Station-days that have both trips and availability observations."""
    return station_daily.filter((F.col("total_trip_activity") > 0) & (F.col("status_observations") > 0)).select(
        "date_key", "station_key", "trips_started", "trips_ended", "total_trip_activity",
        "avg_bikes_available", "avg_docks_available", "empty_observations", "full_observations")


def routes(fct_trip: DataFrame, k: int = 20) -> DataFrame:
    """Top-k station pairs by trips, split by rider type."""
    g = (fct_trip.filter(F.col("start_station_key").isNotNull() & F.col("end_station_key").isNotNull())
         .groupBy("start_station_key", "end_station_key")
         .agg(F.count(F.lit(1)).alias("trip_count"),
              F.count_if(F.col("member_casual") == "member").alias("member_trips"),
              F.count_if(F.col("member_casual") == "casual").alias("casual_trips"),
              F.round(F.avg("duration_minutes"), 6).alias("avg_duration_minutes")))
    return top_k(g, ["trip_count"], k, tie=["start_station_key", "end_station_key"])


def record_counts(layers: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per (source, layer): batch and stream outputs side by side."""
    parts = [df.agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(src).alias("source"), F.lit(layer).alias("layer"), "records")
        for (src, layer), df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
