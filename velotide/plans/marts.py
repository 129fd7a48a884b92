"""Aggregates of the star schema.

All three pre-aggregate the facts before any join, so the joins to the
dimensions see one row per group, not one per trip:

* agg_daily_trip_summary: day x rider type, then the calendar (inner: days
  outside the calendar drop out).
* agg_station_activity: each trip exploded into its start and end, one
  group-by (one shuffle instead of two aggregates and a full outer join).
* agg_station_daily: start rows, end rows and status rows share one set of
  columns and one group-by on (station, day) -- the same result as the 3-way
  full outer join of three aggregates, with one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import zero
from velotide.operators.broadcast import bounded_broadcast


def agg_daily_trip_summary(fct_trip: DataFrame, dim_date: DataFrame, month=None) -> DataFrame:
    """Trips and minutes per start day and rider type.  ``month`` keeps
    trips starting in that calendar month (the reference's refresh window)."""
    f = fct_trip
    if month is not None:
        m = F.lit(month).cast("date")
        f = f.filter((F.col("start_date") >= m) & (F.col("start_date") < F.add_months(m, 1)))
    pre = f.groupBy("start_date_key", "member_casual").agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum("duration_minutes").alias("total_duration_minutes"))
    cal = F.broadcast(dim_date.select(F.col("date_key").alias("start_date_key"), "full_date"))
    return pre.join(cal, "start_date_key").select(
        F.col("start_date_key").alias("date_key"), "full_date", "member_casual", "trip_count",
        "total_duration_minutes")


def _trip_ends(fct_trip: DataFrame, with_day: bool, extra: tuple = ()) -> DataFrame:
    """Each trip as two rows: its start (started=1) and its end (ended=1)."""
    ends = F.array(
        F.struct(F.col("start_station_key").alias("station_key"),
                 (F.col("start_date_key") if with_day else F.lit(None).cast("bigint")).alias("date_key"),
                 F.lit(1).alias("started"), F.lit(0).alias("ended"),
                 F.col("duration_minutes").alias("duration")),
        F.struct(F.col("end_station_key").alias("station_key"),
                 (F.col("end_date_key") if with_day else F.lit(None).cast("bigint")).alias("date_key"),
                 F.lit(0).alias("started"), F.lit(1).alias("ended"),
                 F.lit(None).cast("bigint").alias("duration")),
    )
    return fct_trip.select(*extra, F.inline(ends)).filter(F.col("station_key").isNotNull())


def agg_station_activity(fct_trip: DataFrame) -> DataFrame:
    g = _trip_ends(fct_trip, with_day=False).groupBy("station_key").agg(
        F.sum("started").cast("bigint").alias("start_trip_count"),
        F.sum("ended").cast("bigint").alias("end_trip_count"))
    return g.withColumn("total_trip_activity", F.col("start_trip_count") + F.col("end_trip_count"))


def station_activity_by_batch(fct_trip: DataFrame) -> DataFrame:
    """Start and end counts per (batch, station): stored partitioned by
    batch, so a month run recounts only its batch."""
    return _trip_ends(fct_trip, with_day=False, extra=("source_month",)).groupBy("source_month", "station_key").agg(
        F.sum("started").cast("bigint").alias("start_trip_count"),
        F.sum("ended").cast("bigint").alias("end_trip_count"))


def merge_station_activity(by_batch: DataFrame) -> DataFrame:
    g = by_batch.groupBy("station_key").agg(F.sum("start_trip_count").cast("bigint").alias("start_trip_count"),
                                            F.sum("end_trip_count").cast("bigint").alias("end_trip_count"))
    return g.withColumn("total_trip_activity", F.col("start_trip_count") + F.col("end_trip_count"))


STATION_DAILY_COLS = [
    "date_key", "full_date", "station_key", "station_name", "short_name", "region_id", "latitude",
    "longitude", "capacity", "station_type", "trips_started", "trips_ended", "total_trip_activity",
    "total_trip_duration_minutes", "avg_trip_duration_minutes", "avg_bikes_available",
    "min_bikes_available", "max_bikes_available", "avg_docks_available", "min_docks_available",
    "max_docks_available", "status_observations", "empty_observations", "full_observations",
]


def station_day_rollup(fct_trip: DataFrame, fct_status: DataFrame) -> DataFrame:
    """(station, day) rows with trip and availability measures, one shuffle."""
    trips = _trip_ends(fct_trip, with_day=True).select(
        "station_key", "date_key", "started", "ended", "duration",
        *[F.lit(None).cast("bigint").alias(c) for c in ("bikes", "docks", "observed", "empty", "full")])
    status = fct_status.filter(F.col("station_key").isNotNull()).select(
        "station_key", F.col("observation_date_key").alias("date_key"),
        *[F.lit(None).cast("int").alias(c) for c in ("started", "ended")],
        F.lit(None).cast("bigint").alias("duration"),
        F.col("num_bikes_available").alias("bikes"), F.col("num_docks_available").alias("docks"),
        F.lit(1).cast("bigint").alias("observed"),
        F.when(F.col("is_empty"), 1).otherwise(0).cast("bigint").alias("empty"),
        F.when(F.col("is_full"), 1).otherwise(0).cast("bigint").alias("full"))
    rows = trips.unionByName(status)
    return rows.groupBy("station_key", "date_key").agg(
        F.sum("started").cast("bigint").alias("trips_started"),
        F.sum("ended").cast("bigint").alias("trips_ended"),
        F.sum("duration").alias("total_trip_duration_minutes"),
        F.avg("duration").alias("avg_trip_duration_minutes"),
        F.avg("bikes").alias("avg_bikes_available"),
        F.min("bikes").alias("min_bikes_available"),
        F.max("bikes").alias("max_bikes_available"),
        F.avg("docks").alias("avg_docks_available"),
        F.min("docks").alias("min_docks_available"),
        F.max("docks").alias("max_docks_available"),
        F.sum("observed").alias("status_observations"),
        F.sum("empty").alias("empty_observations"),
        F.sum("full").alias("full_observations"))


def _finish_station_daily(c: DataFrame, dim_date: DataFrame, dim_station: DataFrame,
                          broadcast_dim: bool = True) -> DataFrame:
    cal = F.broadcast(dim_date.select("date_key", "full_date"))
    st = dim_station.filter(F.col("station_key").isNotNull()).select(
        "station_key", "station_name", "short_name", "region_id", "latitude", "longitude", "capacity",
        "station_type")
    if broadcast_dim:
        st = bounded_broadcast(st)
    out = c.join(cal, "date_key").join(st, "station_key", "left")
    return out.select(
        "date_key", "full_date", "station_key", "station_name", "short_name", "region_id", "latitude",
        "longitude", "capacity", "station_type",
        zero("trips_started").alias("trips_started"), zero("trips_ended").alias("trips_ended"),
        (zero("trips_started") + zero("trips_ended")).alias("total_trip_activity"),
        "total_trip_duration_minutes", "avg_trip_duration_minutes", "avg_bikes_available",
        "min_bikes_available", "max_bikes_available", "avg_docks_available", "min_docks_available",
        "max_docks_available", zero("status_observations").alias("status_observations"),
        zero("empty_observations").alias("empty_observations"),
        zero("full_observations").alias("full_observations"))


def agg_station_daily(fct_trip: DataFrame, fct_status: DataFrame, dim_date: DataFrame,
                      dim_station: DataFrame, broadcast_dim: bool = True) -> DataFrame:
    return _finish_station_daily(station_day_rollup(fct_trip, fct_status), dim_date, dim_station, broadcast_dim)


# --- stored partials for incremental runs --------------------------------------
def station_day_trip_parts(fct_trip: DataFrame) -> DataFrame:
    """Per (batch, station, day): starts, ends, and the sum and count of the
    starting trips' minutes.  Stored by batch; a month run recounts its own."""
    t = _trip_ends(fct_trip, with_day=True, extra=("source_month",))
    return t.groupBy("source_month", "station_key", "date_key").agg(
        F.sum("started").cast("bigint").alias("trips_started"), F.sum("ended").cast("bigint").alias("trips_ended"),
        F.sum("duration").alias("duration_sum"), F.count("duration").alias("duration_n"))


def station_day_status_parts(fct_status: DataFrame) -> DataFrame:
    """Per (station, day): sums, counts, minima and maxima of availability.
    Stored by day; a status run replaces the days from its high-water mark."""
    b, d = F.col("num_bikes_available"), F.col("num_docks_available")
    return (fct_status.filter(F.col("station_key").isNotNull())
            .groupBy("station_key", F.col("observation_date_key").alias("date_key"))
            .agg(F.sum(b).alias("bikes_sum"), F.count(b).alias("bikes_n"), F.min(b).alias("min_bikes_available"),
                 F.max(b).alias("max_bikes_available"), F.sum(d).alias("docks_sum"), F.count(d).alias("docks_n"),
                 F.min(d).alias("min_docks_available"), F.max(d).alias("max_docks_available"),
                 F.count(F.lit(1)).alias("status_observations"),
                 F.count_if(F.col("is_empty")).alias("empty_observations"),
                 F.count_if(F.col("is_full")).alias("full_observations")))


def _ratio(num: str, den: str):
    return F.when(F.col(den) > 0, F.col(num).cast("double") / F.col(den).cast("double"))


def station_daily_from_parts(trip_parts: DataFrame, status_parts: DataFrame, dim_date: DataFrame,
                             dim_station: DataFrame, broadcast_dim: bool = True) -> DataFrame:
    """agg_station_daily from stored partials: the same rows and values as
    the full rollup (sums of exact integer partials, then the averages)."""
    trips = trip_parts.groupBy("station_key", "date_key").agg(
        F.sum("trips_started").alias("trips_started"), F.sum("trips_ended").alias("trips_ended"),
        F.sum("duration_sum").alias("total_trip_duration_minutes"), F.sum("duration_n").alias("duration_n"))
    status_cols = ["bikes_sum", "bikes_n", "min_bikes_available", "max_bikes_available", "docks_sum", "docks_n",
                   "min_docks_available", "max_docks_available", "status_observations", "empty_observations",
                   "full_observations"]
    t = trips.select("station_key", "date_key", "trips_started", "trips_ended", "total_trip_duration_minutes",
                     "duration_n", *[F.lit(None).cast("bigint").alias(c) for c in status_cols])
    s_ = status_parts.select("station_key", "date_key",
                             *[F.lit(None).cast("bigint").alias(c) for c in
                               ("trips_started", "trips_ended", "total_trip_duration_minutes", "duration_n")],
                             *[F.col(c).cast("bigint").alias(c) for c in status_cols])
    g = t.unionByName(s_).groupBy("station_key", "date_key").agg(
        *[F.sum(c).alias(c) for c in ("trips_started", "trips_ended", "total_trip_duration_minutes", "duration_n",
                                      "bikes_sum", "bikes_n", "docks_sum", "docks_n", "status_observations",
                                      "empty_observations", "full_observations")],
        *[F.min(c).alias(c) for c in ("min_bikes_available", "min_docks_available")],
        *[F.max(c).alias(c) for c in ("max_bikes_available", "max_docks_available")])
    c = (g.withColumn("avg_trip_duration_minutes", _ratio("total_trip_duration_minutes", "duration_n"))
         .withColumn("avg_bikes_available", _ratio("bikes_sum", "bikes_n"))
         .withColumn("avg_docks_available", _ratio("docks_sum", "docks_n")))
    return _finish_station_daily(c, dim_date, dim_station, broadcast_dim)
