"""Conformed dimensions: calendar and station (SCD type 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.functions.columns import date_key
from velotide.operators.dedup import latest_by

DIM_DATE_COLS = ["date_key", "full_date", "year", "quarter", "month", "month_name", "iso_year", "week",
                 "day", "day_name", "day_of_week", "is_weekend"]


def calendar_columns(d: Column) -> list[Column]:
    dow = F.dayofweek(d)  # 1 = Sunday ... 7 = Saturday
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("bigint").alias("iso_year"),
        F.weekofyear(d).cast("bigint").alias("week"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.cast("bigint").alias("day_of_week"),
        dow.isin(1, 7).alias("is_weekend"),
    ]


def dim_date(spark: SparkSession, first, last) -> DataFrame:
    """One row per day from ``first`` to ``last`` inclusive.  The row count is
    fixed by the two parameters, which is what makes it safe to broadcast."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def dim_date_between(bounds: DataFrame, first_col: str = "first_day", last_col: str = "last_day") -> DataFrame:
    """Calendar spanning bounds computed by Spark (a one-row DataFrame)."""
    days = bounds.select(F.explode(F.sequence(F.col(first_col), F.col(last_col))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def dim_station(stg_stations: DataFrame) -> DataFrame:
    """Latest snapshot per station id.  Unlike the identity reference set it
    keeps stations without coordinates, and a null id forms its own row."""
    latest = latest_by(stg_stations, ["station_id"], "snapshot_date")
    return latest.select(
        F.col("station_id").alias("station_key"), "station_id", "station_name", "short_name", "region_id",
        "latitude", "longitude", "capacity", "station_type", F.col("snapshot_date").alias("last_snapshot_date"))
