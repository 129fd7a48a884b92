"""Incremental models: replace only the partitions a run touches.

* ``replace_partitions``: first run (or ``full_refresh``) writes the whole
  table; later runs use dynamic partition overwrite, which deletes and
  rewrites exactly the partitions present in the new data.
* ``replace_whole`` replaces one batch: what the table held for the batch and
  the new data lacks (a day, a station) goes with it; ``drop_partitions`` does
  so for days of tables laid out by day.
* predicates that pick a run's input -- ``for_month`` (one landed batch) and
  the high-water day -- are filters with literals on partition columns, so
  they prune the scan.  The mark is the target's greatest partition day, so
  the whole last day is reprocessed, not only its last poll time.

Trip models are partitioned by (source_month, day) by default so that two
month files that share a day (a month file holds a few trips of the next
month) do not erase each other; ``compat='last_batch_wins'`` partitions by
day alone and reproduces the reference's behaviour, where the later batch
replaces the day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def replace_partitions(df: DataFrame, path: str, by: list[str], full_refresh: bool = False,
                       sort_by: list[str] | None = None) -> str:
    spark = df.sparkSession
    first = full_refresh or not table_exists(spark, path)
    # REBALANCE by the partition columns: AQE splits a busy partition over
    # several writer tasks and merges small ones (advisory size)
    out = df.hint("rebalance", *by)
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static" if first else "dynamic")
     .partitionBy(*by).parquet(path))
    return path


def replace_whole(df: DataFrame, path: str, col: str, value, by: list[str] | None = None) -> str:
    """Replace everything the table holds for ``col = value`` with ``df``: the
    value's own folder is overwritten as a whole, so partitions (and values)
    that the new data no longer has go too.  ``by`` partitions inside it."""
    out = df.drop(col).hint("rebalance", *(by or []))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{col}={value}")
    return path


def drop_partitions(spark: SparkSession, path: str, col: str, values) -> None:
    """Delete the folders of partition values that no longer exist in the source."""
    if values:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        for v in values:
            fs.delete(hadoop_path(f"{path}/{col}={v}"), True)


def trip_partitioning(compat: str | None = None) -> list[str]:
    return ["start_date"] if compat == "last_batch_wins" else ["source_month", "start_date"]


def for_month(df: DataFrame, month, col: str = "source_month") -> DataFrame:
    return df.filter(F.col(col) == F.lit(month).cast("date"))


def high_water_day(spark: SparkSession, path: str, col: str):
    """Greatest value of the partition column ``col`` of the target table, or
    None (no table): no data column is read."""
    if not table_exists(spark, path):
        return None
    return spark.read.parquet(path).agg(F.max(col)).first()[0]


def touched_days(df: DataFrame, col: str) -> list[dt.date]:
    """Distinct days of a batch (bounded by the calendar, a few dozen)."""
    return sorted(r[0] for r in df.select(F.to_date(col).alias("d")).distinct().collect() if r[0] is not None)
