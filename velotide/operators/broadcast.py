"""Broadcast only what is proven small.

A dimension derived from the data (station identity, station dimension) has
no static bound, so its size is *measured*: it is written once as a parquet
table under ``spark.checkpoint.dir`` (a shared folder on a cluster; this
also cuts the lineage, so a lost executor never re-reads the trips for it),
and the planner's broadcast threshold is applied to the exact size of the
written files.  (An RDD checkpoint of an unpersisted plan would compute it
twice.)  Above the bound Spark plans a shuffle join.  A calendar has a bound known from
its parameters and can use ``F.broadcast`` directly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.session import freed_shuffles, scratch_path


def materialise(df: DataFrame, name: str = "dim") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """A join side that is broadcast only when proven small: it is written once
    (``materialise``) and returned as a parquet scan, whose exact byte size the
    planner compares with ``spark.sql.autoBroadcastJoinThreshold`` -- broadcast
    below it, a shuffle join above it."""
    return materialise(df)


BROADCAST_ROWS = 1_000_000  # of a few short columns each: about 100 MB as a hash table


def small_broadcast(kept: DataFrame, most: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """A narrow join side that is stored, and whether it has at most ``most`` rows; then
    it is broadcast whatever the planner's threshold, since a shuffle would move
    the whole large side.  Above the bound the planner decides."""
    small = kept.count() <= most
    return (F.broadcast(kept) if small else kept), small


def counted_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``small_broadcast`` of a side that is written once for it."""
    return small_broadcast(materialise(df), most)
