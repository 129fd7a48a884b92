"""Which days of a raw table have changed since a run.

The raw table lies in folders of (day, batch).  Their state is the number, bytes
and latest modification of their files, taken from a listing; no data is read.  A
run compares it with the state its last publication was made from, recomputes
exactly the days that differ -- old ones too -- and drops days that have no
folder any more.  The state is written first and named in the note of the target's
manifest, so target and state move on together."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.operators.versions import NULL_VALUE, VersionedTable

STATE = "day string, batch string, files long, bytes long, modified timestamp"


def folder_state(spark: SparkSession, root: str, day: str = "poll_day", batch: str = "batch_id") -> DataFrame:
    """(day, batch, files, bytes, modified) of the folders under ``root``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return files.select(part(day).alias("day"), part(batch).alias("batch"), "length", "modificationTime").groupBy("day", "batch").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified"))


def changed_days(now: DataFrame, before: DataFrame) -> list[str]:
    """Days with a folder that is new, gone or different (days are few)."""
    keys = ["day", "batch"]
    a = now.select(*keys, F.struct("files", "bytes", "modified").alias("a"))
    b = before.select(*keys, F.struct("files", "bytes", "modified").alias("b"))
    return sorted(r.day for r in a.join(b, keys, "full").filter("NOT (a <=> b)").select("day").distinct().collect())


def refresh_changed_days(spark: SparkSession, root: str, target: VersionedTable, model: Callable[[DataFrame], DataFrame],
                         state_root: str, day: str = "poll_day", batch: str = "batch_id") -> list[str]:
    """Bring ``target`` (by day) up to date with the raw folders: ``model`` turns
    the raw rows of some days into the target's rows of these days.  Returns the
    days recomputed."""
    import uuid

    path = f"{state_root.rstrip('/')}/state-{uuid.uuid4().hex[:12]}"
    folder_state(spark, root, day, batch).write.parquet(path)
    now = spark.read.schema(STATE).parquet(path)
    seen = (target.manifest() or {}).get("note", {}).get("state")
    before = spark.read.schema(STATE).parquet(seen) if seen else spark.createDataFrame([], STATE)
    days = changed_days(now, before)
    if days or not target.exists():
        raw = spark.read.parquet(root)
        dated = [d for d in days if d != NULL_VALUE]
        chosen = F.col(day).isin(*[F.lit(d).cast("date") for d in dated]) if dated else F.lit(False)
        if NULL_VALUE in days:
            chosen = chosen | F.col(day).isNull()
        target.replace(model(raw.filter(chosen)), days, note={"state": path})
    return days
