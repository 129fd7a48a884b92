"""Identity changes carried into the trips already written.

A station code may resolve to another station once more stations or more months
are known.  Trip history and fact hold the keys of the run that wrote them; here
the old and the new identity are compared, the batches that hold a changed code
are found in the stored variant counts (one row per batch and variant, not the
trips), and only these batches are written again, in one step each table.  Other
batches keep their files.

Trips are brought together by day once, when they are first written, and as
staged: stations, minutes and reasons are added after that shuffle.  The fact reads
the history and a rewrite the stored trips, which lie by day already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.operators.broadcast import BROADCAST_ROWS, counted_broadcast
from velotide.operators.versions import VersionedTable
from velotide.plans import trips


def changed_codes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Codes whose station or mapping status differs; codes only one side has count."""
    side = lambda df, name: df.select("source_station_code", F.struct("station_key", "mapping_status").alias(name))
    both = side(old, "a").join(side(new, "b"), "source_station_code", "full")
    return both.filter("NOT (a <=> b)").select("source_station_code")


def touched_batches(variants: DataFrame, codes: DataFrame) -> list:
    """Batches with a trip end at one of the codes (batches are few)."""
    held = variants.join(codes, "source_station_code", "left_semi").select("source_month").distinct()
    return sorted(r.source_month for r in held.collect())


def same_trips(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same trips as staged, copies counted: rows and the
    sum of their 64-bit hashes, by batch (batches are few)."""
    row = F.xxhash64(*trips.STAGED_COLS, *[F.col(c).isNull() for c in trips.STAGED_COLS])

    def digest(df):
        return {tuple(r) for r in df.groupBy("source_month").agg(F.count(F.lit(1)), F.sum(row.cast("decimal(20,0)"))).collect()}
    return digest(a) == digest(b)


def write_history(rows: DataFrame, identity: DataFrame, history: VersionedTable, months: list | None = None,
                  laid_out: bool = False, most: int = BROADCAST_ROWS) -> None:
    """The history of staged trips.  With an identity of more than ``most`` codes the
    joins shuffle the trips, and what they give is brought together by day."""
    ident, small = counted_broadcast(identity.select("source_station_code", "station_key", "mapping_status"), most)
    rows = rows.select(*trips.STAGED_COLS)
    if small and not laid_out:
        rows = rows.withColumn("start_date", F.to_date("started_at")).hint("rebalance", history.unit, *history.inner)
    history.replace(trips.trip_history(rows, ident, broadcast_identity=False), months, laid_out=small)


def write_fact(history: VersionedTable, fact: VersionedTable, months: list | None = None) -> None:
    """The fact of the stored history, whose layout it has."""
    rows = history.read()
    fact.replace(trips.fct_trip(rows if months is None else rows.filter(F.col("source_month").isin(months))), months, laid_out=True)


def apply_identity(stg_trip: DataFrame, variants: DataFrame, old: DataFrame, new: DataFrame, history: VersionedTable, fact: VersionedTable) -> list:
    """Rewrite the batches of both tables that hold a changed code; returns them.
    They are read as stored, unless the batches were staged anew since."""
    months = touched_batches(variants, changed_codes(old, new))
    if months:
        staged, stored = (df.filter(F.col("source_month").isin(months)) for df in (stg_trip, history.read()))
        same = same_trips(staged, stored)
        write_history(stored if same else staged, new, history, months, laid_out=same)
        write_fact(history, fact, months)
    return months
