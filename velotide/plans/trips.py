"""int_trip_history, fct_trip and the trip quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import date_key, minute_diff, row_md5
from velotide.functions.rules import TRIP_RULES, passes, reason_codes, rejections
from velotide.operators.broadcast import BROADCAST_ROWS, bounded_broadcast, counted_broadcast

TRIP_HISTORY_COLS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "end_station_id",
    "start_station_key", "end_station_key", "start_station_mapping_status", "end_station_mapping_status",
    "duration_minutes", "start_date", "end_date", "start_hour", "start_latitude", "start_longitude",
    "end_latitude", "end_longitude", "member_casual", "rejection_reasons", "is_valid_trip",
    "source_month", "batch_id",
]
# what a trip's history takes from staging; everything else is derived or looked up
STAGED_COLS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "end_station_id", "start_latitude",
    "start_longitude", "end_latitude", "end_longitude", "member_casual", "source_month", "batch_id",
]


def derive_trips(stg: DataFrame) -> DataFrame:
    """Duration in minute boundaries, start/end day, start hour."""
    return (stg.withColumn("duration_minutes", minute_diff("ended_at", "started_at"))
            .withColumn("start_date", F.to_date("started_at"))
            .withColumn("end_date", F.to_date("ended_at"))
            .withColumn("start_hour", F.hour("started_at").cast("bigint")))


def _spread_null(code: str) -> Column:
    """Join key of a station code: missing codes, which match nothing, are dealt
    over many values instead of meeting in one shuffle partition."""
    return F.coalesce(F.col(code), F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("ride_id"), F.lit(4096)).cast("string")))


def trip_history(stg: DataFrame, identity: DataFrame, source_month=None,
                 broadcast_identity: bool = True) -> DataFrame:
    """Every staged trip (valid or not) with its rejection reasons and both
    station roles resolved.  ``source_month`` restricts to one batch (the
    incremental run); the predicate reaches the scan as a partition filter."""
    t = stg
    if source_month is not None:
        t = t.filter(F.col("source_month") == F.lit(source_month).cast("date"))
    t = derive_trips(t).withColumn("rejection_reasons", rejections(TRIP_RULES))
    ident = identity.select("source_station_code", "station_key", "mapping_status")
    if broadcast_identity:
        ident = bounded_broadcast(ident)
    start = ident.select(F.col("source_station_code").alias("__start"),
                         F.col("station_key").alias("start_station_key"),
                         F.col("mapping_status").alias("start_station_mapping_status"))
    end = ident.select(F.col("source_station_code").alias("__end"),
                       F.col("station_key").alias("end_station_key"),
                       F.col("mapping_status").alias("end_station_mapping_status"))
    t = t.withColumn("__start", _spread_null("start_station_id")).withColumn("__end", _spread_null("end_station_id"))
    t = t.join(start, "__start", "left").join(end, "__end", "left")
    return t.withColumn("is_valid_trip", passes(TRIP_RULES)).select(*TRIP_HISTORY_COLS)


HUBS = 64  # codes of a role that may count as hubs: a bound on what is broadcast


def hub_codes(trips: DataFrame, column: str, k: int = HUBS) -> list[str]:
    """The commonest station codes of a role, by a sketch of fixed size in one pass.
    Which codes it names decides the plan only, never the result."""
    top = trips.agg(F.expr(f"approx_top_k({column}, {k}, {100 * k})").alias("top")).first().top
    return [r["item"] for r in top or [] if r["item"] is not None]


def trip_history_hubs(stg: DataFrame, identity: DataFrame, k: int = HUBS) -> DataFrame:
    """``trip_history`` for an identity too large to broadcast: a hub's trips take
    their station from a broadcast of at most ``k`` codes where they are, and so do
    trips without a code, which match nothing; only the others are shuffled, as
    staged, and meet their part of the identity (one row a code, far fewer than
    trips) as a hash table, so that they are not sorted."""
    t = stg.select(*STAGED_COLS)
    ident = identity.select(F.col("source_station_code").alias("__code"), F.struct("station_key", "mapping_status").alias("__station"))
    for role in ("start", "end"):
        code = f"{role}_station_id"
        hubs = hub_codes(stg, code, k)
        own = F.col(code) == F.col("__code")
        here = F.col(code).isNull() | F.col(code).isin(hubs)
        t = (t.filter(here).join(F.broadcast(ident.filter(F.col("__code").isin(hubs))), own, "left")
             .unionByName(t.filter(~here).join(ident.hint("shuffle_hash"), own, "left")))
        t = t.withColumn(f"{role}_station_key", F.col("__station.station_key")).withColumn(
            f"{role}_station_mapping_status", F.col("__station.mapping_status")).drop("__code", "__station")
    t = derive_trips(t).withColumn("rejection_reasons", rejections(TRIP_RULES))
    return t.withColumn("is_valid_trip", passes(TRIP_RULES)).select(*TRIP_HISTORY_COLS)


def fct_trip(history: DataFrame, source_month=None) -> DataFrame:
    t = history.filter(F.col("is_valid_trip"))
    if source_month is not None:
        t = t.filter(F.col("source_month") == F.lit(source_month).cast("date"))
    return t.select(
        "ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "end_station_id",
        "start_station_key", "end_station_key", "duration_minutes", "start_date", "end_date",
        date_key("start_date").alias("start_date_key"), date_key("end_date").alias("end_date_key"),
        "start_hour", "start_latitude", "start_longitude", "end_latitude", "end_longitude",
        "member_casual", "source_month", "batch_id")


QUARANTINE_ID_COLS = ["batch_id", "ride_id", "started_at", "ended_at", "start_station_id", "end_station_id"]


def quarantine_id(codes: Column, ordinal: Column) -> Column:
    return row_md5(*QUARANTINE_ID_COLS, codes, ordinal)


def quarantined_at(as_of) -> Column:
    return F.lit(as_of).cast("timestamp")


def _counted_copies(bad: DataFrame) -> DataFrame:
    """Rejected trips with their ordinal among equal ones (one shuffle, combined
    map-side): copies are counted and written out again with the ordinals 1..n."""
    copies = bad.groupBy(*QUARANTINE_ID_COLS, "rejection_reasons").agg(F.count(F.lit(1)).alias("__n"))
    return copies.withColumn("__ordinal", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n")))).drop("__n")


def quarantine_trip(history: DataFrame, as_of, stored: bool = False, most: int = BROADCAST_ROWS) -> DataFrame:
    """Rejected trips, one row each.

    The id is an md5 of the identifying columns, the reason codes and the
    row's ordinal among rows equal in all of those (deterministic for a
    given input, unlike a random uuid); ``as_of`` replaces the wall clock so
    reruns are equal.  Every output column is a function of that basis, so
    copies are counted: no window, and no dependence on partitions.

    Of a ``stored`` history, which is cheap to read again, only 64-bit hashes of the
    identifying columns are shuffled at first: a row whose hash no other has is the
    first of its kind and stays where it lies; the others are counted in full.  With
    more than ``most`` repeated hashes all rows are."""
    bad = history.filter(~F.col("is_valid_trip")).select(*QUARANTINE_ID_COLS, "rejection_reasons")
    few = False
    if stored:
        hashed = F.xxhash64(*QUARANTINE_ID_COLS)
        repeated, few = counted_broadcast(bad.groupBy(hashed.alias("__hash")).count().filter("count > 1").select("__hash"), most)
    if few:
        single = bad.join(repeated, hashed == F.col("__hash"), "left_anti").withColumn("__ordinal", F.lit(1).cast("bigint"))
        each = single.unionByName(_counted_copies(bad.join(repeated, hashed == F.col("__hash"), "left_semi")))
    else:
        each = _counted_copies(bad)
        if stored:  # to be written by batch
            each = each.hint("rebalance", "batch_id")
    return each.withColumn("__codes", reason_codes("rejection_reasons")).select(
        quarantine_id(F.col("__codes"), F.col("__ordinal")).alias("quarantine_id"),
        "batch_id", "ride_id", "started_at", "ended_at", "start_station_id", "end_station_id",
        F.col("rejection_reasons").alias("rejections"),
        F.size("rejection_reasons").cast("bigint").alias("rejection_count"),
        quarantined_at(as_of).alias("quarantined_at"),
    )
