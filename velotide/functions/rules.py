"""Data-quality rules as arrays of rejection structs.

A rule is (reason_code, failed_field, reason_detail, condition).  ``reject``
turns a rule list into one ``rejection_reasons`` column -- an array of
struct(reason_code, failed_field, reason_detail) in rule order, empty for a
valid row.  It is a single projection: no shuffle, no UDF."""

from __future__ import annotations

from typing import Callable, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import second_diff


class Rule(NamedTuple):
    code: str
    field: str
    detail: str
    condition: Callable[[], Column]


def _between_fails(c: str, lo: float, hi: float) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).between(lo, hi)


def _not_in(c: str, values) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).isin(*values)


# --- fixed values: trip rules, in the order reasons are listed ---------------
# INVALID_RIDE_ID         ride_id              ride_id must not be null
# INVALID_START_TIME      started_at           started_at must not be null
# INVALID_END_TIME        ended_at             ended_at must not be null
# INVALID_DURATION        started_at,ended_at  started_at must be earlier than ended_at
# INVALID_START_LATITUDE  start_latitude       start_latitude must be between -90 and 90
# INVALID_START_LONGITUDE start_longitude      start_longitude must be between -180 and 180
# INVALID_END_LATITUDE    end_latitude         end_latitude must be between -90 and 90
# INVALID_END_LONGITUDE   end_longitude        end_longitude must be between -180 and 180
# INVALID_RIDER_TYPE      member_casual        member_casual must be member or casual
RIDER_TYPES = ("member", "casual")
TRIP_RULES = [
    Rule("INVALID_RIDE_ID", "ride_id", "ride_id must not be null",
         lambda: F.col("ride_id").isNull()),
    Rule("INVALID_START_TIME", "started_at", "started_at must not be null",
         lambda: F.col("started_at").isNull()),
    Rule("INVALID_END_TIME", "ended_at", "ended_at must not be null",
         lambda: F.col("ended_at").isNull()),
    Rule("INVALID_DURATION", "started_at,ended_at", "started_at must be earlier than ended_at",
         lambda: F.col("started_at").isNotNull() & F.col("ended_at").isNotNull()
         & (second_diff("ended_at", "started_at") <= 0)),
    Rule("INVALID_START_LATITUDE", "start_latitude", "start_latitude must be between -90 and 90",
         lambda: _between_fails("start_latitude", -90, 90)),
    Rule("INVALID_START_LONGITUDE", "start_longitude", "start_longitude must be between -180 and 180",
         lambda: _between_fails("start_longitude", -180, 180)),
    Rule("INVALID_END_LATITUDE", "end_latitude", "end_latitude must be between -90 and 90",
         lambda: _between_fails("end_latitude", -90, 90)),
    Rule("INVALID_END_LONGITUDE", "end_longitude", "end_longitude must be between -180 and 180",
         lambda: _between_fails("end_longitude", -180, 180)),
    Rule("INVALID_RIDER_TYPE", "member_casual", "member_casual must be member or casual",
         lambda: _not_in("member_casual", RIDER_TYPES)),
]

# --- fixed values: station-status rules, in the order reasons are listed -----
# INVALID_STATION_ID        station_id           station_id must not be null
# INVALID_SNAPSHOT_ID       snapshot_id          snapshot_id must not be null
# MISSING_BIKES_AVAILABLE   num_bikes_available  num_bikes_available must not be null
# NEGATIVE_BIKES_AVAILABLE  num_bikes_available  num_bikes_available must be >= 0
# MISSING_DOCKS_AVAILABLE   num_docks_available  num_docks_available must not be null
# NEGATIVE_DOCKS_AVAILABLE  num_docks_available  num_docks_available must be >= 0
# INVALID_IS_INSTALLED      is_installed         is_installed must be 0 or 1
# INVALID_IS_RENTING        is_renting           is_renting must be 0 or 1
# INVALID_IS_RETURNING      is_returning         is_returning must be 0 or 1
FLAG_VALUES = (0, 1)
STATUS_RULES = [
    Rule("INVALID_STATION_ID", "station_id", "station_id must not be null",
         lambda: F.col("station_id").isNull()),
    Rule("INVALID_SNAPSHOT_ID", "snapshot_id", "snapshot_id must not be null",
         lambda: F.col("snapshot_id").isNull()),
    Rule("MISSING_BIKES_AVAILABLE", "num_bikes_available", "num_bikes_available must not be null",
         lambda: F.col("num_bikes_available").isNull()),
    Rule("NEGATIVE_BIKES_AVAILABLE", "num_bikes_available", "num_bikes_available must be >= 0",
         lambda: F.col("num_bikes_available").isNotNull() & (F.col("num_bikes_available") < 0)),
    Rule("MISSING_DOCKS_AVAILABLE", "num_docks_available", "num_docks_available must not be null",
         lambda: F.col("num_docks_available").isNull()),
    Rule("NEGATIVE_DOCKS_AVAILABLE", "num_docks_available", "num_docks_available must be >= 0",
         lambda: F.col("num_docks_available").isNotNull() & (F.col("num_docks_available") < 0)),
    Rule("INVALID_IS_INSTALLED", "is_installed", "is_installed must be 0 or 1",
         lambda: _not_in("is_installed", FLAG_VALUES)),
    Rule("INVALID_IS_RENTING", "is_renting", "is_renting must be 0 or 1",
         lambda: _not_in("is_renting", FLAG_VALUES)),
    Rule("INVALID_IS_RETURNING", "is_returning", "is_returning must be 0 or 1",
         lambda: _not_in("is_returning", FLAG_VALUES)),
]
# ----------------------------------------------------------------------------


REASON_TYPE = "array<struct<reason_code:string,failed_field:string,reason_detail:string>>"


def rejections(rules: list[Rule]) -> Column:
    """Array of the rejection structs whose condition holds, in rule order.

    Built as a ``concat`` of zero- or one-element arrays, which Spark
    compiles with the rest of the projection; a higher-order ``filter``
    over an array of nullable entries would be evaluated row by row in
    interpreted mode."""
    empty = F.array().cast(REASON_TYPE)
    entries = [
        F.when(r.condition(), F.array(F.struct(F.lit(r.code).alias("reason_code"),
                                               F.lit(r.field).alias("failed_field"),
                                               F.lit(r.detail).alias("reason_detail")))).otherwise(empty)
        for r in rules
    ]
    return F.concat(*entries)


def passes(rules: list[Rule]) -> Column:
    """True when no rule holds (a null condition does not reject), i.e.
    ``size(rejections(rules)) = 0`` -- as a plain predicate, so a filter on
    it is cheap wherever the optimizer moves it."""
    any_fail = rules[0].condition()
    for r in rules[1:]:
        any_fail = any_fail | r.condition()
    return ~F.coalesce(any_fail, F.lit(False))


def reject(df: DataFrame, rules: list[Rule], name: str = "rejection_reasons") -> DataFrame:
    return df.withColumn(name, rejections(rules))


def reason_codes(c="rejection_reasons") -> Column:
    """Comma-joined reason codes, for reports and comparisons."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(col, lambda r: r["reason_code"]), ",")
