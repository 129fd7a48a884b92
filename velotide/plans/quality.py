"""The data tests of the models, as check specs (run with ``run_checks``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import date_key
from velotide.operators.checks import (Check, Derived, accepted, grain, not_null, observed, observed_report, relationship,
                                       run_checks, unique)
from velotide.plans import status, trips
from velotide.plans.identity import EXACT, GEO, MATCHED, NUMERIC, UNRESOLVED
from velotide.plans.models import Models
from velotide.functions.rules import RIDER_TYPES, reason_codes
from velotide.session import freed_shuffles

# --- fixed values: the test suite (table, column, test) -------------------------
SPECS: list[Check] = [
    not_null("stg_trip_history", "ride_id"),
    not_null("stg_trip_history", "started_at"),
    not_null("stg_trip_history", "ended_at"),
    not_null("stg_trip_history", "member_casual"),
    not_null("stg_station_information", "station_id"),
    not_null("stg_station_information", "snapshot_date"),
    not_null("stg_station_status", "station_id"),
    not_null("stg_station_status", "snapshot_id"),
    not_null("stg_station_status", "poll_time"),
    not_null("int_station_identity", "source_station_code"),
    unique("int_station_identity", "source_station_code"),
    accepted("int_station_identity", "mapping_method", (EXACT, NUMERIC, GEO)),
    not_null("int_station_identity", "mapping_status"),
    accepted("int_station_identity", "mapping_status", (MATCHED, UNRESOLVED)),
    not_null("int_trip_history", "started_at"),
    not_null("int_trip_history", "ended_at"),
    not_null("int_trip_history", "start_date"),
    not_null("int_trip_history", "end_date"),
    not_null("int_trip_history", "start_hour"),
    accepted("int_trip_history", "member_casual", RIDER_TYPES),
    not_null("int_trip_history", "is_valid_trip"),
    not_null("int_trip_history", "source_month"),
    not_null("int_trip_history", "batch_id"),
    not_null("int_quarantine_trip", "quarantine_id"),
    unique("int_quarantine_trip", "quarantine_id"),
    not_null("int_quarantine_trip", "batch_id"),
    not_null("int_quarantine_trip", "quarantined_at"),
    not_null("int_station_status", "station_id"),
    not_null("int_station_status", "snapshot_id"),
    not_null("int_station_status", "is_valid"),
    not_null("int_quarantine_station_status", "quarantine_id"),
    unique("int_quarantine_station_status", "quarantine_id"),
    not_null("int_quarantine_station_status", "invalid_at"),
    not_null("dim_date", "date_key"),
    unique("dim_date", "date_key"),
    not_null("dim_date", "full_date"),
    not_null("dim_station", "station_key"),
    unique("dim_station", "station_key"),
    not_null("dim_station", "station_id"),
    not_null("fct_trip", "ride_id"),
    unique("fct_trip", "ride_id"),
    not_null("fct_trip", "start_date_key"),
    relationship("fct_trip", "start_date_key", "dim_date", "date_key"),
    not_null("fct_trip", "end_date_key"),
    relationship("fct_trip", "end_date_key", "dim_date", "date_key"),
    relationship("fct_trip", "start_station_key", "dim_station", "station_key"),
    relationship("fct_trip", "end_station_key", "dim_station", "station_key"),
    not_null("fct_station_status", "station_id"),
    relationship("fct_station_status", "station_key", "dim_station", "station_key"),
    not_null("fct_station_status", "snapshot_id"),
    not_null("fct_station_status", "observation_date_key"),
    relationship("fct_station_status", "observation_date_key", "dim_date", "date_key"),
    grain("fct_station_status", ("station_id", "snapshot_id")),
]
# ----------------------------------------------------------------------------


TABLE_MODELS = {
    "stg_trip_history": "stg_trip", "stg_station_information": "stg_station",
    "stg_station_status": "stg_status", "int_station_identity": "station_identity",
    "int_trip_history": "trip_history", "int_quarantine_trip": "quarantine_trip",
    "int_station_status": "station_status", "int_quarantine_station_status": "quarantine_status",
    "dim_date": "dim_date", "dim_station": "dim_station", "fct_trip": "fct_trip",
    "fct_station_status": "fct_station_status",
}


def model_tables(m: Models, names=None) -> dict[str, DataFrame]:
    """The tested tables (only ``names`` when given; models are built lazily,
    so a check of one table does not build the others)."""
    return {t: getattr(m, attr) for t, attr in TABLE_MODELS.items() if names is None or t in names}


def write_checked(m: Models, specs: list[Check], path: str) -> DataFrame:
    """Write the tables of the row-level ``specs`` under ``path`` and return the report,
    counted by the writes.  A model made from another tested one reads what was
    written of it, so each is computed once."""
    spark, seen = m.spark, []
    for name, attr in TABLE_MODELS.items():  # in the order they are made
        if any(c.table == name for c in specs):
            df = getattr(m, attr)
            out, observation = observed(df, name, specs)
            with freed_shuffles(spark):
                out.write.option("compression", "zstd").parquet(f"{path}/{name}")
            setattr(m, attr, spark.read.schema(df.schema).parquet(f"{path}/{name}"))
            m.history_stored |= attr == "trip_history"
            seen.append(observation)
    return observed_report(spark, seen)


def derived_tables(m: Models) -> dict[str, Derived]:
    """Trip history holds every staged trip, and the fact and the quarantine are
    filters of it (likewise for status): one pass over each serves them all."""
    valid, ok = F.col("is_valid_trip"), F.col("is_valid")
    return {
        "stg_trip_history": Derived("int_trip_history", F.lit(True)),
        "fct_trip": Derived("int_trip_history", valid, {"start_date_key": date_key("start_date"), "end_date_key": date_key("end_date")}),
        "int_quarantine_trip": Derived("int_trip_history", ~valid, {
            # the models' own expressions; a row's ordinal is never null
            "quarantine_id": trips.quarantine_id(reason_codes("rejection_reasons"), F.lit(1)), "quarantined_at": trips.quarantined_at(m.as_of)}),
        "fct_station_status": Derived("int_station_status", ok, {"observation_date_key": date_key(F.to_date("poll_time"))}),
        "int_quarantine_station_status": Derived("int_station_status", ~ok, {
            "quarantine_id": status.quarantine_id(), "invalid_at": F.col("poll_time")}),
    }


def run_model_checks(m: Models, kinds: tuple[str, ...] | None = None) -> DataFrame:
    specs = [s for s in SPECS if kinds is None or s.check in kinds]
    derived = derived_tables(m)
    needed = {s.to for s in specs if s.to} | {
        derived[s.table].base if s.table in derived and s.check in ("not_null", "accepted_values") else s.table for s in specs}
    return run_checks(model_tables(m, needed), specs, derived)
