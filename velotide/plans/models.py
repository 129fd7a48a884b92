"""The model graph: each model is a function of the models before it.

``Models`` builds them lazily from three raw DataFrames and memoises each,
so one run reuses the same plan objects (Spark reuses their exchanges).  The
order is that of the daily transform: staging -> station identity -> trip
history -> quarantine, staging -> status -> quarantine, then dimensions ->
facts -> aggregates."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.plans import dims, identity, marts, staging, status, trips
from velotide.operators.broadcast import small_broadcast
from velotide.operators.incremental import table_exists
from velotide.session import scratch_path
from velotide.sources import fixtures

# --- fixed values: calendar used with the fixture data ------------------------
# The trips run 1 Jan - 14 Feb 2024; the calendar ends on 10 Feb so that a few
# days fall outside it (an inner join to the calendar drops them).
FIXTURE_CALENDAR = ("2024-01-01", "2024-02-10")
FIXTURE_AS_OF = "2024-03-01 00:00:00"
# ----------------------------------------------------------------------------

_WRITTEN: dict = {}


class Models:
    def __init__(self, spark: SparkSession, raw_trips: DataFrame, raw_stations: DataFrame,
                 raw_status: DataFrame, calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF,
                 source_month=None, status_since=None, broadcast_dims: bool = True):
        self.spark = spark
        self.raw_trips, self.raw_stations, self.raw_status = raw_trips, raw_stations, raw_status
        self.calendar, self.as_of = calendar, as_of
        self.source_month, self.status_since = source_month, status_since
        self.broadcast_dims = broadcast_dims
        self.shared: tuple | None = None
        self.history_stored = False  # whether trip_history is read from a table

    @classmethod
    def from_fixtures(cls, spark: SparkSession, root: str, **kw) -> "Models":
        """Models over the fixture views, landed once as raw tables."""
        m = cls(spark, fixtures.landed(spark, root, "trips"), fixtures.landed(spark, root, "stations"),
                fixtures.landed(spark, root, "status"), **kw)
        m.shared = (fixtures.landed_path(spark, root, "trips"), fixtures.landed_path(spark, root, "stations"))
        return m

    def _once(self, name: str, make) -> DataFrame:
        """A small model of landed inputs, written once per input version: a scan
        of known size for every query that joins it."""
        if self.shared is None:
            return make()
        path, schema = _WRITTEN.get((name, self.shared), (None, None))
        if path is None or not table_exists(self.spark, path):
            df = make()
            path, schema = _WRITTEN[name, self.shared] = scratch_path(self.spark, name), df.schema
            df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    # staging
    @cached_property
    def stg_trip(self) -> DataFrame:
        return staging.stg_trip(self.raw_trips)

    @cached_property
    def stg_station(self) -> DataFrame:
        return staging.stg_station(self.raw_stations)

    @cached_property
    def stg_status(self) -> DataFrame:
        return staging.stg_status(self.raw_status)

    # intermediate
    @cached_property
    def station_identity(self) -> DataFrame:
        return self._once("station-identity", lambda: identity.station_identity(self.stg_trip, self.stg_station))

    @cached_property
    def trip_history(self) -> DataFrame:
        ident = self.station_identity
        if self.broadcast_dims and self.shared is not None:  # stored already
            ident, _ = small_broadcast(ident.select("source_station_code", "station_key", "mapping_status"))
        return trips.trip_history(self.stg_trip, ident, self.source_month,
                                  broadcast_identity=self.broadcast_dims and self.shared is None)

    @cached_property
    def quarantine_trip(self) -> DataFrame:
        return trips.quarantine_trip(self.trip_history, self.as_of, stored=self.history_stored)

    @cached_property
    def station_status(self) -> DataFrame:
        return status.station_status(self.stg_status, self.status_since)

    @cached_property
    def quarantine_status(self) -> DataFrame:
        return status.quarantine_status(self.station_status)

    # dimensions and facts
    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark, *self.calendar)

    @cached_property
    def dim_station(self) -> DataFrame:
        return self._once("station-dimension", lambda: dims.dim_station(self.stg_station))

    @cached_property
    def fct_trip(self) -> DataFrame:
        return trips.fct_trip(self.trip_history)

    @cached_property
    def fct_station_status(self) -> DataFrame:
        return status.fct_station_status(self.station_status, self.dim_station,
                                         broadcast_dim=self.broadcast_dims and self.shared is None)

    # aggregates
    @cached_property
    def agg_daily_trip_summary(self) -> DataFrame:
        return marts.agg_daily_trip_summary(self.fct_trip, self.dim_date)

    @cached_property
    def agg_station_activity(self) -> DataFrame:
        return marts.agg_station_activity(self.fct_trip)

    @cached_property
    def agg_station_daily(self) -> DataFrame:
        return marts.agg_station_daily(self.fct_trip, self.fct_station_status, self.dim_date,
                                       self.dim_station, broadcast_dim=self.broadcast_dims and self.shared is None)

    def data_calendar(self) -> DataFrame:
        """Calendar from the first to the last trip day, bounds found by Spark."""
        b = self.stg_trip.agg(F.min(F.to_date("started_at")).alias("first_day"),
                              F.max(F.to_date("ended_at")).alias("last_day"))
        return dims.dim_date_between(b)
