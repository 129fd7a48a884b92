"""Jobs: the monthly landing and the daily transform, end to end.

Each model is written as a table under ``out_root`` and the next models read it
back, so lineage is cut at every model: a lost executor costs at most one
model's recomputation, and the small models (identity, dimensions) come back
with exact file sizes that the planner's broadcast threshold checks.

Incremental models are versioned tables (``operators/versions.py``): a run stands
for a set of batches or days and replaces exactly these in one step, those it
has no rows for included.  A run that fails leaves every table as it was or as
it was meant to be.  A table without rows (nothing was rejected) is a table.
Full-rebuild models overwrite."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.functions.columns import as_month
from velotide.operators import incremental as INC
from velotide.operators.checks import assert_checks, run_checks
from velotide.operators.versions import NULL_VALUE, VersionedTable, open_table, read_table
from velotide.plans import dims, identity, marts, staging, status, trips
from velotide.plans.quality import SPECS
from velotide.plans.rekey import write_history
from velotide.plans.runlog import RunLogger
from velotide.session import freed_shuffles
from velotide.sources import ingest


def land_month(spark: SparkSession, landing_root: str, raw_root: str, source_month: str,
               compat: str | None = None, log: RunLogger | None = None) -> str:
    """Monthly trip batch: discover the month's CSVs, read strictly, replace
    the batch in the raw table."""
    def run():
        df = ingest.read_trip_csv(spark, ingest.batch_paths(spark, landing_root, source_month), source_month)
        return ingest.land_trip_batch(df, raw_root, source_month, compat=compat)
    return log.task("land_trip_batch", run) if log else run()


def daily_transform(spark: SparkSession, raw_trips: DataFrame, raw_stations: DataFrame, raw_status: DataFrame,
                    out_root: str, calendar: tuple[str, str], as_of: str, source_month: str | None = None,
                    full_refresh: bool = False, compat: str | None = None, severity: str = "warn", summary_window: str = "days",
                    log_path: str | None = None, run_id: str | None = None, check_scope: str = "all") -> DataFrame:
    """staging -> identity -> trip history -> quarantine; status -> quarantine;
    dimensions -> facts -> aggregates; then the data checks.  Returns the
    check report.

    ``check_scope="run"`` runs the row-level tests (not-null, accepted
    values, relationships) on the rows this run wrote -- the month's batch
    and the status days from the mark -- while uniqueness and grain tests
    still read the whole key columns (a new row may collide with an old one).
    The default ``"all"`` tests whole tables, as the original does.

    ``summary_window``: a month run refreshes the daily summary on the days its
    batch touches (``"days"``) or, as the original, on the days of that calendar
    month (``"calendar_month"``; a month file's trips of the next month then wait
    for that month's run)."""
    out = out_root.rstrip("/")
    source_month = str(as_month(source_month)) if source_month is not None else None
    batch_id = ingest.trip_batch_name(source_month) if source_month else None
    log = RunLogger(spark, log_path, run_id or uuid.uuid4().hex, "daily_transform", batch_id) if log_path else None

    def step(name, fn):
        return log.task(name, fn) if log else fn()

    def write(name, df):
        """A model rebuilt as a whole; read back by its schema, rows or none."""
        with freed_shuffles(spark):
            df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    def versioned(name, unit, inner=()):
        return VersionedTable(spark, f"{out}/{name}", unit, inner, codec="zstd")

    def replace(table, df, covers=None, laid_out=False):
        name = table.path.rsplit("/", 1)[1]
        step(name, lambda: table.replace(df, covers, laid_out=laid_out))
        return table.read()

    stg_trip = staging.stg_trip(raw_trips)
    stg_station = staging.stg_station(raw_stations)
    last_wins = compat == "last_batch_wins"
    # the compat layout lets a later batch erase a day of an earlier one; then a day is
    # the unit that is replaced, and what is stored per batch is rebuilt
    trip_unit = ("start_date", []) if last_wins else ("source_month", ["start_date"])
    t_hist, t_fact = versioned("int_trip_history", *trip_unit), versioned("fct_trip", *trip_unit)
    # the first run builds everything that has landed, whatever month it is asked for
    month = source_month if t_hist.exists() and t_fact.exists() and not full_refresh else None
    by_batch = None if month is None or last_wins else [month]
    by_trip_unit = None if month is None else "present" if last_wins else [month]

    def per_batch(table, make, rows):
        """A table of partials by batch: the month's from its rows, or all anew."""
        whole = by_batch is None or not table.exists()
        return replace(table, make(rows if whole else INC.for_month(rows, month)), None if whole else by_batch)

    # variant counts per batch: a month run recounts only its batch
    variants = per_batch(versioned("int_station_variants", "source_month"), identity.station_variants_by_batch, stg_trip)
    merged = identity.merge_variants(variants)
    ident = step("int_station_identity", lambda: write("int_station_identity", identity.station_identity(
        stg_trip, stg_station, variants=merged)))
    old_days = INC.touched_days(INC.for_month(t_fact.read(), month), "start_date") if month is not None else []
    # trips are brought together by day as staged, once; the fact reads them as they lie
    staged = stg_trip if month is None else INC.for_month(stg_trip, month)
    step("int_trip_history", lambda: write_history(staged, ident, t_hist, by_trip_unit))
    hist_all = t_hist.read()
    hist_t = hist_all if month is None else INC.for_month(hist_all, month)
    # rejected trips by batch: ids never span batches, so a month run replaces only its batch
    t_rejected = versioned("int_quarantine_trip", "batch_id")
    whole = by_batch is None or not t_rejected.exists()
    q_trip = replace(t_rejected, trips.quarantine_trip(hist_all if whole else hist_t, as_of, stored=True), None if whole else [batch_id],
                     laid_out=True)  # the stored history lies by batch

    # status: the days from the mark on are replaced, also those that have no rows any more
    t_status = versioned("int_station_status", "poll_day")
    since = None if full_refresh else high_water_day(t_status)
    status_raw, from_day = raw_status, None
    if since is not None:
        # raw status laid out by poll day: read only the days from the mark on
        day = F.lit(since).cast("date")
        status_raw = raw_status.filter(F.col("poll_day") >= day if "poll_day" in raw_status.columns
                                       else F.col("poll_time") >= day.cast("timestamp"))

        def from_day(value):
            return value != NULL_VALUE and value >= since
    stg_status = staging.stg_status(raw_status)
    st = status.station_status(staging.stg_status(status_raw), since).withColumn("poll_day", F.to_date("poll_time"))
    st_t = replace(t_status, st, from_day)

    def per_day(name, make, rows, key="poll_day"):
        """A table by day made from the status rows from the mark on, or all anew."""
        table = versioned(name, key)
        whole = from_day is None or not table.exists()
        covers = None if whole else from_day if key == "poll_day" else lambda v: v != NULL_VALUE and v >= since.replace("-", "")
        return replace(table, make(rows if whole else rows.filter(F.col("poll_day") >= F.lit(since).cast("date"))), covers)

    def with_day(df):
        return df.withColumn("poll_day", F.to_date("poll_time"))

    q_status = per_day("int_quarantine_station_status", lambda rows: with_day(status.quarantine_status(rows)), st_t)
    dd = step("dim_date", lambda: write("dim_date", dims.dim_date(spark, *calendar)))
    ds = step("dim_station", lambda: write("dim_station", dims.dim_station(stg_station)))
    ft_t = replace(t_fact, trips.fct_trip(hist_t), by_trip_unit, laid_out=True)
    fs_t = per_day("fct_station_status", lambda rows: with_day(status.fct_station_status(rows, ds, broadcast_dim=False)), st_t)
    # daily summary: only the days this batch touched are recomputed and
    # replaced (a month file also holds days of the next month)
    t_summary = versioned("agg_daily_trip_summary", "full_date")
    if month is None or not t_summary.exists():
        replace(t_summary, marts.agg_daily_trip_summary(ft_t, dd, None))
    elif summary_window == "calendar_month":
        replace(t_summary, marts.agg_daily_trip_summary(ft_t, dd, month), "present")
    else:
        # days of the batch before and after it was landed again
        days = sorted({*old_days, *INC.touched_days(INC.for_month(ft_t, month), "start_date")})
        replace(t_summary, marts.agg_daily_trip_summary(ft_t.filter(F.col("start_date").isin(days)), dd, None), days)
    activity = per_batch(versioned("agg_station_activity_by_batch", "source_month"), marts.station_activity_by_batch, ft_t)
    step("agg_station_activity", lambda: write("agg_station_activity", marts.merge_station_activity(activity)))
    # station x day: trip partials by batch, status partials by day
    trip_parts = per_batch(versioned("agg_station_daily_trip_parts", "source_month"), marts.station_day_trip_parts, ft_t)
    status_parts = per_day("agg_station_daily_status_parts", marts.station_day_status_parts, fs_t, "date_key")
    step("agg_station_daily", lambda: write("agg_station_daily", marts.station_daily_from_parts(
        trip_parts, status_parts, dd, ds, broadcast_dim=False)))
    tables = {
        "stg_trip_history": stg_trip, "stg_station_information": stg_station, "stg_station_status": stg_status,
        "int_station_identity": ident, "int_trip_history": hist_all, "int_quarantine_trip": q_trip, "int_station_status": st_t,
        "int_quarantine_station_status": q_status, "dim_date": dd, "dim_station": ds, "fct_trip": ft_t, "fct_station_status": fs_t,
    }
    def checked():
        if check_scope != "run" or month is None:
            return run_checks(tables, SPECS, stored=True)
        in_run = dict(tables)
        for t in ("stg_trip_history", "int_trip_history", "fct_trip"):
            in_run[t] = INC.for_month(tables[t], month)
        if since is not None:
            for t in ("int_station_status", "int_quarantine_station_status", "fct_station_status"):
                in_run[t] = tables[t].filter(F.col("poll_day") >= F.lit(since).cast("date"))
            in_run["stg_station_status"] = staging.stg_status(status_raw)
        in_run["int_quarantine_trip"] = q_trip.filter(F.col("batch_id") == batch_id)
        row_specs = [c for c in SPECS if c.check in ("not_null", "accepted_values", "relationships")]
        key_specs = [c for c in SPECS if c.check in ("unique", "grain")]
        return run_checks(in_run, row_specs).unionByName(run_checks(tables, key_specs, stored=True))

    report = step("checks", lambda: write("check_report", checked()))
    assert_checks(report, severity)
    return report


def high_water_day(table: VersionedTable) -> str | None:
    """Greatest day a table by day holds, from its manifest; None without any."""
    return max((v for v in table.live() if v != NULL_VALUE), default=None)


def read_model(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A model as the daily job left it."""
    return read_table(spark, f"{out_root.rstrip('/')}/{name}")


MODEL_TABLES = ["int_station_variants", "int_station_identity", "int_trip_history", "int_quarantine_trip", "int_station_status",
                "int_quarantine_station_status", "dim_date", "dim_station", "fct_trip", "fct_station_status",
                "agg_daily_trip_summary", "agg_station_activity", "agg_station_daily", "check_report"]


def register_views(spark: SparkSession, out_root: str) -> list[str]:
    """Temp views over the written models, for ad-hoc Spark SQL
    (``SELECT ... FROM fct_trip JOIN dim_date ...``).  Returns the names."""
    names = []
    for name in MODEL_TABLES:
        path = f"{out_root.rstrip('/')}/{name}"
        if open_table(spark, path) or INC.table_exists(spark, path):
            df = read_table(spark, path)
            if "poll_day" in df.columns:  # layout column of the day-partitioned models
                df = df.drop("poll_day")
            df.createOrReplaceTempView(name)
            names.append(name)
    return names
