"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the driver's tables through the fixture views and runs the
platform's models over all of their rows.  Arrays of structs are reported as
comma-joined reason codes and averages are rounded to 6 places, so the Spark
and DuckDB outputs compare value for value."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide import oracle as O
from velotide import schemas as SCH
from velotide.functions.rules import STATUS_RULES, TRIP_RULES, reason_codes
from velotide.operators import incremental as INC
from velotide.plans import analyses as Y
from velotide.plans import identity as I
from velotide.plans import status as S
from velotide.plans.jobs import daily_transform, read_model
from velotide.plans.models import Models
from velotide.session import apply_job_conf, scratch_path
from velotide.sources import feed as FD
from velotide.sources import fixtures as FX
from velotide.sources import ingest as ING
from velotide.sources.fixtures import landed, landed_path
from velotide.streaming import status_stream as SS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def models(spark: SparkSession, root: str, **kw) -> Models:
    apply_job_conf(spark)
    return Models.from_fixtures(spark, root, **kw)


def _codes(df: DataFrame, src: str = "rejection_reasons") -> DataFrame:
    return df.withColumn("reason_codes", reason_codes(src)).drop(src)


# ---------------------------------------------------------------- staging ---
@register("stg_trip", O.q("SELECT * FROM stg_trip"))
def q_stg_trip(spark, root):
    return models(spark, root).stg_trip


@register("stg_station", O.q("SELECT * FROM stg_station"))
def q_stg_station(spark, root):
    return models(spark, root).stg_station


@register("stg_status", O.q("SELECT * FROM stg_status"))
def q_stg_status(spark, root):
    return models(spark, root).stg_status


# ------------------------------------------------------------------ trips ---
@register("trip_derived", O.q(
    "SELECT ride_id, batch_id, started_at, ended_at, duration_minutes, start_date, end_date, start_hour "
    "FROM trip_base"))
def q_trip_derived(spark, root):
    from velotide.plans.trips import derive_trips
    return derive_trips(models(spark, root).stg_trip).select(
        "ride_id", "batch_id", "started_at", "ended_at", "duration_minutes", "start_date", "end_date", "start_hour")


@register("trip_minutes_boundary", O.q(
    "SELECT duration_minutes - CAST(floor(date_diff('second', started_at, ended_at) / 60) AS BIGINT) AS boundary_excess, "
    "count(*) AS trips FROM trip_base WHERE started_at IS NOT NULL AND ended_at IS NOT NULL GROUP BY 1"))
def q_trip_minutes_boundary(spark, root):
    from velotide.functions.columns import second_diff
    from velotide.plans.trips import derive_trips
    t = derive_trips(models(spark, root).stg_trip).filter(F.col("started_at").isNotNull() & F.col("ended_at").isNotNull())
    excess = F.col("duration_minutes") - F.floor(second_diff("ended_at", "started_at") / 60)
    return t.groupBy(excess.cast("bigint").alias("boundary_excess")).agg(F.count(F.lit(1)).alias("trips"))


TRIP_HISTORY_SQL_COLS = (
    "ride_id, rideable_type, started_at, ended_at, start_station_id, end_station_id, start_station_key, "
    "end_station_key, start_station_mapping_status, end_station_mapping_status, duration_minutes, start_date, "
    "end_date, start_hour, start_latitude, start_longitude, end_latitude, end_longitude, member_casual, "
    "reason_codes, is_valid_trip, source_month, batch_id")


@register("trip_history", O.q(f"SELECT {TRIP_HISTORY_SQL_COLS} FROM trip_history"))
def q_trip_history(spark, root):
    return _codes(models(spark, root).trip_history)


@register("trip_rejection_counts", O.q(
    "SELECT code AS reason_code, count(*) AS rejected_rows "
    "FROM (SELECT unnest(string_split(reason_codes, ',')) AS code FROM trip_base WHERE reason_codes <> '') "
    "GROUP BY code"))
def q_trip_rejection_counts(spark, root):
    h = models(spark, root).trip_history
    return (h.select(F.explode("rejection_reasons").alias("r"))
            .groupBy(F.col("r.reason_code").alias("reason_code")).agg(F.count(F.lit(1)).alias("rejected_rows")))


@register("fct_trip", O.q("SELECT * FROM fct_trip"))
def q_fct_trip(spark, root):
    return models(spark, root).fct_trip


@register("quarantine_trip", O.q("SELECT * FROM quarantine_trip_t"))
def q_quarantine_trip(spark, root):
    return _codes(models(spark, root).quarantine_trip, "rejections")


# --------------------------------------------------------------- identity ---
@register("station_variants", O.q(
    "SELECT code AS source_station_code, name AS source_station_name, lat AS source_latitude, "
    "lng AS source_longitude, trip_rows FROM variants"))
def q_station_variants(spark, root):
    return I.station_variants(models(spark, root).stg_trip)


@register("station_dominant", O.q(
    "SELECT code AS source_station_code, name AS source_station_name, lat AS source_latitude, "
    "lng AS source_longitude, trip_rows FROM dominant"))
def q_station_dominant(spark, root):
    return I.dominant_variant(I.station_variants(models(spark, root).stg_trip))


@register("station_reference", O.q(
    "SELECT station_key, short_name, station_name, latitude, longitude, CAST(short_num AS VARCHAR) AS short_name_numeric, "
    "canonical_name FROM ref"))
def q_station_reference(spark, root):
    return I.station_reference(models(spark, root).stg_station).withColumn(
        "short_name_numeric", F.col("short_name_numeric").cast("string"))


@register("canonical_names", O.q(
    f"SELECT name AS station_name, {O.canon('name')} AS canonical_name FROM ("
    "SELECT start_station_name AS name FROM stg_trip UNION SELECT end_station_name FROM stg_trip "
    "UNION SELECT station_name FROM stg_station)"))
def q_canonical_names(spark, root):
    from velotide.functions.columns import canonical_name
    m = models(spark, root)
    names = (m.stg_trip.select(F.col("start_station_name").alias("station_name"))
             .unionByName(m.stg_trip.select(F.col("end_station_name").alias("station_name")))
             .unionByName(m.stg_station.select("station_name")).distinct())
    return names.select("station_name", canonical_name("station_name").alias("canonical_name"))


@register("code_decimal", O.q(
    f"SELECT code AS source_station_code, CAST({O.code_num('code')} AS VARCHAR) AS code_numeric FROM ("
    "SELECT start_station_id AS code FROM stg_trip UNION SELECT end_station_id FROM stg_trip "
    "UNION SELECT short_name FROM stg_station)"))
def q_code_decimal(spark, root):
    from velotide.functions.columns import code_to_decimal
    m = models(spark, root)
    codes = (m.stg_trip.select(F.col("start_station_id").alias("source_station_code"))
             .unionByName(m.stg_trip.select(F.col("end_station_id").alias("source_station_code")))
             .unionByName(m.stg_station.select(F.col("short_name").alias("source_station_code"))).distinct())
    return codes.select("source_station_code",
                        code_to_decimal("source_station_code").cast("string").alias("code_numeric"))


def _sources(spark, root):
    m = models(spark, root)
    src = I.prepare_sources(I.dominant_variant(I.station_variants(m.stg_trip)))
    return src, I.station_reference(m.stg_station)


@register("match_exact", O.q(
    "SELECT code AS source_station_code, station_key, method AS mapping_method FROM exact_m"))
def q_match_exact(spark, root):
    src, ref = _sources(spark, root)
    return I.match_exact(src, ref)


@register("match_numeric", O.q(
    "SELECT code AS source_station_code, station_key, method AS mapping_method FROM num_m"))
def q_match_numeric(spark, root):
    src, ref = _sources(spark, root)
    return I.match_numeric(src, ref, I.match_exact(src, ref))


@register("match_geo", O.q(
    "SELECT code AS source_station_code, station_key, method AS mapping_method FROM geo_m"))
def q_match_geo(spark, root):
    src, ref = _sources(spark, root)
    ex = I.match_exact(src, ref)
    return I.match_geo(src, ref, ex.unionByName(I.match_numeric(src, ref, ex)))


@register("station_identity", O.q("SELECT * FROM identity"))
def q_station_identity(spark, root):
    return models(spark, root).station_identity


# ------------------------------------------------------------- dimensions ---
@register("dim_station", O.q("SELECT * FROM dim_station"))
def q_dim_station(spark, root):
    return models(spark, root).dim_station


@register("dim_date", O.q(
    "SELECT " + O.dkey("d") + " AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter, "
    "month(d) AS month, strftime(d, '%B') AS month_name, isoyear(d) AS iso_year, week(d) AS week, day(d) AS day, "
    "strftime(d, '%A') AS day_name, dayofweek(d) + 1 AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend "
    "FROM (SELECT CAST(unnest(generate_series(min(CAST(started_at AS DATE)), max(CAST(ended_at AS DATE)), "
    "INTERVAL 1 DAY)) AS DATE) AS d FROM stg_trip)"))
def q_dim_date(spark, root):
    return models(spark, root).data_calendar()


# ----------------------------------------------------------------- status ---
STATUS_SQL_COLS = (
    "station_id, num_bikes_available, num_bikes_disabled, num_docks_available, num_docks_disabled, is_installed, "
    "is_renting, is_returning, last_reported, snapshot_id, poll_time, feed_last_updated, feed_ttl, kafka_topic, "
    "kafka_partition, kafka_offset, kafka_timestamp, ingested_at")


@register("status_dedup_technical", O.q(f"SELECT {STATUS_SQL_COLS} FROM status_tech"))
def q_status_dedup_technical(spark, root):
    return S.dedup_technical(models(spark, root).stg_status)


@register("status_dedup_logical", O.q(f"SELECT {STATUS_SQL_COLS} FROM status_logical"))
def q_status_dedup_logical(spark, root):
    return S.dedup_logical(S.dedup_technical(models(spark, root).stg_status))


@register("status_replays", O.q(
    "SELECT kafka_topic, kafka_partition, kafka_offset, count(*) AS copies FROM stg_status "
    "GROUP BY kafka_topic, kafka_partition, kafka_offset HAVING count(*) > 1"))
def q_status_replays(spark, root):
    return (models(spark, root).stg_status.groupBy(*S.KAFKA_KEY).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


@register("status_history", O.q(
    f"SELECT {STATUS_SQL_COLS}, reason_codes, is_valid, is_active_station, is_empty, is_full FROM status_cls"))
def q_status_history(spark, root):
    return _codes(models(spark, root).station_status)


@register("status_rejection_counts", O.q(
    "SELECT code AS reason_code, count(*) AS rejected_rows "
    "FROM (SELECT unnest(string_split(reason_codes, ',')) AS code FROM status_hist WHERE reason_codes <> '') "
    "GROUP BY code"))
def q_status_rejection_counts(spark, root):
    h = models(spark, root).station_status
    return (h.select(F.explode("rejection_reasons").alias("r"))
            .groupBy(F.col("r.reason_code").alias("reason_code")).agg(F.count(F.lit(1)).alias("rejected_rows")))


@register("fct_status", O.q("SELECT * FROM fct_status"))
def q_fct_status(spark, root):
    return models(spark, root).fct_station_status


@register("quarantine_status", O.q("SELECT * FROM quarantine_status_t"))
def q_quarantine_status(spark, root):
    return _codes(models(spark, root).quarantine_status, "rejections")


# ------------------------------------------------------------- aggregates ---
@register("agg_daily_trip_summary", O.q("SELECT * FROM agg_daily"))
def q_agg_daily_trip_summary(spark, root):
    return models(spark, root).agg_daily_trip_summary


@register("agg_station_activity", O.q("SELECT * FROM agg_activity"))
def q_agg_station_activity(spark, root):
    return models(spark, root).agg_station_activity


AVG_COLS = ["avg_trip_duration_minutes", "avg_bikes_available", "avg_docks_available"]


@register("agg_station_daily", O.q(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in AVG_COLS) + ") FROM agg_station_daily"))
def q_agg_station_daily(spark, root):
    df = models(spark, root).agg_station_daily
    for c in AVG_COLS:
        df = df.withColumn(c, F.round(c, 6))
    return df


# ----------------------------------------------------------------- checks ---
def _check_query(kind: str):
    from velotide.plans.quality import SPECS, run_model_checks

    def fn(spark, root):
        return run_model_checks(models(spark, root), (kind,))
    register(f"check_{kind}", O.check_sql([s for s in SPECS if s.check == kind]))(fn)


for _kind in ("not_null", "unique", "accepted_values", "relationships", "grain"):
    _check_query(_kind)


# --------------------------------------------------------------- analyses ---


@register("y1_demand_monthly", O.q(
    "SELECT year, month, member_casual, trip_count, total_duration_minutes, "
    "round(trip_count / sum(trip_count) OVER (PARTITION BY year, month), 6) AS trip_share FROM ("
    "SELECT d.year, d.month, a.member_casual, CAST(sum(a.trip_count) AS BIGINT) AS trip_count, "
    "CAST(sum(a.total_duration_minutes) AS BIGINT) AS total_duration_minutes "
    "FROM agg_daily a JOIN dim_date d ON a.date_key = d.date_key GROUP BY d.year, d.month, a.member_casual)"))
def q_y1_demand_monthly(spark, root):
    m = models(spark, root)
    return Y.demand(m.agg_daily_trip_summary, m.dim_date, "month")


@register("y1_demand_weekly", O.q(
    "SELECT iso_year, week, member_casual, trip_count, total_duration_minutes, "
    "round(trip_count / sum(trip_count) OVER (PARTITION BY iso_year, week), 6) AS trip_share FROM ("
    "SELECT d.iso_year, d.week, a.member_casual, CAST(sum(a.trip_count) AS BIGINT) AS trip_count, "
    "CAST(sum(a.total_duration_minutes) AS BIGINT) AS total_duration_minutes "
    "FROM agg_daily a JOIN dim_date d ON a.date_key = d.date_key GROUP BY d.iso_year, d.week, a.member_casual)"))
def q_y1_demand_weekly(spark, root):
    m = models(spark, root)
    return Y.demand(m.agg_daily_trip_summary, m.dim_date, "week")


@register("y2_busiest_stations", O.q(
    "SELECT a.station_key, a.start_trip_count, a.end_trip_count, a.total_trip_activity, s.station_name, s.capacity, "
    "round(a.total_trip_activity / s.capacity, 6) AS activity_per_dock "
    "FROM agg_activity a LEFT JOIN (SELECT * FROM dim_station WHERE station_key IS NOT NULL) s "
    "ON a.station_key = s.station_key ORDER BY a.total_trip_activity DESC NULLS LAST, a.station_key LIMIT 10"))
def q_y2_busiest_stations(spark, root):
    m = models(spark, root)
    return Y.busiest_stations(m.agg_station_activity, m.dim_station, 10)


@register("y3_hour_profile", O.q(
    "SELECT d.day_of_week, d.day_name, f.start_hour, count(*) AS trip_count, "
    "round(sum(f.duration_minutes) / count(*), 6) AS avg_duration_minutes "
    "FROM fct_trip f JOIN dim_date d ON f.start_date_key = d.date_key GROUP BY d.day_of_week, d.day_name, f.start_hour"))
def q_y3_hour_profile(spark, root):
    m = models(spark, root)
    return Y.hour_profile(m.fct_trip, m.dim_date)


@register("y4_availability", O.q(
    "SELECT station_key, CAST(hour(poll_time) AS BIGINT) AS hour_of_day, round(avg(num_bikes_available), 6) "
    "AS avg_bikes_available, min(num_bikes_available) AS min_bikes_available, round(avg(num_docks_available), 6) "
    "AS avg_docks_available, count(*) AS observations FROM fct_status WHERE station_key IS NOT NULL "
    "GROUP BY station_key, hour(poll_time)"))
def q_y4_availability(spark, root):
    return Y.availability(models(spark, root).fct_station_status)


@register("y5_empty_or_full", O.q(
    "SELECT *, round(empty_observations / status_observations, 6) AS empty_share, "
    "round(full_observations / status_observations, 6) AS full_share FROM ("
    "SELECT station_key, station_name, CAST(sum(status_observations) AS BIGINT) AS status_observations, "
    "CAST(sum(empty_observations) AS BIGINT) AS empty_observations, "
    "CAST(sum(full_observations) AS BIGINT) AS full_observations FROM agg_station_daily "
    "GROUP BY station_key, station_name) WHERE status_observations > 0 "
    "ORDER BY empty_share DESC NULLS LAST, full_share DESC NULLS LAST, station_key LIMIT 10"))
def q_y5_empty_or_full(spark, root):
    return Y.empty_or_full(models(spark, root).agg_station_daily, 10)


@register("y6_activity_vs_availability", O.q(
    "SELECT date_key, station_key, trips_started, trips_ended, total_trip_activity, "
    "round(avg_bikes_available, 6) AS avg_bikes_available, round(avg_docks_available, 6) AS avg_docks_available, "
    "empty_observations, full_observations FROM agg_station_daily "
    "WHERE total_trip_activity > 0 AND status_observations > 0"))
def q_y6_activity_vs_availability(spark, root):
    df = Y.activity_vs_availability(models(spark, root).agg_station_daily)
    return (df.withColumn("avg_bikes_available", F.round("avg_bikes_available", 6))
            .withColumn("avg_docks_available", F.round("avg_docks_available", 6)))


@register("y7_routes", O.q(
    "SELECT start_station_key, end_station_key, count(*) AS trip_count, "
    "count_if(member_casual = 'member') AS member_trips, count_if(member_casual = 'casual') AS casual_trips, "
    "round(avg(duration_minutes), 6) AS avg_duration_minutes FROM fct_trip "
    "WHERE start_station_key IS NOT NULL AND end_station_key IS NOT NULL GROUP BY start_station_key, end_station_key "
    "ORDER BY trip_count DESC, start_station_key, end_station_key LIMIT 20"))
def q_y7_routes(spark, root):
    return Y.routes(models(spark, root).fct_trip, 20)


@register("y8_record_counts", O.q(
    "SELECT 'batch' AS source, 'raw_trip_history' AS layer, count(*) AS records FROM raw_trips2 "
    "UNION ALL SELECT 'batch', 'raw_station_information', count(*) FROM raw_stations "
    "UNION ALL SELECT 'stream', 'raw_station_status', count(*) FROM raw_status "
    "UNION ALL SELECT 'batch', 'fct_trip', count(*) FROM fct_trip "
    "UNION ALL SELECT 'stream', 'fct_station_status', count(*) FROM fct_status"))
def q_y8_record_counts(spark, root):
    m = models(spark, root)
    return Y.record_counts({("batch", "raw_trip_history"): m.raw_trips,
                            ("batch", "raw_station_information"): m.raw_stations,
                            ("stream", "raw_station_status"): m.raw_status,
                            ("batch", "fct_trip"): m.fct_trip,
                            ("stream", "fct_station_status"): m.fct_station_status})


# ------------------------------------------------------------------- feed ---


def feed_responses(spark, root):
    return landed(spark, root, "feed")


@register("feed_classify", O.qf(
    "SELECT coalesce(feed_error, 'ENVELOPE_OK') AS error_type, count(*) AS n FROM feed_env GROUP BY 1 "
    "UNION ALL SELECT CASE WHEN valid THEN 'VALID_STATION' ELSE 'INVALID_STATION_RECORD' END, count(*) "
    "FROM feed_el2 GROUP BY 1"))
def q_feed_classify(spark, root):
    apply_job_conf(spark)
    return FD.feed_classes(feed_responses(spark, root))


@register("feed_events", O.qf(
    "SELECT json_extract_string(e, '$.station_id') AS station_id, "
    + ", ".join(f"CAST(json_extract(e, '$.{f}') AS BIGINT) AS {f}" for f in
                ["num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
                 "is_installed", "is_renting", "is_returning", "last_reported"])
    + ", md5(source_url || '|' || fetched_iso) AS snapshot_id, fetched_iso AS poll_time, feed_last_updated, feed_ttl "
    "FROM feed_el2 WHERE valid"))
def q_feed_events(spark, root):
    apply_job_conf(spark)
    return FD.classify_feed(feed_responses(spark, root))[0]


@register("feed_dlq", O.qf(
    "SELECT failed_at, source_url, http_status, error_type, " + O.FEED_MSG_SQL + " AS error_message, raw_body_snippet, "
    "'velotide-feed' AS producer_id FROM (" + O.FEED_DLQ_SQL + ")"))
def q_feed_dlq(spark, root):
    apply_job_conf(spark)
    return FD.classify_feed(feed_responses(spark, root))[1]


@register("feed_dlq_records", O.qf(
    "SELECT '{' || array_to_string(list_filter([" + ", ".join(
        f"'\"{c}\":' || CAST(to_json({c}) AS VARCHAR)" for c in FD.DLQ_FIELDS)
    + "], lambda x: x IS NOT NULL), ',') || '}' AS value FROM ("
    "SELECT *, " + O.FEED_MSG_SQL + " AS error_message, 'velotide-feed' AS producer_id FROM (" + O.FEED_DLQ_SQL + "))"))
def q_feed_dlq_records(spark, root):
    """Dead letters as they are sent: one JSON text each."""
    apply_job_conf(spark)
    return FD.dlq_records(FD.classify_feed(feed_responses(spark, root))[1])


# -------------------------------------------------------------- streaming ---


@register("stream_raw_status", O.q(
    "SELECT " + ", ".join(c for c in SS.RAW_STATUS_COLS if c != "ingested_at") + " FROM raw_status "
    "WHERE kafka_offset % 199 <> 0 AND station_id IS NOT NULL AND trim(station_id) <> '' "
    "AND last_reported IS NOT NULL AND num_bikes_available IS NOT NULL AND num_docks_available IS NOT NULL "
    "AND is_installed IS NOT NULL AND is_renting IS NOT NULL AND is_returning IS NOT NULL"))
def q_stream_raw_status(spark, root):
    """The status stream end to end over a file source of Kafka records
    (the landed record table, read as a stream in several micro-batches):
    parse, structural filter, idempotent foreachBatch sink; read back."""
    apply_job_conf(spark)
    work = scratch_path(spark, "stream")
    source = landed_path(spark, root, "kafka")
    events = SS.status_stream(spark, "files", {"path": source, "maxFilesPerTrigger": "4"})
    SS.start_status_stream(events, f"{work}/raw", f"{work}/checkpoint", {"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{work}/raw").drop("batch_id", "poll_day", "ingested_at")


# ------------------------------------------------- landing and incremental ---

RAW_TRIP_COLS = ", ".join(f.name for f in SCH.TRIP_RAW.fields)
FIRST_MONTH, SECOND_MONTH = "2024-01-01", "2024-02-01"


def _land_csv_months(spark, root, compat=None, rerun_first=False):
    """Publish the fixture trips as monthly CSV files, then land every month
    (optionally re-running the first) and return the landed raw table."""
    work = scratch_path(spark, "landing")
    trips = FX.raw_trips(spark, root).filter(F.col("started_at").isNotNull())
    months = sorted(r[0] for r in trips.select("source_month").distinct().collect())  # a few months
    for m in months:
        ING.write_trip_csv(trips.filter(F.col("source_month") == F.lit(m)), f"{work}/landing/source_month={m:%Y-%m}", "gzip")
    runs = months + (months[:1] if rerun_first else [])
    for m in runs:
        df = ING.read_trip_csv(spark, ING.batch_paths(spark, f"{work}/landing", str(m)), m)
        ING.land_trip_batch(df, f"{work}/raw", m, compat=compat)
    return ING.read_landed_trips(spark, f"{work}/raw", compat)


@register("ingest_trip_batches", O.q(f"SELECT {RAW_TRIP_COLS} FROM raw_trips2 WHERE started_at IS NOT NULL"))
def q_ingest_trip_batches(spark, root):
    apply_job_conf(spark)
    return _land_csv_months(spark, root)


@register("batch_rerun", O.q(f"SELECT {RAW_TRIP_COLS} FROM raw_trips2 WHERE started_at IS NOT NULL"))
def q_batch_rerun(spark, root):
    """Landing the first month twice leaves one copy of it."""
    apply_job_conf(spark)
    return _land_csv_months(spark, root, rerun_first=True)


@register("day_replace_compat", O.q(
    f"SELECT {RAW_TRIP_COLS} FROM raw_trips2 WHERE started_at IS NOT NULL AND NOT ("
    f"source_month = DATE '{FIRST_MONTH}' AND CAST(started_at AS DATE) IN (SELECT CAST(started_at AS DATE) "
    f"FROM raw_trips2 WHERE source_month = DATE '{SECOND_MONTH}' AND started_at IS NOT NULL))"))
def q_day_replace_compat(spark, root):
    """The reference's day-partition loads: the later batch erases the
    earlier batch's rows of a shared day."""
    apply_job_conf(spark)
    return _land_csv_months(spark, root, compat="last_batch_wins")


@register("latest_batch", O.q(
    "SELECT CAST(date_trunc('month', max(source_month)) AS DATE) AS latest_source_month FROM raw_trips2"))
def q_latest_batch(spark, root):
    apply_job_conf(spark)
    return ING.latest_batch_frame(FX.raw_trips(spark, root))


@register("incremental_month", O.q(f"SELECT * FROM fct_trip WHERE source_month = DATE '{FIRST_MONTH}'"))
def q_incremental_month(spark, root):
    return models(spark, root, source_month=FIRST_MONTH).fct_trip


FCT_TRIP_COLS = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "end_station_id",
                 "start_station_key", "end_station_key", "duration_minutes", "start_date", "end_date",
                 "start_date_key", "end_date_key", "start_hour", "start_latitude", "start_longitude",
                 "end_latitude", "end_longitude", "member_casual", "source_month", "batch_id"]


def _incremental_fct_trip(spark, root, compat=None):
    work = scratch_path(spark, "fct_trip")
    for m in (FIRST_MONTH, SECOND_MONTH):
        fct = models(spark, root, source_month=m).fct_trip
        INC.replace_partitions(fct, work, INC.trip_partitioning(compat), sort_by=["started_at"])
    df = spark.read.parquet(work)
    return df.withColumn("start_date", F.col("start_date").cast("date")).withColumn(
        "source_month", F.col("source_month").cast("date")).select(*FCT_TRIP_COLS)


@register("incremental_fct_trip", O.q("SELECT * FROM fct_trip"))
def q_incremental_fct_trip(spark, root):
    """fct_trip built batch by batch equals the full build (partitioned by
    source month and day, no batch erases another)."""
    return _incremental_fct_trip(spark, root)


@register("incremental_fct_trip_compat", O.q(
    f"SELECT * FROM fct_trip WHERE NOT (source_month = DATE '{FIRST_MONTH}' AND start_date IN ("
    f"SELECT start_date FROM fct_trip WHERE source_month = DATE '{SECOND_MONTH}'))"))
def q_incremental_fct_trip_compat(spark, root):
    return _incremental_fct_trip(spark, root, compat="last_batch_wins")


HW_FIRST_RUN_END, HW_DAY = "2024-01-20", "2024-01-19"


@register("highwater_status", O.q(
    f"SELECT {STATUS_SQL_COLS}, reason_codes, is_valid, is_active_station, is_empty, is_full FROM "
    + O.status_model(f"poll_time < TIMESTAMP '{HW_FIRST_RUN_END}'")
    + f" WHERE CAST(poll_time AS DATE) < DATE '{HW_DAY}' UNION ALL "
    f"SELECT {STATUS_SQL_COLS}, reason_codes, is_valid, is_active_station, is_empty, is_full FROM "
    + O.status_model(f"poll_time >= TIMESTAMP '{HW_DAY}'")))
def q_highwater_status(spark, root):
    """Two runs of int_station_status: the first up to 19 Jan, the second
    from the target's high-water day on, replacing the days it touches."""
    m = models(spark, root)
    work = scratch_path(spark, "status")
    stg = m.stg_status
    first = S.station_status(stg.filter(F.col("poll_time") < F.lit(HW_FIRST_RUN_END).cast("timestamp")))
    INC.replace_partitions(first.withColumn("poll_day", F.to_date("poll_time")), work, ["poll_day"])
    hw = INC.high_water_day(spark, work, "poll_day")
    second = S.station_status(stg, since_day=hw)
    INC.replace_partitions(second.withColumn("poll_day", F.to_date("poll_time")), work, ["poll_day"])
    return _codes(spark.read.parquet(work).drop("poll_day"))


STATION_RAW_COLS = [f.name for f in SCH.STATION_RAW.fields]
STATION_RAW_SQL = ", ".join(c if c != "rental_methods" else "array_to_string(rental_methods, ',') AS rental_methods"
                            for c in STATION_RAW_COLS)


def _station_out(df):
    return df.withColumn("rental_methods", F.array_join("rental_methods", ",")).select(*STATION_RAW_COLS)


@register("station_feed_landing", O.q(f"SELECT {STATION_RAW_SQL} FROM raw_stations"))
def q_station_feed_landing(spark, root):
    """Station snapshots published as feed documents (at most 1,000 stations
    each), read element by element, landed by snapshot day, read back."""
    apply_job_conf(spark)
    work = scratch_path(spark, "stations")
    st = FX.raw_stations(spark, root)
    days = sorted(r[0] for r in st.select("snapshot_date").distinct().collect())  # a few days
    elem = [F.col(f.name) for f in SCH.STATION_INFO.fields]
    for d in days:
        docs = (st.filter(F.col("snapshot_date") == F.lit(d))
                .withColumn("chunk", F.floor(F.regexp_extract("station_id", "[0-9]+", 0).cast("bigint") / 1000))
                .groupBy("chunk").agg(F.collect_list(F.struct(*elem)).alias("stations"))
                .select(F.to_json(F.struct(F.lit(1704067200).alias("last_updated"), F.lit(60).alias("ttl"),
                                           F.struct(F.col("stations").alias("stations")).alias("data"))).alias("value")))
        docs.write.text(f"{work}/feed/{d}")
        ING.land_station_snapshot(ING.read_station_feed(spark, f"{work}/feed/{d}", d, multi_line=False), f"{work}/raw")
    return _station_out(ING.landed_stations(spark, f"{work}/raw").read())


@register("station_ndjson_load", O.q(f"SELECT {STATION_RAW_SQL} FROM raw_stations"))
def q_station_ndjson_load(spark, root):
    apply_job_conf(spark)
    work = scratch_path(spark, "ndjson")
    FX.raw_stations(spark, root).write.json(f"{work}/stations")
    return _station_out(ING.read_station_ndjson(spark, f"{work}/stations"))


# ---------------------------------------------------------- run calendars ---
@register("run_batch_dates", O.q(
    "SELECT poll_time AS run_instant, "
    "CAST(date_trunc('month', CAST((poll_time AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Jakarta' AS DATE)) AS DATE) "
    "AS source_month, CAST((poll_time AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS snapshot_date "
    "FROM (SELECT DISTINCT poll_time FROM raw_status)"))
def q_run_batch_dates(spark, root):
    """Each poll instant taken as a run instant: the trip batch month (in the
    scheduler's zone) and the station snapshot day (in the feed's zone)."""
    from velotide.functions.columns import snapshot_date_of_run, source_month_of_run
    polls = models(spark, root).raw_status.select(F.col("poll_time").alias("run_instant")).distinct()
    return polls.select("run_instant", source_month_of_run("run_instant").alias("source_month"),
                        snapshot_date_of_run("run_instant").alias("snapshot_date"))


@register("feed_stream_events", O.qf(
    "SELECT json_extract_string(e, '$.station_id') AS key, json_extract_string(e, '$.station_id') AS station_id, "
    + ", ".join(f"CAST(json_extract(e, '$.{f}') AS BIGINT) AS {f}" for f in
                ["num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
                 "is_installed", "is_renting", "is_returning", "last_reported"])
    + ", md5(source_url || '|' || fetched_iso) AS snapshot_id, fetched_iso AS poll_time, feed_last_updated, feed_ttl "
    "FROM feed_el2 WHERE valid"))
def q_feed_stream_events(spark, root):
    """The feed classifier as a stream over the landed responses (several
    micro-batches): Kafka-shaped event records, read back and parsed."""
    from velotide.streaming.feed_stream import read_responses, start_feed_stream
    from velotide.streaming.status_stream import STATUS_EVENT_SCHEMA
    apply_job_conf(spark)
    work = scratch_path(spark, "feed-stream")
    src = read_responses(spark, landed_path(spark, root, "feed"), {"maxFilesPerTrigger": "4"})
    start_feed_stream(src, f"{work}/out", f"{work}/checkpoint", {"availableNow": True}).awaitTermination()
    rec = spark.read.parquet(f"{work}/out/events")
    return rec.select("key", F.from_json("value", STATUS_EVENT_SCHEMA).alias("e")).select("key", "e.*")


# ------------------------------------ incremental formulations (partials) ---
@register("station_identity_from_batches", O.q("SELECT * FROM identity"))
def q_station_identity_from_batches(spark, root):
    """Identity from per-batch variant counts (the daily job's incremental form)."""
    m = models(spark, root)
    merged = I.merge_variants(I.station_variants_by_batch(m.stg_trip))
    return I.station_identity(m.stg_trip, m.stg_station, variants=merged)


@register("agg_station_activity_from_parts", O.q("SELECT * FROM agg_activity"))
def q_agg_station_activity_from_parts(spark, root):
    from velotide.plans import marts
    return marts.merge_station_activity(marts.station_activity_by_batch(models(spark, root).fct_trip))


@register("agg_station_daily_from_parts", O.q(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in AVG_COLS) + ") FROM agg_station_daily"))
def q_agg_station_daily_from_parts(spark, root):
    from velotide.plans import marts
    m = models(spark, root)
    df = marts.station_daily_from_parts(marts.station_day_trip_parts(m.fct_trip),
                                        marts.station_day_status_parts(m.fct_station_status), m.dim_date,
                                        m.dim_station)
    for c in AVG_COLS:
        df = df.withColumn(c, F.round(c, 6))
    return df


# ------------------------------------------------ rejections, field by field ---
def _rule_values(rules) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(r.code)}, {quoted(r.field)}, {quoted(r.detail)})" for r in rules)
    return f"(VALUES {rows}) AS r(reason_code, failed_field, reason_detail)"


def _rejections(df, keys):
    return df.select(*keys, F.inline("rejection_reasons"))


@register("trip_rejections", O.q(
    "SELECT ride_id, batch_id, r.reason_code, r.failed_field, r.reason_detail FROM ("
    "SELECT ride_id, batch_id, unnest(string_split(reason_codes, ',')) AS code FROM trip_history WHERE reason_codes <> '') "
    f"JOIN {_rule_values(TRIP_RULES)} ON r.reason_code = code"))
def q_trip_rejections(spark, root):
    return _rejections(models(spark, root).trip_history, ["ride_id", "batch_id"])


@register("status_rejections", O.q(
    "SELECT station_id, snapshot_id, r.reason_code, r.failed_field, r.reason_detail FROM ("
    "SELECT station_id, snapshot_id, unnest(string_split(reason_codes, ',')) AS code FROM status_cls WHERE reason_codes <> '') "
    f"JOIN {_rule_values(STATUS_RULES)} ON r.reason_code = code"))
def q_status_rejections(spark, root):
    return _rejections(models(spark, root).station_status, ["station_id", "snapshot_id"])


# --------------------------------------------------------------- daily job ---
def _daily(spark, root, out, trips, month):
    from velotide.plans.models import FIXTURE_AS_OF, FIXTURE_CALENDAR
    daily_transform(spark, trips, landed(spark, root, "stations"), landed(spark, root, "status"), out,
                    calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF, source_month=month)


@register("first_run_month", O.q("SELECT * FROM fct_trip"))
def q_first_run_month(spark, root):
    """The daily job's first run, asked for one month: builds all that has landed."""
    apply_job_conf(spark)
    out = scratch_path(spark, "first-run")
    _daily(spark, root, out, landed(spark, root, "trips"), SECOND_MONTH)
    return read_model(spark, out, "fct_trip").select(*FCT_TRIP_COLS)


GONE_DAY = "2024-02-05"


@register("batch_reland", O.q(
    "SELECT f.start_date_key AS date_key, d.full_date, f.member_casual, count(*) AS trip_count, "
    "CAST(sum(f.duration_minutes) AS BIGINT) AS total_duration_minutes "
    "FROM fct_trip f JOIN dim_date d ON f.start_date_key = d.date_key "
    f"WHERE NOT (f.source_month = DATE '{SECOND_MONTH}' AND f.start_date = DATE '{GONE_DAY}') "
    "GROUP BY f.start_date_key, d.full_date, f.member_casual"))
def q_batch_reland(spark, root):
    """A month landed again without one of its days: the month run leaves none
    of that day's trips in the fact and its daily summary."""
    apply_job_conf(spark)
    out, trips = scratch_path(spark, "reland"), landed(spark, root, "trips")
    _daily(spark, root, out, trips, None)
    gone = (F.col("source_month") == F.lit(SECOND_MONTH).cast("date")) & (F.to_date("started_at") == F.lit(GONE_DAY).cast("date"))
    _daily(spark, root, out, trips.filter(~F.coalesce(gone, F.lit(False))), SECOND_MONTH)
    return read_model(spark, out, "agg_daily_trip_summary").select(
        "date_key", F.col("full_date").cast("date").alias("full_date"), "member_casual", "trip_count", "total_duration_minutes")


@register("agg_daily_month_window", O.q(
    f"SELECT * FROM agg_daily WHERE full_date >= DATE '{SECOND_MONTH}' AND full_date < DATE '{SECOND_MONTH}' + INTERVAL 1 MONTH"))
def q_agg_daily_month_window(spark, root):
    from velotide.plans.marts import agg_daily_trip_summary
    m = models(spark, root)
    return agg_daily_trip_summary(m.fct_trip, m.dim_date, SECOND_MONTH)


@register("stream_replayed_batch", ORACLE["stream_raw_status"])
def q_stream_replayed_batch(spark, root):
    """One micro-batch written twice, as after a crash: the second write replaces the first."""
    apply_job_conf(spark)
    work = scratch_path(spark, "replay")
    records = spark.read.parquet(landed_path(spark, root, "kafka"))
    write = SS.write_status_batch(f"{work}/raw")
    for _ in range(2):
        write(SS.structural_filter(SS.parse_status(records)), 7)
    return spark.read.parquet(f"{work}/raw").drop("batch_id", "poll_day", "ingested_at")


# ------------------------------------------- replacement, history, late data ---
@register("batch_swap", O.q(
    f"SELECT {RAW_TRIP_COLS} FROM raw_trips2 WHERE started_at IS NOT NULL AND NOT ("
    f"source_month = DATE '{SECOND_MONTH}' AND CAST(started_at AS DATE) = DATE '{GONE_DAY}')"))
def q_batch_swap(spark, root):
    """Two months landed; a new load of the first stops between its write and its
    publication, one of the second (without one of its days) goes through."""
    apply_job_conf(spark)
    work = scratch_path(spark, "swap")
    trips = landed(spark, root, "trips").filter("started_at IS NOT NULL")
    of = lambda m: trips.filter(F.col("source_month") == F.lit(m).cast("date"))
    for m in (FIRST_MONTH, SECOND_MONTH):
        ING.land_trip_batch(of(m), work, m)
    raw, d = ING.landed_trips(spark, work), F.to_date("started_at")
    half = of(FIRST_MONTH).filter(F.xxhash64("ride_id") % 2 == 0)
    raw.stage(half.withColumn("year", F.year(d)).withColumn("month", F.month(d)).withColumn("day", F.dayofmonth(d)))
    ING.land_trip_batch(of(SECOND_MONTH).filter(d != F.lit(GONE_DAY).cast("date")), work, SECOND_MONTH)
    return ING.read_landed_trips(spark, work)


_CLEAN_TRIP = ("ride_id IS NOT NULL AND started_at IS NOT NULL AND ended_at IS NOT NULL AND ended_at > started_at "
               "AND coalesce(start_lat BETWEEN -90 AND 90, true) AND coalesce(start_lng BETWEEN -180 AND 180, true) "
               "AND coalesce(end_lat BETWEEN -90 AND 90, true) AND coalesce(end_lng BETWEEN -180 AND 180, true) "
               "AND coalesce(lower(trim(member_casual)) IN ('member', 'casual'), true)")
_CLEAN_STATUS = ("station_id IS NOT NULL AND snapshot_id IS NOT NULL AND num_bikes_available >= 0 AND num_docks_available >= 0 "
                 "AND is_installed IN (0, 1) AND is_renting IN (0, 1) AND is_returning IN (0, 1)")


@register("clean_first_run", O.q(
    f"SELECT 'fct_trip' AS model, count(*) AS records FROM raw_trips2 WHERE {_CLEAN_TRIP} "
    "UNION ALL SELECT 'int_quarantine_trip', 0 UNION ALL SELECT 'int_quarantine_station_status', 0 "
    f"UNION ALL SELECT 'fct_station_status', count(*) FROM (SELECT DISTINCT station_id, snapshot_id FROM raw_status WHERE {_CLEAN_STATUS})"))
def q_clean_first_run(spark, root):
    """The daily job's first run and a month run on rows of which none is rejected."""
    from velotide.plans.models import FIXTURE_AS_OF, FIXTURE_CALENDAR
    apply_job_conf(spark)
    out = scratch_path(spark, "clean")
    trips, status = landed(spark, root, "trips").filter(_CLEAN_TRIP), landed(spark, root, "status").filter(_CLEAN_STATUS)
    for month in (None, SECOND_MONTH[:7]):
        daily_transform(spark, trips, landed(spark, root, "stations"), status, out, calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF, source_month=month)
    return Y.record_counts({("", m): read_model(spark, out, m) for m in (
        "fct_trip", "int_quarantine_trip", "int_quarantine_station_status", "fct_station_status")}).select(F.col("layer").alias("model"), "records")


@register("stream_dedup", "SELECT DISTINCT * FROM (" + ORACLE["stream_raw_status"] + ")")
def q_stream_dedup(spark, root):
    """The status stream with replays dropped by the set of seen offsets, over
    several micro-batches, merged between them; first copies that come late stay."""
    from velotide.streaming.offsets import SeenOffsets
    apply_job_conf(spark)
    work = scratch_path(spark, "stream-dedup")
    events = SS.status_stream(spark, "files", {"path": landed_path(spark, root, "kafka"), "maxFilesPerTrigger": "2"})
    SS.start_status_stream(events, f"{work}/raw", f"{work}/checkpoint", {"availableNow": True}, seen_path=f"{work}/seen").awaitTermination()
    seen = SeenOffsets(spark, f"{work}/seen")
    seen.compact(max(map(int, seen.table.live())))
    # the same records again, a later micro-batch: nothing in it is new
    again = SS.structural_filter(SS.parse_status(spark.read.parquet(landed_path(spark, root, "kafka"))))
    SS.write_status_batch(f"{work}/raw", seen_path=f"{work}/seen")(again, 1_000_000)
    return spark.read.parquet(f"{work}/raw").drop("batch_id", "poll_day", "ingested_at")


@register("check_unique_incremental", O.q(
    "SELECT source_month, count(*) AS failures FROM (SELECT DISTINCT f.source_month, f.ride_id FROM fct_trip f JOIN ("
    "SELECT ride_id, min(source_month) AS m, max(source_month) AS l, count(*) AS n FROM fct_trip WHERE ride_id IS NOT NULL GROUP BY ride_id HAVING count(*) > 1) d "
    "ON d.ride_id = f.ride_id WHERE EXISTS (SELECT 1 FROM fct_trip g WHERE g.ride_id = f.ride_id AND g.source_month <= f.source_month "
    "GROUP BY g.ride_id HAVING count(*) > 1)) GROUP BY source_month"))
def q_check_unique_incremental(spark, root):
    """Ride ids of each month that occur again in it or in a month before, against
    a store of sorted hash buckets that is joined without being shuffled."""
    import uuid

    from velotide.operators.keystore import KeyStore
    fct = models(spark, root).fct_trip
    work = scratch_path(spark, "keys")
    store, out = KeyStore(spark, f"ride_keys_{uuid.uuid4().hex[:10]}", work), []
    for m in (FIRST_MONTH, SECOND_MONTH):
        store.add(INC.for_month(fct, m), "ride_id", m)
        found = store.repeated(m)
        out.append((m, found.count()))
    store.drop()
    return spark.createDataFrame([r for r in out if r[1]], "month string, failures long").select(
        F.col("month").cast("date").alias("source_month"), "failures")


LATE_DAYS, LOST_DAY = ("2024-01-05", "2024-01-12"), "2024-01-20"
_BY_DAY = (O.status_model(f"CAST(poll_time AS DATE) <> DATE '{LOST_DAY}'")
           .replace("PARTITION BY station_id, snapshot_id", "PARTITION BY station_id, snapshot_id, CAST(poll_time AS DATE)")
           .replace("PARTITION BY kafka_topic, kafka_partition, kafka_offset",
                    "PARTITION BY kafka_topic, kafka_partition, kafka_offset, CAST(poll_time AS DATE)"))


@register("late_status_days", O.q(
    f"SELECT {STATUS_SQL_COLS}, reason_codes, is_valid, is_active_station, is_empty, is_full FROM {_BY_DAY}"))
def q_late_status_days(spark, root):
    """Status observations kept up to date with the raw folders: rows that come late
    for two old days, and a day whose folders are taken away, recompute just those."""
    from velotide.operators.changes import refresh_changed_days
    from velotide.operators.versions import VersionedTable
    apply_job_conf(spark)
    work = scratch_path(spark, "late")
    raw = landed(spark, root, "status").withColumn("poll_day", F.to_date("poll_time"))
    late = F.col("poll_day").isin(*[F.lit(d).cast("date") for d in LATE_DAYS]) & (F.col("kafka_offset") % 3 == 0)
    target = VersionedTable(spark, f"{work}/status", "poll_day")

    def land(rows, batch_id):
        rows.withColumn("batch_id", F.lit(batch_id)).write.mode("append").partitionBy("poll_day", "batch_id").parquet(f"{work}/raw")

    def refresh():
        return refresh_changed_days(spark, f"{work}/raw", target, S.status_by_day, f"{work}/state")

    land(raw.filter(~late), 0)
    refresh()
    land(raw.filter(late), 1)
    days = refresh()
    if set(days) != set(LATE_DAYS):
        raise AssertionError(f"recomputed {days}")
    INC.drop_partitions(spark, f"{work}/raw", "poll_day", [LOST_DAY])
    refresh()
    return _codes(target.read().drop("poll_day"))


@register("trip_history_hubs", ORACLE["trip_history"])
def q_trip_history_hubs(spark, root):
    """Trip history with the identity joined by shuffle and hub codes by a small broadcast."""
    from velotide.plans.trips import trip_history_hubs
    m = models(spark, root)
    return _codes(trip_history_hubs(m.stg_trip, m.station_identity))


@register("check_on_write", ORACLE["check_not_null"])
def q_check_on_write(spark, root):
    """Not-null tests counted while the tables are written: no second read."""
    from velotide.plans.quality import SPECS, write_checked
    m = models(spark, root)
    return write_checked(m, [c for c in SPECS if c.check == "not_null"], scratch_path(spark, "checked"))


_ATTEMPT = ("'run-' || CAST(event_id % 40 AS VARCHAR) AS run_id, 'task-' || CAST(user_id % 9 AS VARCHAR) AS task_id, "
            "CAST(floor(event_id / 40) % 4 + 1 AS BIGINT) AS try_number")


@register("run_log_attempts", f"""
WITH a AS (SELECT {_ATTEMPT}, ts, event_id FROM events),
s AS (SELECT run_id, task_id, try_number, max(event_id) AS event_id FROM a GROUP BY ALL),
e AS (SELECT run_id, task_id, try_number, CASE WHEN event_id % 5 = 0 THEN 'UNFINISHED' WHEN event_id % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      CASE WHEN event_id % 5 <> 0 AND event_id % 3 = 0 THEN 'error ' || CAST(event_id AS VARCHAR) END AS error_message FROM s)
SELECT run_id, task_id, count(*) AS attempts, max(try_number) AS last_try, arg_max(status, try_number) AS last_status,
  (SELECT x.error_message FROM e x WHERE x.run_id = e.run_id AND x.task_id = e.task_id ORDER BY try_number DESC LIMIT 1) AS last_error
FROM e GROUP BY run_id, task_id""")
def q_run_log_attempts(spark, root):
    """Attempts from start and end records: every fifth has a start only (its driver died)."""
    from velotide.plans.runlog import FAILED, RUNNING, SUCCESS, attempt_summary, attempts
    from velotide.sources.tables import load_table
    apply_job_conf(spark)
    e = load_table(spark, root, "events")
    key = [F.concat(F.lit("run-"), (F.col("event_id") % 40).cast("string")).alias("run_id"), F.concat(F.lit("task-"), (F.col("user_id") % 9).cast("string")).alias("task_id"),
           (F.floor(F.col("event_id") / 40) % 4 + 1).cast("long").alias("try_number")]
    last = e.select(*key, "event_id", "ts").groupBy("run_id", "task_id", "try_number").agg(
        F.max("event_id").alias("event_id"), F.max_by("ts", "event_id").cast("timestamp").alias("start_time"))
    null = lambda t: F.lit(None).cast(t)
    shared = ["run_id", F.lit("daily").alias("dag_id"), F.lit("batch").alias("batch_id"), "task_id", "try_number", "start_time"]
    starts = last.select(*shared, null("timestamp").alias("end_time"), F.lit(RUNNING).alias("status"), null("string").alias("error_message"))
    failed = F.col("event_id") % 3 == 0
    ends = last.filter("event_id % 5 <> 0").select(
        *shared, (F.col("start_time") + F.expr("INTERVAL 1 MINUTE")).alias("end_time"), F.when(failed, F.lit(FAILED)).otherwise(F.lit(SUCCESS)).alias("status"),
        F.when(failed, F.concat(F.lit("error "), F.col("event_id").cast("string"))).alias("error_message"))
    return attempt_summary(attempts(ends, starts))


@register("identity_change", ORACLE["trip_history"])
def q_identity_change(spark, root):
    """Trips written with the identity of half the stations, brought to that of all
    of them: only batches with a changed code are written again."""
    from velotide.operators.versions import VersionedTable
    from velotide.plans.rekey import apply_identity, write_fact, write_history
    m = models(spark, root)
    work = scratch_path(spark, "rekey")
    half = m.stg_station.filter(F.xxhash64("station_id") % 2 == 0)
    old = I.station_identity(m.stg_trip, half)
    history, fact = (VersionedTable(spark, f"{work}/{t}", "source_month", ["start_date"], codec="zstd") for t in ("history", "fact"))
    write_history(m.stg_trip, old, history)
    write_fact(history, fact)
    apply_identity(m.stg_trip, I.station_variants_by_batch(m.stg_trip), old, m.station_identity, history, fact)
    return _codes(history.read())


@register("stream_compacted", ORACLE["stream_raw_status"])
def q_stream_compacted(spark, root):
    """The status stream through a commit log: merged between micro-batches, and a
    merge that stops before its publication changes nothing."""
    from velotide.streaming.commits import StreamTable
    apply_job_conf(spark)
    work = scratch_path(spark, "commits")
    out = StreamTable(spark, f"{work}/raw")
    events = SS.status_stream(spark, "files", {"path": landed_path(spark, root, "kafka"), "maxFilesPerTrigger": "2"})

    merged = []

    def write(batch, batch_id):
        out.write_batch()(batch, batch_id)
        small = sorted(out.small_slots("2024-01-10").items())
        if small and not merged:  # the first time that a day has several batches the stream is past
            out.merge(*small[0])  # and stops
            merged.extend(out.compact("2024-01-10"))

    events.writeStream.foreachBatch(write).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out.compact("2024-01-15")
    return out.read().drop("ingested_at")
