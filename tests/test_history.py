"""Seen offsets, key store, changed days, hub codes, checks on write, attempt log, months, clean runs."""

import datetime as dt
import random
import warnings

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from velotide import schemas
from velotide.functions.columns import as_month
from velotide.operators.changes import changed_days, folder_state, refresh_changed_days
from velotide.operators.checks import Check, observed, observed_report
from velotide.operators.keystore import KeyStore
from velotide.operators.versions import VersionedTable, read_table
from velotide.plans import trips as TR
from velotide.plans.jobs import MODEL_TABLES, daily_transform, read_model
from velotide.plans.models import FIXTURE_AS_OF, FIXTURE_CALENDAR
from velotide.plans.runlog import RunLogger, attempt_summary, attempts, log_rows, read_attempts
from velotide.sources import fixtures, ingest
from velotide.streaming import offsets as OF

KW = dict(calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF)


# ---------------------------------------------------------------- offsets ---
def messages(spark, rows):
    return spark.createDataFrame([(t, p, o, dt.datetime(2024, 1, 1), f"{t}{p}{o}") for t, p, o in rows],
                                 "kafka_topic string, kafka_partition long, kafka_offset long, kafka_timestamp timestamp, body string")


def test_seen_offsets_over_batches(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(OF, "CHUNK", 8)
    rng, seen, known = random.Random(3), OF.SeenOffsets(spark, f"{tmp_dir}/seen"), set()
    for batch in range(6):
        rows = [("t", rng.randrange(2), rng.randrange(40)) for _ in range(25)] + [(None, 0, 5), ("t", 0, None)]
        for _ in range(2):  # the batch is replayed before the next one comes
            got = sorted(((r.kafka_topic, r.kafka_partition, r.kafka_offset) for r in seen.first_copies(messages(spark, rows), batch).collect()), key=str)
            fresh = {r for r in rows if None not in r} - known
            assert got == sorted([*fresh, (None, 0, 5), ("t", 0, None)], key=str)
            seen.record(messages(spark, sorted(fresh)), batch)
        known |= fresh
        if batch == 3:
            seen.compact(2)
            assert sorted(map(int, seen.table.live())) == [2, 3]
    held = {(r.kafka_topic, r.kafka_partition, o) for r in seen.table.read().collect() for o in range(r.first, r.last + 1)}
    assert held == known
    merged = OF.merged(seen.table.read()).collect()
    assert all(r.first // 8 == r.last // 8 == r.chunk for r in merged)


# --------------------------------------------------------------- key store ---
def test_key_store_joins_history_without_an_exchange(spark, tmp_dir):
    import uuid
    store = KeyStore(spark, f"keys_{uuid.uuid4().hex[:8]}", f"{tmp_dir}/keys", buckets=4)
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "id string")
    store.add(frame([f"k{i}" for i in range(500)] + ["k7", None, None]), "id", "a")
    store.add(frame([f"m{i}" for i in range(300)] + ["k9", "k10"]), "id", "b")
    assert sorted(r.key for r in store.repeated("b").collect()) == ["k10", "k9"]
    assert sorted(r.key for r in store.repeated("a").collect()) == ["k10", "k7", "k9"]
    store.add(frame(["m1", "m1"]), "id", "b")  # the batch again, corrected
    assert sorted((r.key, r.n) for r in store.repeated("b").collect()) == [("m1", 2)]
    plan = store.others("b").join(store.batch("b").select("key").hint("shuffle_merge"), "key", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    store.drop()


# ------------------------------------------------------------ changed days ---
def test_changed_days_follow_folders(spark, tmp_dir):
    raw, target = f"{tmp_dir}/raw", VersionedTable(spark, f"{tmp_dir}/t", "poll_day")

    def land(day, batch, xs):
        spark.createDataFrame([(dt.date.fromisoformat(day), batch, x) for x in xs], "poll_day date, batch_id int, x int").write.mode(
            "append").partitionBy("poll_day", "batch_id").parquet(raw)

    def refresh():
        return refresh_changed_days(spark, raw, target, lambda df: df.groupBy("poll_day").agg(F.sum("x").alias("x")), f"{tmp_dir}/s")

    land("2024-01-01", 0, [1, 2])
    land("2024-01-02", 0, [3])
    assert refresh() == ["2024-01-01", "2024-01-02"] and refresh() == []
    before = target.live()
    land("2024-01-01", 1, [10])
    assert refresh() == ["2024-01-01"] and target.live()["2024-01-02"] == before["2024-01-02"]
    assert {str(r.poll_day): r.x for r in target.read().collect()} == {"2024-01-01": 13, "2024-01-02": 3}
    from velotide.operators.incremental import drop_partitions
    drop_partitions(spark, raw, "poll_day", ["2024-01-02"])
    assert refresh() == ["2024-01-02"] and [str(r.poll_day) for r in target.read().collect()] == ["2024-01-01"]
    state = folder_state(spark, raw)
    assert changed_days(state, state) == []


# -------------------------------------------------------------------- hubs ---
def test_hub_trips_are_spread(spark):
    n = 30_000
    stg = spark.range(n).select(
        F.col("id").cast("string").alias("ride_id"), F.lit("classic_bike").alias("rideable_type"), F.expr("timestamp_ntz'2024-01-01 10:00:00'").alias("started_at"),
        F.expr("timestamp_ntz'2024-01-01 10:30:00'").alias("ended_at"), F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("c"), F.col("id") % 5000)).alias("start_station_id"),
        F.concat(F.lit("c"), F.col("id") % 4000).alias("end_station_id"), F.lit(40.0).alias("start_latitude"), F.lit(-74.0).alias("start_longitude"),
        F.lit(40.0).alias("end_latitude"), F.lit(-74.0).alias("end_longitude"), F.lit("member").alias("member_casual"),
        F.lit("2024-01-01").cast("date").alias("source_month"), F.lit("b").alias("batch_id"))
    codes = [f"c{k}" for k in range(5000) if k % 7] + ["hub"]
    ident = spark.createDataFrame([(c, f"S{c}", "MATCHED") for c in codes], "source_station_code string, station_key string, mapping_status string")
    assert "hub" in TR.hub_codes(stg, "start_station_id", 4)
    got, plain = TR.trip_history_hubs(stg, ident, 4), TR.trip_history(stg, ident, broadcast_identity=False)
    cols = [c for c in got.columns if c != "rejection_reasons"]
    assert got.select(*cols).exceptAll(plain.select(*cols)).isEmpty() and plain.select(*cols).exceptAll(got.select(*cols)).isEmpty()
    # the shuffle's keys: a hub's rows are dealt over many of them
    hub = F.col("start_station_id").isin(TR.hub_codes(stg, "start_station_id", 4))
    dealt = stg.withColumn("k", F.when(hub, F.lit(None)).otherwise(F.col("start_station_id")))
    sizes = [r["count"] for r in dealt.withColumn("p", F.pmod(F.hash(TR._spread_null("k")), F.lit(16))).groupBy("p").count().collect()]
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


# --------------------------------------------------------- checks, attempts ---
def test_checks_are_counted_by_the_write(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    specs = [Check("t", "x", "not_null"), Check("t", "y", "accepted_values", values=("a",)), Check("u", "x", "not_null")]
    out, seen = observed(df, "t", specs)
    out.write.parquet(f"{tmp_dir}/t")
    assert sorted(tuple(r) for r in observed_report(spark, [seen]).collect()) == [("t", "x", "not_null", 1), ("t", "y", "accepted_values", 1)]


def test_unfinished_attempts_show(spark, tmp_dir):
    log = RunLogger(spark, f"{tmp_dir}/log", "r", "d")
    log.task("t", lambda: 1)
    log._append(f"{tmp_dir}/log_started", task_id="t", try_number=2, start_time=dt.datetime.now(), status="RUNNING")  # and the driver dies
    rows = {r.try_number: r.status for r in read_attempts(spark, f"{tmp_dir}/log").collect()}
    assert rows == {1: "SUCCESS", 2: "UNFINISHED"}
    assert RunLogger(spark, f"{tmp_dir}/log", "r", "d").tries == {"t": 2}
    s = attempt_summary(attempts(log_rows(spark, []), log_rows(spark, [dict(run_id="r", task_id="x", try_number=1, status="RUNNING")]))).first()
    assert (s.attempts, s.last_status) == (1, "UNFINISHED")


def test_a_log_that_cannot_be_written_harms_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/file"
    open(path, "w").write("no folder")
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        log = RunLogger(spark, f"{path}/log", "r", "d")
        assert log.task("t", lambda: 5) == 5
        with pytest.raises(ZeroDivisionError):
            log.task("t", lambda: 1 / 0)
    assert any("cannot be written" in str(w.message) for w in seen)


# ------------------------------------------------------------ months, runs ---
def test_months_are_brought_to_day_one():
    first = dt.date(2024, 2, 1)
    assert [as_month(x) for x in ("2024-02", "2024-02-01", "2024-02-17", dt.date(2024, 2, 9), dt.datetime(2024, 2, 9, 5))] == [first] * 5
    for bad in ("2024", "Feb 2024", "2024-2", "2024-02-30", "2024-13", ""):
        with pytest.raises(ValueError):
            as_month(bad)


def small_status(spark, valid=True):
    st = fixtures.raw_status(spark, SF_SMALL).filter("station_id IS NOT NULL AND snapshot_id IS NOT NULL AND num_docks_available >= 0")
    ok = "num_bikes_available >= 0 AND is_installed IN (0, 1) AND is_renting IN (0, 1) AND is_returning IN (0, 1)"
    return st.filter(ok if valid else "num_bikes_available < 0")


def saved(spark, df, path):
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_month_spellings_give_one_table(spark, tmp_dir):
    inputs = [saved(spark, f(spark, SF_SMALL), f"{tmp_dir}/{n}") for f, n in ((fixtures.raw_trips, "t"), (fixtures.raw_stations, "s"), (fixtures.raw_status, "p"))]
    daily_transform(spark, *inputs, f"{tmp_dir}/out", **KW)
    whole = read_model(spark, f"{tmp_dir}/out", "fct_trip").count()
    for month in ("2024-02", dt.date(2024, 2, 1)):
        daily_transform(spark, *inputs, f"{tmp_dir}/out", source_month=month, **KW)
        assert read_model(spark, f"{tmp_dir}/out", "fct_trip").count() == whole
    assert sorted(VersionedTable(spark, f"{tmp_dir}/out/fct_trip", "source_month").live()) == ["2024-01-01", "2024-02-01"]


@pytest.mark.parametrize("empty", ["rejections", "all"])
def test_daily_job_with_empty_tables(spark, tmp_dir, empty):
    trips, stations = fixtures.raw_trips(spark, SF_SMALL).limit(300), fixtures.raw_stations(spark, SF_SMALL)
    status = small_status(spark).limit(20)
    none = lambda df, *names: df.limit(0) if empty in names else df
    if empty == "rejections":
        trips = trips.filter("ride_id = 'nobody'")
    inputs = [saved(spark, df, f"{tmp_dir}/{k}") for k, df in enumerate((none(trips, "trips", "all"), none(stations, "stations", "all"), none(status, "status", "all")))]
    for month in (None, "2024-01")[:2 if empty == "rejections" else 1]:
        report = daily_transform(spark, *inputs, f"{tmp_dir}/out", source_month=month, **KW)
        assert report.count() == 53
    for name in MODEL_TABLES:
        assert read_model(spark, f"{tmp_dir}/out", name).count() >= 0, name
    if empty in ("status", "all", "rejections"):
        assert read_model(spark, f"{tmp_dir}/out", "int_quarantine_station_status").count() == 0


def test_days_without_rows_from_the_mark_on_lose_theirs(spark, tmp_dir):
    base, out = small_status(spark), f"{tmp_dir}/out"
    bad = small_status(spark, valid=False)
    trips, stations = fixtures.raw_trips(spark, SF_SMALL).limit(200), fixtures.raw_stations(spark, SF_SMALL)
    last = base.agg(F.to_date(F.max("poll_time"))).first()[0]
    on_last = F.to_date("poll_time") == F.lit(last)
    rejected = bad.limit(1).withColumn("poll_time", F.lit(dt.datetime.combine(last, dt.time(1))))
    daily_transform(spark, trips, stations, base.unionByName(rejected), out, **KW)
    q = lambda: read_table(spark, f"{out}/int_quarantine_station_status").filter(F.col("poll_day") == F.lit(last)).count()
    assert q() == 1
    daily_transform(spark, trips, stations, base, out, **KW)  # the rejected row is gone from the raw table
    assert q() == 0
    assert read_table(spark, f"{out}/fct_station_status").filter(on_last).count() > 0


def test_landing_refuses_rows_of_another_month(spark, tmp_dir):
    df = spark.createDataFrame([], schemas.TRIP_RAW)
    with pytest.raises(ValueError):
        ingest.land_trip_batch(df, f"{tmp_dir}/raw", "January")
    ingest.land_trip_batch(df, f"{tmp_dir}/raw", "2024-01")
    assert ingest.read_landed_trips(spark, f"{tmp_dir}/raw").count() == 0
