"""Paths the planner only takes on large data, and months landed again."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from velotide.operators.versions import read_table
from velotide.plans import identity, staging, status, trips
from velotide.plans.jobs import daily_transform
from velotide.plans.models import FIXTURE_AS_OF, FIXTURE_CALENDAR
from velotide.registry import ORACLE, QUERIES
from velotide.session import scratch_path
from velotide.sources import fixtures

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"}


@pytest.fixture()
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["station_identity", "trip_history", "quarantine_trip", "fct_status", "agg_station_daily"])
def test_models_without_a_broadcast_side(spark, no_broadcast, monkeypatch, name):
    import velotide.registry as R
    monkeypatch.setattr(R, "apply_job_conf", lambda s: None)
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, duck(SF_SMALL))
    assert r["ok"], r


def test_quarantine_keeps_every_rejected_row(spark, no_broadcast):
    stg = staging.stg_trip(fixtures.raw_trips(spark, SF_SMALL))
    stg = stg.unionAll(stg).unionAll(stg.limit(50))  # copies of rejected rows
    stations = staging.stg_station(fixtures.raw_stations(spark, SF_SMALL))
    hist = trips.trip_history(stg, identity.station_identity(stg, stations), broadcast_identity=False)
    path = scratch_path(spark, "hist")
    hist.write.parquet(path)
    hist = spark.read.parquet(path)
    bad = trips.quarantine_trip(hist, FIXTURE_AS_OF)
    n = bad.count()
    assert n > 0 and n == bad.select("quarantine_id").distinct().count() == hist.filter("NOT is_valid_trip").count()


def marts_equal(spark, a, b, names):
    for name in names:
        x = read_table(spark, f"{a}/{name}")
        y = read_table(spark, f"{b}/{name}").select(*x.columns)
        assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty(), name


TABLES = ["int_station_identity", "int_trip_history", "int_quarantine_trip", "fct_trip", "agg_daily_trip_summary", "agg_station_activity",
          "agg_station_daily"]


def test_first_month_run_is_a_full_build_and_a_batch_landed_again_leaves_nothing_behind(spark, tmp_dir):
    def save(df, name):
        df.write.parquet(f"{tmp_dir}/{name}")
        return spark.read.parquet(f"{tmp_dir}/{name}")

    raw, stations, polls = (save(f(spark, SF_SMALL), n) for f, n in (
        (fixtures.raw_trips, "t"), (fixtures.raw_stations, "s"), (fixtures.raw_status, "p")))
    kw = dict(calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF)
    full, inc, new_full = (f"{tmp_dir}/{n}" for n in ("full", "inc", "new_full"))
    daily_transform(spark, raw, stations, polls, full, **kw)
    daily_transform(spark, raw, stations, polls, inc, source_month="2024-02-01", **kw)
    marts_equal(spark, full, inc, TABLES)
    hist = read_table(spark, f"{full}/int_trip_history")
    bad = hist.filter("NOT is_valid_trip").select("ride_id").distinct()
    month = F.col("source_month") == F.lit("2024-02-01").cast("date")
    day = F.coalesce(F.to_date("started_at") == F.lit("2024-02-05").cast("date"), F.lit(False))
    again = save(raw.filter(~month).unionByName(raw.filter(month & ~day).join(bad, "ride_id", "left_anti")), "again")
    assert again.count() < raw.count()
    daily_transform(spark, again, stations, polls, inc, source_month="2024-02-01", **kw)
    daily_transform(spark, again, stations, polls, new_full, **kw)
    marts_equal(spark, new_full, inc, TABLES)


def test_status_reads_prune_by_day(spark, tmp_dir):
    st = status.station_status(staging.stg_status(fixtures.raw_status(spark, SF_SMALL)))
    st.withColumn("poll_day", F.to_date("poll_time")).write.partitionBy("poll_day").parquet(f"{tmp_dir}/st")
    from velotide.operators.incremental import high_water_day
    mark = high_water_day(spark, f"{tmp_dir}/st", "poll_day")
    read = spark.read.parquet(f"{tmp_dir}/st").filter(F.col("poll_day") >= F.lit(mark).cast("date"))
    plan = status.quarantine_status(read)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(poll_day" in plan


def test_launcher_settings_and_shared_folder():
    code = ("from velotide.session import get_session\n"
            "s = get_session('local[1]')\nprint('ADVISORY', s.conf.get('spark.sql.adaptive.advisoryPartitionSizeInBytes'))\n")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.adaptive.advisoryPartitionSizeInBytes=300m pyspark-shell",
                        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "ADVISORY 300m" in out.stdout, out.stderr[-2000:]
