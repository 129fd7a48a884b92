"""The daily transform end to end on the sf0.001 fixture: writes every model,
reruns are stable, the incremental run by month equals the full build."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from velotide.operators.versions import read_table
from velotide.plans.jobs import daily_transform
from velotide.plans.models import FIXTURE_AS_OF, FIXTURE_CALENDAR, Models
from velotide.sources import fixtures


def test_daily_transform(spark, tmp_dir):
    trips, stations, status = (fixtures.raw_trips(spark, SF_SMALL), fixtures.raw_stations(spark, SF_SMALL),
                               fixtures.raw_status(spark, SF_SMALL))
    out = f"{tmp_dir}/marts"
    kw = dict(calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF, log_path=f"{tmp_dir}/runlog")
    report = daily_transform(spark, trips, stations, status, out, full_refresh=True, **kw)
    assert report.count() == 53
    m = Models(spark, trips, stations, status)
    for name, ref in [("fct_trip", m.fct_trip), ("agg_station_daily", m.agg_station_daily),
                      ("agg_station_activity", m.agg_station_activity),
                      ("agg_daily_trip_summary", m.agg_daily_trip_summary)]:
        got = read_table(spark, f"{out}/{name}")
        cols = ref.columns
        assert got.select(*cols).exceptAll(ref).count() == 0 and ref.exceptAll(got.select(*cols)).count() == 0, name
    # incremental runs, month by month, give the same fact table
    out2 = f"{tmp_dir}/marts2"
    for month in ("2024-01-01", "2024-02-01"):
        daily_transform(spark, trips, stations, status, out2, source_month=month, **kw)
    for name in ("int_station_identity", "agg_station_activity", "fct_trip", "agg_daily_trip_summary", "int_quarantine_trip", "fct_station_status", "agg_station_daily",
                 "int_quarantine_station_status"):
        a = read_table(spark, f"{out}/{name}")
        b = read_table(spark, f"{out2}/{name}").select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    log = spark.read.parquet(f"{tmp_dir}/runlog")
    assert log.filter(F.col("status") != "SUCCESS").count() == 0
    assert log.select("task_id").distinct().count() == 17


def test_status_runs_prune_raw_by_poll_day(spark, tmp_dir):
    from velotide.streaming.status_stream import write_status_batch
    raw = f"{tmp_dir}/raw_status"
    write_status_batch(raw, ingested_at="2024-02-01 00:00:00")(fixtures.raw_status(spark, SF_SMALL), 0)
    rs = spark.read.parquet(raw)
    assert "poll_day" in rs.columns
    trips, stations = fixtures.raw_trips(spark, SF_SMALL), fixtures.raw_stations(spark, SF_SMALL)
    kw = dict(calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF)
    daily_transform(spark, trips, stations, rs, f"{tmp_dir}/full", full_refresh=True, **kw)
    early = rs.filter(F.col("poll_day") < F.lit("2024-01-20").cast("date"))
    daily_transform(spark, trips, stations, early, f"{tmp_dir}/inc", full_refresh=True, **kw)
    daily_transform(spark, trips, stations, rs, f"{tmp_dir}/inc", source_month="2024-02-01", **kw)
    a = read_table(spark, f"{tmp_dir}/full/fct_station_status")
    b = read_table(spark, f"{tmp_dir}/inc/fct_station_status").select(*a.columns)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_run_scoped_checks(spark, tmp_dir):
    trips, stations, status = (fixtures.raw_trips(spark, SF_SMALL), fixtures.raw_stations(spark, SF_SMALL),
                               fixtures.raw_status(spark, SF_SMALL))
    kw = dict(calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF)
    out = f"{tmp_dir}/m"
    full = {(r["table"], r["column"], r["check"]): r["failures"]
            for r in daily_transform(spark, trips, stations, status, out, full_refresh=True, **kw).collect()}
    run = {(r["table"], r["column"], r["check"]): r["failures"]
           for r in daily_transform(spark, trips, stations, status, out, source_month="2024-02-01",
                                    check_scope="run", **kw).collect()}
    assert set(run) == set(full)
    for k, v in run.items():
        if k[2] in ("unique", "grain") or not k[0].startswith(("int_trip", "fct_trip", "stg_trip")):
            continue
        assert v <= full[k], k          # the month's rows are a subset of all rows
    assert run[("fct_trip", "ride_id", "unique")] == full[("fct_trip", "ride_id", "unique")]
