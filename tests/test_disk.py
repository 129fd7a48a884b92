"""What jobs write, shuffle and leave on disk while they run."""

import contextlib
import glob
import io
import re
import time

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from velotide.operators.broadcast import materialise
from velotide.operators.versions import VersionedTable
from velotide.plans import trips as TR
from velotide.plans.jobs import daily_transform, read_model
from velotide.plans.models import FIXTURE_AS_OF, FIXTURE_CALENDAR
from velotide.sources import fixtures

KW = dict(calendar=FIXTURE_CALENDAR, as_of=FIXTURE_AS_OF)


def saved(spark, df, path):
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_the_daily_job_moves_trips_once_as_staged(spark, tmp_dir, monkeypatch):
    trips, stations, status = (saved(spark, f(spark, SF_SMALL), f"{tmp_dir}/{n}") for f, n in (
        (fixtures.raw_trips, "t"), (fixtures.raw_stations, "s"), (fixtures.raw_status, "p")))
    plans, stage = {}, VersionedTable.stage

    def kept(table, df, *a):
        plans.setdefault(table.path.rsplit("/", 1)[1], []).append((df._jdf.queryExecution().optimizedPlan().toString(), a[1]))
        return stage(table, df, *a)

    monkeypatch.setattr(VersionedTable, "stage", kept)
    for compat, month in ((None, "2024-02"), ("last_batch_wins", "2024-01")):
        plans.clear()
        out = f"{tmp_dir}/out-{compat}"
        daily_transform(spark, trips, stations, status, out, compat=compat, **KW)
        whole = sorted(map(str, read_model(spark, out, "fct_trip").collect()))
        daily_transform(spark, trips, stations, status, out, compat=compat, source_month=month, **KW)
        if compat is None:
            assert sorted(map(str, read_model(spark, out, "fct_trip").collect())) == whole
        assert len(plans["int_trip_history"]) == len(plans["fct_trip"]) == 2
        for p, laid_out in plans["int_trip_history"]:
            below = p[p.index("RebalancePartitions"):]
            assert laid_out and p.count("RebalancePartitions") == 1 and "rejection_reasons" not in below and "Join" not in below
        for p, laid_out in plans["fct_trip"] + plans["int_quarantine_trip"]:  # read as the history lies
            assert laid_out and "RebalancePartitions" not in p


def test_writes_leave_no_shuffle_files(spark, tmp_dir):
    before, df = shuffle_files(spark), spark.range(20_000).withColumn("day", F.col("id") % 5).repartition(3, "id")
    VersionedTable(spark, f"{tmp_dir}/t", "day").replace(df)
    kept = materialise(df)
    until = time.time() + 30
    while shuffle_files(spark) - before and time.time() < until:  # they are deleted beside the job
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == VersionedTable(spark, f"{tmp_dir}/t", "day").read().count() == 20_000


def test_landed_inputs_are_packed_and_trips_not_shuffled(spark, tmp_dir):
    root = f"{tmp_dir}/in"
    line = spark.createDataFrame([(k, k % 40, k % 12, k % 7, float(k % 50), "NRA"[k % 3], "OF"[k % 2]) for k in range(1, 200)] + [(5, None, 3, 1, 1.0, "N", "O"), (6, 7, None, 1, 1.0, "N", None)],
                                 "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string")
    line.write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(k, k % 5) for k in range(12)] + [(3, 4), (None, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{root}/supplier.parquet")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = fixtures.raw_trips(spark, root)
        assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
        trips = fixtures.landed(spark, root, "trips")
    finally:
        spark.conf.set(key, before)
    assert sorted(map(str, trips.collect())) == sorted(map(str, rows.collect())) and rows.count() > 199
    assert all(f.endswith(".zstd.parquet") for f in trips.inputFiles())


def test_hub_trips_and_those_without_a_code_stay_where_they_are(spark):
    starts = ["hub", None, "lost", "a", "b", "c", "hub"]  # "lost" is a hub code that the identity lacks
    rows = [(f"R{k}" if k % 11 else None, starts[k % 7] if k % 13 else f"s{k}", ["end", None, f"e{k % 30}"][k % 3]) for k in range(600)] * 2
    stg = spark.createDataFrame(rows, "ride_id string, start_station_id string, end_station_id string").select(
        "ride_id", F.lit("classic_bike").alias("rideable_type"), F.expr("timestamp_ntz'2024-01-01 10:00:00'").alias("started_at"),
        F.expr("timestamp_ntz'2024-01-01 10:30:00'").alias("ended_at"), "start_station_id", "end_station_id",
        *[F.lit(1.0).alias(c) for c in ("start_latitude", "start_longitude", "end_latitude", "end_longitude")],
        F.lit("guest").alias("member_casual"), F.lit("2024-01-01").cast("date").alias("source_month"), F.lit("b").alias("batch_id"))
    codes = [*"abc", "hub", "hub", "end", "e1", "e1", *[f"s{k}" for k in range(0, 600, 2)], None]  # a code may come twice
    ident = spark.createDataFrame([(c, f"S{i}", "MATCHED" if i % 3 else None) for i, c in enumerate(codes)], "source_station_code string, station_key string, mapping_status string")
    got = TR.trip_history_hubs(stg, ident, 3)
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in p and "SortMergeJoin" not in p
    with contextlib.redirect_stdout(io.StringIO()) as told:
        got.explain("formatted")
    moved = re.findall(r"\) Exchange\s*\nInput \[\d+\]: (.*)", told.getvalue())
    assert moved and not any("rejection_reasons" in m or "duration_minutes" in m for m in moved)  # as staged
    for k in (1, 3, 64):
        h = TR.trip_history_hubs(stg, ident, k)
        assert h.columns == TR.TRIP_HISTORY_COLS
        assert sorted(map(str, h.collect())) == sorted(map(str, TR.trip_history(stg, ident, broadcast_identity=False).collect()))


def test_checked_models_are_made_of_those_written(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from velotide.plans.models import Models
    from velotide.plans.quality import run_model_checks
    from velotide.registry import QUERIES
    made_of, write = {}, DataFrameWriter.parquet

    def kept(self, path, *a, **k):
        found = [re.search(r"/velotide-work/([^/]*)-[0-9a-f]{12}/([^/]*)", f) for f in self._df.inputFiles()]
        made_of[path.rsplit("/", 1)[-1]] = {m[2] if m[1] == "checked" else m[1] for m in found}
        return write(self, path, *a, **k)

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        m = Models.from_fixtures(spark, SF_SMALL)
        assert "SortMergeJoin" not in m.trip_history._jdf.queryExecution().executedPlan().toString()  # the identity is few rows
        monkeypatch.setattr(DataFrameWriter, "parquet", kept)
        got = QUERIES["check_on_write"](spark, SF_SMALL)
    finally:
        spark.conf.set(key, before)
    assert made_of["int_quarantine_trip"] == {"int_trip_history", "dim"}  # and the hashes that repeat
    for table, base in (("fct_trip", "int_trip_history"), ("int_station_status", "stg_station_status"),
                        ("int_quarantine_station_status", "int_station_status")):
        assert made_of[table] == {base}, table
    assert made_of["int_trip_history"] == {"stg_trip_history", "int_station_identity"}
    assert made_of["fct_station_status"] == {"int_station_status", "dim_station"}
    want = run_model_checks(Models.from_fixtures(spark, SF_SMALL), ("not_null",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rejected_trips_that_no_other_equals_are_not_shuffled(spark, tmp_dir, monkeypatch):
    at = "timestamp_ntz'2024-01-01 10:00:00'"
    rows = [(f"R{k % 90}" if k % 4 else None, ["x", None][k % 2], [None, "x"][k % 2], k % 5 == 0, k % 3) for k in range(300)]
    h = spark.createDataFrame(rows, "ride_id string, start_station_id string, end_station_id string, is_valid_trip boolean, r int").select(
        "*", F.concat(F.lit("b"), F.col("r") % 2).alias("batch_id"), F.expr(at).alias("started_at"), F.when(F.col("r") > 0, F.expr(at)).alias("ended_at"),
        F.expr("transform(sequence(0, r), i -> named_struct('reason_code', 'C' || i, 'failed_field', 'f', 'reason_detail', 'd'))").alias("rejection_reasons"))
    history = saved(spark, h, f"{tmp_dir}/h")
    want = sorted(map(str, TR.quarantine_trip(history, FIXTURE_AS_OF).collect()))
    assert len(want) == 240
    hashed = TR.quarantine_trip(history, FIXTURE_AS_OF, stored=True)
    p = hashed._jdf.queryExecution().optimizedPlan().toString()
    single = p[p.index("Join LeftAnti"):p.index("Join LeftSemi")]
    assert "Aggregate" not in single.split("rightHint=(strategy=broadcast)")[0] and "rightHint=(strategy=broadcast)" in single
    assert "RebalancePartitions" not in p
    for got in (hashed, TR.quarantine_trip(history, FIXTURE_AS_OF, stored=True, most=0)):  # or all rows are grouped
        assert sorted(map(str, got.collect())) == want
    once = saved(spark, h.filter("ride_id = 'R1'").limit(1), f"{tmp_dir}/once")
    assert TR.quarantine_trip(once, FIXTURE_AS_OF, stored=True, most=0).count() == TR.quarantine_trip(once, FIXTURE_AS_OF).count()


def test_uniqueness_of_a_stored_table_shuffles_hashes(spark, tmp_dir, monkeypatch):
    from velotide.operators import checks as CH
    df = saved(spark, spark.createDataFrame([(f"v{k % 50}" if k < 60 else f"w{k}", k % 40) for k in range(200)] + [(None, 1), (None, 2)], "x string, y long"), f"{tmp_dir}/t")
    specs = [CH.unique("t", "x"), CH.unique("t", "y")]
    want = [("t", "x", "unique", 10), ("t", "y", "unique", 40)]
    asked, count = [], CH.counted_broadcast
    monkeypatch.setattr(CH, "counted_broadcast", lambda d, *a: asked.append(d.columns) or count(d, *a))
    assert sorted(map(tuple, CH.run_checks({"t": df}, specs, stored=True).collect())) == want and asked == [["__hash"]]
    assert sorted(map(tuple, CH.run_checks({"t": df}, specs).collect())) == want and len(asked) == 1
    monkeypatch.setattr(CH, "counted_broadcast", lambda d, *a: (d, False))  # more repeated hashes than may be broadcast
    assert sorted(map(tuple, CH.run_checks({"t": df}, specs, stored=True).collect())) == want
