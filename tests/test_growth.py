"""Work that grows with the rows, not with the square of what they share."""

import datetime as dt
import json

from pyspark.sql import functions as F

from velotide.plans import identity as I
from velotide.session import open_writers
from velotide.sources import ingest
from velotide.streaming import offsets as OF
from velotide.streaming import status_stream as SS

T = dt.datetime(2024, 1, 1, 12, 0)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def messages(spark, rows):
    return spark.createDataFrame([(t, p, o, T, f"{t}{p}{o}") for t, p, o in rows],
                                 "kafka_topic string, kafka_partition long, kafka_offset long, kafka_timestamp timestamp, body string")


def test_offsets_with_gaps_are_looked_up_without_a_join(spark, tmp_dir):
    seen = OF.SeenOffsets(spark, f"{tmp_dir}/seen")
    first = [("t", 0, o) for o in range(0, 60, 3)] + [("t", 0, o) for o in range(100, 110)]
    assert seen.first_copies(messages(spark, first), 0).count() == len(first)
    seen.record(messages(spark, first), 0)
    rows = [("t", p, o) for p in (0, 1) for o in range(-1, 112)] * 2 + [("t", None, 5), (None, 0, 5)]
    new = seen.first_copies(messages(spark, rows), 1)
    want = {r for r in rows if None not in r} - set(first)
    got = sorted(((r.kafka_topic, r.kafka_partition, r.kafka_offset) for r in new.collect()), key=str)
    assert got == sorted([*want, ("t", None, 5), (None, 0, 5)], key=str)
    assert new.columns == messages(spark, rows).columns
    assert "Join" not in plan(new)


def event(station, day):
    return json.dumps({"station_id": station, "poll_time": f"2024-01-0{day}T10:00:00+00:00", "snapshot_id": "p", "feed_last_updated": 1, "feed_ttl": 60,
                       **{c: 1 for c in [*SS.REQUIRED, "num_bikes_disabled", "num_docks_disabled"]}})


def records(spark, rows):
    return spark.createDataFrame([(None, v.encode(), "status.v1", 0, o, T) for o, v in rows], SS.KAFKA_RECORD_SCHEMA)


def test_compaction_beside_a_stream_of_several_batches(spark, tmp_dir, monkeypatch):
    import velotide.registry as R
    for k in range(8):  # two files a batch: four batches
        records(spark, [(10 * k + d, event(f"S{d}", d)) for d in (1, 2, 3)]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/kafka")
    monkeypatch.setattr(R, "landed_path", lambda *a: f"{tmp_dir}/kafka")
    rows = R.QUERIES["stream_compacted"](spark, tmp_dir)
    assert sorted(r.kafka_offset for r in rows.collect()) == sorted(10 * k + d for k in range(8) for d in (1, 2, 3))
    assert any(".merged" in f for f in rows.inputFiles())


def test_a_status_value_is_parsed_once(spark):
    df = SS.structural_filter(SS.parse_status(records(spark, [(1, event("S1", 1)), (2, "{broken"), (3, event(" ", 1)), (4, "null"), (5, "[]")])))
    assert [r.kafka_offset for r in df.collect()] == [1]
    assert plan(df).count("from_json") == 1


def test_codes_and_stations_of_one_name_are_not_paired(spark, monkeypatch):
    n, paired, unique = 20, [], I._unique
    src = spark.createDataFrame([(f"X{k}", "Twin St & 1 Ave", 40.0, -74.0, None, "1 ave & twin st") for k in range(n)] + [("Y", "Own St", 41.0, -74.0, None, "own st")],
                                "source_station_code string, source_station_name string, source_latitude double, source_longitude double, "
                                "source_station_code_numeric decimal(38,9), canonical_name string")
    ref = spark.createDataFrame([(f"S{k}", f"{k}.01", 40.0, -74.0, "1 ave & twin st") for k in range(n)] + [("T", "t", 41.0, -74.0, "own st"), ("U", None, 41.0, -74.0, None)],
                                "station_key string, short_name string, latitude double, longitude double, canonical_name string")
    monkeypatch.setattr(I, "_unique", lambda c, *a: (paired.append(c.count()), unique(c, *a))[1])
    assert [tuple(r) for r in I.match_geo(src, ref).collect()] == [("Y", "T", I.GEO)]
    assert paired == [n + 1]


def test_partitions_are_written_without_a_sort(spark, tmp_dir):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, df = spark.conf.get(key), spark.range(0, 1000, 1, 3).withColumn("part", F.col("id") % 7)
    with open_writers(spark, 2):  # fewer than there are values
        assert spark.conf.get(key) == "2"
        df.write.partitionBy("part").parquet(f"{tmp_dir}/t")
    assert spark.conf.get(key) == before
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/t").select("id", "part").collect())) == [(i, i % 7) for i in range(1000)]


def test_gzip_trip_files_are_found_and_read(spark, tmp_dir):
    row = ("R1", "classic_bike", T, T + dt.timedelta(minutes=5), 'A "x", St', "1", "B", "2", 40.0, -74.0, 40.1, -74.1, "member")
    df = spark.createDataFrame([row], ingest.schemas.TRIP_CSV)
    for name, how in (("a", "gzip"), ("b", "none")):
        ingest.write_trip_csv(df, f"{tmp_dir}/{name}/source_month=2024-01", how)
        paths = ingest.batch_paths(spark, f"{tmp_dir}/{name}", "2024-01-01")
        assert paths and all(p.endswith(".gz") == (how == "gzip") for p in paths)
        assert [tuple(r)[:13] for r in ingest.read_trip_csv(spark, paths, "2024-01-01").collect()] == [row]


def test_a_feed_batch_of_one_file_is_dealt_to_all_cores(spark, tmp_dir):
    from velotide.streaming.feed_stream import RESPONSE_SCHEMA, write_feed_batch
    station = json.dumps({"station_id": "S1", **{c: 1 for c in SS.REQUIRED}})
    body = '{"last_updated": 1, "ttl": 60, "data": {"stations": [' + station + ']}}'
    rows = [(f"feed://{k}", 200, body, T) for k in range(60)] + [("feed://0", 200, body, T), ("feed://x", 200, None, T), (None, 200, body, None)]
    batch = spark.createDataFrame(rows, RESPONSE_SCHEMA).coalesce(1)
    write_feed_batch(tmp_dir)(batch, 0)
    events = spark.read.parquet(f"{tmp_dir}/events")
    assert events.count() == 62 and spark.read.parquet(f"{tmp_dir}/dlq").count() == 1
    assert len(events.inputFiles()) > 1 or spark.sparkContext.defaultParallelism == 1


def test_the_version_is_added_after_the_shuffle(spark, tmp_dir):
    from velotide.operators.versions import VERSION, VersionedTable
    table = VersionedTable(spark, f"{tmp_dir}/t", "day", ["part"])
    table.replace(spark.range(20).selectExpr("id", "'2024-01-0' || (id % 3) AS day", "id % 2 AS part"), sort_by=["id"])
    assert table.read().count() == 20 and VERSION not in table.read().columns
    table.replace(spark.range(5).selectExpr("id", "'2024-01-01' AS day", "id AS part"), ["2024-01-01"])
    assert table.read().filter("day = '2024-01-01'").count() == 5
