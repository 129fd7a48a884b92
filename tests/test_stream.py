"""Status stream over a file source: malformed and replayed messages,
idempotent batches, restart from the checkpoint."""

import datetime as dt
import json

from pyspark.sql import functions as F

from velotide.streaming.status_stream import KAFKA_RECORD_SCHEMA, start_status_stream, status_stream

T = dt.datetime(2024, 1, 1, 12, 0)


def event(sid, **kw):
    e = {"station_id": sid, "num_bikes_available": 3, "num_bikes_disabled": 0, "num_docks_available": 5,
         "num_docks_disabled": 0, "is_installed": 1, "is_renting": 1, "is_returning": 1, "last_reported": 1,
         "snapshot_id": "p1", "poll_time": "2024-01-01T12:00:00.000000+00:00", "feed_last_updated": 1, "feed_ttl": 60}
    e.update(kw)
    return json.dumps(e)


def write_records(spark, path, records):
    rows = [(None, v.encode(), "status.v1", 0, off, T) for off, v in records]
    spark.createDataFrame(rows, KAFKA_RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_restart_and_replay(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/raw", f"{tmp_dir}/ck"
    write_records(spark, src, [(1, event("S1")), (2, "{broken"), (3, event(" ")), (4, event("S2", last_reported=None)),
                               (5, event("S3", poll_time="not a time")), (1, event("S1"))])
    start_status_stream(status_stream(spark, "files", {"path": src}), out, ck, {"availableNow": True}).awaitTermination()
    first = spark.read.parquet(out)
    assert sorted(r["kafka_offset"] for r in first.collect()) == [1, 1, 5]     # replay kept, dedup is downstream
    assert first.filter("kafka_offset = 5").first()["poll_time"] is None
    assert first.filter("kafka_offset = 1").first()["poll_time"] == dt.datetime(2024, 1, 1, 12, 0)
    # restart: only the new file is processed
    write_records(spark, src, [(6, event("S4"))])
    start_status_stream(status_stream(spark, "files", {"path": src}), out, ck, {"availableNow": True}).awaitTermination()
    both = spark.read.parquet(out)
    assert sorted(r["kafka_offset"] for r in both.collect()) == [1, 1, 5, 6]
    assert both.select("batch_id").distinct().count() == 2
    assert both.filter(F.col("ingested_at").isNull()).count() == 0


def test_late_first_copies_are_kept(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/raw", f"{tmp_dir}/ck"
    for records in ([(1, event("S1"))], [(3, event("S3"))], [(2, event("S2"))]):
        write_records(spark, src, records)
        start_status_stream(status_stream(spark, "files", {"path": src}), out, ck, {"availableNow": True}).awaitTermination()
    assert sorted(r["kafka_offset"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_closed_days_are_compacted(spark, tmp_dir):
    from velotide.streaming.status_stream import compact_closed_days
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/raw", f"{tmp_dir}/ck"
    for k in (1, 2, 3):
        write_records(spark, src, [(k, event(f"S{k}"))])
        start_status_stream(status_stream(spark, "files", {"path": src}), out, ck, {"availableNow": True}).awaitTermination()
    before = spark.read.parquet(out)
    day = before.first().poll_day
    rows = sorted(map(str, before.drop("batch_id").collect()))
    assert compact_closed_days(spark, out, day) == []
    assert compact_closed_days(spark, out, day + dt.timedelta(days=1)) == [day]
    after = spark.read.parquet(out)
    assert sorted(map(str, after.select(*before.drop("batch_id").columns).collect())) == rows
    assert after.select("batch_id").distinct().count() == 1
    assert all(f"poll_day={day}/batch_id=" in f for f in after.inputFiles())
