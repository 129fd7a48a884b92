"""Commit log of the stream, identity changes in stored trips."""

import datetime as dt

from pyspark.sql import functions as F

from velotide.operators.versions import VersionedTable
from velotide.plans.rekey import apply_identity, changed_codes
from velotide.streaming import status_stream as SS
from velotide.streaming.commits import StreamTable


def batch(spark, rows):
    cols = [f"{c} string" if c in ("station_id", "snapshot_id", "poll_time", "kafka_topic") else f"{c} timestamp" if c == "kafka_timestamp" else f"{c} long"
            for c in SS.RAW_STATUS_COLS if c != "ingested_at"]
    names = [c.split()[0] for c in cols]
    return spark.createDataFrame([tuple({"station_id": s, "poll_time": f"2024-01-0{d}T10:00:00+00:00", "kafka_offset": o}.get(n) for n in names) for s, d, o in rows], ", ".join(cols))


def offsets(out):
    return sorted(r.kafka_offset for r in out.read().collect())


def test_compaction_stopped_at_every_step_and_beside_the_stream(spark, tmp_dir):
    out = StreamTable(spark, f"{tmp_dir}/s")
    write = out.write_batch("2024-02-01 00:00:00")
    for b in range(3):
        write(batch(spark, [("A", 1, 10 * b), ("B", 2, 10 * b + 1)]), b)
    write(batch(spark, [("A", 1, 20), ("B", 2, 21)]), 2)  # replayed
    all_rows = [0, 1, 10, 11, 20, 21]
    assert offsets(out) == all_rows
    slots = out.small_slots("2024-01-03")
    assert slots == {"2024-01-01": ["2024-01-01.0", "2024-01-01.1"], "2024-01-02": ["2024-01-02.0", "2024-01-02.1"]}
    out.merge("2024-01-01", slots["2024-01-01"])  # written, not published
    assert offsets(out) == all_rows
    version = out.merge("2024-01-01", slots["2024-01-01"])
    write(batch(spark, [("C", 1, 30)]), 3)  # a late batch of the day comes in between
    out._publish(version, out.table.read().schema, {*slots["2024-01-01"], "2024-01-01.merged"}.__contains__)
    assert offsets(out) == [*all_rows, 30]
    assert out.compact("2024-01-02") == ["2024-01-01"] and offsets(out) == [*all_rows, 30]
    assert sorted(out.table.live()) == ["2024-01-01.3", "2024-01-01.merged", "2024-01-02.0", "2024-01-02.1", "2024-01-02.2"]


def test_identity_change_rewrites_only_batches_with_a_changed_code(spark, tmp_dir):
    ident = lambda rows: spark.createDataFrame(rows, "source_station_code string, station_key string, mapping_status string")
    old = ident([("1", "S1", "MATCHED"), ("2", None, "UNRESOLVED"), ("3", "S3", "MATCHED")])
    new = ident([("1", "S1", "MATCHED"), ("2", "S2", "MATCHED"), ("4", None, "UNRESOLVED"), ("3", "S3", "MATCHED")])
    assert sorted(r[0] for r in changed_codes(old, new).collect()) == ["2", "4"]
    months = [dt.date(2024, m, 1) for m in (1, 2, 3)]
    rows = [(f"R{k}", months[k % 3], "2" if k % 3 == 1 else "1") for k in range(9)]
    stg = spark.createDataFrame(rows, "ride_id string, source_month date, start_station_id string").select(
        "ride_id", F.lit("classic_bike").alias("rideable_type"), F.expr("timestamp_ntz'2024-01-05 10:00:00'").alias("started_at"),
        F.expr("timestamp_ntz'2024-01-05 10:20:00'").alias("ended_at"), "start_station_id", F.lit("3").alias("end_station_id"),
        *[F.lit(1.0).alias(c) for c in ("start_latitude", "start_longitude", "end_latitude", "end_longitude")],
        F.lit("member").alias("member_casual"), "source_month", F.lit("b").alias("batch_id"))
    variants = stg.select(F.explode(F.array("start_station_id", "end_station_id")).alias("source_station_code"), "source_month").distinct()
    from velotide.plans import trips
    history, fact = (VersionedTable(spark, f"{tmp_dir}/{t}", "source_month", ["start_date"]) for t in "hf")
    history.replace(trips.trip_history(stg, old, broadcast_identity=False))
    fact.replace(trips.fct_trip(history.read()))
    before = fact.live()
    assert apply_identity(stg, variants, old, new, history, fact) == [months[1]]
    assert {m for m, v in fact.live().items() if before[m] != v} == {"2024-02-01"}
    want = {(r.ride_id, r.start_station_key) for r in trips.trip_history(stg, new, broadcast_identity=False).collect()}
    assert {(r.ride_id, r.start_station_key) for r in fact.read().collect()} == want
    assert apply_identity(stg, variants, new, new, history, fact) == []


def staged_trips(spark, rows):
    """(ride_id, month, start code, started_at or None) as staged."""
    return spark.createDataFrame(rows, "ride_id string, source_month date, start_station_id string, at string").select(
        "ride_id", F.lit("classic_bike").alias("rideable_type"), F.col("at").cast("timestamp_ntz").alias("started_at"),
        F.expr("timestamp_ntz'2024-01-09 10:20:00'").alias("ended_at"), "start_station_id", F.lit(None).cast("string").alias("end_station_id"),
        *[F.lit(1.0).alias(c) for c in ("start_latitude", "start_longitude", "end_latitude", "end_longitude")],
        F.lit("member").alias("member_casual"), "source_month", F.lit("b").alias("batch_id"))


def test_identity_change_moves_trips_once_as_staged_and_reads_stored_ones(spark, tmp_dir, monkeypatch):
    from velotide.plans import rekey, trips
    ident = lambda rows: spark.createDataFrame(rows, "source_station_code string, station_key string, mapping_status string")
    old, new = ident([("1", "S1", "MATCHED"), ("2", None, "UNRESOLVED")]), ident([("1", "S1", "MATCHED"), ("2", "S2", "MATCHED")])
    month = dt.date(2024, 1, 1)
    rows = [(f"R{k % 9}", month, [None, "1", "2"][k % 3], None if k % 5 == 0 else f"2024-01-0{1 + k % 8} 10:00:00") for k in range(40)]
    stg, more = staged_trips(spark, rows), staged_trips(spark, [*rows, ("new", month, "2", "2024-01-01 10:00:00")])
    variants = spark.createDataFrame([("2", month)], "source_station_code string, source_month date")
    plans, stage = [], VersionedTable.stage
    monkeypatch.setattr(VersionedTable, "stage", lambda self, df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stage(self, df, *a))

    def stored(table):
        return sorted(map(str, table.read().collect()))

    def wanted(staged, identity):
        return [sorted(map(str, df.collect())) for h in [trips.trip_history(staged, identity, broadcast_identity=False)] for df in (h, trips.fct_trip(h))]

    for most in (rekey.BROADCAST_ROWS, 1):  # the identity broadcast, or joined as the planner likes
        history, fact = (VersionedTable(spark, f"{tmp_dir}/{t}{most}", "source_month", ["start_date"], codec="zstd") for t in "hf")
        rekey.write_history(stg, old, history, most=most)
        rekey.write_fact(history, fact)
        assert [stored(history), stored(fact)] == wanted(stg, old)
    first, by_day = plans[0], lambda p: p.count("RebalancePartitions")
    below = first[first.index("RebalancePartitions"):]
    assert by_day(first) == 1 and "rejection_reasons" not in below and "Join" not in below  # moved as staged
    assert by_day(plans[1]) == by_day(plans[3]) == 0
    plans.clear()
    assert apply_identity(stg, variants, old, new, history, fact) == [month]
    assert [stored(history), stored(fact)] == wanted(stg, new)
    assert [by_day(p) for p in plans] == [0, 0]  # the stored rows, where they lie
    assert apply_identity(more, variants, new, old, history, fact) == [month]  # staged anew since: not the stored rows
    assert [stored(history), stored(fact)] == wanted(more, old)
    assert not rekey.same_trips(staged_trips(spark, [("a", month, None, None)]), staged_trips(spark, [(None, month, "a", None)]))
