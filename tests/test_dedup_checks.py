"""Dedup (null coordinates, ties, idempotence), checks and the run log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velotide.operators.checks import (CheckFailed, accepted, assert_checks, grain, not_null, relationship,
                                       run_checks, unique)
from velotide.operators.dedup import first_by, latest_by
from velotide.plans.runlog import FAILED, SUCCESS, RunLogger, attempt_summary, log_rows
from velotide.plans.status import dedup_logical, dedup_technical

T = dt.datetime(2024, 1, 1, 0, 0)
SCHEMA = ("station_id string, snapshot_id string, poll_time timestamp, kafka_topic string, kafka_partition long, "
          "kafka_offset long, kafka_timestamp timestamp, ingested_at timestamp, num_bikes_available long")


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_null_kafka_coordinates_collapse(spark):
    h = dt.timedelta(hours=1)
    df = rows(spark, [("S1", "a", T, None, None, None, T, T + h, 1), ("S2", "b", T, None, None, None, T, T, 2),
                      ("S3", "c", T, "t", 0, 5, T, T, 3), ("S3", "c", T, "t", 0, 5, T, T + h, 3)])
    out = dedup_technical(df).collect()
    assert len(out) == 2
    assert {r["station_id"] for r in out} == {"S2", "S3"}
    assert [r["ingested_at"] for r in out if r["station_id"] == "S3"] == [T]


def test_logical_dedup_order_and_ties(spark):
    m = dt.timedelta(minutes=1)
    df = rows(spark, [("S1", "a", T + m, "t", 0, 1, T, T, 1), ("S1", "a", T, "t", 0, 2, T + m, T, 2),
                      ("S1", "a", T, "t", 0, 3, T, T, 3), ("S1", "a", T, "t", 0, 4, T, T, 4),
                      (None, None, T, "t", 1, 5, T, T, 5), (None, None, T + m, "t", 1, 6, T, T, 6)])
    out = sorted(dedup_logical(df).collect(), key=lambda r: r["kafka_offset"])
    # earliest poll, then Kafka time, then ingestion; exact ties -> smallest other columns
    assert [r["kafka_offset"] for r in out] == [3, 5]
    again = dedup_logical(dedup_logical(df)).collect()
    assert sorted(r["kafka_offset"] for r in again) == [3, 5]


def test_latest_by_keeps_null_key(spark):
    df = spark.createDataFrame([("S1", 1), ("S1", 2), (None, 1), (None, 3)], "k string, v long")
    out = sorted((r["k"] or "", r["v"]) for r in latest_by(df, ["k"], "v").collect())
    assert out == [("", 3), ("S1", 2)]


def test_first_by_hot_key_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = first_by(df, ["k"], ["-id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_checks_report(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    child = spark.createDataFrame([(1, "a", "x"), (3, "b", "x"), (None, "b", None), (2, None, "y")],
                                  "k long, c string, s string")
    report = run_checks({"p": parent, "c": child}, [
        not_null("c", "k"), not_null("c", "c"), unique("c", "c"), accepted("c", "s", ("x",)),
        relationship("c", "k", "p", "k"), grain("c", ("s",))])
    got = {(r["column"], r["check"]): r["failures"] for r in report.collect()}
    assert got == {("k", "not_null"): 1, ("c", "not_null"): 1, ("c", "unique"): 1, ("s", "accepted_values"): 1,
                   ("k", "relationships"): 1, ("s", "grain"): 1}
    with pytest.raises(CheckFailed):
        assert_checks(report, "error")
    assert len(assert_checks(report, "warn")) == 6


def test_run_log(spark, tmp_dir):
    log = RunLogger(spark, f"{tmp_dir}/log", "run1", "daily", "b1")
    log.task("t1", lambda: 1)
    with pytest.raises(ZeroDivisionError):
        log.task("t2", lambda: 1 / 0)
    log.task("t2", lambda: 2, try_number=2)
    s = {r["task_id"]: r for r in attempt_summary(spark.read.parquet(f"{tmp_dir}/log")).collect()}
    assert s["t1"]["attempts"] == 1 and s["t1"]["last_status"] == SUCCESS
    assert s["t2"]["attempts"] == 2 and s["t2"]["last_status"] == SUCCESS and s["t2"]["last_try"] == 2
    first = log_rows(spark, [dict(run_id="r", task_id="x", try_number=1, status=FAILED, error_message="boom")])
    assert attempt_summary(first).first()["last_error"] == "boom"


def test_run_log_keeps_whole_errors_and_true_attempts(spark, tmp_dir):
    def fail():
        raise ValueError("e" * 5000)

    for n in (1, 2):
        log = RunLogger(spark, f"{tmp_dir}/log", "run", "dag", "batch")
        with pytest.raises(ValueError):
            log.task("t", fail)
        rows = spark.read.parquet(f"{tmp_dir}/log").orderBy("try_number").collect()
        assert [r.try_number for r in rows] == list(range(1, n + 1))
        assert all(r.error_message == "e" * 5000 and r.batch_id == "batch" for r in rows)
