"""Versioned tables: nothing is seen before it is published, covered values go, empty tables stay tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velotide.operators.versions import ConcurrentPublish, VersionedTable, open_table, read_table

SCHEMA = "day date, part string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, p, x) for d, p, x in rows], SCHEMA)


def rows(table):
    return sorted(((str(r.day), r.part, r.x) for r in table.read().collect()), key=str)


def test_stopped_run_leaves_the_old_rows(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", "day", ["part"])
    assert not t.exists() and open_table(spark, f"{tmp_dir}/t") is None
    t.replace(frame(spark, [("2024-01-01", "a", 1), ("2024-01-01", "b", 2), ("2024-01-02", "a", 3), (None, "a", 4)]))
    old = rows(t)
    version = t.stage(frame(spark, [("2024-01-01", "a", 9)]))   # and the run stops here
    assert rows(t) == old == [("2024-01-01", "a", 1), ("2024-01-01", "b", 2), ("2024-01-02", "a", 3), ("None", "a", 4)]
    t.publish(version, frame(spark, []).schema, ["2024-01-01"])
    assert rows(t) == [("2024-01-01", "a", 9), ("2024-01-02", "a", 3), ("None", "a", 4)]
    assert rows(open_table(spark, f"{tmp_dir}/t")) == rows(t)
    assert sorted((str(r.day), r.part, r.x) for r in t.read(0).collect()) == old  # an older manifest still reads


def test_covered_values_without_rows_go_and_empty_tables_read(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", "day")
    t.replace(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-01-03", "a", 3)]))
    t.replace(frame(spark, [("2024-01-03", "z", 9)]), lambda day: day >= "2024-01-02")
    assert rows(t) == [("2024-01-01", "a", 1), ("2024-01-03", "z", 9)]
    with pytest.raises(ValueError):
        t.replace(frame(spark, [("2024-01-01", "z", 9)]), ["2024-01-02"])
    assert rows(t) == [("2024-01-01", "a", 1), ("2024-01-03", "z", 9)]
    t.replace(frame(spark, []))
    assert t.exists() and rows(t) == [] and t.read().schema.simpleString() == frame(spark, []).schema.simpleString()
    assert read_table(spark, f"{tmp_dir}/t").count() == 0


def test_two_writers_do_not_both_publish(spark, tmp_dir, monkeypatch):
    t, u = (VersionedTable(spark, f"{tmp_dir}/t", "day") for _ in range(2))
    t.replace(frame(spark, [("2024-01-01", "a", 1)]))
    seen = u.manifest()
    t.replace(frame(spark, [("2024-01-02", "a", 2)]), ["2024-01-02"])
    monkeypatch.setattr(u, "manifest", lambda number=None: seen)
    with pytest.raises(ConcurrentPublish):
        u.replace(frame(spark, [("2024-01-03", "a", 3)]), ["2024-01-03"])
    assert rows(t) == [("2024-01-01", "a", 1), ("2024-01-02", "a", 2)]


def test_filters_prune_and_vacuum_keeps_what_is_live(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", "day", ["part"])
    t.replace(frame(spark, [("2024-01-01", "a", 1), ("2024-01-02", "a", 2)]), note={"seen": 1})
    t.replace(frame(spark, [("2024-01-02", "b", 3)]), "present")
    assert t.manifest()["note"] == {"seen": 1}
    plan = t.read().filter(F.col("day") == F.lit("2024-01-02").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert t.vacuum(keep=1) == 1 and t.vacuum(keep=1) == 0
    assert rows(t) == [("2024-01-01", "a", 1), ("2024-01-02", "b", 3)]
