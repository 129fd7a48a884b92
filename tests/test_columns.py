"""Hand-made cases for the column helpers (minutes, names, codes, trim)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from velotide.functions.columns import (canonical_name, code_to_decimal, date_key, haversine_m, minute_diff,
                                        row_md5, second_diff, trim_ws)


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_minute_boundaries(spark):
    ts = dt.datetime
    rows = [(ts(2024, 1, 1, 12, 0, 59), ts(2024, 1, 1, 12, 1, 0)),
            (ts(2024, 1, 1, 12, 0, 0), ts(2024, 1, 1, 12, 0, 59)),
            (ts(2024, 1, 1, 23, 59, 30), ts(2024, 1, 2, 0, 0, 10)),
            (ts(2024, 1, 1, 12, 0, 0), None)]
    out = one(spark, minute_diff("e", "s"), rows, "s timestamp_ntz, e timestamp_ntz")
    assert out == [1, 0, 1, None]
    secs = one(spark, second_diff("e", "s"), rows, "s timestamp_ntz, e timestamp_ntz")
    assert secs == [1, 59, 40, None]


def test_minute_diff_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(dt.datetime(2024, 3, 10, 1, 59, 0), dt.datetime(2024, 3, 10, 3, 1, 0))]  # DST gap in New York
        assert one(spark, minute_diff("e", "s"), rows, "s timestamp_ntz, e timestamp_ntz") == [62]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_trim_unicode_whitespace(spark):
    rows = [("\t a b ",), ("　x ",), ("  ",), (None,)]
    assert one(spark, trim_ws("s"), rows, "s string") == ["a b", "x", "", None]


def test_canonical_name(spark):
    rows = [("W 21 St & 6 Ave",), ("6 Ave & W 21 St",), ("6 Ave & W 21 St (temp)",), ("A &",), ("",), (None,),
            ("\tB & a ",), ("(closed)",)]
    out = one(spark, canonical_name("s"), rows, "s string")
    assert out[0] == out[1] == out[2] == "6 ave & w 21 st"
    assert out[3] == "a"
    assert out[4] == "" and out[5] == "" and out[7] == ""
    assert out[6] == "a & b"


def test_code_to_decimal(spark):
    rows = [("5329.03",), ("5329.030",), ("5329.03__",), ("JC115",), ("",), ("1e3",), (None,)]
    out = one(spark, code_to_decimal("s"), rows, "s string")
    assert out[0] == out[1] == out[2] == Decimal("5329.030000000")
    assert out[3] is None and out[4] is None and out[6] is None
    assert out[5] == Decimal("1000")


def test_haversine_and_keys(spark):
    rows = [(40.0, -74.0, 40.0009, -74.0, dt.date(2024, 2, 9))]
    d = spark.createDataFrame(rows, "a double, b double, c double, d double, x date").select(
        haversine_m("a", "b", "c", "d").alias("m"), date_key("x").alias("k"), row_md5(F.lit(None), "a").alias("h")).first()
    assert abs(d["m"] - 100.08) < 0.05
    assert d["k"] == 20240209
    assert len(d["h"]) == 32


def test_run_instant_zones(spark):
    from velotide.functions.columns import snapshot_date_of_run, source_month_of_run
    rows = [(dt.datetime(2024, 1, 31, 18, 0),), (dt.datetime(2024, 1, 1, 3, 30),)]
    out = spark.createDataFrame(rows, "t timestamp").select(source_month_of_run("t"), snapshot_date_of_run("t")).collect()
    assert [tuple(r) for r in out] == [(dt.date(2024, 2, 1), dt.date(2024, 1, 31)), (dt.date(2024, 1, 1), dt.date(2023, 12, 31))]


def test_cluster_conf_scales_with_input():
    from velotide.session import cluster_conf
    big = cluster_conf(100 * 2 ** 40, total_cores=8000)          # 100 TB on 1000 executors x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(10 * 2 ** 20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
