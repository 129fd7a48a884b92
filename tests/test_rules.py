"""Rule arrays: hand-made rows per rule and properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velotide.functions.rules import STATUS_RULES, TRIP_RULES, passes, reason_codes, rejections

TRIP_SCHEMA = ("ride_id string, started_at timestamp_ntz, ended_at timestamp_ntz, start_latitude double, "
               "start_longitude double, end_latitude double, end_longitude double, member_casual string")
T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
T1 = dt.datetime(2024, 1, 1, 12, 10, 0)


def codes(spark, rows, schema, rules):
    df = spark.createDataFrame(rows, schema)
    return [(r[0], r[1]) for r in df.select(reason_codes(rejections(rules)), passes(rules)).collect()]


def test_each_trip_rule(spark):
    good = ("R1", T0, T1, 40.7, -74.0, 40.8, -73.9, "member")
    cases = {
        "INVALID_RIDE_ID": (None,) + good[1:],
        "INVALID_START_TIME": good[:1] + (None,) + good[2:],
        "INVALID_END_TIME": good[:2] + (None,) + good[3:],
        "INVALID_DURATION": good[:1] + (T1, T0) + good[3:],
        "INVALID_START_LATITUDE": good[:3] + (95.0,) + good[4:],
        "INVALID_START_LONGITUDE": good[:4] + (-190.0,) + good[5:],
        "INVALID_END_LATITUDE": good[:5] + (-91.0,) + good[6:],
        "INVALID_END_LONGITUDE": good[:6] + (181.0,) + good[7:],
        "INVALID_RIDER_TYPE": good[:7] + ("guest",),
    }
    out = codes(spark, [good] + list(cases.values()), TRIP_SCHEMA, TRIP_RULES)
    assert out[0] == ("", True)
    for (code, _), got in zip(cases.items(), out[1:]):
        assert got == (code, False)


def test_null_rider_type_and_equal_times(spark):
    rows = [("R1", T0, T1, None, None, None, None, None), ("R2", T0, T0, None, None, None, None, "casual")]
    assert codes(spark, rows, TRIP_SCHEMA, TRIP_RULES) == [("", True), ("INVALID_DURATION", False)]


def test_reasons_keep_rule_order(spark):
    rows = [(None, None, None, 95.0, 200.0, None, None, "x")]
    assert codes(spark, rows, TRIP_SCHEMA, TRIP_RULES)[0][0] == (
        "INVALID_RIDE_ID,INVALID_START_TIME,INVALID_END_TIME,INVALID_START_LATITUDE,INVALID_START_LONGITUDE,"
        "INVALID_RIDER_TYPE")


STATUS_SCHEMA = ("station_id string, snapshot_id string, num_bikes_available long, num_docks_available long, "
                 "is_installed long, is_renting long, is_returning long")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["S1", " ", ""])),
                          st.one_of(st.none(), st.just("p")),
                          st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.integers(-1, 3)), st.one_of(st.none(), st.integers(-1, 3)),
                          st.one_of(st.none(), st.integers(-1, 3))), min_size=1, max_size=20))
def test_empty_reasons_iff_valid(spark, rows):
    df = spark.createDataFrame(rows, STATUS_SCHEMA)
    out = df.select(F.size(rejections(STATUS_RULES)).alias("n"), passes(STATUS_RULES).alias("ok")).collect()
    assert all((r["n"] == 0) == r["ok"] for r in out)
    # blank ids are valid in the batch rules (only the stream rejects them)
    assert all(r["ok"] is not None for r in out)
