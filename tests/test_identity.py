"""Station identity on hand-made stations and trips (traps T11-T14, T25) and
the status rules row by row (Q2, T19)."""

import datetime as dt

from pyspark.sql import functions as F

from velotide.functions.rules import STATUS_RULES, passes, reason_codes, rejections
from velotide.plans.dims import dim_station
from velotide.plans.identity import station_identity

ST = ("station_id string, station_name string, short_name string, region_id string, latitude double, "
      "longitude double, capacity long, station_type string, snapshot_date date, batch_id string")
TR = ("start_station_id string, start_station_name string, start_latitude double, start_longitude double, "
      "end_station_id string, end_station_name string, end_latitude double, end_longitude double")
D = dt.date(2024, 1, 1)


def stations(spark, rows):
    return spark.createDataFrame([(sid, name, short, "1", lat, lon, 10, "classic", D, "b")
                                  for sid, name, short, lat, lon in rows], ST)


def trips(spark, rows):
    # each row: (code, name, lat, lon) as the start; the end is a code nobody knows
    return spark.createDataFrame([(c, n, la, lo, "ZZ", "Nowhere", None, None) for c, n, la, lo in rows], TR)


def resolve(spark, st_rows, trip_rows):
    ident = station_identity(trips(spark, trip_rows), stations(spark, st_rows), materialize=False)
    return {r["source_station_code"]: (r["station_key"], r["mapping_method"], r["mapping_status"], r["trip_rows"])
            for r in ident.collect()}


def test_cascade_and_fallthrough(spark):
    st_rows = [("S1", "A St & 1 Ave", "100.01", 40.0, -74.0),
               ("S2", "B St & 2 Ave", "200.01", 40.1, -74.1),
               ("S3", "B St & 3 Ave", "200.01", 40.2, -74.2),      # short name shared by S2 and S3 (T13)
               ("S4", "C St & 3 Ave", "300.01", 40.3, -74.3),
               ("S5", "C St & 3 Ave", "999", 41.3, -75.3),          # same name far away (T12)
               ("S6", "D St", "400.01", None, None)]                # no coordinates (T11)
    trip_rows = [("100.01", "A St & 1 Ave", 40.0, -74.0),           # exact
                 ("100.010__", "x", 40.0, -74.0),                   # numeric
                 ("200.01", "2 Ave & B St (temp)", 40.1, -74.1),    # exact ambiguous -> numeric ambiguous -> geo
                 ("X9", "3 Ave & C St", 40.3, -74.3),               # geo ambiguous before distance (T12)
                 ("X7", "A St & 1 Ave", 40.01, -74.0),              # same name, 1.1 km away
                 ("400.01", "D St", 0.0, 0.0),                      # reference has no coordinates
                 ("X8", "A St & 1 Ave", 95.0, -74.0)]               # latitude outside the globe (T25)
    got = resolve(spark, st_rows, trip_rows)
    assert got["100.01"][:2] == ("S1", "EXACT_SHORT_NAME")
    assert got["100.010__"][:2] == ("S1", "NUMERIC_SHORT_NAME")
    assert got["200.01"][:2] == ("S2", "NAME_COORDINATE")
    assert got["X9"][2] == "UNRESOLVED"
    assert got["X7"][2] == "UNRESOLVED"
    assert got["400.01"][2] == "UNRESOLVED"
    assert got["X8"][2] == "UNRESOLVED"


def test_dominant_variant_counts(spark):
    # T14: trip_rows is that of the most used variant, not the code's total
    rows = [("C1", "Main St", 40.0, -74.0)] * 3 + [("C1", "Main Street", 40.0, -74.0)] * 2
    got = resolve(spark, [("S1", "Main St", "C1", 40.0, -74.0)], rows)
    assert got["C1"] == ("S1", "EXACT_SHORT_NAME", "MATCHED", 3)


def test_dim_station_keeps_what_identity_ignores(spark):
    st = stations(spark, [("S6", "D St", "400.01", None, None), (None, "E St", "500.01", 40.0, -74.0)])
    keys = sorted((r["station_key"] or "") for r in dim_station(st).collect())
    assert keys == ["", "S6"]


STATUS = ("station_id string, snapshot_id string, num_bikes_available long, num_docks_available long, "
          "is_installed long, is_renting long, is_returning long")


def test_each_status_rule(spark):
    good = ("S1", "p", 3, 4, 1, 1, 1)
    cases = {
        "INVALID_STATION_ID": (None,) + good[1:],
        "INVALID_SNAPSHOT_ID": good[:1] + (None,) + good[2:],
        "MISSING_BIKES_AVAILABLE": good[:2] + (None,) + good[3:],
        "NEGATIVE_BIKES_AVAILABLE": good[:2] + (-1,) + good[3:],
        "MISSING_DOCKS_AVAILABLE": good[:3] + (None,) + good[4:],
        "NEGATIVE_DOCKS_AVAILABLE": good[:3] + (-2,) + good[4:],
        "INVALID_IS_INSTALLED": good[:4] + (2,) + good[5:],
        "INVALID_IS_RENTING": good[:5] + (3,) + good[6:],
        "INVALID_IS_RETURNING": good[:6] + (5,),
    }
    blank = ("  ",) + good[1:]          # T19: blank ids pass the batch rules
    unknown_flags = good[:4] + (None, None, None)
    df = spark.createDataFrame([good, blank, unknown_flags] + list(cases.values()), STATUS)
    out = [(r[0], r[1]) for r in df.select(reason_codes(rejections(STATUS_RULES)), passes(STATUS_RULES)).collect()]
    assert out[:3] == [("", True)] * 3
    assert out[3:] == [(c, False) for c in cases]
