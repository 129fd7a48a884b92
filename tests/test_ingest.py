"""Strict landing: CSV and JSON failure cases, batch and day replacement."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velotide.operators.versions import read_table
from velotide.sources import ingest

HEADER = ("ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,"
          "end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual")


def row(rid, start="2024-01-31 10:00:00", end="2024-01-31 10:05:00"):
    return f"{rid},classic_bike,{start},{end},A,1.01,B,2.01,40.5,-74.0,40.6,-74.1,member"


def write(path, text, bom=False):
    with open(path, "wb") as f:
        f.write((b"\xef\xbb\xbf" if bom else b"") + text.encode("utf-8"))
    return path


def test_bom_and_provenance(spark, tmp_dir):
    p = write(f"{tmp_dir}/a.csv", HEADER + "\n" + row("R1") + "\n", bom=True)
    r = ingest.read_trip_csv(spark, p, "2024-01-15").first()
    assert r["ride_id"] == "R1" and r["source_month"] == dt.date(2024, 1, 1)
    assert r["batch_id"] == "trip_history_2024-01"


@pytest.mark.parametrize("body", [
    HEADER + ",extra\n" + row("R1") + ",x\n",                        # extra column
    HEADER.replace("started_at,", "") + "\n" + row("R1").replace("2024-01-31 10:00:00,", "") + "\n",  # no start column
    HEADER + "\n" + row("R1", start="") + "\n",                      # blank start
    HEADER + "\n" + row("R1", start="yesterday") + "\n",             # unparsable start
    HEADER + "\n" + row('"R\n1"') + "\n",                            # quoted newline
])
def test_strict_csv_fails(spark, tmp_dir, body):
    p = write(f"{tmp_dir}/bad.csv", body)
    with pytest.raises(Exception):
        ingest.read_trip_csv(spark, p, "2024-01-01").collect()


def test_batches_sharing_a_day(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    import os
    os.makedirs(f"{land}/source_month=2024-01")
    os.makedirs(f"{land}/source_month=2024-02")
    write(f"{land}/source_month=2024-01/a.csv", HEADER + "\n" + row("J1") + "\n" + row("J2", "2024-01-30 10:00:00") + "\n")
    write(f"{land}/source_month=2024-01/b.csv", HEADER + "\n" + row("J3") + "\n")
    write(f"{land}/source_month=2024-02/a.csv", HEADER + "\n" + row("F1") + "\n" + row("F2", "2024-02-01 09:00:00") + "\n")
    assert len(ingest.batch_paths(spark, land, "2024-01-01")) == 2
    with pytest.raises(FileNotFoundError):
        ingest.batch_paths(spark, land, "2024-03-01")
    for compat in (None, "last_batch_wins"):
        raw = f"{tmp_dir}/raw-{compat}"
        for m in ("2024-01-01", "2024-02-01", "2024-01-01"):   # January is re-run
            df = ingest.read_trip_csv(spark, ingest.batch_paths(spark, land, m), m)
            ingest.land_trip_batch(df, raw, m, compat=compat)
        ids = sorted(r[0] for r in ingest.read_landed_trips(spark, raw, compat).select("ride_id").collect())
        if compat is None:
            assert ids == ["F1", "F2", "J1", "J2", "J3"]        # no batch erases another
        else:
            assert ids == ["F2", "J1", "J2", "J3"]              # the last load of 31 Jan wins


def test_latest_batch(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1),), (dt.date(2024, 1, 1),)], "source_month date")
    assert ingest.latest_batch(df) == dt.date(2024, 2, 1)
    with pytest.raises(ValueError):
        ingest.latest_batch(df.filter(F.lit(False)))


def test_station_feed_and_ndjson(spark, tmp_dir):
    doc = ('{"last_updated": 1, "ttl": 5, "data": {"stations": [{"station_id": "S1", "name": "A & B", '
           '"short_name": "1.01", "lat": 40.5, "lon": -74.0, "capacity": 9, "has_kiosk": true}]}}')
    p = write(f"{tmp_dir}/feed.json", doc)
    df = ingest.read_station_feed(spark, p, "2024-01-02")
    r = df.first()
    assert r["station_id"] == "S1" and r["batch_id"] == "station_information_2024-01-02"
    empty = write(f"{tmp_dir}/empty.json", '{"last_updated": 1, "ttl": 5, "data": {"stations": []}}')
    with pytest.raises(Exception):
        ingest.read_station_feed(spark, empty, "2024-01-02").collect()
    target = ingest.land_station_snapshot(df, f"{tmp_dir}/raw")
    assert read_table(spark, target).count() == 1
    ok = write(f"{tmp_dir}/ok.ndjson", '{"station_id": "S1", "snapshot_date": "2024-01-01", "batch_id": "b"}\n')
    assert ingest.read_station_ndjson(spark, ok).count() == 1
    bad = write(f"{tmp_dir}/bad.ndjson", '{"station_id": "S1", "surprise": 1, "snapshot_date": "2024-01-01", "batch_id": "b"}\n')
    with pytest.raises(Exception):
        ingest.read_station_ndjson(spark, bad).collect()


def test_quoted_names_and_millis(spark, tmp_dir):
    body = (HEADER + "\n"
            + 'R1,classic_bike,2024-01-31 10:00:00.123,2024-01-31 10:05:00,"Broadway, W 60 St",1.01,B,2.01,40.5,-74.0,40.6,-74.1,member\n'
            + 'R2,classic_bike,2024-01-31 11:00:00,2024-01-31 11:05:00.5,"A ""Plaza""",1.01,B,2.01,40.5,-74.0,40.6,-74.1,casual\n')
    rows = {r["ride_id"]: r for r in ingest.read_trip_csv(spark, write(f"{tmp_dir}/q.csv", body), "2024-01-01").collect()}
    assert rows["R1"]["start_station_name"] == "Broadway, W 60 St"
    assert rows["R1"]["started_at"] == dt.datetime(2024, 1, 31, 10, 0, 0, 123000)
    assert rows["R2"]["start_station_name"] == 'A "Plaza"'
    assert rows["R2"]["ended_at"] == dt.datetime(2024, 1, 31, 11, 5, 0, 500000)


def test_station_feed_nested_fields(spark, tmp_dir):
    doc = ('{"last_updated": 1, "ttl": 5, "data": {"stations": [{"station_id": "S1", "name": "A", "short_name": "1.01", '
           '"region_id": 71, "lat": 40.5, "lon": -74.0, "capacity": 9, "rental_uris": {"ios": "x://a"}, '
           '"rental_methods": ["KEY", "CREDITCARD"], "eightd_station_services": [{"id": "e1"}], '
           '"has_kiosk": true, "electric_bike_surcharge_waiver": false, "external_id": "ext"}]}}')
    r = ingest.read_station_feed(spark, write(f"{tmp_dir}/f.json", doc), "2024-01-02").first()
    assert r["region_id"] == "71"
    assert '"ios"' in r["rental_uris"] and r["rental_methods"] == ["KEY", "CREDITCARD"]
    assert '"e1"' in r["eightd_station_services"]


def test_rerun_drops_vanished_days(spark, tmp_dir):
    import os
    land, raw = f"{tmp_dir}/landing", f"{tmp_dir}/raw"
    os.makedirs(f"{land}/source_month=2024-01")
    p = write(f"{land}/source_month=2024-01/a.csv",
              HEADER + "\n" + row("J1") + "\n" + row("J2", "2024-01-30 10:00:00") + "\n")
    df = ingest.read_trip_csv(spark, ingest.batch_paths(spark, land, "2024-01-01"), "2024-01-01")
    ingest.land_trip_batch(df, raw, "2024-01-01")
    write(p, HEADER + "\n" + row("J1") + "\n")          # the corrected file no longer has 30 January
    df = ingest.read_trip_csv(spark, ingest.batch_paths(spark, land, "2024-01-01"), "2024-01-01")
    ingest.land_trip_batch(df, raw, "2024-01-01")
    landed = ingest.read_landed_trips(spark, raw)
    assert [r["ride_id"] for r in landed.collect()] == ["J1"]
    assert sorted(r["day"] for r in read_table(spark, f"{raw}/trip_history").select("day").distinct().collect()) == [31]
