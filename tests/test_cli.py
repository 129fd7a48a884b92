"""The command line end to end: land two monthly batches from CSV, then the
daily transform over the raw tables; the fact equals the in-memory model."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from velotide.operators.versions import read_table
from velotide.__main__ import main
from velotide.plans.models import Models
from velotide.sources import fixtures, ingest


def test_land_then_daily(spark, tmp_dir):
    trips = fixtures.raw_trips(spark, SF_SMALL).filter(F.col("started_at").isNotNull())
    for m in ("2024-01", "2024-02"):
        ingest.write_trip_csv(trips.filter(F.date_format("source_month", "yyyy-MM") == m),
                              f"{tmp_dir}/landing/source_month={m}")
        main(["land", "--landing", f"{tmp_dir}/landing", "--raw", f"{tmp_dir}/raw", "--month", m])
    ingest.land_station_snapshot(fixtures.raw_stations(spark, SF_SMALL), f"{tmp_dir}/raw")
    fixtures.raw_status(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw/station_status/batch_id=0")
    main(["daily", "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/out", "--calendar", "2024-01-01:2024-02-10",
          "--as-of", "2024-03-01 00:00:00", "--full-refresh"])
    got = read_table(spark, f"{tmp_dir}/out/fct_trip")
    ref = Models.from_fixtures(spark, SF_SMALL).fct_trip
    assert got.count() == ref.count()
    cols = ["ride_id", "start_station_key", "end_station_key", "duration_minutes", "start_date_key"]
    assert got.select(*cols).exceptAll(ref.select(*cols)).count() == 0

    from velotide.plans.jobs import register_views
    names = register_views(spark, f"{tmp_dir}/out")
    assert "fct_trip" in names and "agg_station_daily" in names
    n = spark.sql("SELECT count(*) FROM fct_trip f JOIN dim_date d ON f.start_date_key = d.date_key").first()[0]
    assert n > 0
    main(["sql", "--marts", f"{tmp_dir}/out", "SELECT count(*) AS n FROM agg_daily_trip_summary"])
