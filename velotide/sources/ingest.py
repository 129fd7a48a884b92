"""Landing: monthly trip CSVs and daily station snapshots -> raw tables.

The reference splits a month's CSVs by day in one Python process and loads
the days one after another; here a month is one distributed job: read all
files of the month with the declared schema (strict: a bad row, an extra or
missing column, a quoted newline or a missing start time fails the batch),
add provenance, and write day partitions.  A hot day is split over several
writer tasks by AQE (REBALANCE) instead of landing in one.  Raw tables are
versioned: a batch or day is replaced in one step (``operators/versions.py``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from velotide import schemas
from velotide.functions.columns import as_month
from velotide.operators.versions import VersionedTable

# --- fixed values ------------------------------------------------------------
TRIP_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSS]"
TRIP_BATCH_PREFIX = "trip_history_"
STATION_BATCH_PREFIX = "station_information_"
# ----------------------------------------------------------------------------

CSV_OPTIONS = {
    "header": "true", "sep": ",", "mode": "FAILFAST", "enforceSchema": "false", "multiLine": "false",
    "encoding": "UTF-8", "timestampNTZFormat": TRIP_TIME_FORMAT,
    "quote": '"', "escape": '"',          # RFC 4180: an embedded quote is doubled
}


def trip_batch_name(source_month) -> str:
    """``trip_batch_id`` of a month given as text or date."""
    return f"{TRIP_BATCH_PREFIX}{as_month(source_month):%Y-%m}"


def trip_batch_id(source_month) -> F.Column:
    return F.lit(trip_batch_name(source_month))


def read_trip_csv(spark: SparkSession, paths, source_month, batch_id: str | None = None) -> DataFrame:
    """Rows of the month's CSV files plus ``source_month`` (day 1) and
    ``batch_id``.  Every row must have a start time: ``assert_true`` fails
    the job on the first row without one (a blank or unparsable value)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(schemas.TRIP_CSV).options(**CSV_OPTIONS).csv(paths)
    month = F.lit(as_month(source_month))
    bid = F.lit(batch_id) if batch_id else trip_batch_id(source_month)
    checked = F.when(F.assert_true(F.col("started_at").isNotNull(),
                                   F.lit("started_at is missing or unparsable")).isNull(), F.col("started_at"))
    return df.withColumn("started_at", checked).withColumn("source_month", month).withColumn("batch_id", bid)


def write_trip_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write trips as the source publishes them (used for fixtures)."""
    (df.select(*[f.name for f in schemas.TRIP_CSV.fields]).write.mode("overwrite")
     .option("header", "true").option("timestampNTZFormat", TRIP_TIME_FORMAT).option("escape", '"').option("compression", compression)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def batch_paths(spark: SparkSession, root: str, source_month: str) -> list[str]:
    """All CSV files of one month (``<root>/source_month=YYYY-MM/``), plain or gzip, sorted."""
    month = f"{as_month(source_month):%Y-%m}"
    try:
        files = spark.read.text(f"{root.rstrip('/')}/source_month={month}/*.{{csv,csv.gz}}").inputFiles()
    except AnalysisException:
        files = []
    if not files:
        raise FileNotFoundError(f"no trip files for {month} under {root}")
    return sorted(files)


def landed_trips(spark: SparkSession, root: str, compat: str | None = None) -> VersionedTable:
    """The raw trip table: replaced batch by batch, or, with
    ``compat='last_batch_wins'``, day by day."""
    if compat == "last_batch_wins":
        return VersionedTable(spark, f"{root.rstrip('/')}/trip_history_by_day", "start_day")
    return VersionedTable(spark, f"{root.rstrip('/')}/trip_history", "source_month", ["year", "month", "day"])


def land_trip_batch(df: DataFrame, root: str, source_month, compat: str | None = None) -> str:
    """Replace the whole batch in one step: the month's day partitions are written
    aside and published together (days that vanished from the batch vanish too; a
    load that fails leaves the old ones).  ``compat='last_batch_wins'`` instead
    replaces day partitions shared by all batches, so a later batch erases
    an earlier batch's rows of the same day, as the reference's loads do."""
    month = str(as_month(source_month))
    table = landed_trips(df.sparkSession, root, compat)
    # clustered within each day by batch and stations, as the raw table is
    clustering = ["batch_id", "start_station_id", "end_station_id"]
    if compat == "last_batch_wins":
        table.replace(df.withColumn("start_day", F.to_date("started_at")), "present", clustering)
    else:
        d = F.to_date("started_at")
        table.replace(df.withColumn("year", F.year(d)).withColumn("month", F.month(d)).withColumn("day", F.dayofmonth(d)), [month], clustering)
    return table.path


def read_landed_trips(spark: SparkSession, root: str, compat: str | None = None) -> DataFrame:
    return landed_trips(spark, root, compat).read().select(*[f.name for f in schemas.TRIP_RAW.fields])


def read_station_feed(spark: SparkSession, path, snapshot_date, batch_id: str | None = None,
                      multi_line: bool = True) -> DataFrame:
    """One row per element of ``data.stations`` of station_information
    responses (one JSON document per file, or one per line with
    ``multi_line=False``), with provenance.  An empty list fails."""
    doc = (spark.read.schema(schemas.STATION_FEED).option("multiLine", str(multi_line).lower())
           .option("mode", "FAILFAST").json(path))
    stations = F.when(F.assert_true(F.size("data.stations") > 0, F.lit("station list is empty")).isNull(),
                      F.col("data.stations"))
    snap = F.lit(snapshot_date).cast("date")
    bid = F.lit(batch_id) if batch_id else F.concat(F.lit(STATION_BATCH_PREFIX), F.date_format(snap, "yyyy-MM-dd"))
    return (doc.select(F.inline(stations)).withColumn("snapshot_date", snap).withColumn("batch_id", bid))


def read_station_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Strict NDJSON load in one pass: the raw table's schema, a malformed
    line fails, and a key the table does not know fails too (a JSON reader
    would silently ignore it)."""
    allowed = F.array(*[F.lit(f.name) for f in schemas.STATION_RAW.fields])
    unknown = F.array_except(F.json_object_keys(F.col("value")), allowed)
    known = F.assert_true(F.size(unknown) == 0, F.concat(F.lit("unknown fields: "), F.array_join(unknown, ",")))
    row = F.when(known.isNull(), F.from_json(F.col("value"), schemas.STATION_RAW, {"mode": "FAILFAST"}))
    return spark.read.text(path).select(row.alias("r")).select("r.*")


def landed_stations(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, f"{root.rstrip('/')}/station_information", "snapshot_date")


def land_station_snapshot(df: DataFrame, root: str) -> str:
    """Replace the snapshot days present in ``df`` in one step (other days untouched)."""
    return landed_stations(df.sparkSession, root).replace(df, "present", ["station_id"]).path


def latest_batch_frame(raw_trips: DataFrame) -> DataFrame:
    """One row: the latest landed batch month (day 1), null when none."""
    return raw_trips.agg(F.trunc(F.max("source_month"), "month").alias("latest_source_month"))


def latest_batch(raw_trips: DataFrame):
    """The latest landed batch month; raises when nothing was landed."""
    v = latest_batch_frame(raw_trips).first()[0]
    if v is None:
        raise ValueError("no trip batch has been landed")
    return v
