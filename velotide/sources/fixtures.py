"""Trip-, station- and status-shaped views over the driver's test tables.

The platform's inputs are bike-share trips, station snapshots and a status
feed; the test data are TPC-H-like tables.  These views shape ``lineitem``,
``supplier`` and ``events`` deterministically into the three raw schemas so
every rule, trap and join of the models is exercised.  The DuckDB oracle
builds the same views in SQL (``velotide.oracle``).

Abbreviations: ``k`` station number (start: ``l_suppkey``, end:
``l_partkey % 10``), ``nat`` that supplier's nation, ``day`` =
``(l_orderkey*7 + l_linenumber) % 45``, ``s0`` = seconds after 2024-01-01."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from velotide.functions.columns import epoch_micros_ntz, instant_from_micros, ntz_plus_seconds
from velotide.operators.broadcast import small_broadcast
from velotide.session import open_writers
from velotide.sources.tables import load_table

# --- fixed values of the fixture ---------------------------------------------
TRIP_EPOCH = "2024-01-01 00:00:00"
FIRST_MONTH, SECOND_MONTH = "2024-01-01", "2024-02-01"
SNAPSHOT_BASE = "2024-01-01"
STATUS_TOPIC = "status.v1"
POLL_MICROS = 300_000_000          # one poll every 5 minutes
# ----------------------------------------------------------------------------


def _dbl(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("double")


def _station_code(k: Column) -> Column:
    d, ks = k % 10, k.cast("string")
    return (F.when(d <= 3, F.concat(ks, F.lit(".01")))
            .when(d <= 5, F.concat(ks, F.lit(".010__")))
            .when(d == 8, F.concat(F.lit("U"), ks))
            .otherwise(F.concat(F.lit("X"), ks)))


def _station_label(k: Column, nat: Column) -> Column:
    d = k % 10
    return (F.when(d == 9, F.lit("Twin St & 1 Ave"))
            .when(d == 8, F.lit("Nowhere"))
            .otherwise(F.concat(nat.cast("string"), F.lit(" Ave & W "), k.cast("string"), F.lit(" St (temp)"))))


def _lat(k: Column, bad: Column) -> Column:
    base = F.lit(40.5) + _dbl(k) * F.lit(0.001)
    return F.when(bad, F.lit(95.0)).when(k % 10 == 7, base + F.lit(0.01)).otherwise(base + F.lit(0.0002))


def _lng(k: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-190.0)).otherwise(F.lit(-74.0) + _dbl(k) * F.lit(0.001))


def raw_trips(spark: SparkSession, root: str) -> DataFrame:
    """The 15 columns of the raw trip table (13 CSV columns + provenance)."""
    li = load_table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    sup = load_table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    start_sup, _ = small_broadcast(sup.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("start_nat")))
    # end stations are suppliers 0..9 only: a key range, so at most 10 rows
    end_sup = F.broadcast(sup.filter(F.col("s_suppkey").between(0, 9))
                          .select(F.col("s_suppkey").alias("end_k"), F.col("s_nationkey").alias("end_nat")))
    t = (li.join(start_sup, "l_suppkey")
         .withColumn("end_k", F.col("l_partkey") % 10)
         .join(end_sup, "end_k"))
    ok, ks, ke = F.col("l_orderkey"), F.col("l_suppkey"), F.col("end_k")
    day = (ok * 7 + F.col("l_linenumber")) % 45
    s0 = day * 86400 + (F.col("l_partkey") * 37 + ok * 101) % 86400
    s1 = s0 + F.col("l_quantity").cast("int") * 60 - 120 + ks % 60
    month = F.when((day < 30) | ((day == 30) & (F.col("l_partkey") % 2 == 0)), F.lit(FIRST_MONTH)) \
        .otherwise(F.lit(SECOND_MONTH)).cast("date")
    return t.select(
        F.when(ok % 887 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat_ws("-", F.concat(F.lit("R"), ok.cast("string")), F.col("l_linenumber").cast("string"),
                                F.col("l_partkey").cast("string"), ks.cast("string"))).alias("ride_id"),
        F.when(F.col("l_linestatus") == "O", F.lit("electric_bike")).otherwise(F.lit(" classic_bike")).alias("rideable_type"),
        F.when(ok % 877 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(ntz_plus_seconds(TRIP_EPOCH, s0)).alias("started_at"),
        F.when(ok % 997 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(ntz_plus_seconds(TRIP_EPOCH, s1)).alias("ended_at"),
        _station_label(ks, F.col("start_nat")).alias("start_station_name"),
        _station_code(ks).alias("start_station_id"),
        _station_label(ke, F.col("end_nat")).alias("end_station_name"),
        F.when(ok % 71 == 0, F.lit(None).cast("string")).otherwise(_station_code(ke)).alias("end_station_id"),
        _lat(ks, ok % 499 == 0).alias("start_lat"),
        _lng(ks, ok % 491 == 0).alias("start_lng"),
        _lat(ke, ok % 487 == 0).alias("end_lat"),
        _lng(ke, ok % 479 == 0).alias("end_lng"),
        F.when(ok % 613 == 0, F.lit("guest")).when(ok % 617 == 0, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "N", F.lit(" Casual ")).otherwise(F.lit("member")).alias("member_casual"),
        month.alias("source_month"),
        F.concat(F.lit("trip_history_"), F.date_format(month, "yyyy-MM")).alias("batch_id"),
    )


def raw_stations(spark: SparkSession, root: str) -> DataFrame:
    """The 17 columns of the raw station_information table: each supplier is
    a station, seen in two daily snapshots."""
    sup = load_table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    s = sup.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    k, nat, n = F.col("s_suppkey"), F.col("s_nationkey"), F.col("n")
    no_coords = k % 37 == 36
    snap = F.date_add(F.lit(SNAPSHOT_BASE).cast("date"), n)
    return s.select(
        F.concat(F.lit("S"), k.cast("string")).alias("station_id"),
        F.when(k % 10 == 9, F.lit("Twin St & 1 Ave"))
         .otherwise(F.concat(F.lit("W "), k.cast("string"), F.lit(" St & "), nat.cast("string"), F.lit(" Ave"))).alias("name"),
        F.concat(k.cast("string"), F.lit(".01")).alias("short_name"),
        nat.cast("string").alias("region_id"),
        F.when(no_coords, F.lit(None).cast("double")).otherwise(F.lit(40.5) + _dbl(k) * F.lit(0.001)).alias("lat"),
        F.when(no_coords, F.lit(None).cast("double")).otherwise(F.lit(-74.0) + _dbl(k) * F.lit(0.001)).alias("lon"),
        (F.lit(10) + k % 20 + n).cast("bigint").alias("capacity"),
        F.lit(None).cast("string").alias("rental_uris"),
        F.array(F.lit("KEY"), F.lit("CREDITCARD")).alias("rental_methods"),
        F.lit(True).alias("has_kiosk"),
        F.lit("classic").alias("station_type"),
        F.lit(None).cast("string").alias("external_id"),
        F.lit(False).alias("electric_bike_surcharge_waiver"),
        F.lit(None).cast("string").alias("eightd_station_services"),
        F.lit(False).alias("eightd_has_key_dispenser"),
        snap.alias("snapshot_date"),
        F.concat(F.lit("station_information_"), F.date_format(snap, "yyyy-MM-dd")).alias("batch_id"),
    )


def raw_status(spark: SparkSession, root: str) -> DataFrame:
    """The 18 columns of the raw station_status table: one row per event,
    plus a replay (same Kafka coordinates, ingested an hour later) of every
    50th event.  The replay is an explode, so the events are scanned once."""
    ev = load_table(spark, root, "events").select("event_id", "ts", "user_id", "value")
    eid = F.col("event_id")
    ev = ev.withColumn("replay", F.explode(F.when(eid % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    b = F.floor(epoch_micros_ntz("ts") / POLL_MICROS)
    ev = ev.withColumn("b", b)
    bucket_us = F.col("b") * POLL_MICROS
    fv = F.floor(F.col("value"))
    return ev.select(
        F.when(eid % 211 == 0, F.lit(None).cast("string")).when(eid % 89 == 0, F.lit("S999"))
         .otherwise(F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string"))).alias("station_id"),
        F.when(eid % 197 == 0, F.lit(None)).when(eid % 97 == 0, F.lit(-1)).otherwise(fv % 12).cast("bigint").alias("num_bikes_available"),
        F.lit(0).cast("bigint").alias("num_bikes_disabled"),
        F.when(eid % 193 == 0, F.lit(None)).when(eid % 191 == 0, F.lit(-2)).otherwise(F.lit(11) - fv % 12).cast("bigint").alias("num_docks_available"),
        F.lit(0).cast("bigint").alias("num_docks_disabled"),
        F.when(eid % 181 == 0, F.lit(2)).when(eid % 13 == 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("is_installed"),
        F.when(eid % 179 == 0, F.lit(3)).otherwise(F.lit(1)).cast("bigint").alias("is_renting"),
        F.when(eid % 173 == 0, F.lit(5)).otherwise(F.lit(1)).cast("bigint").alias("is_returning"),
        (F.col("b") * 300).cast("bigint").alias("last_reported"),
        F.when(eid % 223 == 0, F.lit(None).cast("string")).otherwise(F.col("b").cast("string")).alias("snapshot_id"),
        instant_from_micros(bucket_us).alias("poll_time"),
        (F.col("b") * 300).cast("bigint").alias("feed_last_updated"),
        F.lit(60).cast("bigint").alias("feed_ttl"),
        F.lit(STATUS_TOPIC).alias("kafka_topic"),
        (eid % 3).cast("bigint").alias("kafka_partition"),
        eid.cast("bigint").alias("kafka_offset"),
        instant_from_micros(bucket_us + 1_000_000 + eid).alias("kafka_timestamp"),
        instant_from_micros(bucket_us + 60_000_000 + F.col("replay") * 3_600_000_000).alias("ingested_at"),
    )


# --- fixed values: feed-response fixture (event_id divisors per defect) -------
FEED_URL = "feed://station_status/"
FEED_EPOCH_SECONDS = 1_700_000_000
# ----------------------------------------------------------------------------


def _txt(c: Column) -> Column:
    return c.cast("string")


def feed_responses(spark: SparkSession, root: str) -> DataFrame:
    """One fetched feed response per event: a body with two station
    elements (the first carrying element defects), plus envelope defects and
    failed fetches chosen by event_id."""
    ev = load_table(spark, root, "events").select("event_id", "ts", "user_id", "value")
    eid, uid = F.col("event_id"), F.col("user_id")
    lu = _txt(eid + FEED_EPOCH_SECONDS)
    fv = F.floor("value")
    sid = (F.when(eid % 37 == 0, F.lit('"  "')).when(eid % 71 == 0, F.lit("123"))
           .otherwise(F.concat(F.lit('"S'), _txt(uid % 10), F.lit('"'))))
    bikes = F.when(eid % 43 == 0, F.lit("5.0")).otherwise(_txt(fv % 12))
    docks = F.when(eid % 47 == 0, F.lit('"5"')).otherwise(_txt(F.lit(11) - fv % 12))
    returning = F.when(eid % 41 == 0, F.lit("true")).otherwise(F.lit("1"))
    reported = F.when(eid % 67 == 0, F.lit("99999999999999999999")).otherwise(lu)
    bikes_dis = F.when(eid % 53 == 0, F.lit("")).otherwise(F.lit(', "num_bikes_disabled": 0'))
    docks_dis = (F.when(eid % 59 == 0, F.lit(', "num_docks_disabled": null'))
                 .when(eid % 61 == 0, F.lit(', "num_docks_disabled": "x"'))
                 .otherwise(F.lit(', "num_docks_disabled": 0')))
    first = F.when(eid % 31 == 0, F.lit("5")).otherwise(F.concat(
        F.lit('{"station_id": '), sid, F.lit(', "num_bikes_available": '), bikes, bikes_dis,
        F.lit(', "num_docks_available": '), docks, docks_dis,
        F.lit(', "is_installed": 1, "is_renting": 1, "is_returning": '), returning,
        F.lit(', "last_reported": '), reported, F.lit("}")))
    second = F.concat(
        F.lit('{"station_id": "S'), _txt((uid + 1) % 10),
        F.lit('", "num_bikes_available": 3, "num_bikes_disabled": 0, "num_docks_available": 8, '
              '"num_docks_disabled": 0, "is_installed": 1, "is_renting": 1, "is_returning": 1, "last_reported": '),
        lu, F.lit("}"))
    stations = (F.when(eid % 113 == 0, F.lit('{"a": 1}')).when(eid % 137 == 0, F.lit("[]"))
                .otherwise(F.concat(F.lit("["), first, F.lit(", "), second, F.lit("]"))))
    data = F.when(eid % 109 == 0, F.lit('"x"')).otherwise(F.concat(F.lit('{"stations": '), stations, F.lit("}")))
    ttl = F.when(eid % 127 == 0, F.lit('"60"')).otherwise(F.lit("60"))
    last = F.when(eid % 131 == 0, F.lit("true")).otherwise(lu)
    body = (F.when(eid % 101 == 0, F.lit("not json {")).when(eid % 103 == 0, F.lit("null"))
            .when(eid % 107 == 0, F.lit("[1, 2]"))
            .otherwise(F.concat(F.lit('{"last_updated": '), last, F.lit(', "ttl": '), ttl, F.lit(', "data": '),
                                data, F.lit("}"))))
    status = (F.when(eid % 139 == 0, F.lit(404)).when(eid % 149 == 0, F.lit(503))
              .when(eid % 151 == 0, F.lit(None)).otherwise(F.lit(200)).cast("int"))
    return ev.select(F.concat(F.lit(FEED_URL), _txt(eid % 3)).alias("source_url"), status.alias("http_status"),
                     body.alias("body"), F.col("ts").cast("timestamp").alias("fetched_at"))


# --- fixed values: Kafka-shaped stream fixture ---------------------------------
MALFORMED_EVERY = 199
STREAM_ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# ----------------------------------------------------------------------------


def kafka_status_records(spark: SparkSession, root: str) -> DataFrame:
    """The status fixture as Kafka records (key, value, topic, partition,
    offset, timestamp); every 199th offset carries a value that is not JSON.
    Replayed offsets appear twice, as after a producer retry."""
    s = raw_status(spark, root)
    event = F.to_json(F.struct(
        "station_id", "num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
        "is_installed", "is_renting", "is_returning", "last_reported", "snapshot_id",
        F.date_format("poll_time", STREAM_ISO_FORMAT).alias("poll_time"), "feed_last_updated", "feed_ttl"))
    value = F.when(F.col("kafka_offset") % MALFORMED_EVERY == 0, F.lit("{not json")).otherwise(event)
    return s.select(
        F.col("station_id").cast("binary").alias("key"), value.cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"), F.col("kafka_partition").cast("int").alias("partition"),
        F.col("kafka_offset").alias("offset"), F.col("kafka_timestamp").alias("timestamp"))


# --- landed fixture tables ----------------------------------------------------
_LANDED: dict[tuple, tuple[str, list[str]]] = {}
_BUILDERS = {"trips": raw_trips, "stations": raw_stations, "status": raw_status, "feed": feed_responses,
             "kafka": kafka_status_records}
_PARTITIONS = {"trips": ["source_month"]}   # the raw trip table's batch layout
_SOURCES = {"trips": ("lineitem", "supplier"), "stations": ("supplier",), "status": ("events",), "feed": ("events",),
            "kafka": ("events",)}


def _source_stamp(root: str, tables) -> tuple:
    import os
    out = []
    for t in tables:
        p = f"{root.rstrip('/')}/{t}.parquet"
        try:
            st = os.stat(p)
            out.append((t, st.st_size, int(st.st_mtime)))
        except OSError:            # not a local path: the path alone identifies it
            out.append((t, p))
    return tuple(out)


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # remote session
        return spark.conf.get("spark.app.id", "remote")


def landed_path(spark: SparkSession, root: str, name: str) -> str:
    """Folder of the landed fixture table ``name`` (landing it if needed)."""
    landed(spark, root, name)
    key = (app_id(spark), root, name, _source_stamp(root, _SOURCES[name]))
    return _LANDED[key][0]


def landed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The fixture view ``name`` landed as a raw parquet table, as the
    landing jobs do with real inputs, written once per session and source
    version under the checkpoint folder; models then read plain columns
    from a multi-file table instead of re-deriving the view."""
    from velotide.session import scratch_path
    key = (app_id(spark), root, name, _source_stamp(root, _SOURCES[name]))
    hit = _LANDED.get(key)
    if hit is not None:
        try:
            return spark.read.parquet(hit[0]).select(*hit[1])
        except AnalysisException:  # the scratch folder was removed: land again
            hit = None
    path = scratch_path(spark, f"raw-{name}")
    df = _BUILDERS[name](spark, root)
    # every writer task writes its own file per partition: no shuffle, and
    # the table keeps as many splits as the job had tasks
    with open_writers(spark):
        df.write.partitionBy(*_PARTITIONS.get(name, [])).option("compression", "zstd").parquet(path)
    _LANDED[key] = (path, df.columns)
    # same column order as the view (partition columns come back last)
    return spark.read.parquet(path).select(*df.columns)
