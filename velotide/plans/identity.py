"""int_station_identity: resolve every station code seen in trips to one
station of the snapshot feed, by a cascade of three methods.

1. EXACT_SHORT_NAME   code = station short_name
2. NUMERIC_SHORT_NAME code and short_name equal as NUMERIC(38,9) after
                      trailing underscores are removed
3. NAME_COORDINATE    equal canonical names and at most ``max_m`` metres apart

A method only takes codes with exactly one candidate; an ambiguous code falls
through to the next method.  The geo candidate count is taken before the
distance test, so two same-name stations are ambiguous even if one is far.

Scale: the only pass over trips is ``station_variants`` (each trip exploded
into its two ends, one hash aggregate with map-side combine); everything
after works on one row per code/variant (thousands of rows), and the join
back to trips broadcasts the result behind a measured row count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import canonical_name, code_to_decimal, haversine_m
from velotide.operators.dedup import first_by, latest_by

# --- fixed values ------------------------------------------------------------
EXACT, NUMERIC, GEO = "EXACT_SHORT_NAME", "NUMERIC_SHORT_NAME", "NAME_COORDINATE"
MATCHED, UNRESOLVED = "MATCHED", "UNRESOLVED"
MAX_DISTANCE_M = 100.0
# ----------------------------------------------------------------------------

VARIANT_COLS = ["source_station_code", "source_station_name", "source_latitude", "source_longitude"]


def _ends(stg_trips: DataFrame, extra: list[str]) -> DataFrame:
    ends = F.array(
        F.struct(F.col("start_station_id").alias("source_station_code"),
                 F.col("start_station_name").alias("source_station_name"),
                 F.col("start_latitude").alias("source_latitude"),
                 F.col("start_longitude").alias("source_longitude")),
        F.struct(F.col("end_station_id").alias("source_station_code"),
                 F.col("end_station_name").alias("source_station_name"),
                 F.col("end_latitude").alias("source_latitude"),
                 F.col("end_longitude").alias("source_longitude")),
    )
    return stg_trips.select(*extra, F.inline(ends)).filter(F.col("source_station_code").isNotNull())


def station_variants(stg_trips: DataFrame) -> DataFrame:
    """Trips per (code, name, lat, lng), start and end ends counted together."""
    return _ends(stg_trips, []).groupBy(*VARIANT_COLS).agg(F.count(F.lit(1)).alias("trip_rows"))


def station_variants_by_batch(stg_trips: DataFrame) -> DataFrame:
    """The same counts per landed batch: stored partitioned by batch, a
    month run recounts only its batch and the identity sums the stored
    counts (a few rows per station and batch) instead of re-reading every
    trip of every month."""
    return (_ends(stg_trips, ["source_month"]).groupBy("source_month", *VARIANT_COLS)
            .agg(F.count(F.lit(1)).alias("trip_rows")))


def merge_variants(by_batch: DataFrame) -> DataFrame:
    return by_batch.groupBy(*VARIANT_COLS).agg(F.sum("trip_rows").cast("bigint").alias("trip_rows"))


def dominant_variant(variants: DataFrame) -> DataFrame:
    """The most used variant of each code (ties: name, lat, lng ascending)."""
    return first_by(variants, ["source_station_code"], ["-trip_rows"])


def prepare_sources(dominant: DataFrame) -> DataFrame:
    return dominant.select(
        *VARIANT_COLS, "trip_rows",
        code_to_decimal("source_station_code").alias("source_station_code_numeric"),
        canonical_name("source_station_name").alias("canonical_name"),
    )


def station_reference(stg_stations: DataFrame) -> DataFrame:
    """Latest snapshot of every station that has an id and coordinates."""
    located = stg_stations.filter(F.col("station_id").isNotNull() & F.col("latitude").isNotNull()
                                  & F.col("longitude").isNotNull())
    latest = latest_by(located, ["station_id"], "snapshot_date")
    return latest.select(
        F.col("station_id").alias("station_key"),
        F.col("short_name"),
        F.col("station_name"),
        F.col("latitude"),
        F.col("longitude"),
        code_to_decimal("short_name").alias("short_name_numeric"),
        canonical_name("station_name").alias("canonical_name"),
    )


def _by_key(ref: DataFrame, key: str, *cols: str) -> DataFrame:
    """The reference with one row per key and how many stations have it.  Codes meet
    this instead of the stations: a name that many codes and many stations share
    would make a pair of each.  The other columns are a station's own only where
    the key has one station; codes of the other keys are ambiguous in any case."""
    return ref.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("stations"), *[F.min(c).alias(c) for c in cols])


def _unique(candidates: DataFrame, method: str, extra_filter=None) -> DataFrame:
    """Codes with exactly one candidate (count taken before ``extra_filter``)."""
    agg = candidates.groupBy("source_station_code").agg(
        F.sum("stations").alias("candidate_count"),
        F.min("station_key").alias("station_key"),
        *([F.min("distance_m").alias("distance_m")] if "distance_m" in candidates.columns else []))
    keep = F.col("candidate_count") == 1
    if extra_filter is not None:
        keep = keep & extra_filter
    return agg.filter(keep).select("source_station_code", "station_key", F.lit(method).alias("mapping_method"))


def match_exact(src: DataFrame, ref: DataFrame) -> DataFrame:
    cand = src.select("source_station_code").join(
        _by_key(ref, "short_name", "station_key").withColumnRenamed("short_name", "source_station_code"), "source_station_code")
    return _unique(cand, EXACT)


def _open(src: DataFrame, done: DataFrame | None) -> DataFrame:
    return src if done is None else src.join(done.select("source_station_code"), "source_station_code", "left_anti")


def match_numeric(src: DataFrame, ref: DataFrame, done: DataFrame | None = None) -> DataFrame:
    open_codes = _open(src, done)
    cand = open_codes.select("source_station_code", F.col("source_station_code_numeric").alias("num")).join(
        _by_key(ref, "short_name_numeric", "station_key").withColumnRenamed("short_name_numeric", "num"), "num")
    return _unique(cand, NUMERIC)


def _valid_point(lat, lon):
    return F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)


def match_geo(src: DataFrame, ref: DataFrame, done: DataFrame | None = None, max_m: float = MAX_DISTANCE_M) -> DataFrame:
    open_codes = (_open(src, done)
                  .filter(F.col("source_latitude").isNotNull() & F.col("source_longitude").isNotNull()))
    cand = open_codes.select("source_station_code", "canonical_name", "source_latitude", "source_longitude").join(
        _by_key(ref, "canonical_name", "station_key", "latitude", "longitude"), "canonical_name")
    # a coordinate outside the globe has no distance (the warehouse would fail)
    dist = F.when(_valid_point("source_latitude", "source_longitude") & _valid_point("latitude", "longitude"),
                  haversine_m("source_latitude", "source_longitude", "latitude", "longitude"))
    cand = cand.withColumn("distance_m", dist)
    return _unique(cand, GEO, F.col("distance_m") <= max_m)


def station_identity(stg_trips: DataFrame, stg_stations: DataFrame, max_m: float = MAX_DISTANCE_M,
                     materialize: bool = True, variants: DataFrame | None = None) -> DataFrame:
    """One row per source station code: its dominant variant and resolution.
    ``variants`` may be given precomputed (e.g. merged per-batch counts).

    With ``materialize`` the reduced trip side of the cascade (one row per
    code) is written once to the checkpoint folder: the trips are read by
    exactly one job, the cascade's joins see a small file of known size
    (planned as broadcast joins), and a lost executor never sends the
    cascade back to the trips.  The reference side comes from the small
    station table and is cheaper to recompute than to write."""
    counted = variants if variants is not None else station_variants(stg_trips)
    src = prepare_sources(dominant_variant(counted))
    ref = station_reference(stg_stations)
    if materialize:
        from velotide.operators.broadcast import materialise
        src = materialise(src, "identity-sources")
    # a method's unique match depends on its own code only, so the first method
    # that has one decides: three left joins, no anti joins and no union
    found = src
    for k, m in enumerate((match_exact(src, ref), match_numeric(src, ref), match_geo(src, ref, max_m=max_m))):
        found = found.join(m.select("source_station_code", F.struct("station_key", "mapping_method").alias(f"__m{k}")),
                           "source_station_code", "left")
    return (found.withColumn("__m", F.coalesce("__m0", "__m1", "__m2"))
            .select(*VARIANT_COLS, "trip_rows", F.col("__m.station_key"), F.col("__m.mapping_method"))
            .select(*VARIANT_COLS, "trip_rows", "station_key", "mapping_method",
                    F.when(F.col("station_key").isNotNull(), F.lit(MATCHED)).otherwise(F.lit(UNRESOLVED))
                    .alias("mapping_status")))
