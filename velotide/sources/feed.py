"""Station-status feed responses -> station events + dead-letter rows.

Input: one row per fetched response (source_url, http_status, body,
fetched_at).  The body is parsed once into a VARIANT; every check is a
column expression on it, and the station list is exploded only for
responses whose envelope passed -- no Python per record, and the work is
spread over the responses' partitions.

Classes, first match wins (the poller's order):

* skipped (not sent anywhere): HTTP 4xx/5xx, no status (network failure),
  or a non-2xx response without a JSON body
* INVALID_JSON            body is not JSON, or is JSON ``null``
* INVALID_FEED_STRUCTURE  body is not an object, or ``data`` is not an object
* INVALID_STATION_DATA    ``data.stations`` is not a list
* INVALID_FEED_METADATA   ``last_updated`` or ``ttl`` is not an integer
* INVALID_STATION_RECORD  per element: not an object, ``station_id`` not a
                          non-blank string, a required count not an integer,
                          an optional count present but not an integer

"Integer" means a JSON integer that fits 64 bits: JSON ``true``, ``5.0`` and
``"5"`` are not integers, and larger integers go to the DLQ because the
stream's schema reads counts as bigint (they would turn into nulls there)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotide.functions.columns import UNICODE_WHITESPACE

# --- fixed values ------------------------------------------------------------
INVALID_JSON = "INVALID_JSON"
INVALID_FEED_STRUCTURE = "INVALID_FEED_STRUCTURE"
INVALID_STATION_DATA = "INVALID_STATION_DATA"
INVALID_FEED_METADATA = "INVALID_FEED_METADATA"
INVALID_STATION_RECORD = "INVALID_STATION_RECORD"
SKIPPED = "SKIPPED"
ERROR_MESSAGES = {
    INVALID_JSON: "Station status response is not valid JSON.",
    INVALID_FEED_STRUCTURE: "Response data is not an object.",
    INVALID_STATION_DATA: "data.stations is not a list.",
    INVALID_FEED_METADATA: "last_updated or ttl has an invalid type.",
    INVALID_STATION_RECORD: "Station record is missing required fields or has invalid types.",
}
REQUIRED_INTS = ["last_reported", "num_bikes_available", "num_docks_available",
                 "is_installed", "is_renting", "is_returning"]
OPTIONAL_INTS = ["num_bikes_disabled", "num_docks_disabled"]
SNIPPET_CHARS = 1000
# characters a blank station id may consist of: Unicode whitespace plus the
# four separators U+001C..U+001F, which the poller's strip() also removes
ID_BLANKS = UNICODE_WHITESPACE + "\u001c\u001d\u001e\u001f"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# ----------------------------------------------------------------------------

EVENT_FIELDS = ["station_id", "num_bikes_available", "num_bikes_disabled", "num_docks_available",
                "num_docks_disabled", "is_installed", "is_renting", "is_returning", "last_reported",
                "snapshot_id", "poll_time", "feed_last_updated", "feed_ttl"]
DLQ_FIELDS = ["failed_at", "source_url", "http_status", "error_type", "error_message", "raw_body_snippet",
              "producer_id"]


def _field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _is_int(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "BIGINT", F.lit(False))


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _snippet(text: Column) -> Column:
    return F.substring(text, 1, SNIPPET_CHARS)


def envelope(responses: DataFrame) -> DataFrame:
    """Parse the body and classify the envelope (``feed_error`` null = ok)."""
    p = F.col("payload")
    status = F.col("http_status")
    ok2xx = status.between(200, 299)
    stations = F.try_variant_get(p, "$.data.stations", "array<variant>")
    err = (F.when(status.isNull() | (status >= 400), F.lit(SKIPPED))
           .when(p.isNull() & ~ok2xx, F.lit(SKIPPED))
           .when(p.isNull() | F.is_variant_null(p), F.lit(INVALID_JSON))
           .when(~_is_object(_field(p, "$.data")), F.lit(INVALID_FEED_STRUCTURE))
           .when(stations.isNull(), F.lit(INVALID_STATION_DATA))
           .when(~(_is_int(_field(p, "$.last_updated")) & _is_int(_field(p, "$.ttl"))), F.lit(INVALID_FEED_METADATA)))
    e = F.col("feed_error")
    # only rejected responses are re-serialised
    snippet = (F.when(e == INVALID_JSON, F.when(p.isNull(), _snippet(F.col("body"))))
               .when(e == INVALID_STATION_DATA, _snippet(F.to_json(_field(p, "$.data"))))
               .when(e.isin(INVALID_FEED_STRUCTURE, INVALID_FEED_METADATA), _snippet(F.to_json(p))))
    # The parse is the output of a one-element generator: filters on the
    # class are then evaluated on the parsed value, instead of the optimizer
    # substituting ``try_parse_json(body)`` into every test of a pushed-down
    # filter (which would parse each body several times).
    parsed = responses.select("*", F.inline(F.array(F.struct(F.try_parse_json("body").alias("payload")))))
    return (parsed.withColumn("stations", stations)
            .withColumn("feed_error", err)
            .withColumn("feed_snippet", snippet)
            .withColumn("feed_last_updated", F.try_variant_get(p, "$.last_updated", "bigint"))
            .withColumn("feed_ttl", F.try_variant_get(p, "$.ttl", "bigint")))


def station_valid(e: Column) -> Column:
    sid = _field(e, "$.station_id")
    sid_ok = F.coalesce((F.schema_of_variant(sid) == "STRING")
                        & (F.btrim(F.try_variant_get(sid, "$", "string"), F.lit(ID_BLANKS)) != ""), F.lit(False))
    ok = _is_object(e) & sid_ok
    for f in REQUIRED_INTS:
        ok = ok & _is_int(_field(e, f"$.{f}"))
    for f in OPTIONAL_INTS:
        v = _field(e, f"$.{f}")
        ok = ok & (v.isNull() | F.is_variant_null(v) | _is_int(v))
    return ok


EVENT, DEAD, SKIP = "event", "dlq", "skipped"


def classified(responses: DataFrame) -> DataFrame:
    """One row per station record, and one per response without any: a single
    scan and a single parse that both outputs are filters of.  ``kind`` is the
    output a row belongs to, ``feed_error`` the class of a rejected envelope or
    record, ``pos`` the record's place in its response (null: no record).  What a
    record needs of its response is taken before the list is exploded: a row
    carries its own element, never the whole body."""
    env = envelope(responses).withColumn("stations", F.when(F.col("feed_error").isNull(), F.col("stations")))
    rows = env.select("source_url", "http_status", "fetched_at", "feed_last_updated", "feed_ttl", "feed_error", "feed_snippet",
                      F.posexplode_outer("stations").alias("pos", "e"))
    rows = rows.withColumn("valid", F.when(F.col("pos").isNotNull(), station_valid(F.col("e"))))
    error = F.when(F.col("valid") == F.lit(False), F.lit(INVALID_STATION_RECORD)).otherwise(F.col("feed_error"))
    kind = (F.when(F.col("valid"), F.lit(EVENT)).when(error.isNull() | (error == SKIPPED), F.lit(SKIP)).otherwise(F.lit(DEAD)))
    return rows.withColumn("kind", kind).withColumn("error_type", error)


def feed_events(rows: DataFrame) -> DataFrame:
    """The 13 event fields (poll_time as ISO text).  The snapshot id is an md5 of
    the response's url and fetch time, so a replayed response gets the same id
    (and the logical dedup downstream removes it)."""
    e, fetched_iso = F.col("e"), F.date_format("fetched_at", ISO_FORMAT)
    return rows.filter(F.col("kind") == EVENT).select(
        F.try_variant_get(e, "$.station_id", "string").alias("station_id"),
        *[F.try_variant_get(e, f"$.{f}", "bigint").alias(f) for f in
          ["num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
           "is_installed", "is_renting", "is_returning", "last_reported"]],
        F.md5(F.concat_ws("|", "source_url", fetched_iso)).alias("snapshot_id"),
        fetched_iso.alias("poll_time"),
        "feed_last_updated", "feed_ttl")


def feed_dlq(rows: DataFrame, producer_id: str = "velotide-feed") -> DataFrame:
    """The 7 dead-letter fields of rejected responses and records."""
    msg = F.create_map(*[x for k, v in ERROR_MESSAGES.items() for x in (F.lit(k), F.lit(v))])
    snippet = F.when(F.col("pos").isNull(), F.col("feed_snippet")).otherwise(_snippet(F.to_json("e")))
    return rows.filter(F.col("kind") == DEAD).select(
        F.date_format("fetched_at", ISO_FORMAT).alias("failed_at"), "source_url", "http_status", "error_type",
        msg[F.col("error_type")].alias("error_message"), snippet.alias("raw_body_snippet"), F.lit(producer_id).alias("producer_id"))


def classify_feed(responses: DataFrame, producer_id: str = "velotide-feed") -> tuple[DataFrame, DataFrame]:
    """(events, dlq), each one scan of the responses when consumed alone."""
    rows = classified(responses)
    return feed_events(rows), feed_dlq(rows, producer_id)


def feed_classes(responses: DataFrame) -> DataFrame:
    """Responses per envelope class and records per record class, in one pass."""
    response = F.when(F.col("pos").isNull() | (F.col("pos") == 0), F.coalesce("feed_error", F.lit("ENVELOPE_OK")))
    record = F.when(F.col("pos").isNotNull(), F.when(F.col("valid"), F.lit("VALID_STATION")).otherwise(F.lit(INVALID_STATION_RECORD)))
    classes = classified(responses).select(F.explode(F.array_compact(F.array(response, record))).alias("error_type"))
    return classes.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


def publish(events: DataFrame, key: str = "station_id") -> DataFrame:
    """Kafka-shaped records: key = station id, value = the JSON event."""
    return events.select(F.col(key).cast("string").alias("key"),
                         F.to_json(F.struct(*EVENT_FIELDS)).alias("value"))


def dlq_records(dlq: DataFrame) -> DataFrame:
    return dlq.select(F.to_json(F.struct(*DLQ_FIELDS)).alias("value"))
