"""Feed bodies from FIXTURES section 3, one response each."""

import datetime as dt
import json

from velotide.sources.feed import classify_feed, dlq_records, publish

GOOD = {"station_id": "S1", "num_bikes_available": 3, "num_bikes_disabled": 0, "num_docks_available": 5,
        "num_docks_disabled": 0, "is_installed": 1, "is_renting": 1, "is_returning": 1, "last_reported": 100}


def body(stations=None, **env):
    doc = {"last_updated": 1700000000, "ttl": 60, "data": {"stations": [GOOD] if stations is None else stations}}
    doc.update(env)
    return json.dumps(doc)


def st(**kw):
    d = dict(GOOD)
    for k, v in kw.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return d


CASES = [
    ("not json {", 200, "INVALID_JSON"),
    ("null", 200, "INVALID_JSON"),
    ("[1, 2]", 200, "INVALID_FEED_STRUCTURE"),
    (json.dumps({"last_updated": 1, "ttl": 1, "data": 5}), 200, "INVALID_FEED_STRUCTURE"),
    (json.dumps({"last_updated": 1, "ttl": 1, "data": {"stations": {"a": 1}}}), 200, "INVALID_STATION_DATA"),
    (body(ttl="60"), 200, "INVALID_FEED_METADATA"),
    (body(last_updated=True), 200, "INVALID_FEED_METADATA"),
    (body([]), 200, None),
    (body([5]), 200, "INVALID_STATION_RECORD"),
    (body([st(station_id="  ")]), 200, "INVALID_STATION_RECORD"),
    (body([st(is_returning=True)]), 200, "INVALID_STATION_RECORD"),
    (body([st(num_bikes_available=5.0)]), 200, "INVALID_STATION_RECORD"),
    (body([st(num_docks_available="5")]), 200, "INVALID_STATION_RECORD"),
    (body([st(num_bikes_disabled=KeyError)]), 200, "OK"),
    (body([st(num_docks_disabled=None)]), 200, "OK"),
    (body([st(num_docks_disabled="x")]), 200, "INVALID_STATION_RECORD"),
    (body([st(last_reported=10 ** 20)]), 200, "INVALID_STATION_RECORD"),
    (body(), 404, None),
    (body(), 503, None),
    ("not json", None, None),
]


def test_feed_classes(spark):
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(f"u{i}", status, b, t0 + dt.timedelta(minutes=i)) for i, (b, status, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "source_url string, http_status int, body string, fetched_at timestamp")
    events, dlq = classify_feed(df)
    got_dlq = {r["source_url"]: r["error_type"] for r in dlq.collect()}
    got_ev = {f"u{int(r['poll_time'][14:16])}" for r in events.collect()}
    for i, (_, _, expect) in enumerate(CASES):
        u = f"u{i}"
        if expect == "OK":
            assert u in got_ev and u not in got_dlq, (i, CASES[i])
        elif expect is None:
            assert u not in got_ev and u not in got_dlq, (i, CASES[i])
        else:
            assert got_dlq.get(u) == expect, (i, CASES[i], got_dlq.get(u))
    d = {r["source_url"]: r for r in dlq.collect()}
    assert d["u0"]["raw_body_snippet"] == "not json {"
    assert d["u1"]["raw_body_snippet"] is None
    assert d["u0"]["error_message"] == "Station status response is not valid JSON."
    ev = events.filter(events.poll_time.startswith("2024-01-01T00:13")).first()
    assert ev["num_bikes_disabled"] is None and ev["num_bikes_available"] == 3
    rec = publish(events).filter("key = 'S1'").first()
    assert json.loads(rec["value"])["station_id"] == "S1"
    assert json.loads(dlq_records(dlq).first()["value"])["producer_id"] == "velotide-feed"


def test_long_snippet_is_cut(spark):
    big = body([st(station_id="S" + "x" * 3000, is_returning=True)])
    df = spark.createDataFrame([("u", 200, big, dt.datetime(2024, 1, 1))],
                               "source_url string, http_status int, body string, fetched_at timestamp")
    _, dlq = classify_feed(df)
    assert len(dlq.first()["raw_body_snippet"]) == 1000


def test_feed_stream_outputs_and_restart(spark, tmp_dir):
    from velotide.streaming.feed_stream import RESPONSE_SCHEMA, read_responses, start_feed_stream
    t0 = dt.datetime(2024, 1, 1)
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    spark.createDataFrame([("u1", 200, body(), t0), ("u2", 200, "not json {", t0)], RESPONSE_SCHEMA) \
        .coalesce(1).write.parquet(src)
    start_feed_stream(read_responses(spark, src), out, ck, {"availableNow": True}).awaitTermination()
    assert spark.read.parquet(f"{out}/events").count() == 1
    assert json.loads(spark.read.parquet(f"{out}/dlq").first()["value"])["error_type"] == "INVALID_JSON"
    spark.createDataFrame([("u3", 200, body([GOOD, GOOD]), t0)], RESPONSE_SCHEMA).coalesce(1) \
        .write.mode("append").parquet(src)
    start_feed_stream(read_responses(spark, src), out, ck, {"availableNow": True}).awaitTermination()
    assert spark.read.parquet(f"{out}/events").count() == 3
