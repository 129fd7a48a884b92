"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is one SELECT over the driver's pre-registered views (lineitem,
supplier, events, ...).  The fixture views and the models are re-stated in
SQL, following the warehouse models' own structure (full outer joins, window
counts, NOT IN), so the oracle is an independent formulation of what the
Spark plans compute with different physical shapes."""

from __future__ import annotations

from velotide.functions.columns import EARTH_RADIUS_M, UNICODE_WHITESPACE

WS = "(" + " || ".join(f"chr({ord(c)})" for c in UNICODE_WHITESPACE) + ")"
ID_BLANKS = "(" + " || ".join(f"chr({ord(c)})" for c in UNICODE_WHITESPACE + "\x1c\x1d\x1e\x1f") + ")"


def tws(x: str) -> str:
    return f"trim({x}, {WS})"


def canon(x: str) -> str:
    parts = (f"list_filter(list_transform(string_split(regexp_replace(lower({tws(x)}), '\\s*\\([^)]*\\)', '', 'g'), '&'),"
             f" lambda p: {tws('p')}), lambda p: p <> '')")
    return f"coalesce(array_to_string(list_sort({parts}), ' & '), '')"


def code_num(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '_+$', '') AS DECIMAL(38,9))"


def dkey(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS BIGINT)"


def hav(lat1, lon1, lat2, lon2) -> str:
    r = lambda x: f"radians({x})"
    h = (f"pow(sin(({r(lat2)} - {r(lat1)}) / 2), 2) + cos({r(lat1)}) * cos({r(lat2)}) * "
         f"pow(sin(({r(lon2)} - {r(lon1)}) / 2), 2)")
    valid = (f"{lat1} BETWEEN -90 AND 90 AND {lon1} BETWEEN -180 AND 180 AND "
             f"{lat2} BETWEEN -90 AND 90 AND {lon2} BETWEEN -180 AND 180")
    return f"CASE WHEN {valid} THEN {2 * EARTH_RADIUS_M} * asin(least(1.0, sqrt({h}))) END"


def _code(k):
    ks = f"CAST({k} AS VARCHAR)"
    return (f"CASE WHEN {k} % 10 <= 3 THEN {ks} || '.01' WHEN {k} % 10 <= 5 THEN {ks} || '.010__' "
            f"WHEN {k} % 10 = 8 THEN 'U' || {ks} ELSE 'X' || {ks} END")


def _label(k, nat):
    return (f"CASE WHEN {k} % 10 = 9 THEN 'Twin St & 1 Ave' WHEN {k} % 10 = 8 THEN 'Nowhere' "
            f"ELSE CAST({nat} AS VARCHAR) || ' Ave & W ' || CAST({k} AS VARCHAR) || ' St (temp)' END")


def _lat(k, bad):
    base = f"(40.5::DOUBLE + CAST({k} AS DOUBLE) * 0.001::DOUBLE)"
    return f"CASE WHEN {bad} THEN 95.0::DOUBLE WHEN {k} % 10 = 7 THEN {base} + 0.01::DOUBLE ELSE {base} + 0.0002::DOUBLE END"


def _lng(k, bad):
    return f"CASE WHEN {bad} THEN -190.0::DOUBLE ELSE -74.0::DOUBLE + CAST({k} AS DOUBLE) * 0.001::DOUBLE END"


TRIP_REASONS = [
    ("INVALID_RIDE_ID", "ride_id IS NULL"),
    ("INVALID_START_TIME", "started_at IS NULL"),
    ("INVALID_END_TIME", "ended_at IS NULL"),
    ("INVALID_DURATION", "started_at IS NOT NULL AND ended_at IS NOT NULL AND date_diff('second', started_at, ended_at) <= 0"),
    ("INVALID_START_LATITUDE", "start_latitude IS NOT NULL AND start_latitude NOT BETWEEN -90 AND 90"),
    ("INVALID_START_LONGITUDE", "start_longitude IS NOT NULL AND start_longitude NOT BETWEEN -180 AND 180"),
    ("INVALID_END_LATITUDE", "end_latitude IS NOT NULL AND end_latitude NOT BETWEEN -90 AND 90"),
    ("INVALID_END_LONGITUDE", "end_longitude IS NOT NULL AND end_longitude NOT BETWEEN -180 AND 180"),
    ("INVALID_RIDER_TYPE", "member_casual IS NOT NULL AND member_casual NOT IN ('member', 'casual')"),
]
STATUS_REASONS = [
    ("INVALID_STATION_ID", "station_id IS NULL"),
    ("INVALID_SNAPSHOT_ID", "snapshot_id IS NULL"),
    ("MISSING_BIKES_AVAILABLE", "num_bikes_available IS NULL"),
    ("NEGATIVE_BIKES_AVAILABLE", "num_bikes_available IS NOT NULL AND num_bikes_available < 0"),
    ("MISSING_DOCKS_AVAILABLE", "num_docks_available IS NULL"),
    ("NEGATIVE_DOCKS_AVAILABLE", "num_docks_available IS NOT NULL AND num_docks_available < 0"),
    ("INVALID_IS_INSTALLED", "is_installed IS NOT NULL AND is_installed NOT IN (0, 1)"),
    ("INVALID_IS_RENTING", "is_renting IS NOT NULL AND is_renting NOT IN (0, 1)"),
    ("INVALID_IS_RETURNING", "is_returning IS NOT NULL AND is_returning NOT IN (0, 1)"),
]


def _codes(reasons):
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{code}' END" for code, c in reasons) + ")"


CALENDAR = ("2024-01-01", "2024-02-10")
AS_OF = "2024-03-01 00:00:00"

BASE_CTES = f"""
li AS (
  SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS ks, l_linenumber AS ln, l_quantity AS qty,
         l_returnflag AS rf, l_linestatus AS ls, l_partkey % 10 AS ke,
         (l_orderkey * 7 + l_linenumber) % 45 AS day
  FROM lineitem),
tb AS (
  SELECT li.*, sp.s_nationkey AS start_nat, ep.s_nationkey AS end_nat,
         day * 86400 + (pk * 37 + ok * 101) % 86400 AS s0
  FROM li JOIN supplier sp ON li.ks = sp.s_suppkey JOIN supplier ep ON li.ke = ep.s_suppkey),
raw_trips AS (
  SELECT
    CASE WHEN ok % 887 = 0 THEN NULL ELSE 'R' || CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR) || '-'
         || CAST(pk AS VARCHAR) || '-' || CAST(ks AS VARCHAR) END AS ride_id,
    CASE WHEN ls = 'O' THEN 'electric_bike' ELSE ' classic_bike' END AS rideable_type,
    CASE WHEN ok % 877 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(s0 AS BIGINT)) END AS started_at,
    CASE WHEN ok % 997 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00'
         + to_seconds(CAST(s0 + CAST(trunc(qty) AS BIGINT) * 60 - 120 + ks % 60 AS BIGINT)) END AS ended_at,
    {_label('ks', 'start_nat')} AS start_station_name,
    {_code('ks')} AS start_station_id,
    {_label('ke', 'end_nat')} AS end_station_name,
    CASE WHEN ok % 71 = 0 THEN NULL ELSE {_code('ke')} END AS end_station_id,
    {_lat('ks', 'ok % 499 = 0')} AS start_lat,
    {_lng('ks', 'ok % 491 = 0')} AS start_lng,
    {_lat('ke', 'ok % 487 = 0')} AS end_lat,
    {_lng('ke', 'ok % 479 = 0')} AS end_lng,
    CASE WHEN ok % 613 = 0 THEN 'guest' WHEN ok % 617 = 0 THEN NULL WHEN rf = 'N' THEN ' Casual '
         ELSE 'member' END AS member_casual,
    CASE WHEN day < 30 OR (day = 30 AND pk % 2 = 0) THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS source_month
  FROM tb),
raw_trips2 AS (SELECT *, 'trip_history_' || strftime(source_month, '%Y-%m') AS batch_id FROM raw_trips),
sup2 AS (
  SELECT s_suppkey AS k, s_nationkey AS nat, 0 AS n FROM supplier
  UNION ALL
  SELECT s_suppkey AS k, s_nationkey AS nat, 1 AS n FROM supplier),
raw_stations AS (
  SELECT 'S' || CAST(k AS VARCHAR) AS station_id,
    CASE WHEN k % 10 = 9 THEN 'Twin St & 1 Ave' ELSE 'W ' || CAST(k AS VARCHAR) || ' St & ' || CAST(nat AS VARCHAR) || ' Ave' END AS name,
    CAST(k AS VARCHAR) || '.01' AS short_name,
    CAST(nat AS VARCHAR) AS region_id,
    CASE WHEN k % 37 = 36 THEN NULL ELSE 40.5::DOUBLE + CAST(k AS DOUBLE) * 0.001::DOUBLE END AS lat,
    CASE WHEN k % 37 = 36 THEN NULL ELSE -74.0::DOUBLE + CAST(k AS DOUBLE) * 0.001::DOUBLE END AS lon,
    CAST(10 + k % 20 + n AS BIGINT) AS capacity,
    'classic' AS station_type,
    CAST(NULL AS VARCHAR) AS rental_uris, ['KEY', 'CREDITCARD'] AS rental_methods, true AS has_kiosk,
    CAST(NULL AS VARCHAR) AS external_id, false AS electric_bike_surcharge_waiver,
    CAST(NULL AS VARCHAR) AS eightd_station_services, false AS eightd_has_key_dispenser,
    CAST(DATE '2024-01-01' + CAST(n AS INTEGER) AS DATE) AS snapshot_date,
    'station_information_' || strftime(CAST(DATE '2024-01-01' + CAST(n AS INTEGER) AS DATE), '%Y-%m-%d') AS batch_id
  FROM sup2),
ev AS (
  SELECT event_id, user_id, value, 0 AS replay, CAST(floor(epoch_us(ts) / 300000000) AS BIGINT) AS b FROM events
  UNION ALL
  SELECT event_id, user_id, value, 1 AS replay, CAST(floor(epoch_us(ts) / 300000000) AS BIGINT) AS b FROM events
  WHERE event_id % 50 = 0),
raw_status AS (
  SELECT
    CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'S999' ELSE 'S' || CAST(user_id % 10 AS VARCHAR) END AS station_id,
    CAST(CASE WHEN event_id % 197 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -1 ELSE CAST(floor(value) AS BIGINT) % 12 END AS BIGINT) AS num_bikes_available,
    CAST(0 AS BIGINT) AS num_bikes_disabled,
    CAST(CASE WHEN event_id % 193 = 0 THEN NULL WHEN event_id % 191 = 0 THEN -2 ELSE 11 - CAST(floor(value) AS BIGINT) % 12 END AS BIGINT) AS num_docks_available,
    CAST(0 AS BIGINT) AS num_docks_disabled,
    CAST(CASE WHEN event_id % 181 = 0 THEN 2 WHEN event_id % 13 = 0 THEN 0 ELSE 1 END AS BIGINT) AS is_installed,
    CAST(CASE WHEN event_id % 179 = 0 THEN 3 ELSE 1 END AS BIGINT) AS is_renting,
    CAST(CASE WHEN event_id % 173 = 0 THEN 5 ELSE 1 END AS BIGINT) AS is_returning,
    b * 300 AS last_reported,
    CASE WHEN event_id % 223 = 0 THEN NULL ELSE CAST(b AS VARCHAR) END AS snapshot_id,
    make_timestamp(b * 300000000) AS poll_time,
    b * 300 AS feed_last_updated,
    CAST(60 AS BIGINT) AS feed_ttl,
    'status.v1' AS kafka_topic,
    CAST(event_id % 3 AS BIGINT) AS kafka_partition,
    CAST(event_id AS BIGINT) AS kafka_offset,
    make_timestamp(b * 300000000 + 1000000 + event_id) AS kafka_timestamp,
    make_timestamp(b * 300000000 + 60000000 + replay * 3600000000) AS ingested_at
  FROM ev),
stg_trip AS (
  SELECT {tws('ride_id')} AS ride_id, {tws('rideable_type')} AS rideable_type, started_at, ended_at,
    {tws('start_station_name')} AS start_station_name, {tws('start_station_id')} AS start_station_id,
    {tws('end_station_name')} AS end_station_name, {tws('end_station_id')} AS end_station_id,
    CAST(start_lat AS DOUBLE) AS start_latitude, CAST(start_lng AS DOUBLE) AS start_longitude,
    CAST(end_lat AS DOUBLE) AS end_latitude, CAST(end_lng AS DOUBLE) AS end_longitude,
    lower({tws('member_casual')}) AS member_casual, source_month, batch_id
  FROM raw_trips2),
stg_station AS (
  SELECT {tws('station_id')} AS station_id, {tws('name')} AS station_name, {tws('short_name')} AS short_name,
    {tws('region_id')} AS region_id, CAST(lat AS DOUBLE) AS latitude, CAST(lon AS DOUBLE) AS longitude,
    capacity, {tws('station_type')} AS station_type, snapshot_date, batch_id
  FROM raw_stations),
stg_status AS (
  SELECT {tws('station_id')} AS station_id, num_bikes_available, num_bikes_disabled, num_docks_available,
    num_docks_disabled, is_installed, is_renting, is_returning, last_reported, {tws('snapshot_id')} AS snapshot_id,
    poll_time, feed_last_updated, feed_ttl, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, ingested_at
  FROM raw_status),
trip_base AS (
  SELECT *, date_diff('minute', started_at, ended_at) AS duration_minutes,
    CAST(started_at AS DATE) AS start_date, CAST(ended_at AS DATE) AS end_date,
    CAST(hour(started_at) AS BIGINT) AS start_hour,
    {_codes(TRIP_REASONS)} AS reason_codes
  FROM stg_trip),
start_rows AS (
  SELECT start_station_id AS code, start_station_name AS name, start_latitude AS lat, start_longitude AS lng,
         count(*) AS trip_rows
  FROM stg_trip WHERE start_station_id IS NOT NULL
  GROUP BY start_station_id, start_station_name, start_latitude, start_longitude),
end_rows AS (
  SELECT end_station_id AS code, end_station_name AS name, end_latitude AS lat, end_longitude AS lng,
         count(*) AS trip_rows
  FROM stg_trip WHERE end_station_id IS NOT NULL
  GROUP BY end_station_id, end_station_name, end_latitude, end_longitude),
variants AS (
  SELECT code, name, lat, lng, CAST(sum(trip_rows) AS BIGINT) AS trip_rows
  FROM (SELECT * FROM start_rows UNION ALL SELECT * FROM end_rows)
  GROUP BY code, name, lat, lng),
dominant AS (
  SELECT code, name, lat, lng, trip_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY trip_rows DESC, name ASC NULLS FIRST,
                                 lat ASC NULLS FIRST, lng ASC NULLS FIRST) AS rn
    FROM variants) WHERE rn = 1),
src AS (
  SELECT *, {code_num('code')} AS code_num, {canon('name')} AS canonical_name FROM dominant),
ref AS (
  SELECT station_id AS station_key, short_name, station_name, latitude, longitude,
         {code_num('short_name')} AS short_num, {canon('station_name')} AS canonical_name
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY snapshot_date DESC NULLS LAST,
                  station_name NULLS FIRST, short_name NULLS FIRST, region_id NULLS FIRST) AS rn
        FROM stg_station
        WHERE station_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL)
  WHERE rn = 1),
exact_c AS (
  SELECT s.code, r.station_key, count(*) OVER (PARTITION BY s.code) AS n
  FROM src s JOIN ref r ON s.code = r.short_name),
exact_m AS (SELECT code, station_key, 'EXACT_SHORT_NAME' AS method FROM exact_c WHERE n = 1),
num_c AS (
  SELECT s.code, r.station_key, count(*) OVER (PARTITION BY s.code) AS n
  FROM src s JOIN ref r ON s.code_num = r.short_num
  WHERE s.code NOT IN (SELECT code FROM exact_m)),
num_m AS (SELECT code, station_key, 'NUMERIC_SHORT_NAME' AS method FROM num_c WHERE n = 1),
geo_c AS (
  SELECT s.code, r.station_key, {hav('s.lat', 's.lng', 'r.latitude', 'r.longitude')} AS distance_m,
         count(*) OVER (PARTITION BY s.code) AS n
  FROM src s JOIN ref r ON s.canonical_name = r.canonical_name
  WHERE s.code NOT IN (SELECT code FROM exact_m UNION SELECT code FROM num_m)
    AND s.lat IS NOT NULL AND s.lng IS NOT NULL),
geo_m AS (SELECT code, station_key, 'NAME_COORDINATE' AS method FROM geo_c WHERE distance_m <= 100 AND n = 1),
matches AS (SELECT * FROM exact_m UNION ALL SELECT * FROM num_m UNION ALL SELECT * FROM geo_m),
identity AS (
  SELECT s.code AS source_station_code, s.name AS source_station_name, s.lat AS source_latitude,
         s.lng AS source_longitude, s.trip_rows, m.station_key, m.method AS mapping_method,
         CASE WHEN m.station_key IS NOT NULL THEN 'MATCHED' ELSE 'UNRESOLVED' END AS mapping_status
  FROM src s LEFT JOIN matches m ON s.code = m.code),
trip_history AS (
  SELECT t.*, si.station_key AS start_station_key, ei.station_key AS end_station_key,
         si.mapping_status AS start_station_mapping_status, ei.mapping_status AS end_station_mapping_status,
         (t.reason_codes = '') AS is_valid_trip
  FROM trip_base t
  LEFT JOIN identity si ON t.start_station_id = si.source_station_code
  LEFT JOIN identity ei ON t.end_station_id = ei.source_station_code),
fct_trip AS (
  SELECT ride_id, rideable_type, started_at, ended_at, start_station_id, end_station_id, start_station_key,
         end_station_key, duration_minutes, start_date, end_date, {dkey('start_date')} AS start_date_key,
         {dkey('end_date')} AS end_date_key, start_hour, start_latitude, start_longitude, end_latitude,
         end_longitude, member_casual, source_month, batch_id
  FROM trip_history WHERE is_valid_trip),
dim_date AS (
  SELECT {dkey('d')} AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
         strftime(d, '%B') AS month_name, isoyear(d) AS iso_year, week(d) AS week, day(d) AS day,
         strftime(d, '%A') AS day_name, dayofweek(d) + 1 AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT CAST(range AS DATE) AS d
        FROM range(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}' + INTERVAL 1 DAY, INTERVAL 1 DAY))),
dim_station AS (
  SELECT station_id AS station_key, station_id, station_name, short_name, region_id, latitude, longitude,
         capacity, station_type, snapshot_date AS last_snapshot_date
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY snapshot_date DESC NULLS LAST,
                  station_name NULLS FIRST, short_name NULLS FIRST, region_id NULLS FIRST,
                  latitude NULLS FIRST, longitude NULLS FIRST, capacity NULLS FIRST) AS rn
        FROM stg_station) WHERE rn = 1),
status_tech AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset
                                 ORDER BY ingested_at ASC NULLS FIRST, station_id NULLS FIRST,
                                 num_bikes_available NULLS FIRST, snapshot_id NULLS FIRST,
                                 poll_time NULLS FIRST, kafka_timestamp NULLS FIRST) AS rn
    FROM stg_status) WHERE rn = 1),
status_logical AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, snapshot_id
                                 ORDER BY poll_time ASC NULLS FIRST, kafka_timestamp ASC NULLS FIRST,
                                 ingested_at ASC NULLS FIRST, num_bikes_available NULLS FIRST,
                                 kafka_offset NULLS FIRST) AS rn
    FROM status_tech) WHERE rn = 1),
status_hist AS (
  SELECT *, {_codes(STATUS_REASONS)} AS reason_codes FROM status_logical),
status_cls AS (
  SELECT *, reason_codes = '' AS is_valid, is_installed = 1 AS is_active_station,
         num_bikes_available = 0 AS is_empty, num_docks_available = 0 AS is_full
  FROM status_hist),
fct_status AS (
  SELECT i.station_id, s.station_key, i.snapshot_id, i.poll_time,
         {dkey('CAST(i.poll_time AS DATE)')} AS observation_date_key, i.last_reported,
         i.num_bikes_available, i.num_bikes_disabled, i.num_docks_available, i.num_docks_disabled,
         i.is_installed, i.is_renting, i.is_returning, i.is_active_station, i.is_empty, i.is_full,
         i.feed_last_updated, i.feed_ttl, i.kafka_topic, i.kafka_partition, i.kafka_offset,
         i.kafka_timestamp, i.ingested_at
  FROM status_cls i LEFT JOIN dim_station s ON i.station_id = s.station_id
  WHERE i.is_valid),
agg_daily AS (
  SELECT f.start_date_key AS date_key, d.full_date, f.member_casual, count(*) AS trip_count,
         CAST(sum(f.duration_minutes) AS BIGINT) AS total_duration_minutes
  FROM fct_trip f JOIN dim_date d ON f.start_date_key = d.date_key
  GROUP BY f.start_date_key, d.full_date, f.member_casual),
act_start AS (
  SELECT start_station_key AS station_key, count(*) AS start_trip_count FROM fct_trip
  WHERE start_station_key IS NOT NULL GROUP BY start_station_key),
act_end AS (
  SELECT end_station_key AS station_key, count(*) AS end_trip_count FROM fct_trip
  WHERE end_station_key IS NOT NULL GROUP BY end_station_key),
agg_activity AS (
  SELECT coalesce(a.station_key, b.station_key) AS station_key, coalesce(a.start_trip_count, 0) AS start_trip_count,
         coalesce(b.end_trip_count, 0) AS end_trip_count,
         coalesce(a.start_trip_count, 0) + coalesce(b.end_trip_count, 0) AS total_trip_activity
  FROM act_start a FULL OUTER JOIN act_end b ON a.station_key = b.station_key),
sd_start AS (
  SELECT start_station_key AS station_key, start_date_key AS date_key, count(*) AS trips_started,
         CAST(sum(duration_minutes) AS BIGINT) AS total_trip_duration_minutes,
         avg(duration_minutes) AS avg_trip_duration_minutes
  FROM fct_trip WHERE start_station_key IS NOT NULL GROUP BY start_station_key, start_date_key),
sd_end AS (
  SELECT end_station_key AS station_key, end_date_key AS date_key, count(*) AS trips_ended
  FROM fct_trip WHERE end_station_key IS NOT NULL GROUP BY end_station_key, end_date_key),
sd_status AS (
  SELECT station_key, observation_date_key AS date_key,
         avg(num_bikes_available) AS avg_bikes_available, min(num_bikes_available) AS min_bikes_available,
         max(num_bikes_available) AS max_bikes_available, avg(num_docks_available) AS avg_docks_available,
         min(num_docks_available) AS min_docks_available, max(num_docks_available) AS max_docks_available,
         count(*) AS status_observations, count_if(is_empty) AS empty_observations,
         count_if(is_full) AS full_observations
  FROM fct_status WHERE station_key IS NOT NULL GROUP BY station_key, observation_date_key),
sd_combined AS (
  SELECT coalesce(a.station_key, e.station_key, s.station_key) AS station_key,
         coalesce(a.date_key, e.date_key, s.date_key) AS date_key,
         a.trips_started, e.trips_ended, a.total_trip_duration_minutes, a.avg_trip_duration_minutes,
         s.avg_bikes_available, s.min_bikes_available, s.max_bikes_available, s.avg_docks_available,
         s.min_docks_available, s.max_docks_available, s.status_observations, s.empty_observations,
         s.full_observations
  FROM sd_start a
  FULL OUTER JOIN sd_end e ON a.station_key = e.station_key AND a.date_key = e.date_key
  FULL OUTER JOIN sd_status s ON coalesce(a.station_key, e.station_key) = s.station_key
                             AND coalesce(a.date_key, e.date_key) = s.date_key),
agg_station_daily AS (
  SELECT c.date_key, d.full_date, c.station_key, s.station_name, s.short_name, s.region_id, s.latitude,
         s.longitude, s.capacity, s.station_type,
         coalesce(c.trips_started, 0) AS trips_started, coalesce(c.trips_ended, 0) AS trips_ended,
         coalesce(c.trips_started, 0) + coalesce(c.trips_ended, 0) AS total_trip_activity,
         c.total_trip_duration_minutes, c.avg_trip_duration_minutes, c.avg_bikes_available,
         c.min_bikes_available, c.max_bikes_available, c.avg_docks_available, c.min_docks_available,
         c.max_docks_available, coalesce(c.status_observations, 0) AS status_observations,
         coalesce(c.empty_observations, 0) AS empty_observations,
         coalesce(c.full_observations, 0) AS full_observations
  FROM sd_combined c JOIN dim_date d ON c.date_key = d.date_key
  LEFT JOIN dim_station s ON c.station_key = s.station_key),
quarantine_trip_t AS (
  SELECT md5(concat_ws('|', coalesce(batch_id, '<NULL>'), coalesce(ride_id, '<NULL>'),
           coalesce(CAST(started_at AS VARCHAR), '<NULL>'), coalesce(CAST(ended_at AS VARCHAR), '<NULL>'),
           coalesce(start_station_id, '<NULL>'), coalesce(end_station_id, '<NULL>'), reason_codes,
           CAST(n AS VARCHAR))) AS quarantine_id,
         batch_id, ride_id, started_at, ended_at, start_station_id, end_station_id, reason_codes,
         CAST(len(string_split(reason_codes, ',')) AS BIGINT) AS rejection_count,
         CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP) AS quarantined_at
  FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, ride_id, started_at, ended_at, start_station_id,
                  end_station_id, reason_codes ORDER BY start_latitude NULLS FIRST, start_longitude NULLS FIRST,
                  end_latitude NULLS FIRST, end_longitude NULLS FIRST, member_casual NULLS FIRST,
                  source_month NULLS FIRST) AS n
        FROM trip_history WHERE NOT is_valid_trip)),
quarantine_status_t AS (
  SELECT md5(concat(coalesce(station_id, '<NULL>'), '|', coalesce(snapshot_id, '<NULL>'), '|',
           coalesce(kafka_topic, '<NULL>'), '|', CAST(coalesce(kafka_partition, -1) AS VARCHAR), '|',
           CAST(coalesce(kafka_offset, -1) AS VARCHAR))) AS quarantine_id,
         station_id, snapshot_id, last_reported, poll_time, kafka_topic, kafka_partition, kafka_offset,
         reason_codes, CAST(len(string_split(reason_codes, ',')) AS BIGINT) AS rejection_count,
         poll_time AS invalid_at
  FROM status_cls WHERE NOT is_valid)
"""


def q(select: str) -> str:
    return "WITH" + BASE_CTES + select


CHECK_TABLES = {
    "stg_trip_history": "stg_trip", "stg_station_information": "stg_station", "stg_station_status": "stg_status",
    "int_station_identity": "identity", "int_trip_history": "trip_history", "int_quarantine_trip": "quarantine_trip_t",
    "int_station_status": "status_cls", "int_quarantine_station_status": "quarantine_status_t",
    "dim_date": "dim_date", "dim_station": "dim_station", "fct_trip": "fct_trip", "fct_station_status": "fct_status",
}


def _lit(v):
    return "'" + str(v).replace("'", "''") + "'"


def check_sql(specs) -> str:
    """One SELECT per check, UNION ALL; counts as in the warehouse's tests."""
    parts = []
    for c in specs:
        t = CHECK_TABLES[c.table]
        head = f"SELECT {_lit(c.table)} AS \"table\", {_lit(c.column)} AS \"column\", {_lit(c.check)} AS \"check\", "
        if c.check == "not_null":
            body = f"CAST(count(*) FILTER (WHERE {c.column} IS NULL) AS BIGINT) AS failures FROM {t}"
        elif c.check == "accepted_values":
            vals = ", ".join(_lit(v) for v in c.values)
            body = f"CAST(count(*) FILTER (WHERE {c.column} IS NOT NULL AND {c.column} NOT IN ({vals})) AS BIGINT) AS failures FROM {t}"
        elif c.check == "unique":
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL "
                    f"GROUP BY {c.column} HAVING count(*) > 1)")
        elif c.check == "relationships":
            p = CHECK_TABLES[c.to]
            body = (f"CAST(count(*) AS BIGINT) AS failures FROM {t} ch LEFT JOIN (SELECT DISTINCT {c.field} AS k FROM {p}) pa "
                    f"ON ch.{c.column} = pa.k WHERE ch.{c.column} IS NOT NULL AND pa.k IS NULL")
        else:
            keys = ", ".join(c.keys)
            body = f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {keys} FROM {t} GROUP BY {keys} HAVING count(*) > 1)"
        parts.append(head + body)
    return q("\nUNION ALL\n".join(parts))


_INT = "('BIGINT', 'UBIGINT')"


def _is_int(x):
    return f"coalesce({x} IN {_INT}, false)"


FEED_CTES = f"""
fr AS (
  SELECT event_id AS eid, user_id AS uid, ts, CAST(event_id + 1700000000 AS VARCHAR) AS lu,
         CAST(floor(value) AS BIGINT) AS fv
  FROM events),
fr2 AS (
  SELECT *,
    CASE WHEN eid % 31 = 0 THEN '5' ELSE '{{"station_id": '
      || (CASE WHEN eid % 37 = 0 THEN '"  "' WHEN eid % 71 = 0 THEN '123' ELSE '"S' || CAST(uid % 10 AS VARCHAR) || '"' END)
      || ', "num_bikes_available": ' || (CASE WHEN eid % 43 = 0 THEN '5.0' ELSE CAST(fv % 12 AS VARCHAR) END)
      || (CASE WHEN eid % 53 = 0 THEN '' ELSE ', "num_bikes_disabled": 0' END)
      || ', "num_docks_available": ' || (CASE WHEN eid % 47 = 0 THEN '"5"' ELSE CAST(11 - fv % 12 AS VARCHAR) END)
      || (CASE WHEN eid % 59 = 0 THEN ', "num_docks_disabled": null' WHEN eid % 61 = 0 THEN ', "num_docks_disabled": "x"'
               ELSE ', "num_docks_disabled": 0' END)
      || ', "is_installed": 1, "is_renting": 1, "is_returning": ' || (CASE WHEN eid % 41 = 0 THEN 'true' ELSE '1' END)
      || ', "last_reported": ' || (CASE WHEN eid % 67 = 0 THEN '99999999999999999999' ELSE lu END) || '}}' END AS first_el,
    '{{"station_id": "S' || CAST((uid + 1) % 10 AS VARCHAR) || '", "num_bikes_available": 3, "num_bikes_disabled": 0, '
      || '"num_docks_available": 8, "num_docks_disabled": 0, "is_installed": 1, "is_renting": 1, "is_returning": 1, '
      || '"last_reported": ' || lu || '}}' AS second_el
  FROM fr),
feed_resp AS (
  SELECT 'feed://station_status/' || CAST(eid % 3 AS VARCHAR) AS source_url,
    CAST(CASE WHEN eid % 139 = 0 THEN 404 WHEN eid % 149 = 0 THEN 503 WHEN eid % 151 = 0 THEN NULL ELSE 200 END AS INTEGER) AS http_status,
    CASE WHEN eid % 101 = 0 THEN 'not json {{' WHEN eid % 103 = 0 THEN 'null' WHEN eid % 107 = 0 THEN '[1, 2]'
      ELSE '{{"last_updated": ' || (CASE WHEN eid % 131 = 0 THEN 'true' ELSE lu END)
        || ', "ttl": ' || (CASE WHEN eid % 127 = 0 THEN '"60"' ELSE '60' END)
        || ', "data": ' || (CASE WHEN eid % 109 = 0 THEN '"x"' ELSE '{{"stations": '
          || (CASE WHEN eid % 113 = 0 THEN '{{"a": 1}}' WHEN eid % 137 = 0 THEN '[]'
                   ELSE '[' || first_el || ', ' || second_el || ']' END) || '}}' END) || '}}' END AS body,
    ts AS fetched_at
  FROM fr2),
feed_j AS (SELECT *, CASE WHEN json_valid(body) THEN body END AS j FROM feed_resp),
feed_env AS (
  SELECT *,
    CASE WHEN http_status IS NULL OR http_status >= 400 THEN 'SKIPPED'
         WHEN j IS NULL AND NOT (http_status BETWEEN 200 AND 299) THEN 'SKIPPED'
         WHEN j IS NULL OR json_type(j) = 'NULL' THEN 'INVALID_JSON'
         WHEN coalesce(json_type(j, '$.data'), '') <> 'OBJECT' THEN 'INVALID_FEED_STRUCTURE'
         WHEN coalesce(json_type(j, '$.data.stations'), '') <> 'ARRAY' THEN 'INVALID_STATION_DATA'
         WHEN NOT ({_is_int("json_type(j, '$.last_updated')")} AND {_is_int("json_type(j, '$.ttl')")}) THEN 'INVALID_FEED_METADATA'
    END AS feed_error,
    strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS fetched_iso
  FROM feed_j),
feed_el AS (
  SELECT source_url, http_status, fetched_iso, CAST(json_extract(j, '$.last_updated') AS BIGINT) AS feed_last_updated,
         CAST(json_extract(j, '$.ttl') AS BIGINT) AS feed_ttl, unnest(json_extract(j, '$.data.stations[*]')) AS e
  FROM feed_env WHERE feed_error IS NULL),
feed_el2 AS (
  SELECT *,
    coalesce(json_type(e) = 'OBJECT' AND json_type(e, '$.station_id') = 'VARCHAR'
             AND trim(json_extract_string(e, '$.station_id'), {ID_BLANKS}) <> ''
             AND {_is_int("json_type(e, '$.last_reported')")} AND {_is_int("json_type(e, '$.num_bikes_available')")}
             AND {_is_int("json_type(e, '$.num_docks_available')")} AND {_is_int("json_type(e, '$.is_installed')")}
             AND {_is_int("json_type(e, '$.is_renting')")} AND {_is_int("json_type(e, '$.is_returning')")}
             AND (json_type(e, '$.num_bikes_disabled') IS NULL OR json_type(e, '$.num_bikes_disabled') = 'NULL'
                  OR {_is_int("json_type(e, '$.num_bikes_disabled')")})
             AND (json_type(e, '$.num_docks_disabled') IS NULL OR json_type(e, '$.num_docks_disabled') = 'NULL'
                  OR {_is_int("json_type(e, '$.num_docks_disabled')")}), false) AS valid
  FROM feed_el)
"""



def _sorted_json(x: str) -> str:
    """A JSON value without blanks, an object's keys in order (two levels, as the feed has below an element)."""
    pairs = f"list_transform(list_sort(json_keys({x})), lambda k: '\"' || k || '\":' || CAST(json_extract({x}, '$.\"' || k || '\"') AS VARCHAR))"
    return f"CASE WHEN json_type({x}) = 'OBJECT' THEN '{{' || array_to_string({pairs}, ',') || '}}' ELSE CAST({x} AS VARCHAR) END"


# the rejected part of a response, cut to 1,000 characters
_STATIONS = (f"CASE WHEN json_type(j, '$.data.stations') = 'ARRAY' THEN '[' || array_to_string(list_transform(json_extract(j, '$.data.stations[*]'), "
             f"lambda e: {_sorted_json('e')}), ',') || ']' ELSE {_sorted_json("json_extract(j, '$.data.stations')")} END")
_DATA = f"CASE WHEN json_type(j, '$.data') = 'OBJECT' THEN '{{\"stations\":' || {_STATIONS} || '}}' ELSE CAST(json_extract(j, '$.data') AS VARCHAR) END"
_BODY = (f"CASE WHEN json_type(j) = 'OBJECT' THEN '{{\"data\":' || {_DATA} || ',\"last_updated\":' || CAST(json_extract(j, '$.last_updated') AS VARCHAR) "
         f"|| ',\"ttl\":' || CAST(json_extract(j, '$.ttl') AS VARCHAR) || '}}' ELSE CAST(json_extract(j, '$') AS VARCHAR) END")
# the variant writes a number such as 5.0 as 5
FEED_DLQ_SQL = f"""
SELECT * REPLACE (regexp_replace(raw_body_snippet, ':([0-9]+)[.]0([,}}])', ':\\1\\2', 'g') AS raw_body_snippet) FROM (
SELECT fetched_iso AS failed_at, source_url, http_status, feed_error AS error_type,
  left(CASE WHEN feed_error = 'INVALID_JSON' THEN CASE WHEN j IS NULL THEN body END
       WHEN feed_error = 'INVALID_STATION_DATA' THEN {_DATA} ELSE {_BODY} END, 1000) AS raw_body_snippet
FROM (SELECT * REPLACE (CAST(j AS JSON) AS j) FROM feed_env) WHERE feed_error IS NOT NULL AND feed_error <> 'SKIPPED'
UNION ALL SELECT fetched_iso, source_url, http_status, 'INVALID_STATION_RECORD', left({_sorted_json('e')}, 1000) FROM feed_el2 WHERE NOT valid)"""

FEED_MESSAGES = {
    "INVALID_JSON": "Station status response is not valid JSON.",
    "INVALID_FEED_STRUCTURE": "Response data is not an object.",
    "INVALID_STATION_DATA": "data.stations is not a list.",
    "INVALID_FEED_METADATA": "last_updated or ttl has an invalid type.",
    "INVALID_STATION_RECORD": "Station record is missing required fields or has invalid types.",
}
FEED_MSG_SQL = "CASE error_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEED_MESSAGES.items()) + " END"


def qf(select: str) -> str:
    return "WITH" + FEED_CTES + select


def status_model(where: str) -> str:
    """int_station_status over the staged rows matching ``where`` (a run)."""
    return f"""(
  SELECT *, reason_codes = '' AS is_valid, is_installed = 1 AS is_active_station,
         num_bikes_available = 0 AS is_empty, num_docks_available = 0 AS is_full
  FROM (SELECT *, {_codes(STATUS_REASONS)} AS reason_codes FROM (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY station_id, snapshot_id
                                   ORDER BY poll_time ASC NULLS FIRST, kafka_timestamp ASC NULLS FIRST,
                                   ingested_at ASC NULLS FIRST, num_bikes_available NULLS FIRST,
                                   kafka_offset NULLS FIRST) AS rn
      FROM (SELECT * EXCLUDE (rn) FROM (
              SELECT *, row_number() OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset
                                           ORDER BY ingested_at ASC NULLS FIRST, station_id NULLS FIRST,
                                           num_bikes_available NULLS FIRST, snapshot_id NULLS FIRST,
                                           poll_time NULLS FIRST, kafka_timestamp NULLS FIRST) AS rn
              FROM stg_status WHERE {where}) WHERE rn = 1))
    WHERE rn = 1)))"""
