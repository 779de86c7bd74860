"""Independent SQL (DuckDB dialect) for every registered query.

These statements are the correctness check, written from the rules rather
than from the Spark code: the validity of each payload comes from a CASE on
``event_id`` (no JSON parser), trips from a plain FULL OUTER JOIN, sliding
windows from a per-trip fan-out, and the gauge from a brute-force range
join of ticks and trips. Views ``events lineitem orders customer supplier
nation region`` are expected to exist.
"""

from __future__ import annotations

from tripcast.config import DEFAULT_RULES

R = DEFAULT_RULES
US = 1_000_000


def _pickup_json(trip_id="'\"' || trip_id || '\"'", event_type="'\"pickup\"'",
                 when="'\"' || strftime(pickup_ts, '%Y-%m-%dT%H:%M:%S') || '\"'",
                 zone="CAST(pickup_zone AS VARCHAR)", pc="CAST(passenger_count AS VARCHAR)", with_zone=True):
    parts = [f"'{{\"trip_id\":' || {trip_id}", f"',\"event_type\":' || {event_type}",
             f"',\"pickup_datetime\":' || {when}"]
    if with_zone:
        parts.append(f"',\"pickup_zone\":' || {zone}")
    parts.append(f"',\"passenger_count\":' || {pc} || '}}'")
    return " || ".join(parts)


def _dropoff_json(zone="CAST(dropoff_zone AS VARCHAR)", dist="CAST(trip_distance AS VARCHAR)",
                  amt="CAST(total_amount AS VARCHAR)"):
    return (
        "'{\"trip_id\":\"' || trip_id || '\",\"event_type\":\"dropoff\",\"dropoff_datetime\":\"' || "
        "strftime(dropoff_ts, '%Y-%m-%dT%H:%M:%S') || '\",\"dropoff_zone\":' || " + zone +
        " || ',\"trip_distance\":' || " + dist + " || ',\"total_amount\":' || " + amt + " || '}'"
    )


def _ceil_minute(x: str) -> str:
    return f"date_trunc('minute', {x} + INTERVAL 59999999 MICROSECOND)"


def trip_ctes(close: str = "watermark", suffix: str = "") -> str:
    """CTEs a, ppay, dpay, vp, vd, bnd, gm, trips, zones, enriched (names get ``suffix``)."""
    s = suffix
    released = (lambda t: "TRUE") if close == "all" else (lambda t: f"{t} + INTERVAL 48 HOUR < (SELECT b FROM bnd{s})")
    timeout_us = R.timeout_seconds * US
    pick_clean = _pickup_json()
    return f"""
a{s} AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS trip_id,
         date_trunc('second', ts) AS pickup_ts,
         date_trunc('second', ts) + to_seconds(CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 89 = 0 THEN 10800
              WHEN event_id % 83 = 0 THEN 10801 WHEN event_id % 79 = 0 THEN 259200
              ELSE 60 + (event_id * 37) % 5400 END) AS dropoff_ts,
         CAST(user_id % 27 AS INTEGER) AS pickup_zone,
         CAST((user_id * 7 + event_id) % 27 AS INTEGER) AS dropoff_zone,
         CAST(CASE WHEN event_id % 101 = 0 THEN 9 ELSE 1 + event_id % 8 END AS INTEGER) AS passenger_count,
         CAST(10 + event_id % 2000 AS DOUBLE) / 100.0 AS trip_distance,
         value AS total_amount,
         event_id % 71 <> 0 AS has_pickup, event_id % 73 <> 0 AS has_dropoff,
         event_id % 50 AS r
  FROM events),
ppay{s} AS (
  SELECT *,
    CASE r WHEN 0 THEN '{{not json' WHEN 9 THEN {pick_clean} || ' x' WHEN 1 THEN '[1]'
      WHEN 2 THEN {_pickup_json(event_type="'\"trip\"'")}
      WHEN 3 THEN {_pickup_json(trip_id="'null'")}
      WHEN 8 THEN {_pickup_json(with_zone=False)}
      WHEN 4 THEN {_pickup_json(when="'\"yesterday\"'")}
      WHEN 5 THEN {_pickup_json(zone="'\"' || CAST(pickup_zone AS VARCHAR) || '\"'")}
      WHEN 6 THEN {_pickup_json(pc="'9'")}
      WHEN 7 THEN {_pickup_json(pc="'\"' || CAST(passenger_count AS VARCHAR) || '\"'")}
      ELSE {pick_clean} END AS raw_payload,
    CASE WHEN r IN (0, 9) THEN 'invalid_json' WHEN r = 1 THEN 'not_a_json_object'
      WHEN r = 2 THEN 'unexpected_event_type' WHEN r = 3 THEN 'missing_trip_id'
      WHEN r = 8 THEN 'missing_pickup_zone' WHEN r = 4 THEN 'invalid_timestamp'
      WHEN r = 5 THEN 'invalid_zone'
      WHEN r IN (6, 7) OR event_id % 101 = 0 THEN 'invalid_passenger_count' END AS reason
  FROM a{s} WHERE has_pickup),
dpay{s} AS (
  SELECT *,
    CASE r WHEN 10 THEN {_dropoff_json(dist="'-1.0'")} WHEN 11 THEN {_dropoff_json(amt="'0.0'")}
      WHEN 12 THEN {_dropoff_json(dist="'true'")} WHEN 13 THEN {_dropoff_json(zone="'5.0'")}
      WHEN 14 THEN {_dropoff_json(zone="'true'")} ELSE {_dropoff_json()} END AS raw_payload,
    CASE WHEN r = 13 THEN 'invalid_zone'
      WHEN r IN (10, 12) OR trip_distance <= 0 THEN 'invalid_trip_distance'
      WHEN r = 11 OR total_amount <= 0 THEN 'invalid_total_amount' END AS reason
  FROM a{s} WHERE has_dropoff),
vp{s} AS (SELECT trip_id, pickup_ts AS p_t, pickup_zone AS p_zone, CAST(passenger_count AS DOUBLE) AS p_pc
        FROM ppay{s} WHERE reason IS NULL),
vd{s} AS (SELECT trip_id, dropoff_ts AS d_t, CASE WHEN r = 14 THEN 1 ELSE dropoff_zone END AS d_zone,
               trip_distance AS d_dist, total_amount AS d_amt
        FROM dpay{s} WHERE reason IS NULL),
bnd{s} AS (SELECT least((SELECT max(p_t) FROM vp{s}), (SELECT max(d_t) FROM vd{s})) - INTERVAL 30 SECOND AS b),
gm{s} AS (
  SELECT coalesce(vp{s}.trip_id, vd{s}.trip_id) AS trip_id, p_t, p_zone, p_pc, d_t, d_zone, d_dist, d_amt,
         epoch_us(d_t) - epoch_us(p_t) AS gap_us,
         coalesce(abs(epoch_us(d_t) - epoch_us(p_t)) <= {timeout_us}, FALSE) AS matched
  FROM vp{s} FULL OUTER JOIN vd{s} ON vp{s}.trip_id = vd{s}.trip_id),
trips{s} AS (
  SELECT trip_id, p_zone AS pickup_zone, d_zone AS dropoff_zone, p_t AS pickup_datetime, d_t AS dropoff_datetime,
         CAST(gap_us AS DOUBLE) / 1000000.0 AS duration_seconds, d_dist AS trip_distance,
         p_pc AS passenger_count, d_amt AS total_amount,
         CASE WHEN gap_us <= 0 THEN 'non_positive_duration'
              WHEN CAST(gap_us AS DOUBLE) / 1000000.0 > {R.max_duration_seconds} THEN 'duration_over_3h' END AS invalid_reason,
         d_t AS event_time
  FROM gm{s} WHERE matched
  UNION ALL
  SELECT trip_id, p_zone, NULL, p_t, NULL, NULL, NULL, p_pc, NULL, 'missing_dropoff', p_t + INTERVAL 48 HOUR
  FROM gm{s} WHERE p_t IS NOT NULL AND NOT matched AND {released('p_t')}
  UNION ALL
  SELECT trip_id, NULL, d_zone, NULL, d_t, NULL, d_dist, NULL, d_amt, 'missing_pickup', d_t + INTERVAL 48 HOUR
  FROM gm{s} WHERE d_t IS NOT NULL AND NOT matched AND {released('d_t')}),
zones{s} AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
         'Zone ' || CAST(r_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey),
enriched{s} AS (
  SELECT t.*, coalesce(z.borough, 'Unknown') AS dropoff_borough,
         CASE WHEN hour(t.dropoff_datetime) >= 5 AND hour(t.dropoff_datetime) < 11 THEN 'morning'
              WHEN hour(t.dropoff_datetime) >= 11 AND hour(t.dropoff_datetime) < 14 THEN 'noon'
              WHEN hour(t.dropoff_datetime) >= 14 AND hour(t.dropoff_datetime) < 17 THEN 'afternoon'
              WHEN hour(t.dropoff_datetime) >= 17 AND hour(t.dropoff_datetime) < 23 THEN 'evening'
              ELSE 'night' END AS time_of_day
  FROM trips{s} t LEFT JOIN zones{s} z ON t.dropoff_zone = z.location_id
  WHERE t.invalid_reason IS NULL)"""


def _stats(src: str, ws: str, we: str, dim: str, extra_from: str = "") -> str:
    dec = "DECIMAL(38,10)"
    return f"""SELECT {ws} AS window_start, {we} AS window_end, {dim} AS dimension, count(*) AS trips,
  sum(CAST(passenger_count AS {dec})) AS passengers, sum(CAST(trip_distance AS {dec})) AS distance,
  sum(CAST(total_amount AS {dec})) AS revenue FROM {src} {extra_from} GROUP BY 1, 2, 3"""


def metric_ctes(close: str = "watermark", s: str = "") -> str:
    """CTEs st_borough, st_tod, st_week, st_hour (closed windows only) and metrics."""
    keep = "TRUE" if close == "all" else f"window_end <= (SELECT b FROM bnd{s})"
    day = "date_trunc('day', event_time)"
    week = "date_trunc('week', event_time)"
    hour_ws = "time_bucket(INTERVAL 5 MINUTE, event_time) - to_minutes(5 * k.range)"
    count = "CAST(trips AS DOUBLE)"

    def avg(c):
        return f"CAST({c} AS DOUBLE) / CAST(trips AS DOUBLE)"

    def rows(st, name, value):
        return f"SELECT '{name}' AS metric_name, window_start, window_end, dimension, {value} AS value FROM {st}{s}"

    return f""",
st_borough{s} AS (SELECT * FROM ({_stats(f'enriched{s}', day, day + ' + INTERVAL 1 DAY', 'dropoff_borough')}) WHERE {keep}),
st_tod{s} AS (SELECT * FROM ({_stats(f'enriched{s}', day, day + ' + INTERVAL 1 DAY', 'time_of_day')}) WHERE {keep}),
st_week{s} AS (SELECT window_start, window_end, strftime(window_start, '%G-W%V') AS dimension, trips, passengers, distance, revenue
  FROM ({_stats(f'enriched{s}', week, week + ' + INTERVAL 7 DAY', "'w'")}) WHERE {keep}),
st_hour{s} AS (SELECT * FROM ({_stats(f'enriched{s}', hour_ws, hour_ws + ' + INTERVAL 1 HOUR', "'all'", 'CROSS JOIN range(12) k')}) WHERE {keep}),
metrics{s} AS (
  {rows('st_borough', 'trip_count_by_borough', count)}
  UNION ALL {rows('st_borough', 'avg_passengers_by_borough', avg('passengers'))}
  UNION ALL {rows('st_borough', 'avg_distance_by_borough', avg('distance'))}
  UNION ALL {rows('st_tod', 'trip_count_by_time_of_day', count)}
  UNION ALL {rows('st_tod', 'avg_passengers_by_time_of_day', avg('passengers'))}
  UNION ALL {rows('st_tod', 'avg_distance_by_time_of_day', avg('distance'))}
  UNION ALL {rows('st_week', 'trips_per_week', count)}
  UNION ALL {rows('st_week', 'revenue_by_week', 'CAST(revenue AS DOUBLE)')}
  UNION ALL {rows('st_week', 'revenue_per_mile_by_week', 'CASE WHEN distance > 0 THEN CAST(revenue AS DOUBLE) / CAST(distance AS DOUBLE) ELSE 0.0 END')}
  UNION ALL {rows('st_hour', 'avg_price_last_h', avg('revenue'))}
  UNION ALL {rows('st_hour', 'revenue_last_h', 'CAST(revenue AS DOUBLE)')}
  UNION ALL {rows('st_hour', 'trips_last_h', count)}),
gp{s} AS (SELECT vp{s}.trip_id, p_t, d_t FROM vp{s} LEFT JOIN vd{s} ON vp{s}.trip_id = vd{s}.trip_id),
glim{s} AS (SELECT {_ceil_minute(f'(SELECT min(p_t) FROM gp{s})')} AS first_t,
  {"(SELECT max(date_trunc('minute', p_t + INTERVAL 3 HOUR)) FROM gp" + s + ")" if close == "all" else f"date_trunc('minute', (SELECT b FROM bnd{s}) - INTERVAL 1 MICROSECOND)"} AS last_t),
ticks{s} AS (SELECT generate_series AS t FROM glim{s}, generate_series(glim{s}.first_t, glim{s}.last_t, INTERVAL 1 MINUTE)),
gauge{s} AS (
  SELECT 'open_trips' AS metric_name, t - INTERVAL 3 HOUR AS window_start, t AS window_end, 'all' AS dimension,
         CAST(count(*) FILTER (d_t IS NULL OR d_t > t OR d_t < p_t - INTERVAL 3 HOUR) AS DOUBLE) AS value
  FROM ticks{s} JOIN gp{s} ON gp{s}.p_t <= ticks{s}.t AND gp{s}.p_t >= ticks{s}.t - INTERVAL 3 HOUR
  GROUP BY t),
aggregates{s} AS (SELECT * FROM metrics{s} UNION ALL SELECT * FROM gauge{s})"""


def all_ctes(close: str = "watermark", s: str = "") -> str:
    return trip_ctes(close, s) + metric_ctes(close, s)


def with_trips(body: str, close: str = "watermark") -> str:
    return "WITH " + all_ctes(close) + "\n" + body


RAW_B = """
rawb AS (
  SELECT CASE WHEN l_orderkey % 113 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS pickup_datetime,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
         CASE WHEN l_orderkey % 109 = 0 THEN CAST(9 AS DOUBLE) ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
         CASE WHEN l_orderkey % 101 = 0 THEN CAST(NULL AS DOUBLE) WHEN l_orderkey % 103 = 0 THEN CAST(0 AS DOUBLE)
              ELSE l_quantity END AS trip_distance,
         CASE WHEN l_orderkey % 107 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) END AS total_amount,
         CAST(c_nationkey AS DOUBLE) AS pickup_location_id, CAST(s_nationkey AS DOUBLE) AS dropoff_location_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey),
vz AS (SELECT DISTINCT CAST(n_nationkey AS INTEGER) AS location_id FROM nation WHERE n_nationkey < 20),
cb AS (
  SELECT rawb.*, TRY_CAST(pickup_datetime AS TIMESTAMP) AS pickup_ts, TRY_CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_ts,
         TRY_CAST(trunc(pickup_location_id) AS INTEGER) AS pz, TRY_CAST(trunc(dropoff_location_id) AS INTEGER) AS dz
  FROM rawb),
cr AS (
  SELECT cb.*, CASE
    WHEN pickup_ts IS NULL OR dropoff_ts IS NULL OR passenger_count IS NULL OR isnan(passenger_count)
      OR trip_distance IS NULL OR isnan(trip_distance) OR total_amount IS NULL OR isnan(total_amount)
      OR pickup_location_id IS NULL OR isnan(pickup_location_id)
      OR dropoff_location_id IS NULL OR isnan(dropoff_location_id) THEN 'missing_values'
    WHEN pickup_ts >= dropoff_ts THEN 'time_order'
    WHEN trip_distance <= 0 THEN 'distance'
    WHEN total_amount <= 0 THEN 'price'
    WHEN NOT (passenger_count BETWEEN 1 AND 8) THEN 'passengers'
    WHEN pz NOT IN (SELECT location_id FROM vz) OR dz NOT IN (SELECT location_id FROM vz)
      OR pz IS NULL OR dz IS NULL THEN 'invalid_zones' END AS reason
  FROM cb)"""

RAW_COLS = ("pickup_datetime, dropoff_datetime, passenger_count, trip_distance, total_amount, "
            "pickup_location_id, dropoff_location_id")
TRIP_COLS = ("trip_id, pickup_zone, dropoff_zone, pickup_datetime, dropoff_datetime, duration_seconds, "
             "trip_distance, passenger_count, total_amount, invalid_reason IS NULL AS is_valid, invalid_reason, event_time")


def _metric(name: str) -> str:
    return with_trips(f"SELECT * FROM metrics WHERE metric_name = '{name}'")


FIRST_INVALID = """
inv_first AS (
  SELECT * FROM trips WHERE invalid_reason IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY event_time, invalid_reason) = 1)"""


_LINEITEM_TEXT = ", ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (
    "l_discount", "l_extendedprice", "l_linenumber", "l_linestatus", "l_orderkey", "l_partkey",
    "l_quantity", "l_returnflag", "l_shipdate", "l_suppkey", "l_tax"))


_NAMED = f"""WITH {RAW_B},
named(slice_no, lo, hi) AS (VALUES (1, DATE '1995-03-09', DATE '1995-06-30'), (2, DATE '1996-02-27', DATE '1996-03-01'),
  (3, DATE '1997-12-31', DATE '1998-01-01'), (9, DATE '2031-01-01', DATE '2031-12-31'))
SELECT {RAW_COLS}, CAST(slice_no AS INTEGER) AS slice_no FROM rawb JOIN named
  ON TRY_CAST(pickup_datetime AS TIMESTAMP) >= lo AND TRY_CAST(pickup_datetime AS TIMESTAMP) < hi + INTERVAL 1 DAY"""


def oracle_sql() -> dict[str, str]:
    from tripcast.plans.queries import METRIC_IDS

    q = {
        "s1_zone_scan": """SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
       'Zone ' || CAST(r_regionkey AS VARCHAR) AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "s2_raw_trips": f"WITH {RAW_B} SELECT {RAW_COLS} FROM rawb",
        "s3_date_slices": f"""WITH {RAW_B} SELECT {RAW_COLS},
  CAST(year(TRY_CAST(pickup_datetime AS TIMESTAMP)) - 1994 AS INTEGER) AS slice_no FROM rawb
  WHERE TRY_CAST(pickup_datetime AS TIMESTAMP) IS NOT NULL""",
        "s3_named_slices": _NAMED,
        "s3_table_slices": _NAMED,
        "s4_ordered_trips": f"""WITH {RAW_B} SELECT pickup_ts AS pickup_datetime, dropoff_ts AS dropoff_datetime,
  pz AS pickup_zone, dz AS dropoff_zone, CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
  CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(total_amount AS DOUBLE) AS total_amount
  FROM cr WHERE reason IS NULL ORDER BY pickup_ts""",
        "s7_valid_zone_ids": "SELECT DISTINCT CAST(n_nationkey AS INTEGER) AS location_id FROM nation",
        "v1_clean_reasons": f"WITH {RAW_B} SELECT {RAW_COLS}, reason FROM cr",
        "v2_coerced_times": f"WITH {RAW_B} SELECT pickup_datetime, dropoff_datetime, pickup_ts, dropoff_ts FROM cr",
        "v3_raw_trips": f"""WITH {RAW_B} SELECT pickup_ts AS pickup_datetime, dropoff_ts AS dropoff_datetime,
  pz AS pickup_zone, dz AS dropoff_zone, CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
  CAST(total_amount AS DOUBLE) AS total_amount, CAST(trip_distance AS DOUBLE) AS trip_distance
  FROM cr WHERE reason IS NULL""",
        "v4_load_summary": f"""WITH {RAW_B}
  SELECT 'processed' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS rows FROM cr
  UNION ALL SELECT 'inserted', NULL, count(*) FROM cr WHERE reason IS NULL
  UNION ALL SELECT 'rejected', NULL, count(*) FROM cr WHERE reason IS NOT NULL
  UNION ALL SELECT 'rejected', reason, count(*) FROM cr WHERE reason IS NOT NULL GROUP BY reason""",
        "j5_zone_semi": f"WITH {RAW_B} SELECT {RAW_COLS} FROM cb WHERE pz IN (SELECT location_id FROM vz) AND dz IN (SELECT location_id FROM vz)",
        "j5_zone_anti": f"""WITH {RAW_B} SELECT {RAW_COLS} FROM cb
  WHERE pz IS NULL OR dz IS NULL OR pz NOT IN (SELECT location_id FROM vz) OR dz NOT IN (SELECT location_id FROM vz)""",
        "o3_trip_ids": f"""
SELECT l_orderkey, l_linenumber, sha256(row || '#' || (row_number() OVER (PARTITION BY row) - 1)) AS trip_id
FROM (SELECT *, concat_ws('#', {_LINEITEM_TEXT}) AS row FROM lineitem)""",
        "o2_replay_positions": with_trips(f"""
  SELECT row_number() OVER (ORDER BY event_time, kind_rank, key) - 1 AS sequence, topic, key, event_time FROM (
    SELECT '{R.pickup_topic}' AS topic, trip_id AS key, pickup_ts AS event_time, 1 AS kind_rank FROM ppay
    UNION ALL SELECT '{R.dropoff_topic}', trip_id, dropoff_ts, 0 FROM dpay)"""),
        "o2_event_log": with_trips(f"""
  SELECT '{R.pickup_topic}' AS topic, trip_id AS key, pickup_ts AS event_time, 1 AS kind_rank, raw_payload AS value FROM ppay
  UNION ALL
  SELECT '{R.dropoff_topic}', trip_id, dropoff_ts, 0, raw_payload FROM dpay"""),
        "v6_pickup_reasons": with_trips("SELECT raw_payload, reason FROM ppay"),
        "v6_dropoff_reasons": with_trips("SELECT raw_payload, reason FROM dpay"),
        "v6_reason_counts": with_trips(f"""
  SELECT coalesce(reason, 'ok') AS reason, count(*) AS events, '{R.pickup_topic}' AS topic FROM ppay GROUP BY 1
  UNION ALL SELECT coalesce(reason, 'ok'), count(*), '{R.dropoff_topic}' FROM dpay GROUP BY 1"""),
        "v8_valid_pickups": with_trips("SELECT trip_id, p_t AS event_time, p_zone AS pickup_zone, p_pc AS passenger_count FROM vp"),
        "v8_valid_dropoffs": with_trips("SELECT trip_id, d_t AS event_time, d_zone AS dropoff_zone, d_dist AS trip_distance, d_amt AS total_amount FROM vd"),
        "u1_rejected_union": with_trips(f"""
  SELECT '{R.pickup_topic}' AS topic, reason, raw_payload FROM ppay WHERE reason IS NOT NULL
  UNION ALL SELECT '{R.dropoff_topic}', reason, raw_payload FROM dpay WHERE reason IS NOT NULL"""),
        "t13_lifecycle": with_trips("""
  SELECT 'pickup' AS signal, trip_id, p_t AS event_time FROM vp
  UNION ALL SELECT 'dropoff', trip_id, d_t FROM vd"""),
        "j1_trips": with_trips(f"SELECT {TRIP_COLS} FROM trips"),
        "j1_trips_all_released": with_trips(f"SELECT {TRIP_COLS} FROM trips", close="all"),
        "j1_repeated_events": f"""WITH RECURSIVE {trip_ctes("all")},
ev AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t, side, zone, pc, dist, amt) AS i FROM (
  SELECT CAST(event_id // 4 AS VARCHAR) AS id, 0 AS side, pickup_ts AS t, pickup_zone AS zone, CAST(passenger_count AS DOUBLE) AS pc,
         CAST(NULL AS DOUBLE) AS dist, CAST(NULL AS DOUBLE) AS amt FROM a WHERE has_pickup
  UNION ALL SELECT CAST(event_id // 4 AS VARCHAR), 1, dropoff_ts, dropoff_zone, NULL, trip_distance, total_amount FROM a WHERE has_dropoff)),
walk(id, i, held, kind, x, y) AS (
  SELECT id, i, i, '', i, i FROM ev WHERE i = 1
  UNION ALL
  SELECT e.id, e.i, CASE WHEN h.i IS NOT NULL AND h.side <> e.side AND e.t <= h.t + INTERVAL 48 HOUR THEN NULL ELSE e.i END,
         CASE WHEN h.i IS NULL THEN '' WHEN e.t > h.t + INTERVAL 48 HOUR THEN 'alone' WHEN h.side <> e.side THEN 'both' ELSE '' END, h.i, e.i
  FROM walk w JOIN ev e ON e.id = w.id AND e.i = w.i + 1 LEFT JOIN ev h ON h.id = w.id AND h.i = w.held),
ends AS (SELECT id, kind, x, y FROM walk WHERE kind <> ''
  UNION ALL SELECT id, 'alone', held, held FROM walk w WHERE held IS NOT NULL AND i = (SELECT max(i) FROM ev WHERE ev.id = w.id)),
found AS (
  SELECT n.id, n.kind, CASE WHEN f.side = 0 THEN f.t WHEN kind = 'both' THEN g.t END AS p_t, CASE WHEN f.side = 1 THEN f.t WHEN kind = 'both' THEN g.t END AS d_t,
         CASE WHEN f.side = 0 THEN f.zone WHEN kind = 'both' THEN g.zone END AS p_zone, CASE WHEN f.side = 1 THEN f.zone WHEN kind = 'both' THEN g.zone END AS d_zone,
         CASE WHEN kind = 'both' THEN coalesce(f.pc, g.pc) ELSE f.pc END AS pc, CASE WHEN kind = 'both' THEN coalesce(f.dist, g.dist) ELSE f.dist END AS dist,
         CASE WHEN kind = 'both' THEN coalesce(f.amt, g.amt) ELSE f.amt END AS amt
  FROM ends n JOIN ev f ON f.id = n.id AND f.i = n.x JOIN ev g ON g.id = n.id AND g.i = n.y),
whole AS (SELECT *, CASE WHEN kind = 'both' THEN CAST(epoch_us(d_t) - epoch_us(p_t) AS DOUBLE) / 1000000.0 END AS secs FROM found),
judged AS (SELECT *, CASE WHEN kind = 'alone' AND d_t IS NULL THEN 'missing_dropoff' WHEN kind = 'alone' THEN 'missing_pickup'
  WHEN secs <= 0 THEN 'non_positive_duration' WHEN secs > {R.max_duration_seconds} THEN 'duration_over_3h' END AS why FROM whole)
SELECT id AS trip_id, p_zone AS pickup_zone, d_zone AS dropoff_zone, p_t AS pickup_datetime, d_t AS dropoff_datetime, secs AS duration_seconds,
  dist AS trip_distance, pc AS passenger_count, amt AS total_amount, why IS NULL AS is_valid, why AS invalid_reason,
  CASE WHEN kind = 'both' THEN d_t ELSE coalesce(p_t, d_t) + INTERVAL 48 HOUR END AS event_time FROM judged""",
        "j2_orphans": with_trips(f"SELECT {TRIP_COLS} FROM trips WHERE invalid_reason IN ('missing_dropoff', 'missing_pickup')"),
        "j3_duration_rule": with_trips("""SELECT trip_id, duration_seconds, invalid_reason IS NULL AS is_valid, invalid_reason
  FROM trips WHERE duration_seconds IS NOT NULL"""),
        "v10_valid_trips": with_trips(f"SELECT {TRIP_COLS} FROM trips WHERE invalid_reason IS NULL"),
        "v10_invalid_trips": with_trips(f"SELECT {TRIP_COLS} FROM trips WHERE invalid_reason IS NOT NULL"),
        "j4_enriched_trips": with_trips("SELECT trip_id, dropoff_datetime, dropoff_zone, dropoff_borough, time_of_day FROM enriched"),
        "a0_daily_borough_stats": with_trips("""SELECT window_start, window_end, dimension, trips,
  CAST(passengers AS DOUBLE) AS passengers, CAST(distance AS DOUBLE) AS distance, CAST(revenue AS DOUBLE) AS revenue FROM st_borough"""),
    }
    for qid, name in METRIC_IDS.items():
        q[qid] = _metric(name)
    q.update({
        "g1_open_trips": with_trips("SELECT * FROM gauge"),
        "a0b_aggregates": with_trips("SELECT * FROM aggregates"),
        "ks5_guarded_load": f"""WITH {RAW_B},
  summary AS (SELECT 'processed' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS rows FROM cr
  UNION ALL SELECT 'inserted', NULL, count(*) FROM cr WHERE reason IS NULL
  UNION ALL SELECT 'rejected', NULL, count(*) FROM cr WHERE reason IS NOT NULL
  UNION ALL SELECT 'rejected', reason, count(*) FROM cr WHERE reason IS NOT NULL GROUP BY reason),
  stored AS (SELECT count(*) AS stored, CAST(sum(trunc(passenger_count)) AS BIGINT) AS passengers FROM cr WHERE reason IS NULL)
  SELECT status, reason, rows, stored, passengers, TRUE AS refused FROM summary, stored""",
        "ks8_published_topics": f"""WITH {RAW_B}
  SELECT '{R.pickup_topic}' AS topic, count(*) AS records, count(*) AS trips, min(pickup_ts) AS first_time, max(pickup_ts) AS last_time,
    TRUE AS sent, FALSE AS sent_again FROM cr WHERE reason IS NULL
  UNION ALL SELECT '{R.dropoff_topic}', count(*), count(*), min(dropoff_ts), max(dropoff_ts), TRUE, FALSE FROM cr WHERE reason IS NULL""",
        "ks6_zones_refresh": """SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
       'Zone ' || CAST(r_regionkey AS VARCHAR) AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "r5_raw_reconciliation": f"""WITH {trip_ctes()},
raw AS (SELECT *, dropoff_ts - pickup_ts AS gap FROM a WHERE passenger_count <= {R.max_passengers} AND total_amount > 0),
lim AS (SELECT least(max(pickup_ts), max(dropoff_ts)) - INTERVAL 30 SECOND AS b FROM raw),
n AS (SELECT count(*) FILTER (gap > INTERVAL 0 SECOND AND gap <= INTERVAL 3 HOUR AND date_trunc('day', dropoff_ts) + INTERVAL 1 DAY <= b) AS ok,
  count(*) FILTER ((gap = INTERVAL 0 SECOND OR gap > INTERVAL 3 HOUR) AND gap <= INTERVAL 48 HOUR OR gap > INTERVAL 48 HOUR AND pickup_ts + INTERVAL 48 HOUR < b) AS bad
  FROM raw, lim)
SELECT CAST(ok AS DOUBLE) AS daily_total, ok AS raw_valid, bad AS invalid_total, bad AS raw_invalid, TRUE AS consistent FROM n""",
        "f5_time_of_day": """SELECT event_id, CASE WHEN hour(ts) >= 5 AND hour(ts) < 11 THEN 'morning'
  WHEN hour(ts) >= 11 AND hour(ts) < 14 THEN 'noon' WHEN hour(ts) >= 14 AND hour(ts) < 17 THEN 'afternoon'
  WHEN hour(ts) >= 17 AND hour(ts) < 23 THEN 'evening' ELSE 'night' END AS time_of_day FROM events""",
        "f6_iso_week": "SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%G-W%V') AS iso_week FROM lineitem",
        "ks1_rejected_dedupe": with_trips(f"""
  SELECT DISTINCT topic, reason, raw_payload, md5(raw_payload) AS payload_md5 FROM (
    SELECT '{R.pickup_topic}' AS topic, reason, raw_payload FROM ppay WHERE reason IS NOT NULL
    UNION ALL SELECT '{R.dropoff_topic}', reason, raw_payload FROM dpay WHERE reason IS NOT NULL)"""),
        "ks2_invalid_first": "WITH " + all_ctes() + "," + FIRST_INVALID + """
  SELECT trip_id, pickup_zone, dropoff_zone, pickup_datetime, dropoff_datetime, duration_seconds, trip_distance,
         passenger_count, total_amount, invalid_reason FROM inv_first""",
        "ks3_metrics_upsert": "WITH " + all_ctes() + "," + all_ctes("all", "_all") + """
  SELECT metric_name, window_start, window_end, dimension, value + 1 AS value FROM metrics_all
  WHERE ends_with(metric_name, '_by_borough') OR ends_with(metric_name, '_last_h')
  UNION ALL
  SELECT w.metric_name, w.window_start, w.window_end, w.dimension, w.value FROM metrics w ANTI JOIN (
    SELECT * FROM metrics_all WHERE ends_with(metric_name, '_by_borough') OR ends_with(metric_name, '_last_h')) x
    ON w.metric_name = x.metric_name AND w.window_start = x.window_start AND w.window_end = x.window_end
   AND w.dimension = x.dimension""",
        "r1_trips_per_borough": with_trips("""SELECT window_start, dimension, value FROM metrics
  WHERE metric_name = 'trip_count_by_borough' ORDER BY window_start, value DESC, dimension"""),
        "r2_invalid_by_reason": "WITH " + all_ctes() + "," + FIRST_INVALID + """
  SELECT invalid_reason, count(*) AS trips FROM inv_first GROUP BY 1""",
        "r3_rejected_listing": with_trips(f"""
  SELECT DISTINCT topic, reason, raw_payload FROM (
    SELECT '{R.pickup_topic}' AS topic, reason, raw_payload FROM ppay WHERE reason IS NOT NULL
    UNION ALL SELECT '{R.dropoff_topic}', reason, raw_payload FROM dpay WHERE reason IS NOT NULL)"""),
        "r4_progress": with_trips("""SELECT count(*) AS windows, max(window_end) AS last_window_end
  FROM metrics WHERE metric_name = 'trips_last_h'"""),
        "r5_reconciliation": "WITH " + all_ctes() + "," + FIRST_INVALID + """
  SELECT d.daily_total, v.valid_trips, i.invalid_trips, d.daily_total = CAST(v.valid_trips AS DOUBLE) AS consistent
  FROM (SELECT coalesce(sum(value), 0.0) AS daily_total FROM metrics WHERE metric_name = 'trip_count_by_borough') d,
       (SELECT count(*) AS valid_trips FROM enriched
        WHERE date_trunc('day', event_time) + INTERVAL 1 DAY <= (SELECT b FROM bnd)) v,
       (SELECT count(*) AS invalid_trips FROM inv_first) i""",
    })
    return q
