"""The registered queries in SQL, written independently of the DataFrame code for a second engine.

`_TABLES` defines the layers as common table expressions; each query selects from them.
"""

from __future__ import annotations



def _mean(amount: str) -> str:
    """Mean of a non-negative amount with two decimals, rounded half up to six in integer arithmetic."""
    cents = f"CAST(sum(CAST(CAST({amount} AS DECIMAL(10,2)) * 100 AS BIGINT)) AS HUGEINT)"
    return f"CAST((2 * 10000 * {cents} + count({amount})) // (2 * count({amount})) AS DOUBLE) / 1e6"


_TABLES = f"""
WITH users AS (
  SELECT c_custkey AS user_id, c_name AS name, CAST(NULL AS VARCHAR) AS email,
         CAST(NULL AS TIMESTAMP) AS created_at, c_mktsegment AS city
  FROM customer),
routes AS (
  SELECT p_partkey AS route_id, p_brand AS route_number, p_type AS vehicle_type,
         CAST(p_retailprice AS DECIMAL(10,2)) AS base_fare
  FROM part),
vehicles AS (
  SELECT s_suppkey AS vehicle_id, CAST(s_nationkey AS BIGINT) AS route_id, s_name AS license_plate,
         CAST(NULL AS INTEGER) AS capacity
  FROM supplier),
rides AS (
  SELECT l_orderkey || '-' || l_linenumber AS ride_id, o_custkey AS user_id, l_partkey AS route_id,
         l_suppkey AS vehicle_id, o_orderdate AS start_time, l_shipdate AS end_time,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS fare_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
payments AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, o_orderkey || '-1' AS ride_id, o_custkey AS user_id,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderpriority AS payment_method,
         o_orderstatus AS status, o_orderdate AS created_at
  FROM orders),
positions AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id AS vehicle_id, event_type AS route_number,
         ts AS event_time, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
         value AS speed_kmh, CAST(json_extract_string(props, '$.k') AS INTEGER) AS passengers_estimated,
         props AS raw_json
  FROM events),
early_users AS (
  SELECT * FROM users WHERE user_id IN (
    SELECT user_id FROM payments WHERE created_at < TIMESTAMP '1995-09-01')),
early_routes AS (
  SELECT * FROM routes WHERE route_id IN (
    SELECT route_id FROM rides WHERE start_time < TIMESTAMP '1995-03-23')),
early_vehicles AS (
  SELECT * FROM vehicles WHERE vehicle_id IN (
    SELECT vehicle_id FROM rides WHERE start_time < TIMESTAMP '1995-01-05')),
times AS (
  SELECT start_time AS ts FROM rides UNION ALL SELECT created_at FROM payments
  UNION ALL SELECT event_time FROM positions),
early_times AS (
  SELECT start_time AS ts FROM rides WHERE start_time < TIMESTAMP '1998-01-01'
  UNION ALL SELECT created_at FROM payments WHERE created_at < TIMESTAMP '1998-01-01'
  UNION ALL SELECT event_time FROM positions WHERE event_time < TIMESTAMP '2024-01-16'),
dim_user AS (
  SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id, name, email, city, created_at,
         TIMESTAMP '2024-02-01' AS updated_dts
  FROM users),
first_users AS (
  SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id, name, email, city, created_at,
         TIMESTAMP '1995-01-01' AS updated_dts
  FROM early_users),
dim_vehicle AS (
  SELECT row_number() OVER (ORDER BY vehicle_id) AS vehicle_sk, vehicle_id, route_id, license_plate,
         capacity, TIMESTAMP '2024-02-01' AS updated_dts
  FROM vehicles),
dim_route AS (
  SELECT row_number() OVER (ORDER BY route_id) AS route_sk, route_id, route_number, vehicle_type,
         base_fare, TIMESTAMP '2024-02-01' AS valid_from_dts, TIMESTAMP '9999-12-31' AS valid_to_dts,
         true AS is_current, TIMESTAMP '2024-02-01' AS updated_dts
  FROM routes),
repriced AS (
  SELECT route_id, route_number, vehicle_type,
         CAST(CASE WHEN vehicle_type = 'PROMO' THEN base_fare + 5 ELSE base_fare END AS DECIMAL(10,2))
           AS base_fare
  FROM routes),
first_routes AS (
  SELECT row_number() OVER (ORDER BY route_id) AS route_sk, * FROM early_routes),
opened_routes AS (
  SELECT (SELECT max(route_sk) FROM first_routes) + row_number() OVER (ORDER BY r.route_id) AS route_sk,
         r.*
  FROM repriced r LEFT JOIN first_routes f ON f.route_id = r.route_id
  WHERE f.route_id IS NULL OR f.base_fare <> r.base_fare),
route_history AS (
  SELECT f.route_sk, f.route_id, f.route_number, f.vehicle_type, f.base_fare,
         TIMESTAMP '1995-01-01' AS valid_from_dts,
         CASE WHEN o.route_id IS NULL THEN TIMESTAMP '9999-12-31' ELSE TIMESTAMP '1998-01-01' END
           AS valid_to_dts,
         o.route_id IS NULL AS is_current,
         CASE WHEN o.route_id IS NULL THEN TIMESTAMP '1995-01-01' ELSE TIMESTAMP '1998-01-01' END
           AS updated_dts
  FROM first_routes f LEFT JOIN opened_routes o ON o.route_id = f.route_id
  UNION ALL
  SELECT route_sk, route_id, route_number, vehicle_type, base_fare, TIMESTAMP '1998-01-01',
         TIMESTAMP '9999-12-31', true, TIMESTAMP '1998-01-01'
  FROM opened_routes),
single_rides AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY user_id, route_id, vehicle_id, start_time,
                                 end_time, fare_amount) AS rn
    FROM rides)
  WHERE rn = 1),
looked_up_rides AS (
  SELECT r.*, u.user_sk, v.vehicle_sk, date_diff('second', start_time, end_time)::INTEGER AS duration_s,
         CAST(strftime(start_time, '%Y%m%d') AS INTEGER) AS start_date_sk
  FROM single_rides r LEFT JOIN dim_user u USING (user_id) LEFT JOIN dim_vehicle v USING (vehicle_id)),
ride_current AS (
  SELECT r.*, d.route_sk FROM looked_up_rides r LEFT JOIN dim_route d ON d.route_id = r.route_id
  WHERE r.user_sk IS NOT NULL AND d.route_sk IS NOT NULL),
ride_asof_all AS (
  SELECT r.*, d.route_sk FROM looked_up_rides r LEFT JOIN route_history d
    ON d.route_id = r.route_id AND d.valid_from_dts <= r.start_time AND r.start_time < d.valid_to_dts),
ride_asof AS (
  SELECT * FROM ride_asof_all WHERE user_sk IS NOT NULL AND route_sk IS NOT NULL),
payment_facts AS (
  SELECT p.*, u.user_sk, CAST(strftime(p.created_at, '%Y%m%d') AS INTEGER) AS created_date_sk
  FROM payments p JOIN dim_user u USING (user_id)),
position_facts AS (
  SELECT p.*, v.vehicle_sk, CAST(strftime(event_time, '%Y%m%d') AS INTEGER) AS event_date_sk
  FROM positions p LEFT JOIN dim_vehicle v USING (vehicle_id)),
dates AS (
  SELECT DISTINCT CAST(ts AS DATE) AS date_value FROM times),
clock AS (
  SELECT DISTINCT hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second FROM times),
mart AS (
  SELECT d.route_number, CAST(r.start_time AS DATE) AS date, hour(r.start_time) AS hour,
         count(*) AS trips_count,
         {_mean('r.fare_amount')} AS avg_fare,
         round(CAST(sum(r.duration_s) AS DOUBLE) / count(r.duration_s), 6) AS avg_duration_s
  FROM ride_current r LEFT JOIN dim_route d ON d.route_sk = r.route_sk AND d.is_current
  GROUP BY ALL)
"""

_STAMP = "'20240201000000' AS batch_id, TIMESTAMP '2024-02-01' AS {}"
_EXTRACT, _INGEST = _STAMP.format("extract_dts"), _STAMP.format("ingest_dts")
_LOADED = "TIMESTAMP '2024-02-01' AS load_dts"

_RIDE = f"""SELECT ride_id, user_sk, route_sk, CAST(vehicle_sk AS VARCHAR) AS vehicle_sk, start_time, end_time, duration_s,
  CAST(fare_amount AS DOUBLE) AS fare_amount, start_date_sk, {_LOADED} FROM """
_PAYMENT = f"""SELECT payment_id, ride_id, user_sk, CAST(amount AS DOUBLE) AS amount, payment_method,
  status, created_at, created_date_sk, {_LOADED} FROM payment_facts"""
_POSITION = f"""SELECT event_id, CAST(vehicle_sk AS VARCHAR) AS vehicle_sk, route_number, event_time,
  event_date_sk, latitude, longitude, speed_kmh, passengers_estimated, {_LOADED} FROM position_facts"""
_MART = """SELECT route_number, CAST(date AS VARCHAR) AS date, CAST(hour AS INTEGER) AS hour,
  CAST(trips_count AS INTEGER) AS trips_count, avg_fare, avg_duration_s FROM mart"""
_DATE = """SELECT CAST(strftime(date_value, '%Y%m%d') AS INTEGER) AS date_sk,
  CAST(date_value AS VARCHAR) AS date_value, CAST(year(date_value) AS INTEGER) AS year,
  CAST(quarter(date_value) AS INTEGER) AS quarter, CAST(month(date_value) AS INTEGER) AS month,
  CAST(day(date_value) AS INTEGER) AS day, CAST(isodow(date_value) AS INTEGER) AS day_of_week,
  isodow(date_value) IN (6, 7) AS is_weekend FROM dates"""
_TIME = """SELECT CAST(hour * 10000 + minute * 100 + second AS INTEGER) AS time_sk,
  strftime(make_time(hour, minute, second) + DATE '2000-01-01', '%H:%M:%S') AS time_value,
  CAST(hour AS INTEGER) AS hour, CAST(minute AS INTEGER) AS minute, CAST(second AS INTEGER) AS second
  FROM clock"""
_MOVEMENT = f"""SELECT route_number, date_trunc('hour', event_time) AS hour_start,
  count(*) AS events_count, {_mean('speed_kmh')} AS avg_speed_kmh,
  round(avg(passengers_estimated), 6) AS avg_passengers
  FROM position_facts GROUP BY ALL"""


def _duplicates(table: str, keys: str, source: str, key_columns: str | None = None) -> str:
    key_columns = key_columns or keys
    return (f"SELECT '{table}' AS table_name, '{keys}' AS check_name, CAST(count(*) AS BIGINT) AS "
            f"violations FROM (SELECT 1 FROM {source} GROUP BY {key_columns} HAVING count(*) > 1)")


def _nulls(table: str, source: str, columns: dict[str, str]) -> list[str]:
    return [f"SELECT '{table}' AS table_name, '{name}' AS check_name, "
            f"CAST(count(*) - count({value}) AS BIGINT) AS violations FROM {source}"
            for name, value in columns.items()]


def _lost(table: str, source: str, column: str, target: str, target_source: str,
          target_column: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{column} -> {target}' AS check_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM {source} s WHERE s.{column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {target_source} t WHERE t.{target_column} = s.{column})")


def _same(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


_KEYED = [
    ("stg.users", "batch_id,user_id", "users", "user_id"),
    ("stg.routes", "batch_id,route_id", "routes", "route_id"),
    ("stg.vehicles", "batch_id,vehicle_id", "vehicles", "vehicle_id"),
    ("stg.rides", "batch_id,ride_id", "rides", "ride_id"),
    ("stg.payments", "batch_id,payment_id", "payments", "payment_id"),
    ("stg.vehicle_positions", "batch_id,event_id", "positions", "event_id"),
    ("dim_user", "user_sk", "dim_user", None), ("dim_user", "user_id", "dim_user", None),
    ("dim_vehicle", "vehicle_sk", "dim_vehicle", None),
    ("dim_vehicle", "vehicle_id", "dim_vehicle", None),
    ("dim_route_scd2", "route_sk", "dim_route", None),
    ("dim_date", "date_sk", "dates", "date_value"), ("dim_date", "date_value", "dates", None),
    ("dim_time", "time_sk", "clock", "hour, minute, second"),
    ("dim_time", "time_value", "clock", "hour, minute, second"),
    ("fact_ride", "ride_id", "ride_current", None),
    ("fact_payment", "payment_id", "payment_facts", None),
    ("fact_vehicle_position", "event_id", "position_facts", None),
]

_REQUIRED = [
    *[check for table, source, stamp, key in [
        ("stg.users", "users", "extract_dts", "user_id"), ("stg.routes", "routes", "extract_dts", "route_id"),
        ("stg.vehicles", "vehicles", "extract_dts", "vehicle_id"),
        ("stg.rides", "rides", "extract_dts", "ride_id"),
        ("stg.payments", "payments", "extract_dts", "payment_id"),
        ("stg.vehicle_positions", "positions", "ingest_dts", "event_id")]
      for check in _nulls(table, source, {"batch_id": "1", stamp: "1", key: key})],
    *_nulls("dim_user", "dim_user", _same("user_sk", "user_id", "updated_dts")),
    *_nulls("dim_vehicle", "dim_vehicle", _same("vehicle_sk", "vehicle_id", "updated_dts")),
    *_nulls("dim_route_scd2", "route_history",
            _same("route_sk", "route_id", "valid_from_dts", "valid_to_dts", "is_current", "updated_dts")),
    *_nulls("dim_date", "dates", {"date_sk": "date_value", "date_value": "date_value",
                                  "year": "year(date_value)", "quarter": "quarter(date_value)",
                                  "month": "month(date_value)", "day": "day(date_value)",
                                  "day_of_week": "isodow(date_value)",
                                  "is_weekend": "isodow(date_value)"}),
    *_nulls("dim_time", "clock", {"time_sk": "hour", "time_value": "hour", "hour": "hour",
                                  "minute": "minute", "second": "second"}),
    *_nulls("fact_ride", "ride_asof_all", {**_same("ride_id", "user_sk", "route_sk", "start_time",
                                                   "start_date_sk"), "load_dts": "1"}),
    *_nulls("fact_payment", "payment_facts", {**_same("payment_id", "user_sk"), "load_dts": "1"}),
    *_nulls("fact_vehicle_position", "position_facts",
            {**_same("event_id", "event_time", "event_date_sk"), "load_dts": "1"}),
]

_DATE_KEYS = "(SELECT CAST(strftime(date_value, '%Y%m%d') AS INTEGER) AS date_sk FROM dates)"
_REFERENCES = [
    _lost("fact_ride", "ride_current", "user_sk", "dim_user", "dim_user", "user_sk"),
    _lost("fact_ride", "ride_current", "route_sk", "dim_route_scd2", "dim_route", "route_sk"),
    _lost("fact_ride", "ride_current", "vehicle_sk", "dim_vehicle", "dim_vehicle", "vehicle_sk"),
    _lost("fact_ride", "ride_current", "start_date_sk", "dim_date", _DATE_KEYS, "date_sk"),
    _lost("fact_payment", "payment_facts", "ride_id", "fact_ride", "ride_current", "ride_id"),
    _lost("fact_payment", "payment_facts", "user_sk", "dim_user", "dim_user", "user_sk"),
    _lost("fact_payment", "payment_facts", "created_date_sk", "dim_date", _DATE_KEYS, "date_sk"),
    _lost("fact_vehicle_position", "position_facts", "vehicle_sk", "dim_vehicle", "dim_vehicle",
          "vehicle_sk"),
    _lost("fact_vehicle_position", "position_facts", "event_date_sk", "dim_date", _DATE_KEYS, "date_sk"),
]

_COUNTED = [("dim_user", "dim_user"), ("dim_vehicle", "dim_vehicle"), ("dim_route_scd2", "dim_route"),
            ("dim_date", "dates"), ("dim_time", "clock"), ("fact_ride", "ride_current"),
            ("fact_payment", "payment_facts"), ("fact_vehicle_position", "position_facts"),
            ("dm_rides_by_route_hour", "mart")]

_UNCLOSED = "(SELECT * REPLACE (true AS is_current, TIMESTAMP '2100-01-01' AS valid_to_dts) " \
            "FROM route_history)"


def _current(label: str, source: str) -> str:
    return (f"SELECT '{label}' AS table_name, 'one current version' AS check_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT route_id FROM {source} "
            f"WHERE is_current GROUP BY route_id HAVING count(*) > 1)")


def _overlap(label: str, source: str) -> str:
    return (f"SELECT '{label}' AS table_name, 'versions do not overlap' AS check_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT valid_to_dts, "
            f"lead(valid_from_dts) OVER (PARTITION BY route_id ORDER BY valid_from_dts, valid_to_dts) "
            f"AS next_from FROM {source}) WHERE next_from < valid_to_dts")


_SELECTS = {
    "stg_users": f"SELECT {_EXTRACT}, * FROM users",
    "stg_routes": f"SELECT {_EXTRACT}, * REPLACE (CAST(base_fare AS DOUBLE) AS base_fare) FROM routes",
    "stg_vehicles": f"SELECT {_EXTRACT}, * REPLACE (CAST(capacity AS VARCHAR) AS capacity) FROM vehicles",
    "stg_rides": f"SELECT {_EXTRACT}, * REPLACE (CAST(fare_amount AS DOUBLE) AS fare_amount) FROM rides",
    "stg_payments": f"SELECT {_EXTRACT}, * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM payments",
    "stg_positions": f"SELECT {_INGEST}, * EXCLUDE (raw_json) FROM positions",
    "stg_positions_json": "SELECT event_id, raw_json, passengers_estimated AS k FROM positions",
    "dedupe_latest": """
        SELECT batch_id, extract_dts, ride_id, user_id, route_id, vehicle_id, start_time, end_time,
               CAST(fare_amount AS DOUBLE) AS fare_amount
        FROM (
          SELECT *, row_number() OVER (
            PARTITION BY ride_id ORDER BY extract_dts DESC, batch_id DESC, user_id, route_id, vehicle_id,
                                          start_time, end_time, fare_amount) AS rn
          FROM (
            SELECT '20010901000000' AS batch_id, TIMESTAMP '2001-09-01' AS extract_dts, * FROM rides
            UNION ALL
            SELECT '20020101000000', TIMESTAMP '2002-01-01',
                   * REPLACE (CAST(fare_amount + 1 AS DECIMAL(10,2)) AS fare_amount)
            FROM rides WHERE start_time >= TIMESTAMP '1998-01-01'))
        WHERE rn = 1""",
    "surrogate_keys": """
        SELECT user_id, user_sk FROM first_users
        UNION ALL
        SELECT user_id, (SELECT max(user_sk) FROM first_users) + row_number() OVER (ORDER BY user_id)
        FROM users WHERE user_id NOT IN (SELECT user_id FROM first_users)""",
    "dim_user_new": """
        SELECT (SELECT max(user_sk) FROM first_users) + row_number() OVER (ORDER BY user_id) AS user_sk,
               user_id, name, email, city, created_at, TIMESTAMP '2024-02-01' AS updated_dts
        FROM users WHERE user_id NOT IN (SELECT user_id FROM first_users)""",
    "dim_vehicle_new": """
        SELECT CAST((SELECT count(*) FROM early_vehicles) + row_number() OVER (ORDER BY vehicle_id)
                    AS VARCHAR) AS vehicle_sk, * REPLACE (CAST(capacity AS VARCHAR) AS capacity), TIMESTAMP '2024-02-01' AS updated_dts
        FROM vehicles WHERE vehicle_id NOT IN (SELECT vehicle_id FROM early_vehicles)""",
    "dim_route_new": """
        SELECT (SELECT count(*) FROM early_routes) + row_number() OVER (ORDER BY route_id) AS route_sk,
               route_id, route_number, vehicle_type, CAST(base_fare AS DOUBLE) AS base_fare,
               TIMESTAMP '2024-02-01' AS valid_from_dts, '9999-12-31 00:00:00' AS valid_to_dts,
               true AS is_current, TIMESTAMP '2024-02-01' AS updated_dts
        FROM routes WHERE route_id NOT IN (SELECT route_id FROM early_routes)""",
    "dim_user_scd1": """
        SELECT * FROM (
          SELECT f.user_sk, f.user_id, f.name, f.email, coalesce(b.new_city, f.city) AS city,
                 f.created_at, CASE WHEN b.new_city <> f.city THEN TIMESTAMP '2024-02-01'
                                    ELSE f.updated_dts END AS updated_dts
          FROM first_users f LEFT JOIN batch b USING (user_id)
          UNION ALL
          SELECT (SELECT max(user_sk) FROM first_users) + row_number() OVER (ORDER BY user_id), user_id,
                 name, email, new_city, created_at, TIMESTAMP '2024-02-01'
          FROM batch WHERE user_id NOT IN (SELECT user_id FROM first_users))""",
    "dim_route_scd2": """
        SELECT * REPLACE (CAST(base_fare AS DOUBLE) AS base_fare,
                          strftime(valid_to_dts, '%Y-%m-%d %H:%M:%S') AS valid_to_dts)
        FROM route_history""",
    "all_event_times": "SELECT ts FROM times",
    "dim_date": _DATE,
    "dim_date_new": f"{_DATE} WHERE date_value NOT IN (SELECT CAST(ts AS DATE) FROM early_times)",
    "dim_time": _TIME,
    "dim_time_new": f"""{_TIME} WHERE hour * 10000 + minute * 100 + second NOT IN (
        SELECT hour(ts) * 10000 + minute(ts) * 100 + second(ts) FROM early_times)""",
    "fact_ride_current_route": f"{_RIDE} ride_current",
    "fact_ride_asof_route": f"{_RIDE} ride_asof",
    "fact_ride_incremental": f"""{_RIDE} ride_current WHERE ride_id NOT IN (
        SELECT ride_id FROM rides WHERE start_time < TIMESTAMP '1998-01-01')""",
    "fact_ride_asof_ordered": f"{_RIDE} ride_asof",
    "fact_ride_bucketed_incremental": f"""{_RIDE} ride_current WHERE ride_id NOT IN (
        SELECT ride_id FROM rides WHERE start_time < TIMESTAMP '1998-01-01')""",
    "fact_ride_rejects": """
        SELECT ride_id, concat_ws(',', CASE WHEN user_sk IS NULL THEN 'user_sk' END,
                                       CASE WHEN route_sk IS NULL THEN 'route_sk' END,
                                       CASE WHEN start_time IS NULL THEN 'start_time' END) AS reason
        FROM ride_asof_all WHERE user_sk IS NULL OR route_sk IS NULL OR start_time IS NULL""",
    "fact_payment": _PAYMENT,
    "fact_payment_incremental": f"""{_PAYMENT} WHERE payment_id NOT IN (
        SELECT payment_id FROM payments WHERE created_at < TIMESTAMP '1998-01-01')""",
    "fact_position": _POSITION,
    "fact_position_incremental": f"""{_POSITION} WHERE event_id NOT IN (
        SELECT event_id FROM positions WHERE event_time < TIMESTAMP '2024-01-16')""",
    "mart_rides_by_route_hour": _MART,
    "mart_rides_by_route_version": f"""
        SELECT d.route_number, CAST(CAST(r.start_time AS DATE) AS VARCHAR) AS date,
               CAST(hour(r.start_time) AS INTEGER) AS hour, CAST(count(*) AS INTEGER) AS trips_count,
               {_mean('r.fare_amount')} AS avg_fare,
               round(CAST(sum(r.duration_s) AS DOUBLE) / count(r.duration_s), 6) AS avg_duration_s,
               {_mean('d.base_fare')} AS avg_base_fare
        FROM ride_asof r LEFT JOIN route_history d ON d.route_sk = r.route_sk
        GROUP BY d.route_number, CAST(r.start_time AS DATE), hour(r.start_time)""",
    "mart_incremental": f"""
        SELECT CASE WHEN d.vehicle_type <> 'PROMO' THEN d.route_number END AS route_number,
               CAST(CAST(r.start_time AS DATE) AS VARCHAR) AS date, CAST(hour(r.start_time) AS INTEGER) AS hour,
               CAST(count(*) AS INTEGER) AS trips_count, {_mean('r.fare_amount')} AS avg_fare,
               round(CAST(sum(r.duration_s) AS DOUBLE) / count(r.duration_s), 6) AS avg_duration_s
        FROM ride_current r JOIN dim_route d ON d.route_sk = r.route_sk
        GROUP BY 1, CAST(r.start_time AS DATE), hour(r.start_time)""",
    "warehouse_load": _MART,
    "mart_top20": f"{_MART} ORDER BY date, hour, route_number LIMIT 20",
    "movement_by_route_hour": _MOVEMENT,
    "layer_row_counts": " UNION ALL ".join(
        f"SELECT '{label}' AS tbl, count(*) AS cnt FROM {source}" for label, source in _COUNTED),
    "qa_duplicate_keys": " UNION ALL ".join(_duplicates(*keyed[:3], keyed[3]) for keyed in _KEYED),
    "qa_not_null": " UNION ALL ".join(_REQUIRED),
    "qa_orphans": " UNION ALL ".join(_REFERENCES),
    "qa_scd2_current": " UNION ALL ".join([_current("dim_route_scd2", "route_history"),
                                           _current("dim_route_scd2 unclosed", _UNCLOSED)]),
    "qa_scd2_overlap": " UNION ALL ".join([_overlap("dim_route_scd2", "route_history"),
                                           _overlap("dim_route_scd2 unclosed", _UNCLOSED)]),
    "stream_positions_dedupe": """
        SELECT event_id, vehicle_id, route_number, event_time, latitude, longitude, speed_kmh,
               passengers_estimated, raw_json FROM positions""",
    "stream_fact_position": _POSITION,
    "stream_stage_positions": """
        SELECT '00000000000000000000' AS batch_id, TIMESTAMP '2024-02-01' AS ingest_dts, * FROM positions""",
    "stream_movement_by_route_hour": _MOVEMENT,
    "dim_route_scd2_backdated": """
        SELECT f.route_sk, f.route_id, f.route_number, f.vehicle_type, CAST(f.base_fare AS DOUBLE) AS base_fare,
               TIMESTAMP '1995-01-01' AS valid_from_dts,
               CASE WHEN vehicle_type = 'PROMO' THEN '1998-01-01 00:00:00' ELSE '9999-12-31 00:00:00' END AS valid_to_dts,
               vehicle_type <> 'PROMO' AS is_current, TIMESTAMP '1995-01-01' AS updated_dts
        FROM first_routes f
        UNION ALL
        SELECT (SELECT max(route_sk) FROM first_routes) + row_number() OVER (ORDER BY r.route_id), r.route_id,
               r.route_number, r.vehicle_type, CAST(r.base_fare AS DOUBLE),
               CASE WHEN f.route_id IS NULL THEN TIMESTAMP '1900-01-01' ELSE TIMESTAMP '2024-02-01' END,
               '9999-12-31 00:00:00', true, TIMESTAMP '2024-02-01'
        FROM routes r LEFT JOIN first_routes f ON f.route_id = r.route_id
        WHERE f.route_id IS NULL OR f.vehicle_type = 'PROMO'""",
    "fact_payment_rejects": """
        SELECT id AS payment_id, concat_ws(',', CASE WHEN id IS NULL THEN 'payment_id' END,
                                                CASE WHEN unknown THEN 'user_sk' END) AS reason
        FROM (SELECT CASE WHEN payment_method = '1-URGENT' AND status = 'P' THEN NULL ELSE payment_id END AS id,
                     user_id NOT IN (SELECT user_id FROM first_users) AS unknown FROM payments)
        WHERE id IS NULL OR unknown""",
    "fact_position_rejects": """
        SELECT id AS event_id, concat_ws(',', CASE WHEN id IS NULL THEN 'event_id' END,
                                              CASE WHEN happened IS NULL THEN 'event_time' END) AS reason
        FROM broken_positions WHERE id IS NULL OR happened IS NULL""",
    "load_reconciliation": """
        SELECT 'fact_ride' AS table_name, kind,
               CASE kind WHEN 'rejected' THEN 0 ELSE (SELECT count(*) FROM single_rides) END AS n
        FROM kinds
        UNION ALL
        SELECT 'fact_payment', kind, CASE kind WHEN 'staged' THEN n WHEN 'rejected' THEN lost ELSE n - lost END
        FROM kinds, (SELECT count(*) AS n, count(*) FILTER (payment_method = '1-URGENT' AND status = 'P') AS lost FROM payments)
        UNION ALL
        SELECT 'fact_vehicle_position', kind, CASE kind WHEN 'staged' THEN keyed + 2 * lost
                                                WHEN 'rejected' THEN keyed - good + 2 * lost ELSE good END
        FROM kinds, (SELECT count(id) AS keyed, count(*) FILTER (id IS NULL) AS lost,
                            count(*) FILTER (id IS NOT NULL AND happened IS NOT NULL) AS good FROM broken_positions)""",
    "dim_route_scd2_snapshots": """
        SELECT row_number() OVER (ORDER BY no, route_id) AS route_sk, route_id, route_number, vehicle_type,
               CAST(base_fare AS DOUBLE) AS base_fare, since AS valid_from_dts,
               strftime(coalesce(next_since, TIMESTAMP '9999-12-31'), '%Y-%m-%d %H:%M:%S') AS valid_to_dts,
               next_since IS NULL AS is_current, coalesce(next_since, since) AS updated_dts
        FROM (SELECT *, lead(since) OVER (PARTITION BY route_id ORDER BY no) AS next_since FROM (
          SELECT *, lag(base_fare) OVER (PARTITION BY route_id ORDER BY no) AS before FROM route_states)
          WHERE before IS NULL OR before <> base_fare)""",
    "ledger_load": """
        SELECT 'fact_ride' AS table_name, kind, CASE kind WHEN 'batches' THEN 3 WHEN 'rejected' THEN 0
               ELSE (SELECT count(*) FROM single_rides) END AS n FROM steps
        UNION ALL
        SELECT 'fact_payment', kind, CASE kind WHEN 'batches' THEN 3 WHEN 'rejected' THEN 0
               ELSE (SELECT count(*) FROM payments) END FROM steps
        UNION ALL
        SELECT 'fact_vehicle_position', kind, CASE kind WHEN 'batches' THEN 3 WHEN 'rejected' THEN 0
               ELSE (SELECT count(*) FROM positions) END FROM steps""",
    "stream_late_events": """
        SELECT epoch, events_in, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept AND NOT late) AS repeated,
               count(*) FILTER (late) AS late, 0::BIGINT AS rejected, newest, watermark
        FROM firsts JOIN marks USING (epoch) GROUP BY epoch, events_in, newest, watermark""",
    "stream_two_sources_reconciliation": """
        SELECT kind, CASE kind WHEN 'staged' THEN count(*) WHEN 'loaded' THEN count(*) FILTER (good)
                     ELSE count(*) FILTER (NOT good) END AS n
        FROM kinds, (SELECT id IS NOT NULL AND happened IS NOT NULL AS good FROM broken_positions) GROUP BY kind""",
    "rides_by_date_range": f"{_RIDE} ride_current WHERE start_date_sk BETWEEN 19970115 AND 19970314",
}

_BATCH = """,
batch AS (
  SELECT *, CASE WHEN city = 'MACHINERY' THEN 'BUILDING' ELSE city END AS new_city
  FROM users)
"""
_BROKEN = """,
kinds AS (SELECT unnest(['staged', 'loaded', 'rejected']) AS kind),
broken_positions AS (
  SELECT CASE WHEN passengers_estimated % 9 <> 4 THEN event_id END AS id,
         CASE WHEN passengers_estimated % 7 <> 3 THEN event_time END AS happened
  FROM positions)
"""
_DEALT = """,
dealt AS (
  SELECT unnest(CASE WHEN day(ts) <= 8 THEN [0] WHEN day(ts) < 12 THEN [2] WHEN day(ts) < 18 THEN [1]
                     WHEN day(ts) < 20 THEN [1, 2] WHEN day(ts) = 20 THEN [1, 3] ELSE [3] END) AS epoch, event_id, ts
  FROM events),
newest AS (
  SELECT epoch, count(*) AS events_in, max(max(ts)) OVER (ORDER BY epoch) AS newest FROM dealt GROUP BY epoch),
marks AS (SELECT *, lag(newest) OVER (ORDER BY epoch) - INTERVAL 2 DAY AS watermark FROM newest),
judged AS (
  SELECT d.epoch, coalesce(ts < watermark, false) AS late, event_id FROM dealt d JOIN marks USING (epoch)),
firsts AS (
  SELECT *, NOT late AND row_number() OVER (PARTITION BY event_id, late ORDER BY epoch) = 1 AS kept FROM judged)
"""
_STATES = """,
steps AS (SELECT unnest(['batches', 'loaded', 'rejected']) AS kind),
route_states AS (
  SELECT 0 AS no, TIMESTAMP '1995-01-01' AS since, * FROM early_routes
  UNION ALL
  SELECT no, make_timestamp(1996 + no, 1, 1, 0, 0, 0), route_id, route_number, vehicle_type,
         CASE WHEN (no IN (2, 3) AND vehicle_type = 'PROMO') OR (no IN (3, 4) AND vehicle_type = 'STANDARD')
              THEN CAST(base_fare + 5 AS DECIMAL(10,2)) ELSE base_fare END
  FROM routes, (SELECT unnest([1, 2, 3, 4]) AS no) WHERE no <> 2 OR route_id % 10 <> 3)
"""
_MORE = {"dim_route_scd2_snapshots": _STATES, "ledger_load": _STATES, "stream_late_events": _DEALT, "stream_two_sources_reconciliation": _BROKEN,
         "dim_user_scd1": _BATCH, "fact_position_rejects": _BROKEN, "load_reconciliation": _BROKEN}

ORACLE = {name: _TABLES + _MORE.get(name, "") + select for name, select in _SELECTS.items()}
