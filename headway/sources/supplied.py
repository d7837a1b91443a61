"""Raw transit tables bound to the supplied TPC-H-like tables.

customer are users, part routes, supplier vehicles, lineitem with its order rides, orders payments, and
events vehicle positions. Columns with no counterpart are typed nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Given explicitly, so that defining a query reads no file footers.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _time(column: str, text: bool) -> str:
    # The files carry no zone; the session runs in UTC.
    if text:
        return f"concat(translate(CAST({column} AS STRING), ' ', 'T'), 'Z')"
    return f"CAST({column} AS TIMESTAMP)"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id", "c_name AS name", "CAST(NULL AS STRING) AS email",
        "CAST(NULL AS STRING) AS created_at", "c_mktsegment AS city")


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS route_id", "p_brand AS route_number", "p_type AS vehicle_type",
        "p_retailprice AS base_fare")


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS vehicle_id", "CAST(s_nationkey AS BIGINT) AS route_id", "s_name AS license_plate",
        "CAST(NULL AS INT) AS capacity")


def rides(spark: SparkSession, sf_dir: str, text_times: bool = False) -> DataFrame:
    """One ride per lineitem; with ``text_times`` times are ISO-8601 text, as raw files carry them."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber) AS ride_id", "o_custkey AS user_id",
        "l_partkey AS route_id", "l_suppkey AS vehicle_id",
        f"{_time('o_orderdate', text_times)} AS start_time",
        f"{_time('l_shipdate', text_times)} AS end_time", "l_extendedprice AS fare_amount")


def payments(spark: SparkSession, sf_dir: str, text_times: bool = False) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS payment_id", "concat_ws('-', o_orderkey, '1') AS ride_id",
        "o_custkey AS user_id", "o_totalprice AS amount", "o_orderpriority AS payment_method",
        "o_orderstatus AS status", f"{_time('o_orderdate', text_times)} AS created_at")


def as_positions(events: DataFrame, text_times: bool = False) -> DataFrame:
    """Position events from rows of the events table, batch or streaming."""
    return events.selectExpr(
        "CAST(event_id AS STRING) AS event_id", "user_id AS vehicle_id", "event_type AS route_number",
        f"{_time('ts', text_times)} AS event_time", "CAST(NULL AS DOUBLE) AS latitude",
        "CAST(NULL AS DOUBLE) AS longitude", "value AS speed_kmh",
        "CAST(get_json_object(props, '$.k') AS INT) AS passengers_estimated", "props AS raw_json")


def positions(spark: SparkSession, sf_dir: str, text_times: bool = False) -> DataFrame:
    return as_positions(table(spark, sf_dir, "events"), text_times)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"users": users(spark, sf_dir), "routes": routes(spark, sf_dir),
            "vehicles": vehicles(spark, sf_dir), "rides": rides(spark, sf_dir),
            "payments": payments(spark, sf_dir), "vehicle_positions": positions(spark, sf_dir)}
