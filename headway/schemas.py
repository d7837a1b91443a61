"""Every table of the warehouse: columns, grain, required columns, references and layout.

Parquet checks none of this, so the loaders and the audit queries take it from here. Business ids are
``BIGINT``: any 32-bit id fits unchanged, and ids of very large tables do not overflow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Reference:
    """``column`` must hold a ``target_column`` value of ``target``, or be null."""

    column: str
    target: str
    target_column: str


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    columns: str
    key: tuple[str, ...] = ()
    also_unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    # Partition folders as (name, SQL expression). Months rather than days keep small loads from being
    # cut into thousands of tiny files; the day still prunes through file statistics.
    partition_by: tuple[tuple[str, str], ...] = ()
    # Rows that agree on these go to the same files as far as file sizes allow.
    cluster_by: tuple[str, ...] = ()
    # Order inside files, so that row-group statistics prune the usual lookups.
    sort_by: tuple[str, ...] = ()
    # Rewritten as a whole under a new version, because existing rows change.
    versioned: bool = False

    @property
    def types(self) -> dict[str, str]:
        """Column name to lower-case type, in column order."""
        pairs = re.split(r",\s*(?!\d)", self.columns)
        return dict(pair.lower().split() for pair in pairs)

    @property
    def column_names(self) -> list[str]:
        return list(self.types)


# Stands in for an unbounded end of validity.
OPEN_END = "9999-12-31T00:00:00Z"
# Start of a first version when history before the first load should resolve to it.
BEFORE_ALL = "1900-01-01T00:00:00Z"

RAW = {t.name: t for t in [
    Table("raw", "users",
          "user_id BIGINT, name STRING, email STRING, created_at STRING, city STRING", ("user_id",)),
    Table("raw", "routes",
          "route_id BIGINT, route_number STRING, vehicle_type STRING, base_fare DOUBLE", ("route_id",)),
    Table("raw", "vehicles",
          "vehicle_id BIGINT, route_id BIGINT, license_plate STRING, capacity INT", ("vehicle_id",)),
    Table("raw", "rides",
          "ride_id STRING, user_id BIGINT, route_id BIGINT, vehicle_id BIGINT, start_time STRING, "
          "end_time STRING, fare_amount DOUBLE", ("ride_id",)),
    Table("raw", "payments",
          "payment_id STRING, ride_id STRING, user_id BIGINT, amount DOUBLE, payment_method STRING, "
          "status STRING, created_at STRING", ("payment_id",)),
    Table("raw", "vehicle_positions",
          "event_id STRING, vehicle_id BIGINT, route_number STRING, event_time STRING, latitude DOUBLE, "
          "longitude DOUBLE, speed_kmh DOUBLE, passengers_estimated INT", ("event_id",)),
]}


def _staged(name: str, key: str, columns: str, stamp: str = "extract_dts", sort_by=()) -> Table:
    return Table("stg", name, f"batch_id STRING, {stamp} TIMESTAMP, {columns}", ("batch_id", key),
                 required=("batch_id", stamp, key), partition_by=(("batch_id", "batch_id"),), sort_by=sort_by)


STAGING = {t.name: t for t in [
    _staged("users", "user_id",
            "user_id BIGINT, name STRING, email STRING, created_at TIMESTAMP, city STRING"),
    _staged("routes", "route_id",
            "route_id BIGINT, route_number STRING, vehicle_type STRING, base_fare DECIMAL(10,2)"),
    _staged("vehicles", "vehicle_id",
            "vehicle_id BIGINT, route_id BIGINT, license_plate STRING, capacity INT"),
    _staged("rides", "ride_id",
            "ride_id STRING, user_id BIGINT, route_id BIGINT, vehicle_id BIGINT, start_time TIMESTAMP, "
            "end_time TIMESTAMP, fare_amount DECIMAL(10,2)"),
    _staged("payments", "payment_id",
            "payment_id STRING, ride_id STRING, user_id BIGINT, amount DECIMAL(10,2), "
            "payment_method STRING, status STRING, created_at TIMESTAMP"),
    _staged("vehicle_positions", "event_id",
            "event_id STRING, vehicle_id BIGINT, route_number STRING, event_time TIMESTAMP, "
            "latitude DOUBLE, longitude DOUBLE, speed_kmh DOUBLE, passengers_estimated INT, "
            "raw_json STRING", stamp="ingest_dts", sort_by=("event_time",)),
]}

# Raw rows that a lenient load staged with nulls in place of unreadable values.
UNREADABLE = Table("stg", "unreadable", "batch_id STRING, table_name STRING, row_key STRING, "
                   "broken_columns STRING", partition_by=(("batch_id", "batch_id"),))

# The staged batches of each staging table that a load has finished with.
LEDGER = Table("stg", "loaded", "table_name STRING, batch_id STRING, load_dts TIMESTAMP", ("table_name", "batch_id"),
               versioned=True)

# What became of the events of every micro-batch, and those that came too late to be loaded.
ACCOUNT = Table("stg", "stream_account", "batch_id STRING, epoch BIGINT, events_in BIGINT, kept BIGINT, repeated BIGINT, "
                "late BIGINT, rejected BIGINT, newest TIMESTAMP, watermark TIMESTAMP", ("batch_id",),
                partition_by=(("batch_id", "batch_id"),))
LATE = Table("stg", "late_events", "batch_id STRING, event_id STRING, vehicle_id BIGINT, route_number STRING, event_time TIMESTAMP, "
             "watermark TIMESTAMP", ("batch_id", "event_id"), partition_by=(("batch_id", "batch_id"),))

CORE = {t.name: t for t in [
    Table("core", "dim_date",
          "date_sk INT, date_value DATE, year INT, quarter INT, month INT, day INT, day_of_week INT, "
          "is_weekend BOOLEAN",
          ("date_sk",), also_unique=(("date_value",),),
          required=("date_sk", "date_value", "year", "quarter", "month", "day", "day_of_week",
                    "is_weekend")),
    Table("core", "dim_time",
          "time_sk INT, time_value STRING, hour INT, minute INT, second INT",
          ("time_sk",), also_unique=(("time_value",),),
          required=("time_sk", "time_value", "hour", "minute", "second")),
    Table("core", "dim_user",
          "user_sk BIGINT, user_id BIGINT, name STRING, email STRING, city STRING, "
          "created_at TIMESTAMP, updated_dts TIMESTAMP",
          ("user_sk",), also_unique=(("user_id",),), required=("user_sk", "user_id", "updated_dts"),
          sort_by=("user_id",), versioned=True),
    Table("core", "dim_vehicle",
          "vehicle_sk BIGINT, vehicle_id BIGINT, route_id BIGINT, license_plate STRING, capacity INT, "
          "updated_dts TIMESTAMP",
          ("vehicle_sk",), also_unique=(("vehicle_id",),),
          required=("vehicle_sk", "vehicle_id", "updated_dts"), sort_by=("vehicle_id",)),
    Table("core", "dim_route_scd2",
          "route_sk BIGINT, route_id BIGINT, route_number STRING, vehicle_type STRING, "
          "base_fare DECIMAL(10,2), valid_from_dts TIMESTAMP, valid_to_dts TIMESTAMP, "
          "is_current BOOLEAN, updated_dts TIMESTAMP",
          ("route_sk",),
          required=("route_sk", "route_id", "valid_from_dts", "valid_to_dts", "is_current",
                    "updated_dts"),
          sort_by=("route_id", "valid_from_dts"), versioned=True),
    Table("core", "fact_ride",
          "ride_id STRING, user_sk BIGINT, route_sk BIGINT, vehicle_sk BIGINT, start_time TIMESTAMP, "
          "end_time TIMESTAMP, duration_s INT, fare_amount DECIMAL(10,2), start_date_sk INT, "
          "load_dts TIMESTAMP",
          ("ride_id",),
          required=("ride_id", "user_sk", "route_sk", "start_time", "start_date_sk", "load_dts"),
          references=(Reference("user_sk", "dim_user", "user_sk"),
                      Reference("route_sk", "dim_route_scd2", "route_sk"),
                      Reference("vehicle_sk", "dim_vehicle", "vehicle_sk"),
                      Reference("start_date_sk", "dim_date", "date_sk")),
          partition_by=(("month", "start_date_sk div 100"),), cluster_by=("start_date_sk",),
          sort_by=("user_sk", "start_time")),
    Table("core", "fact_payment",
          "payment_id STRING, ride_id STRING, user_sk BIGINT, amount DECIMAL(10,2), "
          "payment_method STRING, status STRING, created_at TIMESTAMP, created_date_sk INT, "
          "load_dts TIMESTAMP",
          ("payment_id",), required=("payment_id", "user_sk", "load_dts"),
          references=(Reference("ride_id", "fact_ride", "ride_id"),
                      Reference("user_sk", "dim_user", "user_sk"),
                      Reference("created_date_sk", "dim_date", "date_sk")),
          partition_by=(("month", "created_date_sk div 100"),), cluster_by=("created_date_sk",),
          sort_by=("status", "user_sk")),
    Table("core", "fact_vehicle_position",
          "event_id STRING, vehicle_sk BIGINT, route_number STRING, event_time TIMESTAMP, "
          "event_date_sk INT, latitude DOUBLE, longitude DOUBLE, speed_kmh DOUBLE, "
          "passengers_estimated INT, load_dts TIMESTAMP",
          ("event_id",), required=("event_id", "event_time", "event_date_sk", "load_dts"),
          references=(Reference("vehicle_sk", "dim_vehicle", "vehicle_sk"),
                      Reference("event_date_sk", "dim_date", "date_sk")),
          partition_by=(("month", "event_date_sk div 100"),), cluster_by=("event_date_sk",),
          sort_by=("route_number", "event_time")),
]}

# Staged rows that are not loaded, with the batch they were staged in; rows leave the list when they load.
REJECTS = {t.name: t for t in [
    Table("core", f"{name}_rejects", f"{key} STRING, reason STRING, load_batch STRING", (key,),
          partition_by=(("load_batch", "load_batch"),), sort_by=(key,))
    for name, key in [("fact_ride", "ride_id"), ("fact_payment", "payment_id"),
                      ("fact_vehicle_position", "event_id")]
]}

MARTS = {t.name: t for t in [
    Table("mart", "dm_rides_by_route_hour",
          "route_number STRING, date DATE, hour INT, trips_count INT, avg_fare DOUBLE, "
          "avg_duration_s DOUBLE",
          ("route_number", "date", "hour"), partition_by=(("month", "year(date) * 100 + month(date)"),),
          sort_by=("route_number", "date", "hour")),
    # Counts and sums per load that the mart is made of, the loads not summed up yet, and the numbers last shown.
    Table("mart", "rides_partial",
          "route_sk BIGINT, date DATE, hour INT, trips BIGINT, fares BIGINT, fare_sum DECIMAL(24,2), durations BIGINT, "
          "duration_sum BIGINT, load STRING", ("load", "route_sk", "date", "hour"),
          partition_by=(("load", "load"), ("month", "year(date) * 100 + month(date)")), sort_by=("date", "route_sk"),
          versioned=True),
    Table("mart", "rides_pending", "load_dts TIMESTAMP", ("load_dts",), versioned=True),
    Table("mart", "rides_shown", "route_sk BIGINT, route_number STRING", ("route_sk",), sort_by=("route_sk",), versioned=True),
    Table("mart", "dm_movement_by_route_hour",
          "route_number STRING, hour_start TIMESTAMP, events_count BIGINT, avg_speed_kmh DOUBLE, avg_passengers DOUBLE",
          ("route_number", "hour_start"),
          partition_by=(("day", "CAST(date_format(hour_start, 'yyyyMMdd') AS INT)"),),
          sort_by=("route_number", "hour_start")),
]}

WAREHOUSE = {**{f"stg.{n}": t for n, t in STAGING.items()}, "stg.unreadable": UNREADABLE, "stg.loaded": LEDGER,
             "stg.stream_account": ACCOUNT, "stg.late_events": LATE,
             **CORE, **REJECTS, **MARTS}
