"""User, vehicle, route, calendar and clock dimensions, with inserts of new members."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.calendar import date_sk, instant, iso_weekday, time_sk
from headway.operators.keys import highest, latest_per_key, number_rows, unseen, with_key
from headway.schemas import CORE, OPEN_END

USER_ATTRIBUTES = ("name", "email", "city", "created_at")
VEHICLE_ATTRIBUTES = ("route_id", "license_plate", "capacity")
ROUTE_ATTRIBUTES = ("route_number", "vehicle_type", "base_fare")


def _new_members(staged: DataFrame, existing: DataFrame | None, key: str, sk: str) -> DataFrame:
    members = latest_per_key(with_key(staged, key), [key])
    if existing is None:
        return number_rows(members, key, sk)
    return number_rows(unseen(members, existing, key), key, sk, highest(existing, sk))


def new_users(staged: DataFrame, existing: DataFrame | None, load_dts: str) -> DataFrame:
    """Users not yet in ``existing``, ready to append to `dim_user`."""
    return (_new_members(staged, existing, "user_id", "user_sk")
            .withColumn("updated_dts", instant(load_dts))
            .select(*CORE["dim_user"].column_names))


def new_vehicles(staged: DataFrame, existing: DataFrame | None, load_dts: str) -> DataFrame:
    """Vehicles not yet in ``existing``, ready to append to `dim_vehicle`."""
    return (_new_members(staged, existing, "vehicle_id", "vehicle_sk")
            .withColumn("updated_dts", instant(load_dts))
            .select(*CORE["dim_vehicle"].column_names))


def open_versions(routes: DataFrame, valid_from: Column, load_dts: str) -> DataFrame:
    """Open, current version rows for routes that already carry a ``route_sk``."""
    return (routes.withColumn("valid_from_dts", valid_from)
            .withColumn("valid_to_dts", instant(OPEN_END))
            .withColumn("is_current", F.lit(True))
            .withColumn("updated_dts", instant(load_dts))
            .select(*CORE["dim_route_scd2"].column_names))


def new_routes(staged: DataFrame, existing: DataFrame | None, load_dts: str,
               valid_from: str | None = None) -> DataFrame:
    """Open versions of routes without a current version; changed attributes are ignored.

    A route the dimension has never seen starts at ``valid_from`` when given, one that has closed versions at
    the load, so that its versions don't overlap.
    """
    members = latest_per_key(with_key(staged, "route_id"), ["route_id"])
    after = 0
    if existing is not None:
        members = unseen(members, existing.where("is_current"), "route_id")
        # Closed versions hold keys too.
        after = highest(existing, "route_sk")
    numbered = number_rows(members, "route_id", "route_sk", after)
    if existing is None or valid_from is None:
        return open_versions(numbered, instant(valid_from or load_dts), load_dts)
    marked = mark_known(numbered, existing)
    start = F.when(F.col("__known"), instant(load_dts)).otherwise(instant(valid_from))
    return open_versions(marked, start, load_dts)


def mark_known(routes: DataFrame, dimension: DataFrame) -> DataFrame:
    """Add ``__known``: whether the dimension has any version of the route, closed ones included."""
    known = dimension.select(F.col("route_id").alias("__id")).distinct()
    return (routes.join(known, F.col("route_id") == F.col("__id"), "left")
            .withColumn("__known", F.col("__id").isNotNull()).drop("__id"))


def overwrite_users(existing: DataFrame, staged: DataFrame, load_dts: str) -> DataFrame:
    """The whole user dimension after a type-1 load.

    Staged attributes replace the stored ones, nulls included; users missing from the batch stay as
    they are; new users get the next keys. ``updated_dts`` moves only where an attribute changed.
    """
    batch = latest_per_key(with_key(staged, "user_id"), ["user_id"])
    incoming = batch.select("user_id", F.struct(*USER_ATTRIBUTES).alias("__new"))
    stored = F.struct(*USER_ATTRIBUTES)
    kept = (existing.join(incoming, "user_id", "left")
            .withColumn("__changed", F.col("__new").isNotNull() & ~F.col("__new").eqNullSafe(stored))
            .select("user_sk", "user_id",
                    *[F.when(F.col("__changed"), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
                      for c in USER_ATTRIBUTES],
                    F.when(F.col("__changed"), instant(load_dts))
                    .otherwise(F.col("updated_dts")).alias("updated_dts")))
    added = new_users(staged, existing, load_dts)
    return kept.unionByName(added)


def event_times(rides: DataFrame, payments: DataFrame, positions: DataFrame) -> DataFrame:
    """Every ride start, payment and position time that is known, duplicates kept."""
    times = [rides.select(F.col("start_time").alias("ts")),
             payments.select(F.col("created_at").alias("ts")),
             positions.select(F.col("event_time").alias("ts"))]
    return reduce(DataFrame.unionByName, times).where(F.col("ts").isNotNull())


def moments(times: DataFrame) -> DataFrame:
    """Each date with each second of day that occurs on it, once: what `calendar` and `clock` need of the events."""
    return times.select(F.date_trunc("second", "ts").alias("ts")).distinct()


def calendar(times: DataFrame) -> DataFrame:
    """One row per date that occurs. Only distinct dates leave each task."""
    day = F.col("date_value")
    return (times.select(F.to_date("ts").alias("date_value")).distinct()
            .select(date_sk(day).alias("date_sk"), day,
                    F.year(day).alias("year"), F.quarter(day).alias("quarter"),
                    F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
                    iso_weekday(day).alias("day_of_week"),
                    iso_weekday(day).isin(6, 7).alias("is_weekend")))


def clock(times: DataFrame) -> DataFrame:
    """One row per second of day that occurs, at most 86,400."""
    at = F.col("ts")
    hour, minute, second = F.col("hour"), F.col("minute"), F.col("second")
    return (times.select(F.hour(at).alias("hour"), F.minute(at).alias("minute"),
                         F.second(at).alias("second")).distinct()
            .select(time_sk(hour, minute, second).alias("time_sk"),
                    F.format_string("%02d:%02d:%02d", hour, minute, second).alias("time_value"),
                    hour, minute, second))
