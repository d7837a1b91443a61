"""Ride, payment and position facts: surrogate lookups, derived columns, idempotent appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.calendar import date_sk, instant, seconds_between
from headway.operators.history import version_at, version_at_ordered
from headway.operators.keys import latest_per_key, look_up, unseen
from headway.schemas import CORE

# Columns that staging or the lookups may leave null although the fact requires them.
_NEEDED = {
    "fact_ride": ("ride_id", "user_sk", "route_sk", "start_time"),
    "fact_payment": ("payment_id", "user_sk"),
    "fact_vehicle_position": ("event_id", "event_time"),
}
# Begins the stand-in key of a row without one.
_NO_KEY = "\0row "


def _to_load(staged: DataFrame, key: str, existing: DataFrame | None) -> DataFrame:
    """One row per key, without keys already loaded; rows without a key stay, each for itself.

    Going first keeps the lookups narrow, and both steps share one exchange on the key. A row without a key
    has a stand-in meanwhile, so such rows neither replace each other nor meet in one task.
    """
    lone = F.concat(F.lit(_NO_KEY), F.monotonically_increasing_id().cast("string"))
    rows = latest_per_key(staged.withColumn(key, F.coalesce(F.col(key), lone)), [key])
    rows = rows if existing is None else unseen(rows, existing, key)
    return rows.withColumn(key, F.when(~F.col(key).startswith(_NO_KEY), F.col(key)))


def ride_facts(staged: DataFrame, users: DataFrame, vehicles: DataFrame, routes: DataFrame,
               load_dts: str, existing: DataFrame | None = None, route_lookup: str = "current",
               carry: Sequence[str] = ()) -> DataFrame:
    """Rides with surrogate keys, duration and date key; unresolved keys are null. ``carry`` names staged columns to keep.

    ``route_lookup`` is ``"current"`` (the route's current version) or ``"asof"`` (the version valid at
    the ride's start); ``"asof_ordered"`` finds the same without joining rides with versions, for routes with very
    many of them.
    """
    rides = look_up(_to_load(staged, "ride_id", existing), users, "user_id", "user_sk")
    rides = look_up(rides, vehicles, "vehicle_id", "vehicle_sk")
    if route_lookup == "current":
        rides = look_up(rides, routes.where("is_current"), "route_id", "route_sk")
    elif route_lookup == "asof":
        rides = version_at(rides, routes, "start_time")
    elif route_lookup == "asof_ordered":
        rides = version_at_ordered(rides, routes, "start_time")
    else:
        raise ValueError(f"route_lookup must be 'current', 'asof' or 'asof_ordered', not {route_lookup!r}")
    return (rides.withColumn("duration_s", seconds_between(F.col("start_time"), F.col("end_time")))
            .withColumn("start_date_sk", date_sk(F.col("start_time")))
            .withColumn("load_dts", instant(load_dts))
            .select(*CORE["fact_ride"].column_names, *carry))


def payment_facts(staged: DataFrame, users: DataFrame, load_dts: str,
                  existing: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Payments with the user's surrogate key and a date key; an unknown user is null."""
    payments = look_up(_to_load(staged, "payment_id", existing), users, "user_id", "user_sk")
    return (payments.withColumn("created_date_sk", date_sk(F.col("created_at")))
            .withColumn("load_dts", instant(load_dts))
            .select(*CORE["fact_payment"].column_names, *carry))


def position_facts(staged: DataFrame, vehicles: DataFrame, load_dts: str,
                   existing: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Position events with the vehicle's surrogate key (null if unknown) and a date key."""
    positions = look_up(_to_load(staged, "event_id", existing), vehicles, "vehicle_id", "vehicle_sk")
    return (positions.withColumn("event_date_sk", date_sk(F.col("event_time")))
            .withColumn("load_dts", instant(load_dts))
            .select(*CORE["fact_vehicle_position"].column_names, *carry))


def reject_reason(table: str) -> Column:
    """The required columns left null, comma-separated; empty for a row the fact accepts."""
    return F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in _NEEDED[table]])


def accepted(facts: DataFrame, table: str) -> DataFrame:
    """Rows whose required columns are all filled."""
    return facts.dropna(subset=list(_NEEDED[table]))


def rejected(facts: DataFrame, table: str, *carried: str) -> DataFrame:
    """Key and reason of every row `accepted` leaves out, and columns it carries."""
    return (facts.select(CORE[table].key[0], reject_reason(table).alias("reason"), *carried)
            .where(F.col("reason") != ""))
