"""Aggregates for reporting. All of them combine map-side, so a hot route costs no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators.keys import by_rows

def _hourly(rides: DataFrame, *extra: Column) -> DataFrame:
    return (rides.groupBy("route_number", F.to_date("start_time").alias("date"),
                          F.hour("start_time").alias("hour"))
            .agg(F.count(F.lit(1)).cast("int").alias("trips_count"),
                 # Decimal sums do not depend on the order of the rows.
                 F.avg("fare_amount").cast("double").alias("avg_fare"),
                 F.avg("duration_s").alias("avg_duration_s"),
                 *extra))


def rides_by_route_hour(rides: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips, average fare and average duration per route number, date and hour.

    Only current versions are joined: rides on a closed version count under a null route number.
    """
    current = routes.where("is_current").select("route_sk", "route_number")
    return _hourly(rides.join(by_rows(current), "route_sk", "left"))


def rides_by_route_version(rides: DataFrame, routes: DataFrame) -> DataFrame:
    """As `rides_by_route_hour`, but by the version each ride refers to, with its average tariff."""
    versions = routes.select("route_sk", "route_number", "base_fare")
    return _hourly(rides.join(by_rows(versions), "route_sk", "left"),
                   F.avg("base_fare").cast("double").alias("avg_base_fare"))


def partial_rides(rides: DataFrame) -> DataFrame:
    """Counts and sums of rides per route version, date and hour; sums of more rides are sums of these."""
    return (rides.groupBy("route_sk", F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour"))
            .agg(F.count(F.lit(1)).alias("trips"), F.count("fare_amount").alias("fares"),
                 F.sum("fare_amount").cast("decimal(24,2)").alias("fare_sum"),
                 F.count("duration_s").alias("durations"), F.sum("duration_s").alias("duration_sum")))


_SUMS = ("trips", "fares", "fare_sum", "durations", "duration_sum")


def add_partials(partials: DataFrame, *by: str) -> DataFrame:
    """Partial sums added up per route version, date and hour, or per the columns named."""
    kinds = dict(partials.dtypes)
    return partials.groupBy(*(by or ("route_sk", "date", "hour"))).agg(
        *[F.sum(c).cast(kinds[c]).alias(c) for c in _SUMS])


def mart_of_partials(partials: DataFrame, shows: DataFrame) -> DataFrame:
    """The same as `rides_by_route_hour` of the rides summed up; ``shows`` has route_sk and route_number.

    The number is looked up first: sums per route version would be shuffled, though hardly fewer than the partial ones.
    """
    summed = add_partials(partials.join(by_rows(shows), "route_sk", "left"), "route_number", "date", "hour")
    return summed.select("route_number", "date", "hour", F.col("trips").cast("int").alias("trips_count"),
                         F.expr("CAST(fare_sum / CAST(nullif(fares, 0) AS DECIMAL(12,0)) AS DECIMAL(14,6))").cast("double").alias("avg_fare"),
                         F.expr("CAST(duration_sum AS DOUBLE) / nullif(durations, 0)").alias("avg_duration_s"))


def first_rows(mart: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` mart rows by date, hour and route number: a top-k, not a full sort."""
    return mart.orderBy("date", "hour", "route_number").limit(n)


def movement_by_route_hour(positions: DataFrame) -> DataFrame:
    """Events, average speed and average load per route number and hour."""
    return (positions.groupBy("route_number", F.date_trunc("hour", "event_time").alias("hour_start"))
            .agg(*movement_measures()))


def movement_measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("events_count"),
            F.avg("speed_kmh").alias("avg_speed_kmh"),
            F.avg("passengers_estimated").alias("avg_passengers")]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [table.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
              for name, table in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
