"""The ride mart kept up to date from stored partial sums, which grow with what loads add, not with the history.

Partial sums are kept per load, route version, date and hour. A load is announced before its rides are appended and
settled when its sums are stored, so a load that broke off is summed up by the next one: sums of a load replace each
other, however often they are computed. The mart adds the sums of the months concerned and takes averages when it
does. Route versions are looked up then, so closing one moves its rides without reading any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.calendar import instant
from headway.operators import marts
from headway.sources.warehouse import Warehouse

PENDING, PARTIALS, SHOWN = "rides_pending", "rides_partial", "rides_shown"
# Loads whose sums are kept apart before they are folded into one.
KEEP_LOADS = 24
_FOLDED = "folded"


def announce(warehouse: Warehouse, load_dts: str) -> None:
    """Note that the load of that time is about to append rides."""
    pending = warehouse.read(PENDING)
    new = pending.sparkSession.range(1).select(instant(load_dts).alias("load_dts"))
    warehouse.replace(pending.unionByName(new).distinct(), PENDING)


def new_rides(warehouse: Warehouse, load_dts) -> DataFrame:
    """The stored rides of one load. Files hold the rides of one load, so statistics keep all others closed."""
    return warehouse.read("fact_ride").where(F.col("load_dts") == F.lit(load_dts))


def settle(warehouse: Warehouse) -> list[int]:
    """Store the sums of all announced loads. Returns the months they have rides in."""
    label = F.date_format("load_dts", "yyyyMMdd'T'HHmmss.SSSSSS").alias("label")
    loads = {r.label: r.load_dts for r in warehouse.read(PENDING).select("load_dts", label).collect()}
    if not warehouse.versions(PARTIALS):
        warehouse.replace(warehouse.read(PARTIALS), PARTIALS)
    for label, load_dts in loads.items():
        sums = marts.partial_rides(new_rides(warehouse, load_dts)).withColumn("load", F.lit(label))
        warehouse.overwrite_batch(sums, PARTIALS, label)
    return sorted(warehouse.months(PARTIALS, list(loads)))


def _of_months(warehouse: Warehouse, months: set[int]) -> DataFrame:
    found = warehouse.read(PARTIALS, min(months), max(months))
    return found.where((F.year("date") * 100 + F.month("date")).isin(*months))


def refresh(warehouse: Warehouse) -> list[int]:
    """Bring the mart up to date and return the months that were computed anew.

    These are the months that announced loads have rides in, and those of rides whose route version shows another
    number than it did. No ride is read but those of announced loads.
    """
    months = set(settle(warehouse))
    shows = warehouse.read("dim_route_scd2").where("is_current").select("route_sk", "route_number")
    others = warehouse.months(PARTIALS, warehouse.batches(PARTIALS)) - months
    if others:
        before = warehouse.read(SHOWN).select("route_sk", F.col("route_number").alias("__was"), F.lit(True).alias("__shown"))
        moved = (shows.withColumn("__shows", F.lit(True)).join(before, "route_sk", "full")
                 .where("NOT (__shows <=> __shown AND route_number <=> __was)").select("route_sk"))
        found = _of_months(warehouse, others).join(moved, "route_sk", "left_semi")
        found = found.select((F.year("date") * 100 + F.month("date")).alias("m")).distinct()
        months |= {r.m for r in found.collect()}
    if months:
        warehouse.overwrite_partitions(marts.mart_of_partials(_of_months(warehouse, months), shows), "dm_rides_by_route_hour")
    # Last, so that a refresh that broke off does all of this again.
    warehouse.replace(shows, SHOWN)
    warehouse.replace(warehouse.read(PENDING).limit(0), PENDING)
    if len(warehouse.batches(PARTIALS)) > KEEP_LOADS:
        warehouse.replace(marts.add_partials(warehouse.read(PARTIALS)).withColumn("load", F.lit(_FOLDED)), PARTIALS)
    return sorted(months)
