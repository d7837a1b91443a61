"""The streams run over the supplied events until the input present is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import DEFAULTS, scratch_path
from headway.sources import supplied
from headway.sources.warehouse import Warehouse
from headway.streaming import positions

LOAD = "2024-02-01T00:00:00Z"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(state, DEFAULTS[state])
    # A glob, because the source must accept a single file as well as a folder of files.
    files = f"{sf_dir}/events.parque[t]"
    return supplied.as_positions(positions.read_files(spark, files, supplied.SCHEMAS["events"]))


def _to_files(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    base = scratch_path(spark, label)
    positions.write_files(rows, f"{base}/out", f"{base}/progress").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_files(spark, positions.without_repeats(_events(spark, sf_dir)), "dedupe")


def with_exact_speed(rows: DataFrame) -> DataFrame:
    """Speeds as decimals: the last bits of a sum of doubles depend on the order of addition."""
    return rows.withColumn("speed_kmh", rows.speed_kmh.cast("decimal(10,2)"))


def _loaded(spark: SparkSession, sf_dir: str, vehicles: DataFrame, movements: bool = False) -> Warehouse:
    warehouse = Warehouse(spark, scratch_path(spark, "facts"))
    positions.append_facts(_events(spark, sf_dir), lambda: vehicles, warehouse, LOAD, f"{warehouse.root}/progress",
                           movements=movements).awaitTermination()
    return warehouse


def movement(spark: SparkSession, sf_dir: str, vehicles: DataFrame) -> DataFrame:
    return _loaded(spark, sf_dir, vehicles, movements=True).read("dm_movement_by_route_hour")


def staged(spark: SparkSession, sf_dir: str, vehicles: DataFrame) -> DataFrame:
    """The staged events, with the epoch as batch: the name of the stream before it is another at every start."""
    rows = _loaded(spark, sf_dir, vehicles).read("stg.vehicle_positions")
    return rows.withColumn("batch_id", F.substring_index("batch_id", "-", -1))


def facts(spark: SparkSession, sf_dir: str, vehicles: DataFrame) -> DataFrame:
    return _loaded(spark, sf_dir, vehicles).read("fact_vehicle_position")


def two_sources(spark: SparkSession, sf_dir: str, vehicles: DataFrame,
                broken: Callable[[DataFrame], DataFrame]) -> Warehouse:
    """Two streams, each with its own half of the events and its own checkpoint, into one warehouse."""
    warehouse = Warehouse(spark, scratch_path(spark, "facts"))
    events = _events(spark, sf_dir)
    for n in range(2):
        half = broken(events.where(F.expr(f"CAST(event_id AS BIGINT) % 2 = {n}")))
        positions.append_facts(half, lambda: vehicles, warehouse, LOAD, f"{warehouse.root}/progress-{n}").awaitTermination()
    return warehouse


def accounted(spark: SparkSession, sf_dir: str, vehicles: DataFrame) -> Warehouse:
    """The events in four files that are out of order and overlap, one a micro-batch, with two days of lateness."""
    warehouse = Warehouse(spark, scratch_path(spark, "facts"))
    source = supplied.table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    folder = scratch_path(spark, "events")
    for days in ("day <= 8", "day BETWEEN 12 AND 20", "day BETWEEN 9 AND 11 OR day BETWEEN 18 AND 19", "day >= 20"):
        source.where(days).drop("day").coalesce(1).write.mode("append").parquet(folder)
    events = supplied.as_positions(positions.read_files(spark, folder, supplied.SCHEMAS["events"], max_files=1))
    positions.append_facts(events, lambda: vehicles, warehouse, LOAD, f"{warehouse.root}/progress",
                           lateness="2 days").awaitTermination()
    return warehouse
