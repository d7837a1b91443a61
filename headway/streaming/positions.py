"""Vehicle positions as a stream: ingest without repeats, hourly movement, appends to the fact."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.calendar import date_sk
from headway.operators.facts import accepted, position_facts
from headway.operators.keys import stored_among
from headway.operators.marts import movement_by_route_hour, movement_measures
from headway.operators.staging import stage
from headway.sources.rejects import append_fact
from headway.sources.warehouse import Warehouse

# How long a repeat or a late event may lag behind the newest event.
LATENESS = "1 hour"


# Most input a micro-batch takes, so that its state and its writes stay bounded.
BYTES_PER_TRIGGER = 4 << 30


def read_files(spark: SparkSession, path: str, schema, max_files: int | None = None,
               max_bytes: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Events arriving as Parquet files under ``path`` (a folder or a glob); limits are per micro-batch."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def without_repeats(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each event id once, as long as repeats come within ``lateness``; later rows are dropped.

    One shuffle and one state of the ids of the last ``lateness``. Copies of one event within a micro-batch meet
    in the task that owns its id; the input limit per micro-batch bounds them. Use `append_facts` where late
    events must not get lost.
    """
    return events.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["event_id"])


def movement(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Events, average speed and load per route number and hour, emitted once the hour is closed.

    In append mode the hours still open when the input ends stay in the state and come out when later
    events move the watermark. Events later than ``lateness`` are dropped. Where both matter, let
    `append_facts` keep the stored table of movements.
    """
    return (events.withWatermark("event_time", lateness)
            .groupBy("route_number", F.window("event_time", "1 hour").alias("__hour"))
            .agg(*movement_measures())
            .select("route_number", F.col("__hour.start").alias("hour_start"),
                    "events_count", "avg_speed_kmh", "avg_passengers"))


def _identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps in its checkpoint from its first start on."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"].replace("-", "")


def append_facts(events: DataFrame, vehicles: Callable[[], DataFrame], warehouse: Warehouse, load_dts: str,
                 checkpoint: str, repeats_keep_time: bool = True, movements: bool = False,
                 stream: str | None = None, lateness: str | None = None) -> StreamingQuery:
    """Stage every micro-batch of raw events, run it through the batch fact builder and append the result.

    The batch id is the name of the stream and the epoch. The name is ``stream``, or else the id in the checkpoint,
    so that streams never touch what others staged or had rejected. A stream that has lost its checkpoint and
    starts over should keep its name: else what it reads again is staged a second time.

    A micro-batch is staged first and read back from its folder, so it is computed once and can be loaded again; a
    replay overwrites its staged rows. Rows already in the fact are left out, so a batch that is replayed after a
    failure, whole or in part, adds only what is missing. Events without an id or a time are listed as rejected.
    Late events are loaded like any other, unless ``lateness`` bounds how far (e.g. "1 hour") an event may lag behind
    the newest one of earlier micro-batches: older ones are listed in `stg.late_events` instead. `stg.stream_account`
    then tells of each micro-batch how many events came in and were kept, repeated, late or rejected, which add up,
    and the newest event so far, from which the next batch takes its watermark. It is written once, before anything
    is appended, so a replay leaves it as it is. Late comes before repeated, rejected before both.

    The stored event ids are scanned, not shuffled, and only those of the months the batch has events of. That
    rests on a repeated event carrying its first time; set ``repeats_keep_time`` to false where it may not.

    With ``movements`` the stored table of hourly movements is kept up to date: the days that a micro-batch
    has events of are computed anew from the fact and replaced.
    """
    name = "fact_vehicle_position"

    def load(batch: DataFrame, epoch: int) -> None:
        batch_id = f"{stream or _identity(warehouse.spark, checkpoint)}-{epoch:020d}"
        warehouse.overwrite_batch(stage(batch, "vehicle_positions", batch_id, load_dts), "stg.vehicle_positions", batch_id)
        staged = warehouse.read_batches("stg.vehicle_positions", [batch_id])
        month = "year({0}(event_time)) * 100 + month({0}(event_time))"
        months = staged.agg(F.expr(month.format("min")), F.expr(month.format("max"))).first()
        stored = warehouse.read(name, *months) if repeats_keep_time else warehouse.read(name)
        known = stored_among(stored, staged, "event_id")
        timely, account = staged, None
        if lateness is not None:
            watermark = _watermark(warehouse, batch_id, epoch, lateness)
            late = F.col("event_id").isNotNull() & (F.col("event_time") < F.lit(watermark).cast("timestamp"))
            timely = staged.where(~F.coalesce(late, F.lit(False)))
            overdue = staged.where(late).withColumn("watermark", F.lit(watermark).cast("timestamp"))
            warehouse.overwrite_batch(overdue, "stg.late_events", batch_id)
            account = partial(_enter, warehouse, staged, late, batch_id, epoch, watermark)
        append_fact(warehouse, position_facts(timely, vehicles(), load_dts, known, ("batch_id",)), name, [batch_id], account)
        if movements and months[0] is not None:
            refresh_movements(warehouse, staged, *months)

    return (events.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _previous(batch_id: str, epoch: int) -> str:
    return f"{batch_id.rsplit('-', 1)[0]}-{epoch - 1:020d}"


def _watermark(warehouse: Warehouse, batch_id: str, epoch: int, lateness: str) -> datetime | None:
    """The time before which events of a micro-batch are late; None for the first."""
    before = warehouse.read_batches("stg.stream_account", [_previous(batch_id, epoch)])
    row = before.select(F.expr(f"newest - INTERVAL {lateness}").alias("at")).first()
    return row and row.at


def _enter(warehouse: Warehouse, staged: DataFrame, late: Column, batch_id: str, epoch: int, watermark: datetime | None,
           found: DataFrame) -> None:
    """Write the account of a micro-batch, unless an attempt before this one has."""
    table = "stg.stream_account"
    if batch_id in warehouse.batches(table):
        return
    unusable = F.col("event_id").isNull() | F.col("event_time").isNull()
    before = warehouse.read_batches(table, [_previous(batch_id, epoch)]).agg(F.max("newest").alias("newest")).first()
    kept = accepted(found, "fact_vehicle_position").count()
    counts = staged.agg(F.count("*").alias("events_in"), F.count_if(unusable).alias("rejected"), F.count_if(late).alias("late"),
                        F.max(F.when(~unusable, F.col("event_time"))).alias("__now"))
    rows = counts.select(
        F.lit(batch_id).alias("batch_id"), F.lit(epoch).cast("bigint").alias("epoch"), "events_in",
        F.lit(kept).cast("bigint").alias("kept"), F.expr(f"events_in - {kept} - late - rejected").alias("repeated"), "late",
        "rejected", F.greatest("__now", F.lit(before.newest).cast("timestamp")).alias("newest"), F.lit(watermark).cast("timestamp").alias("watermark"))
    warehouse.overwrite_partitions(rows, table)


def refresh_movements(warehouse: Warehouse, changed: DataFrame, from_month: int, to_month: int) -> None:
    """Compute the movements of the days that ``changed`` has events of from the whole fact, and replace them."""
    days = changed.select(date_sk(F.col("event_time")).alias("event_date_sk")).where("event_date_sk IS NOT NULL").distinct()
    positions = warehouse.read("fact_vehicle_position", from_month, to_month).join(days, "event_date_sk", "left_semi")
    # Speeds as decimals: the last bits of a sum of doubles depend on the order of addition.
    exact = positions.withColumn("speed_kmh", F.col("speed_kmh").cast("decimal(10,2)"))
    rows = movement_by_route_hour(exact).withColumn("avg_speed_kmh", F.col("avg_speed_kmh").cast("double"))
    warehouse.overwrite_partitions(rows, "dm_movement_by_route_hour")


def write_files(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once, until the input present now is used up."""
    return (rows.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
