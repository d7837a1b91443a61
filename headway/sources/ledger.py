"""The ledger of loading: which staged batches each staging table has had loaded into the core."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F

from headway.functions.calendar import instant
from headway.schemas import STAGING
from headway.sources.warehouse import Warehouse

_LEDGER = "stg.loaded"


def staged_batches(warehouse: Warehouse) -> dict[str, list[str]]:
    """The batches of every staging table, in order. Only folders are listed."""
    return {name: warehouse.batches(f"stg.{name}") for name in STAGING}


def unloaded(warehouse: Warehouse) -> dict[str, list[str]]:
    """The staged batches no load has finished with, in order, per staging table.

    The ledger has one row per table and batch, so it comes to the driver, as the list of folders does.
    """
    done = {(r.table_name, r.batch_id) for r in warehouse.read(_LEDGER).collect()}
    return {name: [b for b in batches if (name, b) not in done] for name, batches in staged_batches(warehouse).items()}


def record(warehouse: Warehouse, loaded: Mapping[str, Sequence[str]], load_dts: str) -> None:
    """Enter batches a load has finished with. Until then a load that broke off finds them unloaded again."""
    before = warehouse.read(_LEDGER)
    done = {(r.table_name, r.batch_id) for r in before.collect()}
    new = [(name, b) for name, batches in loaded.items() for b in batches if (name, b) not in done]
    if new:
        rows = warehouse.spark.createDataFrame(new, "table_name STRING, batch_id STRING")
        warehouse.replace(before.unionByName(rows.withColumn("load_dts", instant(load_dts))), _LEDGER)


def forget(warehouse: Warehouse, batch_id: str) -> None:
    """Take a batch out of the ledger, because it is about to be staged anew."""
    before = warehouse.read(_LEDGER)
    if not before.where(F.col("batch_id") == batch_id).isEmpty():
        warehouse.replace(before.where(F.col("batch_id") != batch_id), _LEDGER)
