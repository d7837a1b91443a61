"""Facts split into rows to append and rows to list as rejected."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import facts
from headway.operators.keys import by_rows
from headway.schemas import CORE
from headway.session import scratch_table
from headway.sources.warehouse import Warehouse


def append_fact(warehouse: Warehouse, rows: DataFrame, name: str, batches: Sequence[str] | None = None,
                before_append: Callable[[DataFrame], None] | None = None) -> None:
    """Append accepted rows and list rejected ones, each under the staged batch it came with.

    ``rows`` carry that ``batch_id``. They are written to the shared scratch folder once, so that splitting them
    repeats neither the joins nor the removal of repeats. ``batches`` are those that were read whole; None means all.
    What is listed of these is listed anew. A row of another batch leaves the list when its key is among ``rows``;
    rows without a key can't be told apart and stay with their batch. The list is kept by batch: only the batches
    concerned are written. ``before_append`` is given the rows when they are stored and nothing is appended yet.
    """
    key, table = CORE[name].key[0], f"{name}_rejects"
    with scratch_table(warehouse.spark, rows, name) as found:
        if before_append:
            before_append(found)
        warehouse.append(facts.accepted(found, name), name)
        rejects = facts.rejected(found, name, "batch_id").withColumnRenamed("batch_id", "load_batch")
        before = warehouse.batches(table)
        touched = set(before) if batches is None else set(batches) & set(before)
        if batches is not None and before:
            listed = warehouse.read(table).where(~F.col("load_batch").isin(*batches))
            tried = by_rows(found.select(key).where(F.col(key).isNotNull()).distinct(), found.select(key))
            met = [r.load_batch for r in listed.join(tried, key, "left_semi").select("load_batch").distinct().collect()]
            touched |= set(met)
            if met:
                others = warehouse.read_batches(table, met).where(~F.col("load_batch").isin(*batches))
                rejects = rejects.unionByName(others.join(tried, key, "left_anti"))
        if touched or not rejects.isEmpty():
            with scratch_table(warehouse.spark, rejects, table) as anew:
                warehouse.replace_batches(anew, table, touched)


def waiting(warehouse: Warehouse, name: str, but: Sequence[str]) -> DataFrame | None:
    """Keys, with their batch, of listed rows to try again: those of other batches than ``but``; None if none are.

    The batches are few beside the rows, so their names come to the driver, to read only the folders concerned.
    """
    key, table = CORE[name].key[0], f"{name}_rejects"
    batches = [b for b in warehouse.batches(table) if b not in set(but)]
    if not batches:
        return None
    return warehouse.read_batches(table, batches).where(F.col(key).isNotNull()).select(key, "load_batch")
