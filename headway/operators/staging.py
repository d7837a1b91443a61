"""Raw to staging: give raw columns their types and stamp the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.calendar import instant
from headway.schemas import STAGING


def _typed(raw: DataFrame, table: str, lenient: bool) -> list[str]:
    stamps = STAGING[table].column_names[:2]
    cast = "TRY_CAST" if lenient else "CAST"
    # The raw event text is optional: sources that parse on arrival do not keep it.
    return [f"{cast}({name if name in raw.columns else 'NULL'} AS {kind}) AS {name}"
            for name, kind in STAGING[table].types.items() if name not in stamps]


def stage(raw: DataFrame, table: str, batch_id: str, load_dts: str, lenient: bool = False) -> DataFrame:
    """Rows of ``raw`` as the staging table holds them: a narrow projection, no shuffle.

    ISO-8601 text becomes timestamps and floating-point money becomes decimals. A value that does not
    convert fails the job; with ``lenient`` it becomes null and `stage_rejects` lists the row.
    """
    batch, stamp = STAGING[table].column_names[:2]
    return raw.select(F.lit(batch_id).alias(batch), instant(load_dts).alias(stamp),
                      *map(F.expr, _typed(raw, table, lenient)))


def stage_rejects(raw: DataFrame, table: str) -> DataFrame:
    """Key and offending columns of rows that hold a value which does not convert."""
    key = STAGING[table].key[-1]
    broken = [
        F.when(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(), F.lit(name))
        for name, kind in STAGING[table].types.items()
        if name in raw.columns
    ]
    return (raw.select(key, F.concat_ws(",", *broken).alias("broken_columns"))
            .where(F.col("broken_columns") != ""))


def event_attribute(positions: DataFrame, path: str, kind: str, name: str) -> DataFrame:
    """Event id plus one attribute read out of the raw event text."""
    return positions.select("event_id", "raw_json",
                            F.get_json_object("raw_json", path).cast(kind).alias(name))
