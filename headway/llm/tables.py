"""Tables the operators read and store, and expressions they share."""

from __future__ import annotations

import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import scratch_path

# White space is the six ASCII characters; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once to the folder all executors share and read back.

    Later steps start from the files, so a lost executor costs one step, not the whole chain, and Spark
    knows the size before it decides on a broadcast.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order."""
    return F.array_remove(F.split(text, SPACE), "")


def fingerprint128(*values: Column) -> Column:
    """Two independent 64-bit hashes: equal values always agree, different ones never in practice."""
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(7), *values, F.lit("#")).alias("b"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once; as ``--py-files`` would."""
    package = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(context._temp_dir, f"{package.name}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
