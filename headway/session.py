"""Session settings the warehouse relies on, and where its scratch tables go."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Set on every session that runs warehouse code: event times are declared in UTC, so every
# hour, date and clock key must be taken in UTC whatever zone the cluster runs in.
ZONE = "UTC"

DEFAULTS = {
    "spark.sql.session.timeZone": ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Event-id state outgrows the heap long before it outgrows local disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "headway", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the warehouse defaults; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", ZONE)
    return spark


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path as its own object."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def side_by_side(*jobs: Callable[[], object]) -> list:
    """Run independent Spark jobs at the same time, so that one fills executors another leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as threads:
        return [job.result() for job in [threads.submit(job) for job in jobs]]


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths``; only a listing, nothing is read."""
    total = 0
    for path in paths:
        files, location = file_system(spark, path)
        total += files.getContentSummary(location).getLength()
    return total


def size_shuffles(spark: SparkSession, nbytes: int, target: int = 64 << 20) -> int:
    """Give shuffles enough partitions that one holds about ``target`` bytes of the input.

    Compressed Parquet grows a few times in a shuffle, hence the modest target. The setting is only
    ever raised: AQE merges partitions that turn out small, but cannot make a shuffle wider.
    """
    key = "spark.sql.shuffle.partitions"
    wanted = max(int(spark.conf.get(key)), -(-nbytes // target))
    spark.conf.set(key, str(wanted))
    return wanted


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables in a folder all executors share.

    That folder is ``spark.checkpoint.dir``, or else one inside ``spark.sql.warehouse.dir``, which every
    session has. What is still there when the session's JVM ends is removed then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    files, location = file_system(spark, path)
    files.deleteOnExit(location)
    return path


@contextmanager
def scratch_table(spark: SparkSession, rows: DataFrame, label: str) -> Iterator[DataFrame]:
    """``rows`` computed once and read back from the shared folder; removed again at the end."""
    path = scratch_path(spark, label)
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        files, location = file_system(spark, path)
        files.delete(location, True)
