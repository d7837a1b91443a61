"""Warehouse tables as Parquet under one root, on any file system Spark can reach."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import WAREHOUSE, Table
from headway.session import file_system, input_bytes

_VERSION = "version-"
# Facts are gathered by this many consecutive date keys: a file holds some days of a month, a month has four groups.
_DAYS = 10


class Warehouse:
    """Reads and writes the tables of `headway.schemas`.

    A table exists once something was written; until then it reads as empty. Appends go with an
    anti-join on the stored keys in the loaders, which makes a repeated or interrupted load add exactly
    what is missing. One load may run at a time.

    Versioned tables keep their last ``keep_versions`` versions for readers that still use them; older ones are
    removed when a new one is finished.
    """

    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 5):
        if keep_versions < 2:
            raise ValueError("the version before the current one may still be read: keep two at least")
        self.spark, self.root, self.keep_versions = spark, root.rstrip("/"), keep_versions

    # -- where a table is --

    def _base(self, table: Table) -> str:
        return f"{self.root}/{table.layer}/{table.name}"

    def _exists(self, path: str) -> bool:
        files, location = file_system(self.spark, path)
        return files.exists(location)

    def versions(self, name: str) -> list[str]:
        """Finished versions of a versioned table, oldest first; an interrupted write is not finished."""
        base = self._base(WAREHOUSE[name])
        files, location = file_system(self.spark, base)
        if not files.exists(location):
            return []
        paths = [status.getPath() for status in files.listStatus(location)]
        return sorted(p.toString() for p in paths if p.getName().startswith(_VERSION)
                      and self._exists(f"{p.toString()}/_SUCCESS"))

    def path(self, name: str) -> str:
        """Where the current content of a table lies."""
        table = WAREHOUSE[name]
        if not table.versioned:
            return self._base(table)
        finished = self.versions(name)
        return finished[-1] if finished else f"{self._base(table)}/{_VERSION}{1:08d}"

    # -- reading and writing --

    def read(self, name: str, from_month: int | None = None, to_month: int | None = None, *,
             from_date_sk: int | None = None, to_date_sk: int | None = None) -> DataFrame:
        """The current content of a table.

        ``from_month`` and ``to_month`` (e.g. 202410, both included) skip the folders of other months. The date
        bounds (e.g. 20241027, both included) select rows of a fact by the date it is stored by, and skip the
        folders of other months too.
        """
        table, path = WAREHOUSE[name], self.path(name)
        if not self._exists(path):
            return self.spark.createDataFrame([], table.columns)
        return self._bounded(self._stored(table, path, path), table, from_month, to_month, from_date_sk, to_date_sk)

    def _stored(self, table: Table, base: str, *paths: str) -> DataFrame:
        derived = [f"{part} INT" for part, source in table.partition_by if part != source]
        return self.spark.read.schema(", ".join([table.columns, *derived])).option("basePath", base).parquet(*paths)

    @staticmethod
    def _bounded(stored: DataFrame, table: Table, from_month: int | None, to_month: int | None,
                 from_date_sk: int | None, to_date_sk: int | None) -> DataFrame:
        month = F.col("month")
        if from_month is not None:
            stored = stored.where(month >= from_month)
        if to_month is not None:
            stored = stored.where(month <= to_month)
        if from_date_sk is not None:
            stored = stored.where((month >= from_date_sk // 100) & (F.col(table.cluster_by[0]) >= from_date_sk))
        if to_date_sk is not None:
            stored = stored.where((month <= to_date_sk // 100) & (F.col(table.cluster_by[0]) <= to_date_sk))
        return stored.select(*table.column_names)

    def batches(self, name: str) -> list[str]:
        """The batches of a table kept by batch, in order, as its folders name them."""
        table = WAREHOUSE[name]
        prefix = f"{table.partition_by[0][0]}="
        files, location = file_system(self.spark, self.path(name))
        if not files.exists(location):
            return []
        names = [status.getPath().getName() for status in files.listStatus(location)]
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))

    def months(self, name: str, batches: Sequence[str]) -> set[int]:
        """The months that batches of a table kept by batch and month have rows in. Only folders are listed."""
        part, found = WAREHOUSE[name].partition_by[0][0], set()
        for batch in batches:
            files, folder = file_system(self.spark, f"{self.path(name)}/{part}={batch}")
            if files.exists(folder):
                names = [status.getPath().getName() for status in files.listStatus(folder)]
                found |= {int(n.removeprefix("month=")) for n in names if re.fullmatch(r"month=-?\d+", n)}
        return found

    def batch_bytes(self, name: str, batches: Sequence[str]) -> int:
        """The size of the files of some batches."""
        table = WAREHOUSE[name]
        folders = [f"{self.path(name)}/{table.partition_by[0][0]}={b}" for b in sorted(set(batches))]
        return input_bytes(self.spark, *[f for f in folders if self._exists(f)])

    def read_batches(self, name: str, batches: Sequence[str]) -> DataFrame:
        """The rows of some batches of a table kept by batch. No other folder is listed or opened."""
        table, path = WAREHOUSE[name], self.path(name)
        part = table.partition_by[0][0]
        folders = [f"{path}/{part}={b}" for b in sorted(set(batches))]
        folders = [f for f in folders if self._exists(f)]
        if not folders:
            return self.spark.createDataFrame([], table.columns)
        return self._stored(table, path, *folders).where(F.col(part).isin(*batches)).select(*table.column_names)

    def _laid_out(self, rows: DataFrame, table: Table) -> DataFrame:
        """The rows as they are written: with their partition columns, gathered and sorted for later reads."""
        parts = [part for part, _ in table.partition_by]
        rows = rows.select(*table.column_names).withColumns(
            {part: F.expr(source) for part, source in table.partition_by if part != source})
        # AQE fits the files to the advisory size: it merges small groups and splits very large ones.
        # A staged batch is written as it was read: shuffling it would only size the files.
        # Gathered by single days, every task would hold days of every month and write a file for each.
        if table.layer != "stg":
            group = [f"__{c}" for c in table.cluster_by] or parts
            named = rows.withColumns({f"__{c}": F.expr(f"{c} div {_DAYS}") for c in table.cluster_by})
            rows = (named.hint("rebalance", *group) if group else named.hint("rebalance")).drop(*group if table.cluster_by else ())
        order = (*parts, *table.cluster_by, *table.sort_by)
        return rows.sortWithinPartitions(*order) if order else rows

    def _writer(self, rows: DataFrame, table: Table):
        parts = [part for part, _ in table.partition_by]
        writer = self._laid_out(rows, table).write.option("compression", "zstd")
        return writer.partitionBy(*parts) if parts else writer

    def append(self, rows: DataFrame, name: str) -> None:
        self._writer(rows, WAREHOUSE[name]).mode("append").parquet(self.path(name))

    def overwrite_partitions(self, rows: DataFrame, name: str) -> None:
        """Replace the partitions that ``rows`` has rows for, and no others."""
        (self._writer(rows, WAREHOUSE[name]).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(self.path(name)))

    def overwrite_batch(self, rows: DataFrame, name: str, batch_id: str) -> None:
        """Replace one batch of a table kept by batch, also when there are no rows for it now.

        The stored rows stay in place until the new ones are written in full. The rows are computed once:
        whether there were any shows in the folder they leave.
        """
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"a batch id consists of letters, digits, '_', '-' and '.', not {batch_id!r}")
        files, folder = file_system(self.spark, f"{self.path(name)}/{WAREHOUSE[name].partition_by[0][0]}={batch_id}")
        before = self._files(files, folder)
        self.overwrite_partitions(rows, name)
        # Replacing a partition leaves no file of before in it; no rows leave the partition untouched.
        if before and before == self._files(files, folder):
            files.delete(folder, True)

    def replace_batches(self, rows: DataFrame, name: str, batches: Iterable[str]) -> None:
        """Replace the batches that ``rows`` has rows of, and remove those of ``batches`` that it has none of."""
        part = WAREHOUSE[name].partition_by[0][0]
        present = {r[0] for r in rows.select(part).distinct().collect()}
        self.overwrite_partitions(rows, name)
        for batch in set(batches) - present:
            files, folder = file_system(self.spark, f"{self.path(name)}/{part}={batch}")
            files.delete(folder, True)

    @staticmethod
    def _files(files, folder) -> set[str]:
        if not files.exists(folder):
            return set()
        found, names = files.listFiles(folder, True), set()
        while found.hasNext():
            names.add(found.next().getPath().toString())
        return names

    def replace(self, rows: DataFrame, name: str) -> None:
        """Write the whole table as its next version. Readers see it when the write is finished.

        ``rows`` may be computed from the current version, which stays as it is.
        """
        table = WAREHOUSE[name]
        finished = self.versions(name)
        last = int(finished[-1].rsplit(_VERSION, 1)[1]) if finished else 0
        (self._writer(rows, table).mode("overwrite")
         .parquet(f"{self._base(table)}/{_VERSION}{last + 1:08d}"))
        for old in self.versions(name)[:-self.keep_versions]:
            files, location = file_system(self.spark, old)
            files.delete(location, True)
