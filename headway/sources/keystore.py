"""Keys of a stored fact in buckets, so that looking for new rows shuffles the new rows only."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.schemas import CORE
from headway.session import file_system
from headway.sources.warehouse import Warehouse

BUCKETS = 64


class KeyStore:
    """The keys of one fact as a table clustered by key.

    An anti-join with it takes the stored side as it lies: neither its rows nor its sort are moved. Buckets should
    hold some hundred MB of keys at most; their number is fixed when the store is made.

    Keys are added after the rows they belong to. A load that broke off in between leaves the store short, which
    `check` sees by the numbers of rows and mends from the fact, of which it reads the key alone.
    """

    def __init__(self, warehouse: Warehouse, fact: str, buckets: int = BUCKETS):
        self._warehouse, self._fact, self._buckets = warehouse, fact, buckets
        self.key = CORE[fact].key[0]
        self._path = f"{warehouse.root}/core/{fact}_keys"
        self._name = f"{fact}_keys_{hashlib.sha256(self._path.encode()).hexdigest()[:12]}"
        self._declare()

    def _declare(self) -> None:
        # The catalog of a session may be new; the files say nothing about their buckets by themselves.
        self._warehouse.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name} ({self.key} STRING) USING parquet "
            f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self._buckets} BUCKETS LOCATION '{self._path}'")

    def table(self) -> DataFrame:
        self._warehouse.spark.catalog.refreshTable(self._name)
        return self._warehouse.spark.table(self._name)

    def add(self, keys: DataFrame) -> None:
        """Append keys, a file per bucket."""
        rows = keys.select(F.col(self.key).cast("string")).repartition(self._buckets, self.key)
        rows.write.insertInto(self._name)

    def check(self) -> bool:
        """Whether the store was as long as the fact; if not, it is made anew from it. Both counts come from footers."""
        fact = self._warehouse.read(self._fact)
        if self.table().count() == fact.count():
            return True
        files, folder = file_system(self._warehouse.spark, self._path)
        self._warehouse.spark.sql(f"DROP TABLE IF EXISTS {self._name}")
        files.delete(folder, True)
        self._declare()
        self.add(fact)
        return False
