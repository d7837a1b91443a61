"""Warehouse tables in a database, for sites that keep staging, core or mart there."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Read in ``parts`` parallel ranges of a numeric, date or timestamp column.

    The bounds only place the cuts; rows outside them, and nulls, are read as well.
    """

    column: str
    lower: str | int
    upper: str | int
    parts: int


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    # Further driver properties, e.g. stringtype=unspecified to let the server cast strings.
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        login = {"user": self.user, "password": self.password} if self.user else {}
        return {"url": self.url, "driver": self.driver, **login, **self.properties}

    def read_options(self, table: str, split: Split | None = None, fetch: int = 10_000) -> dict[str, str]:
        cuts = {} if split is None else {
            "partitionColumn": split.column, "lowerBound": str(split.lower),
            "upperBound": str(split.upper), "numPartitions": str(split.parts)}
        return {**self.options(), "dbtable": table, "fetchsize": str(fetch), **cuts}

    def write_options(self, table: str, batch: int = 10_000, connections: int | None = None,
                      **extra: str) -> dict[str, str]:
        limit = {} if connections is None else {"numPartitions": str(connections)}
        return {**self.options(), "dbtable": table, "batchsize": str(batch), **limit, **extra}

    def read(self, spark: SparkSession, table: str, split: Split | None = None) -> DataFrame:
        """A table; without ``split`` one task reads all of it. Filters and columns are pushed down."""
        return spark.read.format("jdbc").options(**self.read_options(table, split)).load()

    def append(self, rows: DataFrame, table: str, connections: int | None = None, **extra: str) -> None:
        """Append rows; ``connections`` bounds how many tasks write at once.

        ``extra`` are writer options such as ``createTableOptions``.
        """
        (rows.write.format("jdbc").mode("append")
         .options(**self.write_options(table, connections=connections, **extra)).save())
