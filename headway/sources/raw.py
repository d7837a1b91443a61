"""Raw Parquet tables, as exported: times are ISO-8601 text, money is floating point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.schemas import RAW

# Folder of each raw table below the raw root: the exported tables and the event topic.
FOLDERS = {"vehicle_positions": "kafka"}
TABLES_FOLDER = "oltp"


def raw_root(source: str = "s3a", *, bucket: str = "raw", prefix: str = "", folder: str = "") -> str:
    """Where raw tables lie: ``"file"`` for a local or mounted folder, ``"s3a"`` for an object store."""
    if source == "file":
        if not folder:
            raise ValueError("source 'file' needs a folder")
        return folder.rstrip("/")
    if source == "s3a":
        return "/".join(part for part in (f"s3a://{bucket}", prefix.strip("/")) if part)
    raise ValueError(f"source must be 'file' or 's3a', not {source!r}")


def raw_path(root: str, name: str) -> str:
    return f"{root}/{FOLDERS.get(name, TABLES_FOLDER)}/{name}.parquet"


def read_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All raw tables, read with their declared columns: no footer is opened to find a schema."""
    return {name: spark.read.schema(table.columns).parquet(raw_path(root, name))
            for name, table in RAW.items()}
