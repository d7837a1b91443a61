"""Integrity audits. Each returns rows (table_name, check_name, violations), clean tables included."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.schemas import WAREHOUSE


def _labelled(measured: DataFrame, table: str, check: str) -> DataFrame:
    return measured.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                           F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def duplicate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Per primary or unique key: how many key values occur more than once."""
    checks = []
    for name, rows in tables.items():
        spec = WAREHOUSE[name]
        for keys in (spec.key, *spec.also_unique):
            repeated = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                        .agg(F.count_if(F.col("__n") > 1).alias("violations")))
            checks.append(_labelled(repeated, name, ",".join(keys)))
    return reduce(DataFrame.unionByName, checks)


def missing_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Per required column: how many rows leave it null. One pass over each table."""
    checks = []
    for name, rows in tables.items():
        columns = WAREHOUSE[name].required
        nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        melted = nulls.unpivot([], list(columns), "check_name", "violations")
        checks.append(melted.select(F.lit(name).alias("table_name"), "check_name", "violations"))
    return reduce(DataFrame.unionByName, checks)


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Per reference: how many rows point at a row that does not exist.

    Both sides are reduced to one row per value before they are joined, so neither a value that many rows
    refer to nor one that the audited table wrongly repeats burdens a single task.
    """
    checks = []
    for name, rows in tables.items():
        for ref in WAREHOUSE[name].references:
            if ref.target not in tables:
                continue
            used = (rows.where(F.col(ref.column).isNotNull())
                    .groupBy(F.col(ref.column).alias("__value")).agg(F.count(F.lit(1)).alias("__n")))
            known = tables[ref.target].select(F.col(ref.target_column).alias("__value")).distinct()
            lost = (used.join(known, "__value", "left_anti")
                    .agg(F.sum("__n").alias("violations")))
            checks.append(_labelled(lost, name, f"{ref.column} -> {ref.target}"))
    return reduce(DataFrame.unionByName, checks)


def several_current(routes: DataFrame, name: str = "dim_route_scd2") -> DataFrame:
    """How many routes have more than one current version."""
    crowded = (routes.where("is_current").groupBy("route_id").agg(F.count(F.lit(1)).alias("__n"))
               .agg(F.count_if(F.col("__n") > 1).alias("violations")))
    return _labelled(crowded, name, "one current version")


def overlapping_versions(routes: DataFrame, name: str = "dim_route_scd2") -> DataFrame:
    """How many versions start before the previous version of the same route ends.

    Versions with the same start are counted together first. The next start is then sought inside a
    month, and across months over one row per month, so a route with very many versions is spread over
    its months instead of being sorted in one task.
    """
    month = F.date_trunc("month", "valid_from_dts").alias("__month")
    starts = (routes.groupBy("route_id", month, "valid_from_dts")
              .agg(F.count(F.lit(1)).alias("__n"), F.max("valid_to_dts").alias("__until")))
    months = (starts.groupBy("route_id", "__month")
              .agg(F.min("valid_from_dts").alias("__opening"))
              .withColumn("__next_opening", F.lead("__opening").over(
                  Window.partitionBy("route_id").orderBy("__month")))
              .drop("__opening"))
    inside = F.lead("valid_from_dts").over(
        Window.partitionBy("route_id", "__month").orderBy("valid_from_dts"))
    following = F.coalesce("__inside", "__next_opening")
    measured = (starts.withColumn("__inside", inside)
                .join(months, ["route_id", "__month"])
                .agg(F.sum(F.col("__n") - 1
                           + F.when(following < F.col("__until"), 1).otherwise(0)).alias("violations")))
    return _labelled(measured, name, "versions do not overlap")
