"""Documents to packed training sequences: rules, line dedup, near-dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import lines, mixing, packing, rules, simhash
from headway.llm.tables import keep, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.judge(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many pages of a source share go; every document stays."""
    return lines.drop_boilerplate(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group whose fingerprints of three-word shingles link at two bits or fewer the smallest id stays."""
    return simhash.drop_near_duplicates(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS).select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    mixed = mixing.mix(mixing.sized(docs)).where("copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences, with their token ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing_sources),
    ("packing", packing_sequences),
]

# Fingerprints and tokens have no counterpart in SQL; tests/llm/test_pipeline.py compares with plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each starting from the files its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
