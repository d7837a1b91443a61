"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import keep, text_of

PREFIX = 64


def mark_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                prefix: int = PREFIX) -> DataFrame:
    """One row per input row: doc_id, text_sha256, keep_id, group_size, kept.

    Texts are equal when identical; null counts as empty. Of equal texts the largest doc_id stays; a null id
    is smaller than any other. Of rows that repeat both text and doc_id one stays, any one, as nothing tells
    them apart. An empty table gives an empty result. Other columns are ignored. Texts of any length are hashed whole.

    Texts are read once. Their length, the hash of their first characters and their digest go to a narrow
    table, of which each round of refinement reads only the columns it compares: lengths of all rows, prefix
    hashes of rows whose length recurs, digests of rows whose length and prefix recur. A row that is alone
    after a round takes no part in the next. The digest is computed in that one reading because the result
    names it for every row; fetching the texts of the last candidates again would shuffle whole texts.

    Groups are counted before the exchange, so a group of copies ships one row per task; the joins back to
    the rows are equi-joins whose large side AQE splits at a hot key.
    """
    sketch = keep(docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.octet_length(text_of(text)).alias("n_bytes"),
        F.xxhash64(F.substring(text_of(text), 1, prefix)).alias("prefix"),
        F.unhex(F.sha2(text_of(text), 256)).alias("digest")), "exact-sketch")

    lengths = sketch.groupBy("n_bytes").count().where("count > 1").select("n_bytes")
    same_length = sketch.select("n_bytes", "prefix").join(lengths, "n_bytes", "left_semi")
    starts = keep(same_length.groupBy("n_bytes", "prefix").count().where("count > 1")
                  .select("n_bytes", "prefix"), "exact-prefixes")
    candidates = sketch.join(starts, ["n_bytes", "prefix"], "left_semi")
    groups = keep(candidates.groupBy("digest")
                  .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))
                  .where("group_size > 1"), "exact-groups")

    found = sketch.drop("n_bytes", "prefix").join(groups, "digest", "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id", F.lower(F.hex("digest")).alias("text_sha256"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("row") == F.col("best.row"))).alias("kept"))
