"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.components import connected
from headway.llm.tables import keep, ship, text_of

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits, of which one is set if it is set in over half of the hashes of the shingles.

    Words are runs without ASCII white space, with A-Z in lower case. A shingle is ``shingle`` words joined by
    spaces; fewer words are one shingle, and no words give 0. Repeated shingles count each time.
    """
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:].tolist()
    first = [0] + (ends[:n - 1] + 1).tolist()
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, _AT_ONCE):
        values = [hashed(data[i:j], SEED) for i, j in zip(first[at:at + _AT_ONCE], last[at:at + _AT_ONCE], strict=False)]
        bits = np.unpackbits(np.array(values, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("content"), pa.array(np.array(prints, np.uint64).view(np.int64))],
            ["doc_id", "content", "fp"])


def masks(radius: int = RADIUS) -> list[int]:
    """Bit masks such that any two words that differ in at most ``radius`` bits agree under one of them.

    Every bit gets a vector over GF(2) with ``radius`` + 1 places, and every nonzero vector v of that length a
    mask of the bits whose vector has an odd product with v. Up to ``radius`` differing bits are as many linear
    equations in one unknown more, so some v is orthogonal to all of them: its mask leaves those bits out.
    """
    vectors = range(1, 2 ** (radius + 1))
    of_bit = [vectors[bit % len(vectors)] for bit in range(BITS)]
    return [sum(1 << bit for bit, m in enumerate(of_bit) if (m & v).bit_count() & 1) for v in vectors]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp``, each of at most ``radius`` bits.

    The edges connect whatever chains of links of at most ``radius`` bits connect. Fingerprints that share
    no masked value with another are done. The others name the values half the radius away from them, in
    the bits their mask leaves out: two are within the radius just if they name a common value. Those that
    name a value are linked to the smallest of them. So the work is a fixed number of rows per fingerprint
    however many of them crowd in one bucket, and no bucket is paired off or capped.
    """
    if radius % 2:
        raise ValueError("fingerprints are linked through the value half way: the radius must be even")
    steps = [[_signed(sum(1 << bit for bit in flipped)) for n in range(radius // 2 + 1)
              for flipped in combinations([b for b in range(BITS) if not mask >> b & 1], n)]
             for mask in masks(radius)]
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
                       for t, mask in enumerate(masks(radius))])
    bucketed = prints.select("fp", F.explode(tables).alias("at")).select("fp", "at.t", "at.key")
    crowded = bucketed.groupBy("t", "key").count().where("count > 1").select("t", "key")
    members = bucketed.join(crowded, ["t", "key"], "left_semi")
    flips = F.array(*[F.array(*[F.lit(x) for x in of_table]) for of_table in steps])
    named = members.select("fp", F.explode(F.get(flips, F.col("t"))).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    # At most one fingerprint per flip names a value: the sets stay small.
    stars = named.groupBy("value").agg(F.sort_array(F.collect_set("fp")).alias("near")).where("size(near) > 1")
    return stars.select(F.expr("near[0]").alias("b"), F.explode(F.expr("slice(near, 2, size(near) - 1)")).alias("a")).distinct()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Stored: doc_id, content (a hash of the text) and fp, one row per document."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"),
                       F.xxhash64(text_of(text)).alias("content"))
    return keep(rows.mapInArrow(lambda batches: _fingerprints(batches, shingle), "doc_id long, content long, fp long"),
                "fingerprints")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, content, fingerprint (16 hexadecimal digits), component, component_id.

    Documents link if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    doc_id that links reach, the document itself included. A null or empty text has the fingerprint 0 and links
    like any other; a null doc_id is passed over in the minimum. Repeated rows each get a row. Other columns
    are ignored, an empty table gives an empty result; a very long text is read whole, hashed in parts. ``content`` tells rows with the same doc_id apart, and
    ``component``, a fingerprint of the component, components that share a doc_id.

    Documents with the same fingerprint are one node from the start, combined before the exchange, so a
    group of copies costs no more than one document beyond its own rows.
    """
    prints = fingerprints(docs, doc_id, text, shingle)
    nodes = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    roots = connected(keep(links(nodes, radius), "fingerprint-links"))
    linked = roots.join(nodes, roots["node"] == nodes["fp"]).select("node", "root", "first")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = keep(linked.join(smallest, "root").select(F.col("node").alias("fp"), "root", "component_id"), "fingerprint-components")
    alone = F.col("root").isNull()
    labels = nodes.join(of_node, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("component"),
        F.when(alone, F.col("first")).otherwise(F.col("component_id")).alias("component_id"))
    return prints.join(labels, "fp").select(
        "doc_id", "content", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                         radius: int = RADIUS) -> DataFrame:
    """One row of each component, that with the smallest doc_id, with all columns of the input.

    A null doc_id counts as larger than any other. Of rows that agree in doc_id and text one stays.
    """
    return one_of_each(docs, near_duplicates(docs, doc_id, text, shingle, radius), doc_id, text)


def one_of_each(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest doc_id of each ``component`` in ``found`` (doc_id, content, component)."""
    # Three key columns without nulls, so that the join and the choice among equal rows share one shuffle of the
    # texts.
    key = lambda own, content: {"__n": F.isnull(own), "__d": F.coalesce(own, F.lit(0)), "__c": content}
    marked = F.struct(*[c.alias(name) for name, c in key(F.col("doc_id"), F.col("content")).items()])
    chosen = keep(found.groupBy("component").agg(F.min(marked).alias("best")).select("best.*"), "near-dedup-kept")
    rows = docs.withColumns(key(F.col(doc_id).cast("long"), F.xxhash64(text_of(text))))
    kept = rows.join(chosen, ["__n", "__d", "__c"], "left_semi")
    rank = F.expr("row_number() OVER (PARTITION BY __n, __d, __c ORDER BY __c)")
    return kept.withColumn("__rank", rank).where("__rank = 1").select(*docs.columns)
