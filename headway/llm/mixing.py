"""Mixing sources to target weights with pivotal dependent rounding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import keep, text_of, words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
# Members of one node of the reduction tree, on average.
FAN_IN = 64


def ranked(sizes: DataFrame) -> DataFrame:
    """Add ``place``, from 0, to one row per ``source``: its place in code point order, null last.

    Sources are sorted over all tasks and stored; each sorted part is then numbered by itself, behind the parts before
    it. Only one row per part meets in one task.
    """
    sorted_parts = keep(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("__part", F.spark_partition_id()), "mix-sources")
    parts = sorted_parts.groupBy("__part").count().selectExpr(
        "__part AS __of", "coalesce(sum(count) OVER (ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __before")
    inside = sorted_parts.selectExpr("*", "row_number() OVER (PARTITION BY __part ORDER BY source ASC NULLS LAST) - 1 AS __inside")
    return (inside.join(F.broadcast(parts), F.expr("__part = __of"))
            .selectExpr(*sizes.columns, "__before + __inside AS place"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """Add ``target`` to one row per source with ``source`` and ``source_size``.

    Sources in code point order, null last, take the weights in turn and split ``share`` times the sum of all
    sizes by weight. A target stops at ``most`` times the size of its source; what is over goes to the others
    by weight until none is above. That ends where every open target is its weight times one level.

    The level is found by raising it: sources that it fills stop, and what they leave raises it for the others,
    until it fills no other. Each step adds up sizes and counts of sources, in whole numbers, so reruns agree, and
    one row comes to the driver. No source waits for another in one task, as a mix of hosts may have very many.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = keep(ranked(sizes).withColumn("turn", F.expr(f"CAST(place % {len(weights)} AS INT)"))
                   .withColumn("weight", F.get(cycle, F.col("turn"))).drop("place"), "mix-weights")
    level = 0.0
    while True:
        stops = F.col("source_size") * F.lit(float(most)) <= F.col("weight") * F.lit(level)
        sums = weighed.groupBy("turn", stops.alias("stops")).agg(F.count("*").alias("n"), F.sum("source_size").alias("size")).collect()
        total = sum(r.size for r in sums)
        stopped = sum(r.size for r in sums if r.stops)
        gone = sum(weights[r.turn] * r.n for r in sums if not r.stops)
        raised = (share * total - most * stopped) / gone if gone else level
        if raised <= level:
            break
        level = raised
    return weighed.select("source", "source_size", F.least(
        F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level)).alias("target"))


_ITEM = "STRUCT<size: BIGINT, id: STRUCT<id: BIGINT, size: BIGINT>, x: DOUBLE, u: DOUBLE>"


def _item(of: str, x: str) -> str:
    return f"named_struct('size', {of}.size, 'id', {of}.id, 'x', {x}, 'u', {of}.u)"


def _pivot(items: str) -> str:
    """SQL that folds an array of items (size, id, x, u) into decided ones and at most one open one.

    The open item a meets the next item b. At most ``up`` words can move from b to a and ``down`` words from a
    to b before a share is 0 or 1. Up is chosen with probability down / (up + down), u being uniform.
    """
    a, b = "acc.open", "item"
    room_a, has_a = f"((1 - {a}.x) * {a}.size)", f"({a}.x * {a}.size)"
    room_b, has_b = f"((1 - {b}.x) * {b}.size)", f"({b}.x * {b}.size)"
    up, down = f"least({room_a}, {has_b})", f"least({has_a}, {room_b})"
    goes_up = f"({b}.u * ({up} + {down}) < {down})"
    # Which of the two becomes whole follows from the comparison, not from rounded shares.
    a_decided = f"IF({goes_up}, {room_a} <= {has_b}, {has_a} <= {room_b})"
    moved = f"IF({goes_up}, {up}, -{down})"
    step = f"""
      CASE WHEN {a} IS NULL THEN named_struct('open', item, 'done', acc.done)
           WHEN {a_decided} THEN named_struct(
             'open', {_item(b, f"{b}.x - {moved} / {b}.size")},
             'done', array_append(acc.done, {_item(a, f"IF({goes_up}, 1D, 0D)")}))
           ELSE named_struct(
             'open', {_item(a, f"{a}.x + {moved} / {a}.size")},
             'done', array_append(acc.done, {_item(b, f"IF({goes_up}, 0D, 1D)")})) END"""
    start = f"named_struct('open', CAST(NULL AS {_ITEM}), 'done', CAST(array() AS ARRAY<{_ITEM}>))"
    return f"aggregate({items}, {start}, (acc, item) -> {step})"


def round_shares(items: DataFrame, seed: int = 42, fan_in: int = FAN_IN) -> DataFrame:
    """``source``, ``doc_id``, ``size`` and ``extra`` (0 or 1) for items with a fractional share ``x``.

    Pivotal dependent rounding. Two open items of a source meet, and words move at random from one to the
    other until one of them is taken whole or not at all; the chances are such that no item's expectation
    changes, and the words of the two together stay the same. Nodes of a tree do this for about ``fan_in``
    items each, longest first, and hand one open item up; the next level pairs those. The last open item of a
    source, as a rule a short one, is taken with the chance that its share has come to. A source's words so miss
    their target by that item at most.

    An item's node depends on a hash of its id, so reruns agree and no source is too large: it has nodes in
    proportion to its items. Each level is stored, and has about 1 / ``fan_in`` of the rows of the one below.
    """
    is_open = "x > 0 AND x < 1 AND size > 0"
    done = [items.where(f"NOT ({is_open})").selectExpr(
        "source", "doc_id", "size", "CAST(IF(x >= 1, 1, 0) AS INT) AS extra")]
    open_items = keep(items.where(is_open).selectExpr("source", "doc_id", "size", "x", f"{_uniform(seed, 0)} AS u"),
                      "mix-open")
    level, last = 0, False
    while not last:
        counts = keep(open_items.groupBy("source").agg(
            F.expr(f"CAST(ceil(count(*) / {fan_in}) AS BIGINT)").alias("nodes")).withColumnRenamed("source", "of"),
            "mix-nodes")
        last = (counts.agg(F.max("nodes")).first()[0] or 0) <= 1
        placed = open_items.join(counts, F.expr("source <=> of")).selectExpr(
            "source", "doc_id", "size", "x", "u", f"pmod(xxhash64(doc_id, size, {seed + level}), nodes) AS node")
        items_of = F.expr("sort_array(collect_list(named_struct('size', size, 'id', doc_id, 'x', x, 'u', u)), false)").alias("items")
        folded = keep(placed.groupBy("source", "node").agg(items_of).select("source", F.expr(_pivot("items")).alias("r")),
                      f"mix-level-{level}")
        level += 1
        done.append(folded.select("source", F.explode("r.done").alias("i")).selectExpr(
            "source", "i.id AS doc_id", "i.size AS size", "CAST(i.x AS INT) AS extra"))
        open_items = folded.where("r.open IS NOT NULL").selectExpr(
            "source", "r.open.id AS doc_id", "r.open.size AS size", "r.open.x AS x",
            f"{_uniform(seed, level, 'r.open.id', 'r.open.size')} AS u")
    done.append(open_items.selectExpr("source", "doc_id", "size", "CAST(u < x AS INT) AS extra"))
    return reduce(DataFrame.unionByName, done)


def _uniform(seed: int, level: int, *of: str) -> str:
    return f"pmod(xxhash64({seed}, {-1 - level}, {', '.join(of or ('doc_id', 'size'))}), 1000003) / 1000003D"


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size``, the number of words of the text."""
    return docs.withColumn("size", F.size(words_of(text_of(text))).cast("long"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, most: float = MOST, seed: int = 42) -> DataFrame:
    """Add source_size, target, copies and taken (copies times size) to rows with a ``size``; see `sized`.

    A document is wanted target / source_size times, at most ``most`` times. Its whole part is certain, the
    fraction is rounded so that the words taken of a source come near its target; see `round_shares`.

    Rows without a source are a source of their own. Rows that repeat doc_id, source and size cannot be told
    apart: they are one item and get the same copies, and a null doc_id is an id like any other. A document
    without words counts no words and gets the certain copies only; a very long one is taken whole or not. An empty
    table gives an empty result.
    """
    docs = docs.drop("source_size", "target", "copies", "taken")
    rows = docs.withColumns({"__id": F.col(doc_id), "__source": F.col(source), "__size": F.col("size")})
    items = keep(rows.groupBy("__source", "__id", "__size").count(), "mix-items")
    sizes = items.groupBy("__source").agg(F.sum(F.expr("__size * count")).alias("source_size"))
    recipe = keep(targets(sizes.withColumnRenamed("__source", "source"), weights, share, most), "mix-targets")

    wanted = items.join(recipe, F.expr("__source <=> source")).withColumn(
        "q", F.expr("coalesce(target / nullif(source_size, 0), 0D)"))
    # Copies of a row weigh together; `size` is that weight from here on.
    shares = wanted.selectExpr("source", "struct(__id AS id, __size AS size) AS doc_id", "__size * count AS size",
                               "q - floor(q) AS x")
    extra = round_shares(shares, seed).selectExpr("source AS __of", "doc_id AS __key", "extra")
    decided = keep(wanted.join(extra, F.expr("source <=> __of AND struct(__id AS id, __size AS size) <=> __key"))
                   .selectExpr("__source AS __s", "__id AS __i", "__size AS __z", "source_size", "target",
                               "CAST(floor(q) + extra AS BIGINT) AS copies"), "mix-copies")
    return (rows.join(decided, F.expr("__source <=> __s AND __id <=> __i AND __size <=> __z"))
            .withColumn("taken", F.expr("copies * size"))
            .drop("__source", "__id", "__size", "__s", "__i", "__z"))
