"""Type-2 history of routes: merging a snapshot, and looking up the version valid at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.calendar import instant
from headway.operators.dimensions import ROUTE_ATTRIBUTES, mark_known, open_versions
from headway.operators.keys import by_rows, highest, latest_per_key, number_rows, with_key
from headway.schemas import CORE, OPEN_END


def merge_routes(dimension: DataFrame, staged: DataFrame, load_dts: str,
                 first_valid_from: str | None = None) -> DataFrame:
    """The whole route dimension after loading a newer state of the routes.

    Unchanged routes and routes missing from the batch stay as they are. A changed route has its current
    version closed at ``load_dts`` and gets a new one from then on. Comparison is null-safe. A new route
    starts at ``load_dts``, or at ``first_valid_from`` when given; one with closed versions only is not new. Loading a state that is not newer than
    a version it would close fails the job.
    """
    batch = latest_per_key(with_key(staged, "route_id"), ["route_id"])
    incoming = batch.select("route_id", F.struct(*ROUTE_ATTRIBUTES).alias("__new"))
    stored = F.struct(*ROUTE_ATTRIBUTES)
    load = instant(load_dts)

    changed = (F.col("is_current") & F.col("__new").isNotNull()
               & ~F.col("__new").eqNullSafe(stored))
    closed_at = F.when(load > F.col("valid_from_dts"), load).otherwise(
        F.raise_error(F.concat(F.lit("route state is not newer than the current version of route "),
                               F.col("route_id"))).cast("timestamp"))
    kept = (dimension.join(incoming, "route_id", "left")
            .withColumn("__changed", changed)
            .withColumn("valid_to_dts",
                        F.when(F.col("__changed"), closed_at).otherwise(F.col("valid_to_dts")))
            .withColumn("is_current", F.col("is_current") & ~F.col("__changed"))
            .withColumn("updated_dts", F.when(F.col("__changed"), load).otherwise(F.col("updated_dts")))
            .select(*CORE["dim_route_scd2"].column_names))

    current = dimension.where("is_current").select("route_id", stored.alias("__old"))
    # A struct never equals a missing one, so this also keeps routes without a current version.
    needed = (incoming.join(current, "route_id", "left")
              .where(~F.col("__new").eqNullSafe(F.col("__old")))
              .select("route_id", *[F.col(f"__new.{c}").alias(c) for c in ROUTE_ATTRIBUTES]))
    numbered = number_rows(needed, "route_id", "route_sk", highest(dimension, "route_sk"))
    start = load
    if first_valid_from is not None:
        numbered = mark_known(numbered, dimension)
        start = F.when(F.col("__known"), load).otherwise(instant(first_valid_from))
    opened = open_versions(numbered, start, load_dts)
    return kept.unionByName(opened)


def merge_snapshots(dimension: DataFrame, staged: DataFrame, first_valid_from: str | None = None) -> DataFrame:
    """The whole route dimension after any number of route states, each staged as a batch of its own.

    The same as loading the batches one by one, each at its ``extract_dts``: the states of a route are put in order,
    a state equal to the one before is no change, and what remains is spliced in behind the current version in one
    go. Versions that open and close in between appear too, and surrogate keys follow the order of batches. Routes
    missing from a batch stay as they are; comparison is null-safe.

    A state no newer than the current version of its route must be what the dimension already says of that time, as
    after a load that broke off and is repeated; otherwise the job fails.
    """
    order = Window.partitionBy("route_id").orderBy("extract_dts", "batch_id")
    batches = (staged.select("extract_dts", "batch_id").distinct()
               .withColumn("__state_no", F.row_number().over(Window.orderBy("extract_dts", "batch_id"))))
    states = (latest_per_key(with_key(staged, "route_id"), ["route_id", "batch_id"])
              .join(batches, ["extract_dts", "batch_id"])
              .select("route_id", "extract_dts", "batch_id", "__state_no", F.struct(*ROUTE_ATTRIBUTES).alias("__state")))
    stored = F.struct(*ROUTE_ATTRIBUTES)
    current = dimension.where("is_current").select(
        F.col("route_id").alias("__id"), stored.alias("__current"), F.col("valid_from_dts").alias("__since"))
    versions = dimension.select(F.col("route_id").alias("__of"), stored.alias("__was"), "valid_from_dts", "valid_to_dts")
    then = ((F.col("route_id") == F.col("__of")) & (F.col("valid_from_dts") <= F.col("extract_dts"))
            & (F.col("extract_dts") < F.col("valid_to_dts")))
    stale = F.raise_error(F.concat(F.lit("route state is not newer than the current version of route "), F.col("route_id")))
    passed = F.col("extract_dts") <= F.col("__since")
    known = F.col("__state").eqNullSafe(F.col("__was"))
    newer = (states.join(current, F.col("route_id") == F.col("__id"), "left").join(versions, then, "left")
             .where(F.when(passed & ~known, stale.cast("boolean")).otherwise(F.coalesce(~passed, F.lit(True)))))

    # Gaps and islands: a state opens a version where it differs from the one before it.
    before = F.when(F.row_number().over(order) == 1, F.col("__current")).otherwise(F.lag("__state").over(order))
    changes = newer.withColumn("__before", before).where(~F.col("__state").eqNullSafe(F.col("__before")))
    following = F.lead("extract_dts").over(order)
    twice = F.raise_error(F.concat(F.lit("two states of the same time for route "), F.col("route_id"))).cast("timestamp")
    changes = (changes.withColumn("__next", F.when(following <= F.col("extract_dts"), twice).otherwise(following))
               .withColumn("__first", F.row_number().over(order) == 1)
               .select("route_id", "extract_dts", "__next", "__first", "__state_no", "__state.*"))

    closing = changes.where("__first").select(F.col("route_id").alias("__id"), F.col("extract_dts").alias("__closed"))
    ends = F.col("is_current") & F.col("__closed").isNotNull()
    kept = (dimension.join(closing, F.col("route_id") == F.col("__id"), "left").withColumn("__ends", ends)
            .withColumn("valid_to_dts", F.when(F.col("__ends"), F.col("__closed")).otherwise(F.col("valid_to_dts")))
            .withColumn("updated_dts", F.when(F.col("__ends"), F.col("__closed")).otherwise(F.col("updated_dts")))
            .withColumn("is_current", F.col("is_current") & ~F.col("__ends"))
            .select(*CORE["dim_route_scd2"].column_names))

    numbered = number_rows(changes, "route_id", "route_sk", highest(dimension, "route_sk"), first="__state_no")
    start = F.col("extract_dts")
    if first_valid_from is not None:
        numbered = mark_known(numbered, dimension)
        start = F.when(F.col("__known") | ~F.col("__first"), start).otherwise(instant(first_valid_from))
    opened = (numbered.withColumn("valid_from_dts", start)
              .withColumn("valid_to_dts", F.coalesce("__next", instant(OPEN_END)))
              .withColumn("is_current", F.col("__next").isNull())
              .withColumn("updated_dts", F.coalesce("__next", "extract_dts"))
              .select(*CORE["dim_route_scd2"].column_names))
    return kept.unionByName(opened)


def version_at(rows: DataFrame, dimension: DataFrame, at: str) -> DataFrame:
    """Add the ``route_sk`` of the version with ``valid_from <= at < valid_to``; null if there is none.

    An equi-join on the route with the interval as residual condition, so it hashes or sort-merges like
    any other join; a ride is compared with the versions of its own route only.
    """
    versions = dimension.select(F.col("route_id").alias("__route_id"), "route_sk",
                                "valid_from_dts", "valid_to_dts")
    match = ((F.col("route_id") == F.col("__route_id")) & (F.col("valid_from_dts") <= F.col(at))
             & (F.col(at) < F.col("valid_to_dts")))
    return (rows.join(by_rows(versions), match, "left")
            .drop("__route_id", "valid_from_dts", "valid_to_dts"))


def version_at_ordered(rows: DataFrame, dimension: DataFrame, at: str, spread: int = 8) -> DataFrame:
    """The same as `version_at`, by putting versions and rows of a route in one order of time.

    A row takes the last version before it: inside its month by a running last value, and where the month has none
    yet, the one that the months before leave, over one row per route and month. So a route with very many versions
    costs its versions and its rows, not one times the other. ``spread`` deals the rows of a route and month over so
    many parts, each with the versions of that month, so that a busy route does not meet in one task. Versions of a
    route must not overlap.
    """
    of, time = F.col("route_id"), F.col(at)
    usable = of.isNotNull() & time.isNotNull()
    version = F.struct("route_sk", "valid_to_dts")
    versions = dimension.select(of.alias("__of"), F.col("valid_from_dts").alias("__ts"), version.alias("__version"))
    month = F.date_trunc("month", "__ts").alias("__month")
    carried = (versions.select("__of", month, "__ts", "__version").groupBy("__of", "__month")
               .agg(F.max_by("__version", "__ts").alias("__last")))
    needed = rows.where(usable).select(of.alias("__of"), F.date_trunc("month", time).alias("__month")).distinct()
    before = Window.partitionBy("__of").orderBy("__month").rowsBetween(Window.unboundedPreceding, -1)
    carry = (needed.withColumn("__last", F.lit(None).cast(carried.schema["__last"].dataType)).unionByName(carried)
             .groupBy("__of", "__month").agg(F.max("__last").alias("__last"), F.lit(1).alias("__one"))
             .withColumn("__carried", F.last("__last", ignorenulls=True).over(before))
             .select(F.col("__of").alias("__o"), F.col("__month").alias("__m"), "__carried"))

    row = F.struct(*[F.col(c) for c in rows.columns])
    part = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(spread))
    stream = rows.where(usable).select(of.alias("__of"), time.alias("__ts"), part.alias("__part"),
                                       F.lit(None).cast(carried.schema["__last"].dataType).alias("__version"), row.alias("__row"))
    parts = F.explode(F.expr(f"sequence(0L, {spread - 1}L)")).alias("__part")
    marks = versions.join(needed.select(F.col("__of").alias("__o"), F.col("__month").alias("__m")),
                          (F.col("__of") == F.col("__o")) & (F.date_trunc("month", "__ts") == F.col("__m")), "left_semi")
    marks = marks.select("__of", "__ts", parts, "__version", F.lit(None).cast(stream.schema["__row"].dataType).alias("__row"))
    order = (Window.partitionBy("__of", "__month", "__part").orderBy("__ts", F.col("__row").isNotNull())
             .rowsBetween(Window.unboundedPreceding, 0))
    found = (stream.unionByName(marks).select("*", month)
             .withColumn("__inside", F.last("__version", ignorenulls=True).over(order)).where("__row IS NOT NULL"))
    joined = found.join(carry, (F.col("__of") == F.col("__o")) & (F.col("__month") == F.col("__m")), "left")
    last = F.coalesce("__inside", "__carried")
    valid = joined.select("__row.*", F.when(F.col("__ts") < last["valid_to_dts"], last["route_sk"]).alias("route_sk"))
    return valid.unionByName(rows.where(~F.coalesce(usable, F.lit(False))).withColumn(
        "route_sk", F.lit(None).cast(dimension.schema["route_sk"].dataType)))
