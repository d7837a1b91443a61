"""Key handling: one row per key, new keys only, surrogate keys and surrogate lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: Sequence[str],
                   newest: Sequence[str] = ("extract_dts", "ingest_dts", "batch_id")) -> DataFrame:
    """One row per key: the newest, with every other column as tie-break, so reruns agree.

    ``row_number() = 1`` is planned with a group limit below the exchange, so each task ships at most
    one row per key: copies of one key, however many, never meet in one task.
    """
    leading = [c for c in newest if c in rows.columns]
    rest = [c for c in rows.columns if c not in leading and c not in keys]
    order = ", ".join([f"{c} DESC NULLS LAST" for c in leading] + [f"{c} ASC NULLS LAST" for c in rest])
    rank = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order})"
    return rows.selectExpr("*", f"{rank} AS __rank").where("__rank = 1").drop("__rank")


def _is_read(plan) -> bool:
    """Whether a logical plan does no more than read, filter and project tables, one below another."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    return not children or plan.nodeName() in ("Project", "Filter", "Union") and all(map(_is_read, children))


def by_rows(side: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """``side`` of a join, kept from being broadcast if its rows are too many for that.

    Spark takes the size of files for the size of rows. Numbers and sorted keys are stored so closely that millions of
    rows pass for a few megabytes, which the driver then has to hold as a hash table; AQE does not take that back, as
    it would cost a shuffle. Here the rows are counted, which reads file footers and what filters need, and only where
    Spark would broadcast. ``source`` is counted in place of ``side`` that comes of it by grouping: it has no fewer rows.
    Nothing is counted that would have to be worked out.
    """
    plan, most = side._jdf.queryExecution().optimizedPlan(), side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    source = side if source is None else source
    if plan.stats().sizeInBytes() > most or not _is_read(source._jdf.queryExecution().optimizedPlan()):
        return side
    width = side._jdf.schema().defaultSize() + 8
    return side.hint("merge") if source.count() * width > most else side


def unseen(rows: DataFrame, existing: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not among the existing ones.

    Existing keys should be unique, as stored tables keep them: the join cannot split copies of one.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return rows.join(by_rows(existing.select(*keys)), keys, "left_anti")


def with_key(rows: DataFrame, key: str) -> DataFrame:
    """``rows``, failing the job at one without a key: a member nobody can refer to must not vanish unseen."""
    missing = F.raise_error(F.lit(f"a row has no {key}")).cast(rows.schema[key].dataType)
    return rows.withColumn(key, F.coalesce(F.col(key), missing))


def stored_among(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The stored keys that occur among the incoming rows.

    For a batch that is small beside the stored table: its keys are broadcast, the stored keys are only
    scanned, and what is left for `unseen` is small. Otherwise it would be a shuffle more.
    """
    return existing.select(key).join(by_rows(incoming.select(key).distinct(), incoming.select(key)), key, "left_semi")


def highest(existing: DataFrame, sk: str) -> Column:
    """The largest key handed out so far, 0 before the first."""
    return F.coalesce(existing.agg(F.max(sk)).scalar(), F.lit(0))


# A page is 2**16 consecutive keys, a book 2**24 consecutive pages: together they cover 64-bit keys.
_PAGE_BITS, _BOOK_BITS = 16, 24


def number_rows(rows: DataFrame, key: str, sk: str, after: Column | int = 0, first: str | None = None) -> DataFrame:
    """Add ``sk`` = ``after`` + position of the row in ``key`` order, 1, 2, 3, ... without gaps.

    With ``first``, an integer column of few values without nulls, rows are numbered by it and then by ``key``, which
    must be unique among rows that agree on it.

    ``key`` must be an integer and unique in ``rows``. A global ``row_number`` would sort everything in
    one task. Here rows are numbered inside pages of consecutive keys, and the page starts come from
    running sums over page sizes. As keys are unique, a page holds at most 65,536 rows and a book at
    most 16.8 million page sizes, whatever the keys are. Pages depend on the key alone, so a recomputed
    task numbers its rows as before.
    """
    # A page that is never null keeps null filters out of the plan, so that the rows read here and the
    # page sizes share one scan and exchange.
    page = f"coalesce(shiftright(CAST({key} AS BIGINT), {_PAGE_BITS}), 0)"
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    lead = [] if first is None else [first]
    of = "".join(f"{c}, " for c in lead)
    paged = rows.selectExpr("*", f"{page} AS __page")
    pages = (paged.groupBy(*lead, "__page").agg(F.count(F.lit(1)).alias("__n"))
             .selectExpr("*", f"shiftright(__page, {_BOOK_BITS}) AS __book")
             .selectExpr("*", f"coalesce(sum(__n) OVER (PARTITION BY {of}__book ORDER BY __page {earlier}), 0)"
                              " AS __in_book"))
    books = (pages.groupBy(*lead, "__book").agg(F.sum("__n").alias("__n"))
             .selectExpr(*lead, "__book", f"coalesce(sum(__n) OVER (PARTITION BY 0 ORDER BY {of}__book {earlier}), 0)"
                                          " AS __in_shelf"))
    starts = pages.join(books, [*lead, "__book"]).selectExpr(*lead, "__page", "__in_book + __in_shelf AS __start")
    after = F.lit(after) if isinstance(after, int) else after
    return (paged.selectExpr("*", f"row_number() OVER (PARTITION BY {of}__page ORDER BY {key}) AS __place")
            .join(starts, [*lead, "__page"])
            .select((F.expr("__place + __start") + after).cast("bigint").alias(sk), *rows.columns))


def look_up(rows: DataFrame, dimension: DataFrame, key: str, sk: str) -> DataFrame:
    """Add the surrogate key of a dimension that has one row per ``key``; null if there is none.

    No broadcast is forced: dimensions grow with the data. Small ones are broadcast by the size
    threshold, and a hot key in a shuffled join is split by AQE, which may split the row side here.
    """
    return rows.join(by_rows(dimension.select(key, sk)), key, "left")
