"""Boilerplate lines by their frequency on one site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import WORD, fingerprint128, keep, text_of

RATIO = 0.05


def boilerplate(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO) -> DataFrame:
    """One row per site and boilerplate line: ``site``, ``line`` (a 128-bit hash), ``n_pages``, ``total``.

    A line is boilerplate on a page if more than ``ratio`` of the other pages of the site hold it, so what one page
    alone says never is, on a site of any size. A page counts once for a line however often it repeats it, and rows
    of a site with the same text are one page: a page copied often enough would otherwise pass for boilerplate, and
    every copy would lose all its lines. Lines without a word never count. Rows without a site form a site of their
    own. As every such line takes a share of the lines of the site, a site has at most about (lines per page /
    ratio) of them, however many pages it has.

    Counts are combined in each task before the exchange, which carries hashes, not lines.
    """
    lines = F.array_distinct(F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD)))
    by_page = docs.select(F.col(site).alias("site"), text_of(text).alias("__text"))
    page = fingerprint128(F.col("__text")).alias("page")
    totals = by_page.select("site", page).groupBy("site").agg(F.countDistinct("page").alias("total"))
    counts = (by_page.select("site", page, F.explode(lines).alias("line"))
              .select("site", "page", fingerprint128(F.col("line")).alias("line"))
              .groupBy("site", "line").agg(F.countDistinct("page").alias("n_pages")))
    return (counts.where("n_pages > 1").join(totals.withColumnRenamed("site", "of"), F.expr("site <=> of")).drop("of")
            .where(F.col("n_pages") - 1 > ratio * (F.col("total") - 1)))


def drop_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO) -> DataFrame:
    """The rows without the boilerplate lines of their site, with ``n_lines`` and ``n_dropped`` (long).

    ``n_lines`` counts all \\n-separated lines of a text, ``n_dropped`` those removed; the others stay in order
    and as they were. No row is removed: a text of boilerplate alone becomes empty, a null text stays null
    (no line, none dropped), an empty text is one empty line, which stays. Repeated rows are treated alike.

    The lines to drop are stored as one short row per site. Spark broadcasts them if they are small;
    otherwise it splits the pages of a hot site. A page first meets them as two sets of numbers; only a page that
    has some of them is searched line by line, for these. Texts of any length are worked off in their row.
    """
    bad = keep(boilerplate(docs, site, text, ratio)
               .groupBy(F.col("site").alias("__site"))
               .agg(F.collect_list("line").alias("__bad"))
               .withColumn("__bad_a", F.transform("__bad", lambda x: x["a"])), "boilerplate")
    joined = docs.join(bad, docs[site].eqNullSafe(bad["__site"]), "left")
    lines = joined.withColumn("__lines", F.split(F.col(text), "\n"))
    lines = lines.withColumn("__met", F.array_intersect(F.transform("__lines", lambda x: fingerprint128(x)["a"]), "__bad_a"))
    lines = lines.withColumn("__bad", F.when(F.size("__met") > 0, F.filter("__bad", lambda x: F.array_contains("__met", x["a"]))))
    cleaned = lines.withColumn("__kept", F.when(
        F.col("__bad").isNull(), F.col("__lines")).otherwise(F.filter(
            "__lines", lambda x: ~F.array_contains("__bad", fingerprint128(x)))))
    size = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)).cast("long")
    return cleaned.withColumns({
        text: F.when(F.col(text).isNotNull(), F.array_join("__kept", "\n")),
        "n_lines": F.when(F.col("__lines").isNull(), F.lit(0)).otherwise(size("__lines")),
        "n_dropped": F.when(F.col("__lines").isNull(), F.lit(0)).otherwise(size("__lines") - size("__kept")),
    }).drop("__site", "__bad", "__bad_a", "__met", "__lines", "__kept")
