"""Quality rules: one table of thresholds compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import WORD, text_of, words_of

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with a in is it for was on as are this from by at or an "
    "der die und das den von zu ist ein eine mit im auf für dem des sich nicht auch "
    "le la les de et un une que est en du pour dans qui au sur pas par "
    "el los las y se por una para con no es lo como más"
).split()

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``part`` must lie between ``low`` and ``high`` percent of ``whole``; None leaves a side open."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None


# Counts are compared as integers, so no rounding decides about a document.
RULES = (
    Rule("word_length", "word_chars", "n_words", 300, 1000),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("stop_words", "n_stop_words", "n_words", 2, None),
    Rule("capitals", "n_capital_words", "n_words", None, 30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 30),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
          "n_capital_words", "n_ellipsis_lines", "n_bullet_lines")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts in ``COUNTS`` (long, never null) to every row.

    n_words; word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``; n_lines: lines with a
    word; n_dup_lines: those equal to an earlier line; n_repeat_words: words inside windows of eight words
    that occur twice or more, the first occurrence included; n_stop_words, n_capital_words: words of the
    stop list, words with letters but none in lower case; n_ellipsis_lines, n_bullet_lines: lines that end
    with an ellipsis or begin with a bullet. A null or empty text has zero of everything.

    Windows are compared by 64-bit hashes that double in width: one word, two, four, eight. Only a text
    that has an equal pair of windows is sorted to find which words they cover. Everything stays in the
    row, so the cost of a row follows the length of its text and nothing is shuffled.
    """
    w, m = "size(__words)", "size(__sorted)"
    stop = ", ".join(f"'{x}'" for x in STOP_WORDS)
    steps = (
        {"__text": text_of(text)},
        {"__words": words_of(F.col("__text")),
         "__lines": F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))},
        {"__h1": F.expr("transform(__words, x -> xxhash64(x))")},
        {"__h2": F.expr(f"transform(slice(__h1, 1, greatest({w} - 1, 0)), (h, i) -> xxhash64(h, get(__h1, i + 1)))")},
        {"__h4": F.expr(f"transform(slice(__h2, 1, greatest({w} - 3, 0)), (h, i) -> xxhash64(h, get(__h2, i + 2)))")},
        {"__h8": F.expr(f"transform(slice(__h4, 1, greatest({w} - 7, 0)), (h, i) -> xxhash64(h, get(__h4, i + 4)))")},
        {"__sorted": F.expr("CASE WHEN size(array_distinct(__h8)) < size(__h8) THEN "
                            "array_sort(transform(__h8, (h, i) -> struct(h AS h, i AS i))) END")},
        {"__starts": F.expr("array_sort(transform(filter(__sorted, (x, j) -> "
                            "(j > 0 AND get(__sorted, j - 1).h = x.h) OR "
                            f"(j < {m} - 1 AND get(__sorted, j + 1).h = x.h)), x -> x.i))")},
        {"__n_words": F.expr(w),
         "__word_chars": F.expr("aggregate(__words, 0L, (n, x) -> n + length(x))"),
         "__n_symbols": F.expr(f"length(__text) - length(translate(__text, '{SYMBOLS}', ''))"),
         "__n_dup_lines": F.expr("size(__lines) - size(array_distinct(__lines))"),
         # Each repeated window adds its words up to where the next one starts.
         "__n_repeat_words": F.expr(f"coalesce(aggregate(transform(__starts, (p, j) -> least({WINDOW}, "
                                  f"coalesce(get(__starts, j + 1) - p, {WINDOW}))), 0L, (n, x) -> n + x), 0L)"),
         "__n_lines": F.expr("size(__lines)"),
         "__n_stop_words": F.expr(f"size(filter(__words, x -> lower(x) IN ({stop})))"),
         "__n_capital_words": F.expr("size(filter(__words, x -> upper(x) = x AND lower(x) <> x))"),
         "__n_ellipsis_lines": F.expr("size(filter(__lines, x -> rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…'))"),
         "__n_bullet_lines": F.expr("size(filter(__lines, x -> left(ltrim(x), 1) IN ('-', '*', '•')))")},
    )
    columns = [c for c in docs.columns if c.lower() not in COUNTS]
    for step in steps:
        docs = docs.withColumns(step)
    # A generator hands the counts on: were they plain projections, a filter on them would be pushed below and
    # every mention of a count would repeat all the work behind it.
    counts = F.inline_outer(F.array(F.struct(*[F.col(f"__{c}").cast("long").alias(c) for c in COUNTS])))
    return docs.select(*columns, counts)


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the counts of `measure`, ``base_failed`` and ``kept`` to every row; no row is removed.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows. ``kept``: the base holds
    and so does every rule. An empty or null text fails. Equal texts get equal verdicts, and a text at a
    threshold passes. Texts of any length are judged whole, in their row.
    """
    checks = []
    for rule in rules:
        if rule.low is not None:
            checks.append(f"100 * {rule.part} >= {rule.low} * {rule.whole}")
        if rule.high is not None:
            checks.append(f"100 * {rule.part} <= {rule.high} * {rule.whole}")
    verdict = reduce(and_, [F.expr(c) for c in checks], F.expr("NOT base_failed"))
    return (measure(docs, text)
            .withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
            .withColumn("kept", verdict))
