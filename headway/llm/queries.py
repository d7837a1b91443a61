"""The registered corpus queries: each operator over its whole table, and the same in SQL where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import ctw, exact, gam, html, jaccard, lines, mixing, packing, phrases, records, repeats, rules, simhash
from headway.llm.tables import keep, table, text_of, words_of
from headway.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query
def op1_exact_dedup(spark, sf_dir):
    return exact.mark_copies(documents(spark, sf_dir))


ORACLE["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


# Labels of these documents are not learnt from.
HELD_OUT = "crc32(CAST(doc_id AS STRING)) % 4 = 2"


@query
def op2_quality_model(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = gam.train(docs, labels.where(f"NOT ({HELD_OUT})"))
    return gam.score(docs, model).selectExpr(
        "doc_id", f"coalesce({HELD_OUT}, false) AS held_out", "score", "CAST(score >= 0.7 AS INT) AS predicted")


@query
def op3_mixing(spark, sf_dir):
    rows = keep(mixing.sized(documents(spark, sf_dir)).select("doc_id", "source", "size"), "sizes")
    return mixing.mix(rows).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_line_dedup(spark, sf_dir):
    cleaned = lines.drop_boilerplate(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


ORACLE["op4_line_dedup"] = f"""
WITH pages AS (
  SELECT row_number() OVER () AS page, doc_id, source, text FROM documents),
lines AS (
  SELECT page, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM pages WHERE text IS NOT NULL),
totals AS (SELECT source, count(DISTINCT coalesce(text, '')) AS total FROM pages GROUP BY source),
counts AS (
  SELECT source, line, count(DISTINCT text) AS n FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY source, line),
bad AS (
  SELECT c.source, c.line FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE n - 1 > {lines.RATIO}::DOUBLE * (total - 1)),
marked AS (
  SELECT page, l.line, place, b.line IS NOT NULL AS dropped FROM lines l
  LEFT JOIN bad b ON b.source IS NOT DISTINCT FROM l.source AND b.line = l.line),
cleaned AS (
  SELECT page, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '') AS text
  FROM marked GROUP BY page)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       sha256(coalesce(c.text, '')) AS text_sha256
FROM pages LEFT JOIN cleaned c USING (page)
"""


@query
def op8_html_text(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op9_quality_rules(spark, sf_dir):
    judged = rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept")


def _rules_sql() -> str:
    stop = ", ".join(f"'{x}'" for x in rules.STOP_WORDS)
    checks = [f"100 * {r.part} >= {r.low} * {r.whole}" for r in rules.RULES if r.low is not None]
    checks += [f"100 * {r.part} <= {r.high} * {r.whole}" for r in rules.RULES if r.high is not None]
    word, bullets = "[^\\x20\\x09-\\x0D]", "('-', '*', '•')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS page, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{word}+') AS w FROM documents),
windows AS (
  SELECT page, unnest(range(1, len(w) - 6)) AS i,
         unnest(list_transform(range(1, len(w) - 6), lambda k: array_to_string(w[k:k + 7], ' '))) AS words
  FROM d WHERE len(w) >= 8),
twice AS (
  SELECT page, i FROM windows QUALIFY count(*) OVER (PARTITION BY page, words) > 1),
covered AS (
  SELECT page, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (
    SELECT page, i, lead(i) OVER (PARTITION BY page ORDER BY i) AS nxt FROM twice) GROUP BY page),
lines AS (
  SELECT page, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS l FROM d),
m AS (
  SELECT doc_id, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(text) - length(translate(text, '{rules.SYMBOLS}', '')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    len(list_filter(w, lambda x: list_contains([{stop}], lower(x)))) AS n_stop_words,
    len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) AS n_capital_words,
    len(list_filter(l, lambda x: rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…')) AS n_ellipsis_lines,
    len(list_filter(l, lambda x: left(ltrim(x), 1) IN {bullets})) AS n_bullet_lines
  FROM d JOIN lines USING (page) LEFT JOIN covered USING (page)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {" AND ".join(checks)} AS kept FROM b
"""


ORACLE["op9_quality_rules"] = _rules_sql()


@query
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir)).drop("content", "component")


@query
def op6_lm_scoring(spark, sf_dir):
    return ctw.score(documents(spark, sf_dir), held_out="crc32(CAST(doc_id AS STRING)) % 7 = 2")


@query
def op7_token_records(spark, sf_dir):
    path = scratch_path(spark, "records")
    records.write(documents(spark, sf_dir), path)
    return records.index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "offset", "n_bytes")


@query
def op10_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@query
def op11_periodic_runs(spark, sf_dir):
    # In a tenth of the documents a part is repeated, so that runs of all lengths occur.
    docs = documents(spark, sf_dir).select("doc_id", text_of().alias("text"), F.expr("crc32(CAST(doc_id AS STRING))").alias("h"))
    planted = (docs.withColumn("w", F.when(F.expr("h % 10 = 0"), words_of(F.col("text"))))
               .withColumn("a", F.expr("CASE WHEN size(w) > 0 THEN CAST((h div 10) % size(w) AS INT) END"))
               .withColumn("p", F.expr("CAST(1 + (size(w) - a) div (3 + (h div 10) % 8) AS INT)"))
               .withColumn("text", F.expr("CASE WHEN a IS NULL THEN text ELSE array_join(transform("
                                          "w, (x, i) -> IF(i < a, x, get(w, a + (i - a) % p))), ' ') END")))
    found = repeats.periodic_runs(planted.select("doc_id", "text"))
    longest = "array_min(transform(runs, r -> named_struct('l', -r.length, 'start', r.start, 'period', r.period)))"
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return found.withColumn("b", F.expr(longest)).selectExpr(
        "doc_id", "CAST(size(runs) AS BIGINT) AS n_runs", "b.start AS start", "-b.l AS length", "b.period AS period",
        "1000 * -b.l div b.period AS exponent_milli", f"sha2({listed}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256")


@query
def op12_ngram_jaccard(spark, sf_dir):
    return jaccard.similar_documents(documents(spark, sf_dir))


ORACLE["op12_ngram_jaccard"] = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT i, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 2, 1) + 1), lambda k: array_to_string(w[k:k + 2], ' '))) END AS s FROM d),
shingles AS (SELECT i, unnest(s) AS shingle FROM sets),
links AS (
  SELECT x.i AS a, y.i AS b FROM shingles x JOIN shingles y USING (shingle)
  JOIN sets p ON p.i = x.i JOIN sets q ON q.i = y.i WHERE x.i <> y.i
  GROUP BY x.i, y.i HAVING 100 * count(*) >= 90 * (any_value(len(p.s)) + any_value(len(q.s)) - count(*))),
reach AS (SELECT i, i AS j FROM sets UNION SELECT r.i, l.b FROM reach r JOIN links l ON l.a = r.j)
SELECT any_value(s.doc_id) AS doc_id, any_value(len(s.s))::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM reach r JOIN sets s ON s.i = r.i JOIN sets o ON o.i = r.j GROUP BY r.i
"""


@query
def op13_phrases(spark, sf_dir):
    return phrases.collocations(documents(spark, sf_dir))


ORACLE["op13_phrases"] = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p
  FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, p, count(*) AS f FROM grams GROUP BY lang, k, p HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
cuts AS (SELECT lang, k, p, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[:cut] JOIN f y ON y.lang = c.lang AND y.p = c.p[cut + 1:]),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
around AS (
  SELECT lang, p, max(a) AS a FROM (
    SELECT lang, f AS a, unnest([p[:2], p[2:]]) AS p FROM f WHERE k = 3) GROUP BY lang, p),
kept AS (
  SELECT l.*, array_to_string(l.p, ' ') AS phrase FROM lowest l LEFT JOIN around o ON o.lang = l.lang AND o.p = l.p
  WHERE o.a IS NULL OR 100 * o.a < 50 * l.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
