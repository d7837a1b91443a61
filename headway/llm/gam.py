"""Quality classifier: an additive model with pairwise interactions, scored by adding up bins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.rules import measure
from headway.llm.tables import keep, ship, text_of, words_of

# Labelled rows that the fit takes at most: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 50, 6
RATE, SHRINK, LEAVES = 0.1, 5.0, 4

_OWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
        "n_capital_words", "n_ellipsis_lines", "n_bullet_lines")
# Properties of the text alone, as ratios of counts.
FEATURES = {
    "log_words": "ln(n_words + 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "stop_words": "n_stop_words / greatest(n_words, 1)",
    "capitals": "n_capital_words / greatest(n_words, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "line_length": "n_words / greatest(n_lines, 1)",
    "distinct_words": "__distinct / greatest(n_words, 1)",
    "digits": "__digits / greatest(word_chars, 1)",
    "marks": "__marks / greatest(n_words, 1)",
    "stops": "__stops / greatest(n_words, 1)",
}


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add one double column ``__x`` (array) with the features of the text to every row."""
    plain = docs.select("*", text_of(text).alias("__plain"))
    without = lambda chars: F.length("__plain") - F.length(F.translate("__plain", chars, ""))
    counted = measure(plain, "__plain").withColumns({
        "__distinct": F.size(F.array_distinct(words_of(F.col("__plain")))), "__digits": without("0123456789"),
        "__marks": without("!?"), "__stops": without(".,;:")})
    return counted.withColumn("__x", F.array(*[F.expr(f"CAST({x} AS DOUBLE)") for x in FEATURES.values()])).drop(
        "__plain", "__distinct", "__digits", "__marks", "__stops", *_OWN)


@dataclass
class Model:
    """Edges of bins and lookup tables of each feature, and tables of pairs on coarser bins."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: bins looked up and added."""
        total = np.full(len(x), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        coarse = [np.searchsorted(edges, x[:, j], side="right") for j, edges in enumerate(self.pair_edges)]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins of about equal weight; a value that is common has a bin of its own."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if len(x) else np.empty(0)


def _leaf(gradient: float, weight: float) -> float:
    return gradient / (weight + SHRINK)


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf value per bin of a shallow tree that splits the bins where that gains most."""
    g, w = np.concatenate([[0], gradient.cumsum()]), np.concatenate([[0], weight.cumsum()])

    def best(a: int, b: int) -> tuple[float, int]:
        cuts = np.arange(a + 1, b)
        if not len(cuts):
            return 0.0, a
        left, right = g[cuts] - g[a], g[b] - g[cuts]
        gain = (left ** 2 / (w[cuts] - w[a] + SHRINK) + right ** 2 / (w[b] - w[cuts] + SHRINK)
                - (g[b] - g[a]) ** 2 / (w[b] - w[a] + SHRINK))
        at = int(gain.argmax())
        return float(gain[at]), int(cuts[at])

    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        (gain, cut), at = max(((best(*part), i) for i, part in enumerate(parts)), key=lambda x: x[0][0])
        if gain <= 1e-12:
            break
        a, b = parts[at]
        parts[at:at + 1] = [(a, cut), (cut, b)]
    values = np.zeros(len(gradient))
    for a, b in parts:
        values[a:b] = _leaf(g[b] - g[a], w[b] - w[a])
    return values


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts each of two features once: four quadrants."""
    g, w = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))
    n, m = gradient.shape
    best = (0.0, np.zeros((n, m)))
    for i in range(1, n):
        for j in range(1, m):
            cells = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, m)), (slice(i, n), slice(0, j)), (slice(i, n), slice(j, m))]
            gs = [g[i, j], g[i, m] - g[i, j], g[n, j] - g[i, j], g[n, m] - g[i, m] - g[n, j] + g[i, j]]
            ws = [w[i, j], w[i, m] - w[i, j], w[n, j] - w[i, j], w[n, m] - w[i, m] - w[n, j] + w[i, j]]
            gain = sum(a * a / (b + SHRINK) for a, b in zip(gs, ws, strict=True))
            if gain > best[0]:
                values = np.zeros((n, m))
                for cell, a, b in zip(cells, gs, ws, strict=True):
                    values[cell] = _leaf(a, b)
                best = (gain, values)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic gradient boosting: each round gives every feature one shallow tree on what is left to explain.

    Then the pairs of features whose four-quadrant trees gain most on the remaining gradient are boosted in turn
    in the same way. Trees of one feature, or pair, add up to its lookup table. Without rows, or with one
    class, what is left is a smoothed prior.
    """
    n, k = x.shape
    start = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    edges = [_edges(x[:, j], BINS) for j in range(k)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(n, start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS if n else 0):
        for j in range(k):
            gradient, weight = slopes()
            step = RATE * _tree(np.bincount(bins[j], gradient, len(tables[j])), np.bincount(bins[j], weight, len(tables[j])))
            tables[j] += step
            total += step[bins[j]]

    coarse_edges = [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse_edges)]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = len(coarse_edges[i]) + 1, len(coarse_edges[j]) + 1
        return np.bincount(coarse[i] * shape[1] + coarse[j], values, shape[0] * shape[1]).reshape(shape)

    gradient, weight = slopes()
    gains = {(i, j): _pair_tree(grid(i, j, gradient), grid(i, j, weight))[0] for i, j in combinations(range(k), 2)}
    pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    pair_tables = [np.zeros((len(coarse_edges[i]) + 1, len(coarse_edges[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS if n else 0):
        for table, (i, j) in zip(pair_tables, pairs, strict=True):
            gradient, weight = slopes()
            step = RATE * _pair_tree(grid(i, j, gradient), grid(i, j, weight))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return Model(start, edges, tables, coarse_edges, pairs, pair_tables)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
          rows: int = SAMPLE_ROWS) -> Model:
    """The model of at most ``rows`` labelled documents, those whose ids hash lowest.

    Rows without an id or a label are passed over; a document labelled more than once counts with its largest
    label. The sample is fitted on the driver; its size is bounded by ``rows`` whatever the tables hold.
    """
    marked = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max(label).cast("double").alias("y")))
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    chosen = keep(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "labelled")
    sample = features(known.join(chosen, "doc_id")).select("doc_id", "__x", "y")
    # Rows that repeat an id must not enlarge what is collected.
    found = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "__x").limit(rows).toPandas()
    x = np.array(found["__x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, found["y"].to_numpy(float))


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher for label 1) of every row, from its whole text alone.

    A null or empty text has a score too, that of a text without words; repeated rows get the same score; a null
    doc_id stays null; an empty table gives an empty result. Other columns are ignored, texts of any length are
    counted whole. Counting is native, adding
    up bins is one vectorised pass over batches of features, and nothing is shuffled.
    """
    ship(docs.sparkSession)
    rows = features(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "__x")
    return rows.mapInArrow(lambda batches: _scores(batches, model), "doc_id long, score double")
