"""Periodic runs of words: maximal repetitions by longest common extensions on suffix trees.

A run is a stretch of consecutive words whose smallest period is ``q``, at least ``max(MIN_LENGTH, MIN_POWER * q)``
words long, that no neighbouring word extends keeping that period.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import ship, text_of

# A run repeats its first ``period`` words ``MIN_POWER`` times at least, and has ``MIN_LENGTH`` words at least.
MIN_POWER = 4
MIN_LENGTH = 6
# Words given to one pair of trees, unless a single stretch has more.
TREE_WORDS = 1 << 18
_BLOCK = 16


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of small numbers of which the last occurs nowhere else.

    ``rank`` holds the place of every suffix in sorted order. `extension` gives the length of the longest common
    prefix of two suffixes: the depth of their lowest common ancestor, which is the least depth between their
    leaves on the Euler tour.
    """

    def __init__(self, symbols: Sequence[int]):
        self._build(list(symbols))
        self._tour()

    def _build(self, text: list[int]) -> None:
        # Nodes are numbers, the root is 0. The label of the edge into a node is text[start:stop]. Children are
        # kept in one dictionary by node * width + first symbol.
        width, end = max(text) + 1, len(text)
        start, stop, parent, link, child = [0], [0], [0], [0], {}
        node = edge = length = pending = 0
        for i, symbol in enumerate(text):
            pending += 1
            unlinked = 0
            while pending:
                if not length:
                    edge = i
                at = node * width + text[edge]
                below = child.get(at)
                if below is None:
                    child[at] = len(start)
                    start.append(i), stop.append(end), parent.append(node), link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    begin = start[below]
                    size = stop[below] - begin
                    if size <= length:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if text[begin + length] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    middle = child[at] = len(start)
                    start.append(begin), stop.append(begin + length), parent.append(node), link.append(0)
                    start[below] = begin + length
                    parent[below] = middle
                    child[middle * width + text[begin + length]] = below
                    child[middle * width + symbol] = middle + 1
                    start.append(i), stop.append(end), parent.append(middle), link.append(0)
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.size, self._parent = end, np.array(parent)
        self._first = np.array(text)[np.array(start)]
        self._label = np.array(stop) - np.array(start)

    def _tour(self) -> None:
        parent, size = self._parent, self.size
        # The children of a node stand side by side, in the order of their first symbols.
        order = np.lexsort((self._first[1:], parent[1:])) + 1
        begin = np.searchsorted(parent[order], np.arange(len(parent) + 1)).tolist()
        order, label = order.tolist(), self._label.tolist()
        depth, tour, leaf_at = [0] * len(label), [], [0] * size
        leaves, stack = [], [0]
        while stack:
            node = stack.pop()
            if node < 0:  # back from a child
                tour.append(depth[~node])
                continue
            here = depth[node]
            left, right = begin[node], begin[node + 1]
            if left == right:
                leaf_at[size - here] = len(tour)
                leaves.append(size - here)
                tour.append(here)
                continue
            tour.append(here)
            for below in order[left:right][::-1]:
                depth[below] = here + label[below]
                stack.append(~node)
                stack.append(below)
        self.rank = np.empty(size, np.int64)
        self.rank[leaves] = np.arange(size)
        self._at = np.array(leaf_at)
        self._least(np.array(tour, np.int32))

    def _least(self, tour: np.ndarray) -> None:
        """Minima of blocks in a sparse table, and from each place to both ends of its block."""
        blocks = -(-len(tour) // _BLOCK)
        self._depths = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        self._depths[:len(tour)] = tour
        square = self._depths.reshape(blocks, _BLOCK)
        self._ahead = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        self._behind = np.minimum.accumulate(square, axis=1).ravel()
        self._table = [square.min(axis=1)]
        while 2 << len(self._table) - 1 <= blocks:
            half, last = 1 << len(self._table) - 1, self._table[-1]
            self._table.append(np.minimum(last[:-half], last[half:]))

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes that start at i and j, which differ."""
        left, right = np.minimum(self._at[i], self._at[j]), np.maximum(self._at[i], self._at[j])
        first, last = left // _BLOCK, right // _BLOCK
        found = np.minimum(self._ahead[left], self._behind[right])
        between = last - first - 1
        for power, row in enumerate(self._table):
            at = np.flatnonzero((between >> power) == 1)
            if len(at):
                found[at] = np.minimum(found[at], np.minimum(row[first[at] + 1], row[last[at] - (1 << power)]))
        same = np.flatnonzero(first == last)
        if len(same):
            lo, hi = left[same], right[same]
            inside = self._depths[np.minimum(lo[:, None] + np.arange(_BLOCK), hi[:, None])]
            found[same] = inside.min(axis=1)
        return found.astype(np.int64)


def _next_below(values: list[int]) -> np.ndarray:
    """For each place the next one with a smaller value, or the length."""
    n = len(values)
    found, stack = [n] * n, []
    for i, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            found[stack.pop()] = i
        stack.append(i)
    return np.array(found)


def _runs_of(symbols: np.ndarray, most: int, power: int, least: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence, for periods up to ``most``.

    The longest Lyndon word that starts at a place ends before the next smaller suffix. By one of the two orders
    of the symbols, every run holds such a word as long as its period. Each is extended to both sides by the
    longest common extension of two of its ends.
    """
    size = len(symbols)
    lone = int(symbols.max()) + 1
    ahead = SuffixTree([*symbols.tolist(), lone])
    back = SuffixTree([*symbols[::-1].tolist(), lone])
    rank = ahead.rank.tolist()
    # No suffix is a prefix of another, so the other order of symbols turns the order of suffixes round.
    starts = np.arange(size + 1)
    roots = []
    for order in (rank, [-r for r in rank]):
        period = _next_below(order) - starts
        at = np.flatnonzero((period <= most) & (starts + period < size))
        roots.append(np.stack([at, period[at]]))
    i, period = np.unique(np.concatenate(roots, axis=1), axis=1)
    if not len(i):
        return np.empty((0, 3), np.int64)
    j = i + period
    right = ahead.extension(i, j)
    left = np.zeros_like(right)
    inner = np.flatnonzero(i > 0)
    left[inner] = back.extension(size - i[inner], size - j[inner])
    found = np.stack([i - left, period + left + right, period], axis=1)
    return np.unique(found[found[:, 1] >= np.maximum(least, power * period)], axis=0)


def _stretches(ids: np.ndarray, power: int, least: int) -> list[tuple[int, int]]:
    """Disjoint stretches [start, stop) such that every run lies in one of them.

    In a run of at least ``power`` >= 2 periods every ``least`` - 1 or fewer words at one place recur one period
    before or after. So a run is covered by short sequences of words that recur nearby; sequences that occur once
    in their stretch cut it, until none does.
    """
    k = max(1, min(4, least - 1))
    n = len(ids) - k + 1
    if n < 1 or len(ids) < max(least, power):
        return []
    mixed = np.zeros(n, np.uint64)
    for j in range(k):  # equal sequences are equal numbers; different ones that are equal too cut less
        mixed = (mixed ^ ids[j:j + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    at, stretch = np.arange(n), np.zeros(n, np.int64)
    while len(at):
        order = np.lexsort((at, stretch, mixed[at]))
        gram, of = mixed[at][order], stretch[order]
        same = (gram[1:] == gram[:-1]) & (of[1:] == of[:-1])
        again = np.zeros(len(at), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        if again.all():
            break
        at = at[again]
        stretch = np.cumsum(np.diff(at, prepend=-2) > 1) if len(at) else at
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > 1)
    first, last = at[np.r_[0, cuts + 1]], at[np.r_[cuts, len(at) - 1]]
    return [(a, b + k) for a, b in zip(first.tolist(), last.tolist(), strict=True) if b + k - a >= max(least, power)]


def find_runs(words: Sequence, power: int = MIN_POWER, least: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of words, by start and then period.

    Only stretches that may hold runs go into the trees, each closed by a symbol of its own, so that nothing
    matches across them. Memory grows with the longest stretch of a text that repeats itself, not with the text.
    """
    if power < 2:
        raise ValueError("a run has two periods at least")
    known: dict = {}
    ids = np.fromiter((known.setdefault(word, len(known)) for word in words), np.int64, len(words))
    found, part, held = [], [], 0

    def flush() -> None:
        nonlocal part, held
        if not part:
            return
        # Numbers in the order of first occurrence keep the symbols of a tree few.
        body = np.concatenate([piece for a, b in part for piece in (ids[a:b], [-1])])
        closing = np.flatnonzero(body < 0)
        _, symbols = np.unique(body, return_inverse=True)
        symbols[closing] = symbols.max() + 1 + np.arange(len(closing))
        most = max(b - a for a, b in part) // power
        runs = _runs_of(symbols, most, power, least)
        starts = np.array([a for a, _ in part])
        offset = np.r_[0, closing[:-1] + 1]
        of = np.searchsorted(offset, runs[:, 0], side="right") - 1
        runs[:, 0] += starts[of] - offset[of]
        found.append(runs)
        part, held = [], 0

    for a, b in _stretches(ids, power, least):
        if held + b - a > TREE_WORDS:
            flush()
        part.append((a, b))
        held += b - a
    flush()
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside runs and the first period of each run, joined by single spaces."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


_FOUND = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"


def _search(texts: pa.Array, power: int, least: int) -> pa.Array:
    counts, collapsed, sizes, rows = [], [], [], []
    for text in texts:
        words = text.as_py().encode().split()
        runs = find_runs(words, power, least)
        counts.append(len(words))
        collapsed.append(_collapsed(words, runs).decode())
        sizes.append(len(runs))
        rows.append(runs)
    every = np.concatenate(rows) if rows else np.empty((0, 3), np.int64)
    entry = pa.StructArray.from_arrays([pa.array(every[:, c]) for c in range(3)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes, dtype=np.int64)].astype(np.int32)), entry)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), runs, pa.array(collapsed, pa.string())],
                                      ["n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", power: int = MIN_POWER, least: int = MIN_LENGTH) -> DataFrame:
    """Add ``n_words`` (long), ``runs`` and ``collapsed`` to every row; no row is removed.

    ``runs`` is an array of (start, length, period) in words from 0, by start and then period. ``collapsed`` is
    the text with every run cut to its first period, its words joined by single spaces: a word goes if any run
    has it after its first period. Words are runs without ASCII white space, compared exactly.

    A null text counts as empty: no words, no runs, an empty ``collapsed``. Repeated rows are treated alike,
    columns with these names are replaced, an empty table gives an empty result. A very long text is handled
    whole by one task, whose memory grows with its words and its longest stretch of recurring words. Nothing is
    shuffled, so no group of copies matters.
    """
    ship(docs.sparkSession)

    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        return _search(texts, power, least)

    rows = docs.withColumn("__found", found(text_of(text)))
    own = [c for c in docs.columns if c.lower() not in ("n_words", "runs", "collapsed")]
    return rows.select(*own, "__found.n_words", "__found.runs", "__found.collapsed")
