import random

import numpy as np
import pytest

from headway.llm import repeats


def by_hand(words, power=4, least=6):
    """All runs by trying every period: maximal stretches of equal words that far apart."""
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, power * q):
                found.setdefault((i, j + q - i), q)  # the smallest period of a stretch comes first
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def as_tuples(runs):
    return [tuple(map(int, r)) for r in runs]


@pytest.mark.parametrize("words", [
    "", "a", "a a a a a", "a a a a a a", "x a a a a a a y", "a b a b a b a b", "a b a b a b a", "a b c a b c a b c a b c a",
    "a a a a a a b a a a a a a b a a a a a a b a a a a a a b", "a a a a a a a b b b b b b b", "z a b a b a b a b a c a c a c a c"])
def test_examples(words):
    assert as_tuples(repeats.find_runs(words.split())) == by_hand(words.split())


@pytest.mark.parametrize("seed", range(60))
def test_random_words(seed):
    rng = random.Random(seed)
    words = [rng.choice("ab" if seed % 3 else "abcd") for _ in range(rng.randrange(0, 120))]
    for _ in range(seed % 4):
        at, q = rng.randrange(0, len(words) + 1), rng.randrange(1, 9)
        words[at:at] = [rng.choice("abcde") for _ in range(q)] * rng.randrange(2, 7)
    assert as_tuples(repeats.find_runs(words)) == by_hand(words)
    assert as_tuples(repeats.find_runs(words, 2, 2)) == by_hand(words, 2, 2)


@pytest.mark.parametrize("seed", range(8))
def test_extensions_and_ranks(seed):
    rng = random.Random(seed)
    text = [rng.randrange(2) for _ in range(200)] + [2]
    tree = repeats.SuffixTree(text)
    assert sorted(range(len(text)), key=lambda i: text[i:]) == np.argsort(tree.rank).tolist()
    pairs = [(i, j) for i in range(0, 201, 3) for j in range(1, 201, 7) if i != j]
    want = [next(k for k in range(202) if text[i + k:i + k + 1] != text[j + k:j + k + 1]) for i, j in pairs]
    assert tree.extension(*np.array(pairs).T).tolist() == want


def test_trees_of_bounded_size_find_the_same(monkeypatch):
    rng = random.Random(3)
    words = [w for _ in range(40) for w in [f"w{rng.randrange(9)}", *[f"v{rng.randrange(3)}"] * rng.randrange(4, 12)]]
    whole = as_tuples(repeats.find_runs(words))
    monkeypatch.setattr(repeats, "TREE_WORDS", 10)
    assert as_tuples(repeats.find_runs(words)) == whole == by_hand(words)


def test_very_long_texts():
    words = [f"w{i % 1000}" for i in range(60_000)] + ["x"] * 10_000
    assert as_tuples(repeats.find_runs(words)) == [(0, 60_000, 1000), (60_000, 10_000, 1)]


def test_rows(docs, edges):
    rows = docs((1, "a b  a\tb a b a b c", "s"), (2, None, "s"), (2, None, "s"), (None, "A a A a A a A a", None))
    found = repeats.periodic_runs(rows)
    assert [c for c in found.columns if c not in rows.columns] == ["runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    assert got == [(1, 9, [(0, 8, 2)], "a b c"), (2, 0, [], ""), (2, 0, [], ""), (None, 8, [(0, 8, 2)], "A a")]
    assert repeats.periodic_runs(edges).count() == edges.count()
    assert repeats.periodic_runs(edges.limit(0)).collect() == []


def test_the_query(spark, tmp_path):
    """All columns of the registered query against a plain version of its contract."""
    import hashlib
    import re
    import zlib

    from headway.llm.queries import REGISTRY

    rng = random.Random(5)
    texts = [None, "", " \n ", "x"] + [" ".join(rng.choice("abcdefg") + rng.choice(" \n") for _ in range(rng.randrange(1, 90)))
                                        for _ in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in REGISTRY["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for doc_id, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = by_hand(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        row = got[doc_id]
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(
            " ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest()
    assert any(r.n_runs for r in got.values())
