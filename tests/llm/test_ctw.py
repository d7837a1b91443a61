import math
from collections import defaultdict
from functools import lru_cache

import pytest

from headway.llm import ctw


def seen_bytes(text):
    return b"".join(w + b" " for w in (text or "").encode().lower().split()) + b"\n"


def by_hand(training, texts, depth):
    """log10 probabilities by the definition: counts in every node, mixed recursively."""
    counts = defaultdict(lambda: [0, 0])

    def decisions(data):
        for i, byte in enumerate(data):
            before = (bytes(depth) + data[:i])[-depth:] if depth else b""
            for j in range(8):
                yield before, (1 << j) | byte >> (8 - j), byte >> (7 - j) & 1

    for data in training:
        for before, k, bit in decisions(data):
            for d in range(depth + 1):
                counts[before[depth - d:], k][bit] += 1

    children = defaultdict(set)
    for context, k in list(counts):
        if context:
            children[context[1:], k].add(context)

    def kt(a, b):
        g = math.lgamma
        return g(a + .5) + g(b + .5) - 2 * g(.5) - g(a + b + 1)

    @lru_cache(None)
    def weighed(context, k):
        own = kt(*counts[context, k])
        if len(context) == depth:
            return own, 1.0
        deeper = sum(weighed(c, k)[0] for c in children[context, k])
        both = math.log(.5) + max(own, deeper) + math.log1p(math.exp(-abs(own - deeper)))
        return both, math.exp(math.log(.5) + own - both)

    def one(before, k):
        p, left = 0.0, 1.0
        for d in range(depth + 1):
            node = before[depth - d:], k
            if node not in counts:
                break
            (a, b), (_, own) = counts[node], weighed(*node)
            p, left = p + left * own * (b + .5) / (a + b + 1), left * (1 - own)
        return p + left / 2

    return [sum(math.log10(one(c, k) if bit else 1 - one(c, k)) for c, k, bit in decisions(t)) for t in texts]


@pytest.mark.parametrize("depth", [1, 3])
def test_scores_by_hand(docs, depth):
    rows = [(1, "the cat sat on the mat", "s"), (2, "The Cat  sat", "s"), (3, "zebra é", "s"), (4, None, "s"), (5, "a a a", "s"),
            (None, "the", "s")]
    got = {r.doc_id: r for r in ctw.score(docs(*rows), held_out="doc_id = 3", depth=depth).collect()}
    data = [seen_bytes(t) for _, t, _ in rows]
    want = by_hand([x for x, r in zip(data, rows, strict=True) if r[0] != 3], data, depth)
    for (d, _, _), value in zip(rows, want, strict=True):
        assert got[d].score == pytest.approx(value, abs=1e-6)
    assert [got[d].held_out for d in (1, 3, None)] == [False, True, False]


def test_base_counts(docs):
    rows = [(1, "a b a", "s"), (2, "A", "s"), (3, "c a", "s"), (4, None, "s")]
    got = {r.doc_id: r for r in ctw.score(docs(*rows), held_out="doc_id = 3").collect()}
    # Training: a 3, b 1, end 3.
    assert {r.train_tokens for r in got.values()} == {7}
    assert (got[3].n_tokens, got[3].n_known) == (3, 2)
    assert got[3].base_score == pytest.approx(sum(math.log10(c / (7 + 3 + 1)) for c in (1, 4, 4)))
    assert got[4].base_score == pytest.approx(math.log10(4 / 11)) and got[4].n_tokens == 1


def test_probabilities_of_the_next_byte_sum_to_one(spark):
    body = seen_bytes("the cat sat on the mat")
    trained = {}
    for g in ctw.grams(bytes(2), body, 2).tolist():
        trained[g] = trained.get(g, 0) + 1
    context = int.from_bytes(b"th", "big") << 8
    asked = {context | byte: trained.get(context | byte, 0) for byte in range(256)} | trained
    rows = ctw.model(spark.createDataFrame(list(asked.items()), "key long, n long"), depth=2).collect()
    assert sum(10 ** r.log10p for r in rows if r.key >> 8 == context >> 8) == pytest.approx(1)


def test_learning_pays_on_held_out_text(docs):
    rows = [(i, f"the quick brown fox number {i} jumps over the lazy dog", "s") for i in range(60)]
    got = ctw.score(docs(*rows), held_out="doc_id % 7 = 2").collect()
    bits = [-r.score / math.log10(2) / len(seen_bytes(rows[r.doc_id][1])) for r in got if r.held_out]
    assert bits and max(bits) < 1.5


def test_pieces_make_no_difference(monkeypatch, docs):
    text = " ".join(f"word{i % 50}" for i in range(400))
    whole = [b for b, _ in ctw.pieces(text)]
    parts = [b for b, _ in ctw.pieces(text, 64)]
    assert len(whole) == 1 and len(parts) > 20 and b"".join(parts) == whole[0] == seen_bytes(text)
    assert b"".join(b for b, _ in ctw.pieces(" a " * 50 + " " * 300, 64)) == seen_bytes("a " * 50)
    assert [b for b, _ in ctw.pieces("x" * 500, 64)] == [b"x" * 500 + b" \n"]


def test_edge_rows(edges):
    got = ctw.score(edges, held_out="doc_id = 5").collect()
    assert len(got) == edges.count() and all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert sorted(r.n_tokens for r in got) == sorted(len((r.text or "").encode().split()) + 1 for r in edges.collect())


def test_nothing_and_nothing_to_learn_from(docs):
    assert ctw.score(docs()).count() == 0
    only = ctw.score(docs((1, "ab", "s")), held_out="true").first()
    assert only.train_tokens == 0 and only.score == pytest.approx(-8 * 4 * math.log10(2))
