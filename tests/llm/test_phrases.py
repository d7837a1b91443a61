import random
import re
from collections import Counter

import pytest

from headway.llm import phrases


def by_hand(rows, least=10, most=3, top=2000, covered=50):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            for k in range(1, most + 1):
                f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    result = []
    for lang, f in counts.items():
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p in candidates:
            a = f[p]
            if any(100 * f[q] >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q in candidates if len(q) > len(p)):
                continue
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def texts(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["Éa", "éa", "W1", "w\x0b", "\x00", "."]
    return [(rng.choice(["en", "de", None]), "".join(
        rng.choice(["New york city", "new York", rng.choice(vocabulary)]) + rng.choice([" ", " ", "  ", "\t", "\n", ", "])
        for _ in range(rng.randrange(0, 60)))) for _ in range(n)] + [("en", None), (None, ""), ("fr", "a"), ("fr", " . ")]


def collected(found):
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("least", "most", "shards", "slots", "top"),
                         [(10, 3, 4, 1 << 16, 2000), (3, 4, 2, 1 << 10, 7), (10, 2, 1, 8, 2000), (2, 3, 3, 64, 2000)])
def test_against_a_plain_version(spark, least, most, shards, slots, top):
    rows = texts(least)
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "lang string, text string, word string, a string")
    got = collected(phrases.collocations(docs.repartition(3), least=least, most=most, shards=shards, slots=slots, top=top))
    assert got == by_hand(rows, least, most, top)
    assert got


def test_late_phrases_are_counted_in_full(spark, monkeypatch):
    """A phrase that becomes active in a late scan gets the shards it missed in the next cycle."""
    rows = [("en", f"common words here {i}") for i in range(9)] + [("en", "common words here too")] * 3
    rows += [("en", f"a{i % 5} b{i % 5}") for i in range(80)]
    monkeypatch.setattr(phrases, "_WINDOW", 7)
    monkeypatch.setattr(phrases, "_ROWS", 5)
    monkeypatch.setattr(phrases, "_REMEMBERED", 20)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert collected(phrases.collocations(docs, shards=3, slots=1 << 12)) == by_hand(rows)


def test_one_long_text_without_breaks(spark):
    rows = [("en", " ".join(f"w{i * i % 101}" for i in range(70_000)))]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert collected(phrases.collocations(docs, slots=1 << 14)) == by_hand(rows)


def test_empty_tables_and_clashing_columns(docs, edges):
    assert phrases.collocations(edges.limit(0), slots=64).collect() == []
    assert phrases.collocations(docs((1, None, "a")), slots=64).collect() == []
    assert collected(phrases.collocations(edges, slots=1 << 12)) == by_hand([(r.lang, r.text) for r in edges.collect()])


def test_arguments(docs):
    for wrong in ({"most": 1}, {"least": 0}, {"least": 999}, {"slots": 100}, {"shards": 99}):
        with pytest.raises(ValueError):
            phrases.collocations(docs((1, "a", "a")), **wrong)
