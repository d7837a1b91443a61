import hashlib
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from headway.llm import exact, lines, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text(st.sampled_from("ab#A .\n\té"), max_size=60)


def _by_hand(rows):
    """(doc_id, sha, keep_id, group_size) of each row, sorted, and how many rows stay per text."""
    out, best, size = [], {}, Counter(t or "" for _, t, _ in rows)
    for d, t, _ in rows:
        known = [x for x in (best.get(t or ""), d) if x is not None]
        best[t or ""] = max(known, default=None)
    for d, t, _ in rows:
        out.append((d, hashlib.sha256((t or "").encode()).hexdigest(), best[t or ""], size[t or ""]))
    return sorted(out, key=repr)


def _found(df):
    rows = exact.mark_copies(df).collect()
    return sorted(((r.doc_id, r.text_sha256, r.keep_id, r.group_size) for r in rows), key=repr), \
        Counter(r.text_sha256 for r in rows if r.kept), {(r.text_sha256, r.doc_id) for r in rows if r.kept}, rows


def test_edge_rows_are_grouped_and_one_of_each_text_stays(edges):
    rows = [(r.doc_id, r.text, r.source) for r in edges.collect()]
    found, kept, _, all_rows = _found(edges)
    assert found == _by_hand(rows)
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t, _ in rows})
    assert all(r.doc_id == r.keep_id for r in all_rows if r.kept)


def test_same_length_and_prefix_are_not_enough(docs):
    same = "x" * exact.PREFIX
    found, kept, _, _ = _found(docs((1, same + "a", "s"), (2, same + "b", "s"), (3, same + "a", "s")))
    assert [f[2:] for f in found] == [(3, 2), (2, 1), (3, 2)] and len(kept) == 2


def test_exact_of_nothing(docs):
    assert exact.mark_copies(docs()).count() == 0


@SETTINGS
@given(texts=st.lists(st.sampled_from(["", "a", "b", "aa", "ab", "x" * 70 + "a", "x" * 70 + "b"]), max_size=12))
def test_exact_by_hand(docs, texts):
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    assert _found(docs(*rows))[0] == _by_hand(rows)


# --- lines ----------------------------------------------------------------------------------------

def test_lines_of_many_pages_go_and_the_rest_stays(docs):
    rows = [(i, f"menu\nown {i}\n\nfooter {i % 2}\nmenu", "a") for i in range(10)] + [(99, "menu\nx", "b"), (100, None, None)]
    got = {r.doc_id: r for r in lines.drop_boilerplate(docs(*rows), ratio=0.5).collect()}
    assert got[4].text == "own 4\n\nfooter 0" and (got[4].n_lines, got[4].n_dropped) == (5, 2)
    assert got[99].text == "menu\nx" and got[99].n_dropped == 0
    assert got[100].text is None and got[100].n_lines == 0


def test_copies_of_a_page_are_one_page(docs):
    rows = [(i, "copied line\nsecond", "a") for i in range(50)] + [(100 + i, f"own {i}", "a") for i in range(5)]
    got = lines.drop_boilerplate(docs(*rows), ratio=0.1)
    assert all(r.n_dropped == 0 for r in got.collect())


def test_small_sites_lose_what_their_pages_share_and_nothing_else(docs):
    rows = [(1, "menu\none", "a"), (2, "menu\ntwo", "a"), (3, "menu\nalone", "b"), (4, "menu", None)]
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(docs(*rows)).collect()}
    assert got == {1: "one", 2: "two", 3: "menu\nalone", 4: "menu"}


def test_a_line_at_the_ratio_stays(docs):
    rows = [(i, f"own {i}" + "\nmore" * (i < 5) + "\nless" * (i < 6), "a") for i in range(81)]
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(docs(*rows), ratio=0.05).collect()}  # 4 and 5 of 80 others
    assert got[0] == "own 0\nmore" and got[5] == "own 5"


def test_lines_keep_every_row_and_column(edges):
    out = lines.drop_boilerplate(edges, ratio=0.0)
    assert set(out.columns) == set(edges.columns) | {"n_lines", "n_dropped"}
    got = out.collect()
    assert len(got) == edges.count() and all(r.site == "extra" for r in got)
    assert sorted(r.doc_id for r in got if r.text is None and r.doc_id) == [2]


def test_lines_of_nothing(docs):
    assert lines.drop_boilerplate(docs()).count() == 0


# --- rules ----------------------------------------------------------------------------------------

def counts(text):
    words = WORD.findall(text)
    held = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in rules.SYMBOLS), len(held) - len(set(held)), len(covered))


def _measured(df):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.measure(df).collect()]


@SETTINGS
@given(texts=st.lists(TEXT | st.lists(st.sampled_from("ab"), max_size=40).map(" ".join), min_size=1, max_size=6))
def test_counts_by_hand(docs, texts):
    assert _measured(docs(*[(i, t, "s") for i, t in enumerate(texts)])) == [counts(t) for t in texts]


def test_counts_of_edge_rows(edges):
    assert _measured(edges) == [counts(r.text or "") for r in edges.collect()]


@pytest.mark.parametrize("text, kept", [
    ("the of and to plain words that follow each other in a row of some length for this one " * 1 + "and then more come", True),
    ("the### of### and### to### plain### words that follow each other in a row of some length for this one### yes", False),
    ("THE OF AND TO PLAIN WORDS THAT FOLLOW EACH OTHER IN A ROW OF SOME LENGTH FOR THIS ONE YES SURE", False),
    ("ab " * 100, False), ("the of and to", False), ("", False), (None, False),
    ("\n".join(["the same line of words"] * 3 + ["and some other words that are of use in a line of text to read on"]), False),
])
def test_verdicts(docs, text, kept):
    row = rules.judge(docs((1, text, "s"))).first()
    assert row.kept is kept


def test_threshold_itself_passes(docs):
    text = " ".join(["the"] + [f"word{i}" for i in range(48)] + ["of"])
    strict = rules.Rule("stop_words", "n_stop_words", "n_words", 4)
    assert rules.judge(docs((1, text, "s")), rules=(strict,)).first().kept
    assert not rules.judge(docs((1, text, "s")), rules=(rules.Rule("s", "n_stop_words", "n_words", 5),)).first().kept


def test_a_filter_on_the_verdict_does_not_repeat_the_counting(docs):
    plan = rules.judge(docs((1, "a", "s"))).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") <= 2 and "Python" not in plan


def test_rules_of_nothing(docs):
    assert rules.judge(docs()).count() == 0
