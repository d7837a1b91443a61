"""The whole pipeline against plain versions of its stages, each on what the one before it kept."""

import math
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from test_exact_lines_rules import counts
from test_mixing import by_hand as targets_by_hand
from test_simhash import by_hand as fingerprint
from test_simhash import components_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from headway.llm import lines, rules
from headway.llm.tables import keep, table
from headway.llm.tokens import END_ID, default_tokenizer

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="supplied tables are not here")


def _accepted(row):
    text = row["text"] or ""
    words, held = text.encode().split(), [x for x in text.split("\n") if x.encode().split()]
    words = [w.decode() for w in words]
    found = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), counts(text), strict=True))
    found |= {"n_lines": len(held), "n_stop_words": sum(w.lower() in rules.STOP_WORDS for w in words),
              "n_capital_words": sum(w.upper() == w != w.lower() for w in words),
              "n_ellipsis_lines": sum(x.rstrip(" ").endswith(("...", "…")) for x in held),
              "n_bullet_lines": sum(x.lstrip(" ").startswith(("-", "*", "•")) for x in held)}
    if found["n_words"] < 20 or 100 * found["n_repeat_words"] > 30 * found["n_words"]:
        return False
    return all((r.low is None or 100 * found[r.part] >= r.low * found[r.whole])
               and (r.high is None or 100 * found[r.part] <= r.high * found[r.whole]) for r in rules.RULES)


def _without_boilerplate(rows):
    pages, holding = defaultdict(set), Counter()
    for row in rows:
        if row["text"] not in pages[row["source"]]:
            pages[row["source"]].add(row["text"])
            holding.update({(row["source"], line) for line in row["text"].split("\n") if line.split()})
    bad = {(s, line) for (s, line), n in holding.items() if n - 1 > lines.RATIO * (len(pages[s]) - 1)}
    return [{**row, "text": "\n".join(x for x in row["text"].split("\n") if (row["source"], x) not in bad)} for row in rows]


def _one_of_each_group(rows):
    label = components_by_hand([fingerprint(row["text"]) for row in rows])
    best = {}
    for i, row in enumerate(rows):
        best.setdefault(label[i], row)
        best[label[i]] = min(best[label[i]], row, key=lambda r: r["doc_id"])
    return list(best.values())


def _same(got, want):
    key = lambda row: repr(sorted(row.items()))
    assert sorted(map(key, (r.asDict() for r in got))) == sorted(map(key, want))


def test_every_stage_against_a_plain_version(spark):
    docs = table(spark, SF, "documents")
    rows = [r.asDict() for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    for name, plain in (("quality rules", lambda rows: [r for r in rows if _accepted(r)]),
                        ("line dedup", _without_boilerplate), ("near dedup", _one_of_each_group)):
        docs = keep(stages[name](spark, docs, SF), "tested")
        before, rows = len(rows), plain(rows)
        _same(docs.collect(), rows)
        assert rows and (name == "line dedup" or len(rows) < before)

    mixed = keep(stages["mixing"](spark, docs, SF), "tested")
    copies = Counter(r.doc_id for r in mixed.collect())
    size = {row["doc_id"]: len((row["text"] or "").encode().split()) for row in rows}
    of = defaultdict(list)
    for row in rows:
        of[row["source"]].append(row["doc_id"])
    names = sorted(of, key=lambda s: (s is None, s or ""))
    for name, target in zip(names, targets_by_hand([sum(size[d] for d in of[s]) for s in names]), strict=True):
        share = target / sum(size[d] for d in of[name])
        assert all(math.floor(share - 1e-9) <= copies[d] <= math.ceil(share + 1e-9) for d in of[name])
        assert abs(sum(copies[d] * size[d] for d in of[name]) - target) <= max(size[d] for d in of[name])

    pieces = stages["packing"](spark, mixed, SF).collect()
    encode, texts = Tokenizer.from_file(default_tokenizer()), {row["doc_id"]: row["text"] for row in rows}
    placed, of_document = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = encode.encode(texts[p.doc_id], add_special_tokens=False).ids + [END_ID]
        assert list(p.ids) == ids[p.start:p.start + p.length] and p.doc_tokens == len(ids)
        placed[p.sequence_id].append((p.offset, p.length))
        of_document[p.doc_id].append((p.start, p.length))
    for spans in placed.values():
        upto = 0
        for offset, length in sorted(spans):
            assert offset == upto
            upto += length
        assert upto == 4096 or upto & (upto - 1) == 0 and upto < 4096
    # Every copy of a document lies in the sequences once.
    for doc_id, spans in of_document.items():
        covered = Counter(i for start, length in spans for i in range(start, start + length))
        assert set(covered.values()) == {copies[doc_id]}
        assert len(covered) == len(encode.encode(texts[doc_id], add_special_tokens=False).ids) + 1
    assert set(of_document) == set(copies)
