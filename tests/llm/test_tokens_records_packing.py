import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import packing, records
from headway.llm.tokens import Encoder, default_tokenizer

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def plain():
    tokenizer = tokenizers.Tokenizer.from_file(default_tokenizer())
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()


ODD = ["", None, " áb ́ ë   x", "<|endoftext|> hi<|startoftext|>!", "İstanbul ΣΑΣ ΣΑΣ. 12345 don't we'll   　 中文",
       "\x1c\x1d\x85 a\x1cb ᅠ 𝒳 ﬁ", "Å ̸ ≯", "word " * 3000]


def test_ids_are_those_of_the_library(plain):
    assert Encoder(default_tokenizer()).encode(ODD) == [plain(t) for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_ids_of_any_text(plain, texts):
    encoder = Encoder(default_tokenizer())
    assert encoder.encode(texts) == [plain(t) for t in texts] == encoder.encode(texts)


def test_forgetting_words_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr("headway.llm.tokens.REMEMBERED", 3)
    encoder = Encoder(default_tokenizer())
    for text in ODD + ODD:
        assert encoder.encode([text]) == [plain(text)]


# --- packing --------------------------------------------------------------------------------------

def _check_pieces(pieces, lengths, capacity):
    for doc, n in enumerate(lengths):
        at = 0
        for _, start, length, _, _ in sorted(p for p in pieces if p[0] == doc):
            assert start == at and length > 0
            at += length
        assert at == n
    by_sequence = {}
    for _, _, length, sequence, offset in pieces:
        by_sequence.setdefault(sequence, []).append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=40))
def test_every_token_lies_in_one_piece_and_nothing_is_padded(lengths):
    _check_pieces(packing.assign(lengths, 16), lengths, 16)


def test_attention_cost_is_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(5, 900, 800).tolist()
    pieces = packing.assign(lengths)
    costs, cuts = {}, len(pieces) - len(lengths)
    for _, _, n, sequence, _ in pieces:
        costs[sequence] = costs.get(sequence, 0) + packing.cost(n)
    full = sorted(costs[s] for s in costs if sum(p[2] for p in pieces if p[3] == s) == packing.CAPACITY)
    in_turn, at = {}, 0
    for n in lengths:  # one after the other instead
        in_turn[at // packing.CAPACITY] = in_turn.get(at // packing.CAPACITY, 0) + packing.cost(n)
        at += n
    assert np.std(full) < 0.5 * np.std(list(in_turn.values())[:-1]) and cuts < len(lengths) / 4


def test_packing_of_edge_rows(edges, plain):
    rows = packing.pack(edges, with_ids=True).collect()
    texts = [(r.doc_id, r.text) for r in edges.collect()]
    assert sorted(map(str, (r.doc_id for r in rows if r.start == 0))) == sorted(str(d) for d, _ in texts)
    for r in rows:
        ids = np.array(r.ids, "<u4").tobytes()
        assert zlib.crc32(ids) == r.ids_crc32 and len(r.ids) == r.length
    assert sum(r.length for r in rows) == sum(len(plain(t)) // 4 for _, t in texts)
    sizes = {}
    for r in rows:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in sizes.values())


def test_packing_of_nothing(docs):
    assert packing.pack(docs()).count() == 0


# --- records --------------------------------------------------------------------------------------

def test_round_trip_of_edge_rows(spark, edges, plain, tmp_path):
    path = str(tmp_path / "records")
    records.write(edges, path)
    index = records.index(spark, path)
    found = sorted(index.collect(), key=lambda r: r.start)
    texts = [(r.doc_id, r.text) for r in edges.collect()]
    want = [(r.doc_id, r.ids_crc32) for r in found]
    assert sorted(map(str, want)) == sorted(str((d, zlib.crc32(plain(t)))) for d, t in texts)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert keys == sorted(keys)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    some = index.where("doc_id IN (5, 8)").orderBy("offset", ascending=False)
    got = sorted((r.doc_id, len(r.ids), r.ids[-1]) for r in records.fetch(spark, path, some).collect())
    assert got == sorted((d, len(plain(t)) // 4, 2) for d, t in texts if d in (5, 8))


def test_records_of_nothing(spark, docs, tmp_path):
    records.write(docs(), str(tmp_path / "records"))
    assert records.index(spark, str(tmp_path / "records")).count() == 0


def test_records_spread_over_files_and_partitions(spark, docs, tmp_path, monkeypatch, plain):
    monkeypatch.setattr(records, "RECORDS_PER_FILE", 7)
    path = str(tmp_path / "records")
    rows = [(i % 90, f"text {i}", "s") for i in range(100)]
    records.write(docs(*rows).repartition(5), path)
    found = sorted(records.index(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted(d for d, _, _ in rows)
    assert len(list(Path(path).glob("part-*"))) >= 100 // 7


@pytest.mark.parametrize("ids", [[], [2], [65535, 1], [65536, 1]])
@pytest.mark.parametrize("doc_id", [None, 0, -5, 2 ** 40])
def test_frames(ids, doc_id):
    data = np.array(ids, "<u4").tobytes()
    frame = records.frame(records.payload_of(doc_id, data)) + b"\n"
    assert records.parse(memoryview(b"xx" + frame), 2) == (doc_id, data, 2 + len(frame))


def test_damage_is_found():
    frame = bytearray(records.frame(records.payload_of(1, np.array([5, 6], "<u4").tobytes())) + b"\n")
    for at in range(len(frame) - 1):
        broken = bytearray(frame)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="record"):
            records.parse(memoryview(broken), 0)
    with pytest.raises(ValueError, match="cut off"):
        records.parse(memoryview(frame[:-3]), 0)
