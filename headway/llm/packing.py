"""Packing documents into sequences of equal length with balanced attention cost."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import ship
from headway.llm.tokens import END_ID, default_tokenizer, encoder

CAPACITY = 4096
# Documents are packed together until they hold so many tokens: this bounds the memory of a task.
BLOCK_TOKENS = 2_000_000
# A piece of n tokens costs n plus n * n / SPAN: attention outweighs the rest from about this length.
SPAN = 1024

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cost(n):
    """Linear plus quadratic cost of a piece in its sequence."""
    return n + n * n / SPAN


def assign(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that cover documents of the given lengths.

    Whole multiples of ``capacity`` are cut off first and fill sequences of their own. What remains goes,
    costliest first, to the cheapest sequence with room for all of it. What fits nowhere is cut to fill
    the gaps, cheapest sequence first. There are only as many sequences as become full; the rest of the
    tokens makes sequences whose lengths are powers of two, so none needs padding.
    """
    pieces, rest, n_sequences = [], [], 0
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            pieces.append((doc, k * capacity, capacity, n_sequences, 0))
            n_sequences += 1
        if n % capacity:
            rest.append((n % capacity, doc, whole * capacity))
    rest.sort(key=lambda piece: (-cost(piece[0]), piece[1]))
    full, tail = divmod(sum(n for n, _, _ in rest), capacity)
    room, costs = np.full(full, capacity), np.zeros(full)

    def put(sequence: int, doc: int, start: int, n: int) -> None:
        pieces.append((doc, start, n, n_sequences + sequence, int(capacity - room[sequence])))
        room[sequence] -= n
        costs[sequence] += cost(n)

    unplaced = []
    for n, doc, start in rest:
        open_costs = np.where(room >= n, costs, np.inf)
        cheapest = int(open_costs.argmin()) if full else 0
        if full and open_costs[cheapest] < np.inf:
            put(cheapest, doc, start, n)
        else:
            unplaced.append([n, doc, start])

    def cut(n: int) -> Iterator[tuple[int, int, int]]:
        """Take n tokens from the pieces that fit nowhere."""
        while n:
            piece = unplaced[-1]
            taken = min(n, piece[0])
            yield piece[1], piece[2], taken
            piece[0] -= taken
            piece[2] += taken
            n -= taken
            if not piece[0]:
                unplaced.pop()

    for sequence in np.argsort(costs, kind="stable"):
        for doc, start, taken in cut(int(room[sequence])):
            put(int(sequence), doc, start, taken)
    last = n_sequences + full
    for power in (1 << bit for bit in reversed(range(capacity.bit_length())) if tail >> bit & 1):
        at = 0
        for doc, start, taken in cut(power):
            pieces.append((doc, start, taken, last, at))
            at += taken
        last += 1
    return pieces


def _pack(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int,
          with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer).encode
    first = TaskContext.get().partitionId() << 32
    docs, ids, held = [], [], 0

    def block() -> pa.RecordBatch:
        nonlocal first, docs, ids, held
        pieces = assign([len(x) // 4 for x in ids], capacity)
        spans = [ids[doc][4 * start:4 * (start + n)] for doc, start, n, _, _ in pieces]
        columns = [
            pa.array([docs[p[0]] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()),
            pa.array([p[2] for p in pieces], pa.int64()), pa.array([zlib.crc32(x) for x in spans], pa.int64()),
            pa.array([len(ids[p[0]]) // 4 for p in pieces], pa.int64()),
            pa.array([first + p[3] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.int64())]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            flat = np.frombuffer(b"".join(spans), "<u4").astype(np.int32)
            ends = np.cumsum([0] + [p[2] for p in pieces], dtype=np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            names.append("ids")
        first += max((p[3] for p in pieces), default=-1) + 1
        docs, ids, held = [], [], 0
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for at in range(0, len(texts), 64):
            encoded = encode(texts[at:at + 64].to_pylist(), end_id)
            docs += keys[at:at + 64].to_pylist()
            ids += encoded
            held += sum(map(len, encoded)) // 4
            if held >= BLOCK_TOKENS:
                yield block()
    if docs:
        yield block()


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``capacity`` tokens.

    Columns: doc_id, start (tokens of its document before it), length, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers), doc_tokens (the document's, end id included), sequence_id, offset (its place
    in the sequence, without gaps from 0) and, if asked for, ids. A sequence is full or a power of two long.

    Every row is a document of its own, repeated ids included; a null or empty text is the end id alone; a
    null doc_id stays null; an empty table gives no piece. Texts of any length are cut as needed. Other
    columns are ignored.

    Tasks pack the rows they read, block by block: no shuffle, no state beyond a block and one document. A
    block holds hundreds of sequences, so packing more together would gain nothing. Sequence ids start at
    the number of the task times 2**32, and a task that runs again yields the same.
    """
    ship(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(lambda batches: _pack(batches, path, end_id, capacity, with_ids), schema)
