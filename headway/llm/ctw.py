"""Code length of texts under context-tree weighting over bytes.

A text is a sequence of words, A-Z in lower case, each followed by a space, and an end byte. Every byte is eight
binary decisions. Each decision has a node per depth 0 to ``depth``: the bits of the byte so far and the last
bytes before it. A node estimates its next bit from its counts by Krichevsky and Trofimov, and mixes this half
and half with what the nodes one byte deeper say; training fixes how far each side of the mix is believed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import keep, ship, text_of

DEPTH = 4
# Texts scored together: a chunk asks for each different byte sequence and word it holds once.
CHUNK_BYTES = 16 << 20
# Texts are cut at white space into pieces of about this size, which bounds the arrays of a task.
PIECE_BYTES = 1 << 20
_END = b"\n"
_SPACES = b" \t\n\r\x0b\x0c"


def pieces(text: str, size: int = PIECE_BYTES) -> Iterator[tuple[bytes, bool]]:
    """The bytes of a text as the model sees them, cut after words, and whether they start the text."""
    data = text.encode().lower()
    at = 0
    while True:
        cut = at + size
        while cut < len(data) and data[cut] not in _SPACES:
            cut += 1
        words = data[at:cut].split()
        body = b" ".join(words) + b" " if words else b""
        if cut >= len(data):
            yield body + _END, at == 0
            return
        yield body, at == 0
        at = cut


def grams(before: bytes, body: bytes, depth: int) -> np.ndarray:
    """Each byte of a body with the ``depth`` bytes before it as one number, the byte lowest."""
    data = np.frombuffer(before + body, np.uint8)
    values = np.zeros(len(body), np.int64)
    for i in range(depth + 1):
        values = (values << 8) | data[i:i + len(body)]
    return values


def word_key(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _tokens(body: bytes) -> list[bytes]:
    return body.split() + [_END] * body.endswith(_END)


def _chunks(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Compressed pieces of about ``CHUNK_BYTES``: row number, doc_id, held out, context, bytes."""
    row = n_chunks = TaskContext.get().partitionId() << 32
    names = ["row", "doc_id", "held_out", "before", "body"]
    rows, size = [], 0

    def chunk() -> pa.RecordBatch:
        nonlocal rows, size, n_chunks
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
            pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.large_binary()), strict=True)]
        sink = pa.BufferOutputStream()
        table = pa.table(columns, names)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
            out.write_table(table)
        rows, size = [], 0
        n_chunks += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([n_chunks], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "payload"])

    for batch in batches:
        for doc_id, held_out, text in zip(*batch.columns, strict=True):
            before = bytes(depth)
            for body, _ in pieces(text.as_py()):
                rows.append((row, doc_id.as_py(), held_out.as_py(), before, body))
                before = (before + body)[-depth:] if depth else b""
                size += len(body)
                if size >= CHUNK_BYTES:
                    yield chunk()
            row += 1
    if rows:
        yield chunk()


def _unpacked(payload: pa.Scalar) -> dict[str, list]:
    return pa.ipc.open_stream(payload.as_buffer()).read_all().to_pydict()


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different values and how often each occurs; ``values`` is sorted in place, the fastest way there is."""
    values.sort()
    first = np.flatnonzero(np.diff(values, prepend=values[0] - 1)) if len(values) else np.empty(0, np.int64)
    return values[first], np.diff(np.r_[first, len(values)])


def _grams_of(held: dict[str, list], depth: int, wanted: bool) -> np.ndarray:
    """The grams of all pieces of a chunk that are held out, or of all that are not."""
    chosen = [(before, body) for held_out, before, body in zip(held["held_out"], held["before"], held["body"], strict=True)
              if bool(held_out) == wanted]
    values, at = np.empty(sum(len(body) for _, body in chosen), np.int64), 0
    for before, body in chosen:
        values[at:at + len(body)] = grams(before, body, depth)
        at += len(body)
    return values


def _asked_words(held: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
    counts: Counter = Counter()
    seen: set[bytes] = set()
    for held_out, body in zip(held["held_out"], held["body"], strict=True):
        (seen if held_out else counts).update(_tokens(body))
    found = list(counts) + [word for word in seen if word not in counts]
    return (np.array([word_key(word) for word in found], np.int64),
            np.array([counts.get(word, 0) for word in found], np.int64))


def _asked_grams(held: dict[str, list], depth: int) -> tuple[np.ndarray, np.ndarray]:
    keys, n = _distinct(_grams_of(held, depth, False))
    others, _ = _distinct(_grams_of(held, depth, True))
    every, _ = _distinct(np.concatenate([keys, others]))
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, keys)] = n
    return every, counts


def _asked(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Per chunk each different gram (kind 0) and word (kind 1) once, with its count in the training texts of the
    chunk, maybe 0."""
    for batch in batches:
        for number, payload in zip(batch.column(0), batch.column(1), strict=True):
            held = _unpacked(payload)
            for kind, (keys, n) in enumerate((_asked_grams(held, depth), _asked_words(held))):
                for at in range(0, len(keys), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    size = len(keys[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, number.as_py())), pa.array(np.full(size, kind, np.int32)),
                         pa.array(keys[part]), pa.array(n[part])], ["chunk", "kind", "key", "n"])


def _log_gamma(x: str) -> str:
    """SQL for the logarithm of the gamma function for x of 0.5 or more, good to 1e-9."""
    z = f"({x} + 7)"
    rising = " * ".join(f"({x} + {i})" for i in range(7))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + {0.5 * math.log(2 * math.pi)!r}D + 1 / (12 * {z}) "
            f"- 1 / (360 * pow({z}, 3)) + 1 / (1260 * pow({z}, 5)) - ln({rising}))")


def _weighed(nodes: DataFrame, leaf: bool) -> DataFrame:
    """Add ``pw``, the log probability of the node's training bits, and ``own``, the belief in its own counts."""
    kt = (f"{_log_gamma('(n0 + 0.5D)')} + {_log_gamma('(n1 + 0.5D)')} - {math.log(math.pi)!r}D "
          f"- {_log_gamma('(n0 + n1 + 1D)')}")
    half = f"{math.log(0.5)!r}D"
    rows = nodes.withColumn("pe", F.expr(kt))
    if leaf:
        return rows.selectExpr("ctx", "k", "n0", "n1", "pe AS pw", "1D AS own")
    return rows.withColumn("pw", F.expr(f"{half} + greatest(pe, deeper) + log1p(exp(-abs(pe - deeper)))")).selectExpr(
        "ctx", "k", "n0", "n1", "pw", f"exp({half} + pe - pw) AS own")


def model(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``key`` and ``log10p`` for every counted gram (``key``, ``n``): its last byte given those before.

    Counts become nodes of the deepest level, a row per context and bits so far; each level is the one below
    added up over its oldest byte. Then, from the root down, every node learns the probability of a 1 when the
    mix stops there. A gram that no training text has takes part with the count 0: its nodes predict a half,
    which is what the mix says of what it never saw. All of it is grouping and equi-joins on nodes.
    """
    bits = F.expr("transform(sequence(0, 7), j -> struct("
                  "CAST((1 << j) | shiftright(key & 255, 8 - j) AS INT) AS k, "
                  "CAST(shiftright(key & 255, 7 - j) & 1 AS INT) AS bit))")
    decisions = counts.select("key", "n", F.shiftrightunsigned("key", 8).alias("ctx"), F.explode(bits).alias("d"))
    decisions = decisions.selectExpr("key", "n", "ctx", "d.k AS k", "d.bit AS bit")
    leaves = decisions.groupBy("ctx", "k").agg(F.expr("sum(IF(bit = 0, n, 0))").alias("n0"),
                                               F.expr("sum(IF(bit = 1, n, 0))").alias("n1"))
    levels = [keep(_weighed(leaves, True), f"tree-{depth}")]
    for d in range(depth - 1, -1, -1):
        above = levels[0].groupBy(F.expr(f"ctx & {(1 << 8 * d) - 1}L").alias("ctx"), "k").agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("pw").alias("deeper"))
        levels.insert(0, keep(_weighed(above, False), f"tree-{d}"))

    estimate = "own * (n1 + 0.5D) / (n0 + n1 + 1D)"
    mixed = levels[0].selectExpr("ctx", "k", f"{estimate} AS one", "1 - own AS left")
    for d in range(1, depth + 1):
        parents = mixed.selectExpr("ctx AS up", "k AS same", "one AS so_far", "left AS open")
        mixed = keep(levels[d].join(parents, F.expr(f"ctx & {(1 << 8 * (d - 1)) - 1}L = up AND k = same")).selectExpr(
            "ctx", "k", f"so_far + open * {estimate} AS one", "open * (1 - own) AS left"), f"mix-{d}")
    return (decisions.select("key", "ctx", "k", "bit").join(mixed, ["ctx", "k"]).groupBy("key")
            .agg(F.expr("sum(log10(IF(bit = 1, one, 1 - one)))").alias("log10p")))


def _sums(pieces: list[tuple[bytes, bytes]], depth: int, keys: np.ndarray, values: np.ndarray) -> list[float]:
    """The sum of the values of its grams for each piece (bytes before, bytes).

    Grams are sorted with the number of their piece below them, so that each different one is looked up once and in
    order. Deep contexts leave no room for that number; then every place is looked up.
    """
    spare = 63 - 8 * (depth + 1)
    if spare < 4:
        return [float(values[np.searchsorted(keys, grams(before, body, depth))].sum()) for before, body in pieces]
    sums: list[float] = []
    part: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal part, held
        packed = np.concatenate(part)
        packed.sort()
        found = packed >> spare
        first = np.flatnonzero(np.diff(found, prepend=-1))
        value = np.repeat(values[np.searchsorted(keys, found[first])], np.diff(np.r_[first, len(found)]))
        sums.extend(np.bincount(packed & (1 << spare) - 1, value, len(part)).tolist())
        part, held = [], 0

    for before, body in pieces:
        part.append(grams(before, body, depth) << spare | len(part))
        held += len(body)
        if held >= PIECE_BYTES or len(part) == 1 << spare:
            flush()
    if part:
        flush()
    return sums


def _scored(asked: pa.Table, chunks: pa.Table, depth: int, total: int, distinct: int) -> pa.Table:
    """Sums per piece of the chunk; ``asked`` holds what the chunk asked for (kind, key, value)."""
    kinds, keys, values = (asked.column(c).to_numpy() for c in ("kind", "key", "value"))
    order = np.lexsort((keys, kinds))
    kinds, keys, values = kinds[order], keys[order], values[order]
    cut = int(np.searchsorted(kinds, 1))
    gram_keys, gram_values, word_keys, word_values = keys[:cut], values[:cut], keys[cut:], values[cut:]
    bottom = math.log10(total + distinct + 1)
    out: dict[str, list] = {c: [] for c in ("row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
    known: dict[bytes, int] = {}
    for payload in chunks.column("payload"):
        held = _unpacked(payload)
        out["score"] += _sums(list(zip(held["before"], held["body"], strict=True)), depth, gram_keys, gram_values)
        for row, doc_id, held_out, body in zip(*(held[c] for c in ("row", "doc_id", "held_out", "body")), strict=True):
            tokens = _tokens(body)
            if new := [word for word in dict.fromkeys(tokens) if word not in known]:
                at = np.searchsorted(word_keys, np.array([word_key(word) for word in new], np.int64))
                known.update(zip(new, word_values[at].astype(np.int64).tolist(), strict=True))
            counts = np.array([known[word] for word in tokens], np.int64)
            out["row"].append(row)
            out["doc_id"].append(doc_id)
            out["held_out"].append(held_out)
            out["n_tokens"].append(len(tokens))
            out["n_known"].append(int((counts > 0).sum()))
            out["base_score"].append(float((np.log10(counts + 1) - bottom).sum()))
    return pa.table({"row": pa.array(out["row"], pa.int64()), "doc_id": pa.array(out["doc_id"], pa.int64()),
                     "held_out": pa.array(out["held_out"], pa.bool_()),
                     "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
                     "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64())})


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: str = "false",
          depth: int = DEPTH) -> DataFrame:
    """One row per document with its code length under a model of the others.

    ``held_out`` is an SQL condition on ``doc_id``; documents it selects are scored and not learnt from. Columns:
    doc_id, held_out, n_tokens (words and one end), n_known (tokens that training has), train_tokens,
    base_score (log10 probability by word counts plus one), score (log10 probability under the
    tree: its code length in decimal digits, negated).

    A null or empty text is the end alone; a null doc_id makes a null condition, which is not held out;
    repeated rows are learnt from and scored each; an empty table gives an empty result. Texts of any length
    are worked off in pieces. Words are told apart by 64-bit hashes.

    Texts are packed into chunks once. A chunk asks for every different gram and word it holds once, with its
    own counts; what chunks ask for is added up, modelled, and joined back to the chunks that asked. So the
    shuffles carry keys per chunk, not per position, no table is broadcast or held whole anywhere, and the
    memory of a task follows the size of a chunk.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).selectExpr(
        "doc_id", f"coalesce({held_out}, false) AS held_out", "text")
    chunks = keep(rows.mapInArrow(lambda b: _chunks(b, depth), "chunk long, payload binary"), "text-chunks")

    asked = keep(chunks.mapInArrow(lambda b: _asked(b, depth), "chunk long, kind int, key long, n long"), "asked")
    asked_grams, asked_words = asked.where("kind = 0"), asked.where("kind = 1")

    words = keep(asked_words.groupBy("key").agg(F.sum("n").alias("n")), "word-counts")
    totals = words.where("n > 0").agg(F.sum("n"), F.count("*")).first()
    total, distinct = totals[0] or 0, totals[1]
    log10p = keep(model(keep(asked_grams.groupBy("key").agg(F.sum("n").alias("n")), "gram-counts"), depth), "gram-values")
    answers = (asked_grams.select("chunk", "kind", "key").join(log10p, "key").selectExpr("chunk", "kind", "key", "log10p AS value")
               .unionByName(asked_words.select("chunk", "kind", "key").join(words, "key")
                            .selectExpr("chunk", "kind", "key", "CAST(n AS DOUBLE) AS value")))
    parts = answers.groupBy("chunk").cogroup(chunks.groupBy("chunk")).applyInArrow(
        lambda a, c: _scored(a, c, depth, total, distinct),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    sums = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    return sums.drop("row")

