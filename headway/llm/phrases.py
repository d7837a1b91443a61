"""Phrase collocations by dynamic itemset counting.

The documents are dealt over shards, which are scanned in turn, again and again. Single words are counted from the
first scan on. A longer phrase becomes active after the scan at which both phrases one word shorter have reached the
threshold, and is then counted for one full cycle of shards, so phrases of all lengths are counted side by side.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import keep, ship, text_of

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
# A phrase goes if a longer one around it occurs in at least this percentage of its places.
COVERED = 50
SHARDS = 4
# Counters per phrase length, a power of two. They decide only when a phrase becomes active: phrases that share a
# counter may become active too early, which costs rows, and never too late.
SLOTS = 1 << 24

# Bounds of what a task holds: words looked at together, rows before they are summed, words remembered.
_WINDOW = 1 << 19
_ROWS = 1 << 20
_REMEMBERED = 1 << 20
_CHUNK = 1 << 18
_NEVER = 255

_BREAK = b"."
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0a\x0b\x0c\x0d", bytes(range(97, 123)) + _BREAK * 10)


class _Words(dict):
    """The words of one language and their numbers; new ones are numbered as they are met. 0 is a break."""

    def __init__(self, lang: str, hashes: array, names: list):
        super().__init__({_BREAK: 0})
        self._lang, self._salt, self._hashes, self._names = lang, f"{len(lang)}:{lang}:".encode(), hashes, names

    def __missing__(self, word: bytes) -> int:
        import xxhash

        number = self[word] = len(self._hashes)
        self._hashes.append(xxhash.xxh64_intdigest(self._salt + word) - (1 << 63))
        self._names.append((self._lang, word))
        return number


def _mixed(before: np.ndarray | None, word: np.ndarray) -> np.ndarray:
    """A hash of a phrase from that of all but its last word and the last word."""
    value = word.view(np.uint64) if before is None else (before ^ word.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (value ^ value >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)


def _value(columns: list[np.ndarray]) -> np.ndarray:
    value = None
    for column in columns:
        value = _mixed(value, column)
    return value


def _slot(value: np.ndarray, slots: int) -> np.ndarray:
    return (value >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def _tokens(lang: str, text: str, known: dict, hashes: array, names: list) -> np.ndarray:
    """Numbers of the words of a text, with a break between pieces and at the end."""
    tokens = text.encode().translate(_TABLE).replace(_BREAK, b" . ").split()
    if lang not in known:
        known[lang] = _Words(lang, hashes, names)
    tokens.append(_BREAK)
    return np.fromiter(map(known[lang].__getitem__, tokens), np.int64, len(tokens))


class _Scan:
    """What one task counts of a shard."""

    def __init__(self, step: int, shards: int, most: int, least: int, slots: int, parts: int, reached: list[np.ndarray]):
        self.step, self.shards, self.most, self.least, self.slots, self.parts = step, shards, most, least, slots, parts
        self.reached = reached
        self.counters = [np.zeros(slots, np.uint16) for _ in range(most)]
        self.found: list[list[np.ndarray]] = [[] for _ in range(most + 1)]
        self.held = 0
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, _Words] = {}
        self.hashes, self.names = array("q", [0]), [("", _BREAK)]
        self.times = np.zeros(1, np.int64)

    def look(self, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes = np.array(self.hashes)
        for at in range(0, len(ids), _WINDOW):
            self._window(ids[at:at + _WINDOW + self.most - 1], _WINDOW, hashes)
            if self.held > _ROWS:
                yield from self.flush()

    def _window(self, ids: np.ndarray, own: int, hashes: np.ndarray) -> None:
        """Note the active phrases that start at the first ``own`` places."""
        if self.step < self.shards:
            times = np.bincount(ids[:own], minlength=len(hashes))
            times[:len(self.times)] += self.times
            self.times = times
        words, is_word = hashes[ids], ids > 0
        whole, mixed = is_word, _mixed(None, words)
        for k in range(2, self.most + 1):
            shorter = np.where(whole, self.reached[k - 2][_slot(mixed, self.slots)], _NEVER)
            if len(shorter) < 2 or shorter.min() == _NEVER:
                return
            since = np.maximum(shorter[:-1], shorter[1:]).astype(np.int16)
            whole = whole[:-1] & is_word[k - 1:]
            active = whole & (since < self.step) & (self.step <= since + self.shards)
            at = np.flatnonzero(active[:own])
            if len(at):
                self.found[k].append(np.stack([ids[at + j] for j in range(k)]).astype(np.int32))
                self.held += len(at)
            mixed = _mixed(mixed[:-1], words[k - 1:])

    def flush(self) -> Iterator[pa.RecordBatch]:
        """The counts so far: a row per size and part, phrases as the hashes of their words."""
        hashes = np.array(self.hashes)
        at = np.flatnonzero(self.times)
        at = at[at > 0]
        if len(at):
            langs = sorted({self.names[i][0] for i in at.tolist()})
            number = {lang: i for i, lang in enumerate(langs)}
            of = np.array([number[self.names[i][0]] for i in at.tolist()])
            for lang, n in zip(langs, np.bincount(of, self.times[at]).astype(np.int64).tolist(), strict=True):
                yield _row(size=0, n=n, langs=[lang])
            words = [self.names[i][1] for i in at.tolist()]
            yield from self._blocks([hashes[at]], self.times[at], of, words, langs)
        self.times = np.zeros(len(hashes), np.int64)
        for k in range(2, self.most + 1):
            if self.found[k]:
                ids, times = _counted(np.concatenate(self.found[k], axis=1), len(hashes))
                self.found[k] = []
                yield from self._blocks([hashes[column] for column in ids], times)
        self.held = 0

    def _blocks(self, columns: list[np.ndarray], times: np.ndarray, of: np.ndarray | None = None,
                words: list[bytes] | None = None, langs: list[str] | None = None) -> Iterator[pa.RecordBatch]:
        value = _value(columns)
        counter = self.counters[len(columns) - 1]
        np.add.at(counter, _slot(value, self.slots), np.minimum(times, self.least).astype(np.uint16))
        np.minimum(counter, self.least, out=counter)
        part = (value % np.uint64(self.parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cuts = np.r_[0, np.flatnonzero(np.diff(part[order])) + 1, len(order)]
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = order[first:last]
            held = [c[at] for c in (*columns, times, *([] if of is None else [of]))]
            yield _row(size=len(columns), part=int(part[at[0]]), n=len(at), payload=_packed(*held), langs=langs,
                       names=None if words is None else _squeezed(b"\n".join([words[i] for i in at.tolist()])))

    def totals(self) -> Iterator[pa.RecordBatch]:
        """The counters, in compressed chunks; a chunk of zeros is left out."""
        for k, counter in enumerate(self.counters, 1):
            for chunk, values in enumerate(counter.reshape(-1, min(_CHUNK, self.slots)).astype(np.uint8)):
                if values.any():
                    yield _row(size=k, chunk=chunk, payload=_squeezed(values.tobytes()))


def _counted(ids: np.ndarray, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of ``ids``, sorted, and how often each occurs."""
    k, width = len(ids), max(1, (numbers - 1).bit_length())
    if k * width > 63:
        order = np.lexsort(ids[::-1])
        ids = ids[:, order]
        first = np.flatnonzero(np.r_[True, (ids[:, 1:] != ids[:, :-1]).any(axis=0)])
        return ids[:, first], np.diff(np.r_[first, ids.shape[1]])
    packed = np.zeros(ids.shape[1], np.int64)
    for column in ids:
        packed = packed << width | column
    packed, times = np.unique(packed, return_counts=True)
    return np.stack([packed >> width * (k - 1 - j) & (1 << width) - 1 for j in range(k)]), times


_ROW = pa.schema([("size", pa.int32()), ("part", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()),
                  ("payload", pa.binary()), ("names", pa.binary()), ("langs", pa.list_(pa.string()))])
_DDL = "size int, part int, chunk int, n long, payload binary, names binary, langs array<string>"


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values], _ROW)


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _loosened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _packed(*columns: np.ndarray) -> bytes:
    return _squeezed(b"".join([c.astype(np.int64).tobytes() for c in columns]))


def _columns(payload: bytes, n: int) -> list[np.ndarray]:
    return list(np.frombuffer(_loosened(payload), np.int64).reshape(-1, n))


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Chunks of counters with the same place summed, up to the threshold, with a bit for each that has reached it."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            values = np.frombuffer(_loosened(row["payload"]), np.uint8)
            at = row["size"], row["chunk"]
            sums[at] = np.minimum(sums[at] + values, least) if at in sums else values
    for (size, chunk), values in sums.items():
        yield _row(size=size, chunk=chunk, payload=_squeezed(values.tobytes()), names=np.packbits(values >= least).tobytes())


def _count(docs: DataFrame, least: int, most: int, shards: int, slots: int,
           parts: int) -> tuple[DataFrame, list[np.ndarray]]:
    """Stored partial counts of all phrases that were active, and the counters that reached the threshold."""
    spark = docs.sparkSession
    width = min(_CHUNK, slots)
    reached = [np.full(slots, _NEVER, np.uint8) for _ in range(most)]
    last = [-shards] * most
    counters = counted = None
    step = 0
    # Words are counted in the first cycle, longer phrases up to a cycle after the last that made one active.
    while step < shards or any(step <= at + shards for at in last[:-1]):
        shared = spark.sparkContext.broadcast([_squeezed(of.tobytes()) for of in reached[:-1]])

        def scan(batches: Iterator[pa.RecordBatch], step: int = step, shared=shared) -> Iterator[pa.RecordBatch]:
            active = [np.frombuffer(_loosened(of), np.uint8) for of in shared.value]
            task, waiting, held = _Scan(step, shards, most, least, slots, parts, active), [], 0
            for batch in batches:
                for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                    waiting.append(_tokens(lang.as_py(), text.as_py(), task.known, task.hashes, task.names))
                    held += len(waiting[-1])
                    if held >= _WINDOW:
                        yield from task.look(np.concatenate(waiting))
                        waiting, held = [], 0
                        if len(task.hashes) > _REMEMBERED:
                            yield from task.flush()
                            task.forget()
            if waiting:
                yield from task.look(np.concatenate(waiting))
            yield from task.flush()
            yield from task.totals()

        shard = docs.where(F.pmod(F.xxhash64("lang", "text"), F.lit(shards)) == step % shards)
        rows = keep(shard.mapInArrow(scan, _DDL), f"phrase-counts-{step}")
        counted = rows if counted is None else counted.unionByName(rows)
        chunks = rows.where("chunk IS NOT NULL")
        if counters is not None:
            chunks = chunks.unionByName(counters)
        counters = keep(chunks.repartition("size", "chunk").mapInArrow(lambda batches: _merge(batches, least), _DDL),
                        f"phrase-counters-{step}")
        # One bit per counter comes to the driver, whatever the input.
        for row in counters.select("size", "chunk", "names").collect():
            part = reached[row["size"] - 1][row["chunk"] * width:(row["chunk"] + 1) * width]
            now = np.unpackbits(np.frombuffer(row["names"], np.uint8))[:width].astype(bool) & (part == _NEVER)
            if now.any():
                part[now] = step
                last[row["size"] - 1] = step
        shared.destroy()
        step += 1
    return counted, reached


def _added(batches: Iterator[pa.RecordBatch], most: int, least: int) -> Iterator[pa.RecordBatch]:
    """Phrases with their counts, from blocks in the order of size and part; those below the threshold are left out."""
    at, columns, names, langs = None, [], [], []

    def rows() -> pa.RecordBatch | None:
        size = at[0]
        merged = [np.concatenate(c) for c in zip(*[c[:size + 1] for c in columns], strict=True)]
        order = np.lexsort(merged[size - 1::-1])
        merged = [c[order] for c in merged]
        first = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in merged[:size]])])
        times = np.add.reduceat(merged[size], first)
        kept = np.flatnonzero(times >= least)
        n = len(kept)
        out = [pa.array(c[first[kept]]) for c in merged[:size]] + [pa.nulls(n, pa.int64())] * (most - size)
        text = [names[i] for i in order[first[kept]].tolist()] if size == 1 else [None] * n
        of = [langs[i] for i in order[first[kept]].tolist()] if size == 1 else [None] * n
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, size, np.int32)), pa.array(of, pa.string()), pa.array(text, pa.string()), *out, pa.array(times[kept])],
            ["size", "lang", "word", *[f"x{j}" for j in range(1, most + 1)], "a"])

    for batch in batches:
        for row in batch.to_pylist():
            if at != (row["size"], row["part"]):
                if columns:
                    yield rows()
                at, columns, names, langs = (row["size"], row["part"]), [], [], []
            columns.append(_columns(row["payload"], row["n"]))
            if row["size"] == 1:
                names += _loosened(row["names"]).decode().split("\n")
                langs += [row["langs"][i] for i in columns[-1][2].tolist()]
    if columns:
        yield rows()


def _possible(batches: Iterator[pa.RecordBatch], bits: list[np.ndarray], slots: int) -> Iterator[pa.RecordBatch]:
    """Blocks without the phrases whose counter stayed below the threshold: they are below it, too."""
    for batch in batches:
        for row in batch.to_pylist():
            columns = _columns(row["payload"], row["n"])
            slot = _slot(_value(columns[:row["size"]]), slots)
            at = np.flatnonzero(bits[row["size"] - 1][slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
            if len(at):
                if row["size"] == 1:
                    names = _loosened(row["names"]).split(b"\n")
                    row["names"] = _squeezed(b"\n".join([names[i] for i in at.tolist()]))
                yield _row(**{**row, "n": len(at), "payload": _packed(*[c[at] for c in columns])})


def _frequent(counted: DataFrame, reached: list[np.ndarray], most: int, least: int, slots: int, parts: int) -> DataFrame:
    """Stored: size, lang and word of single words, x1, x2, ..., and ``a`` of all phrases at or above the threshold."""
    bits = counted.sparkSession.sparkContext.broadcast([np.packbits(of != _NEVER) for of in reached])
    possible = counted.where("size > 0 AND chunk IS NULL").mapInArrow(lambda b: _possible(b, bits.value, slots), _DDL)
    dealt = possible.repartition(parts, "part").sortWithinPartitions("size", "part")
    ddl = "size int, lang string, word string, " + "".join(f"x{j} long, " for j in range(1, most + 1)) + "a long"
    return keep(dealt.mapInArrow(lambda b: _added(b, most, least), ddl), "phrase-frequent")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = MIN_COUNT,
                 most: int = MAX_WORDS, top: int = TOP, covered: int = COVERED, shards: int = SHARDS,
                 slots: int = SLOTS) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``most`` words: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts, with A-Z in lower case, are cut at ``.,;:!?`` and line ends into pieces, and those at spaces and tabs into
    words. ``n`` counts the words of a language, ``a`` the places of a phrase inside pieces, overlapping ones
    included. A candidate has a >= ``least``. Cut after k words it scores floor(1000000 a a / (l r)), l and r being
    the counts of its parts; the lowest score counts, ties to the smallest k. Candidates inside a longer candidate
    with at least ``covered`` % of their count are dropped. Order: score and a descending, phrase ascending by bytes.

    A null text counts as empty, a null language as ``und``; other columns are ignored, repeated rows count each
    time, an empty table gives an empty result. Very long texts are counted window by window.

    Tasks ship sums, not places, and a phrase takes hashes of its words instead of text. Sums travel in blocks, dealt
    over as many parts as a shuffle has partitions. Only counters and marks of a fixed size (``slots`` bytes per
    length) are broadcast or come to the driver. All counts are exact; words of equal hash fail the job.
    """
    if most < 2 or least < 1 or least > 250 or slots & (slots - 1) or slots < 8:
        raise ValueError("two words at least, a threshold of 1 to 250, and a power of two of 8 or more as slots")
    if shards * (most + 1) >= _NEVER:
        raise ValueError("too many shards")
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted, reached = _count(rows, least, most, shards, slots, parts)
    totals = counted.where("size = 0").select(F.col("langs")[0].alias("lang"), "n").groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = _frequent(counted, reached, most, least, slots, parts)
    words = frequent.where("size = 1").select("lang", "word", "x1", F.col("a").alias("f"))
    if not words.groupBy("x1").count().where("count > 1").isEmpty():
        raise ValueError("two words have the same number")
    xs = [f"x{j}" for j in range(1, most + 1)]
    grams = frequent.where("size > 1").select("size", *xs, "a")

    def frequency(of: list[str], label: str) -> DataFrame:
        """Counts of phrases as long as ``of``, with columns to join those of a candidate by."""
        table = words.withColumnRenamed("f", "a") if len(of) == 1 else grams.where(F.col("size") == len(of))
        return table.select(*[F.col(f"x{j}").alias(c) for j, c in enumerate(of, 1)], F.col("a").alias(label))

    scores = []
    for k in range(2, most + 1):
        rows = grams.where(F.col("size") == k)
        for cut in range(1, k):
            rows = rows.join(frequency(xs[:cut], f"l{cut}"), xs[:cut]).join(frequency(xs[cut:k], f"r{cut}"), xs[cut:k])
        wide = lambda c: f"CAST({c} AS DECIMAL(13,0))"  # noqa: E731  a million squares of it fit 38 digits
        scored = [f"named_struct('score', CAST(1000000 AS DECIMAL(7,0)) * {wide('a')} * {wide('a')} div "
                  f"({wide(f'l{cut}')} * {wide(f'r{cut}')}), 'cut', {cut}, 'l', l{cut}, 'r', r{cut})" for cut in range(1, k)]
        scores.append(rows.withColumn("best", F.expr(f"array_min(array({', '.join(scored)}))"))
                     .select("size", *xs, "a", "best.score", "best.l", "best.r"))
        if k < most:
            inner = [F.struct(*[F.col(xs[at + j]) for j in range(k)]) for longer in range(k + 1, most + 1)
                     for at in range(longer - k + 1)]
            sizes = [longer for longer in range(k + 1, most + 1) for at in range(longer - k + 1)]
            around = grams.where(F.col("size") > k).select("a", F.explode(F.array(*[
                F.when(F.col("size") == size, part.cast("struct<" + ", ".join(f"y{j}: bigint" for j in range(k)) + ">"))
                for size, part in zip(sizes, inner, strict=True)])).alias("y")).where("y IS NOT NULL")
            around = (around.select("a", *[F.col(f"y.y{j}").alias(xs[j]) for j in range(k)])
                      .groupBy(*xs[:k]).agg(F.max("a").alias("__around")))
            scores[-1] = (scores[-1].join(around, xs[:k], "left")
                         .where(f"__around IS NULL OR 100 * __around < {covered} * a").drop("__around"))
    left = scores[0]
    for part in scores[1:]:
        left = left.unionByName(part)
    for j, x in enumerate(xs, 1):
        names = words.select(F.col("x1").alias(f"__{x}"), F.col("word").alias(f"__w{j}"), *([F.col("lang")] if j == 1 else []))
        left = left.join(names, F.col(x) == F.col(f"__{x}"), "left").drop(f"__{x}")
    named = left.withColumn("phrase", F.concat_ws(" ", *[f"__w{j}" for j in range(1, most + 1)]))
    best = (named.selectExpr("lang", "phrase", "a", "l", "r", "score",
                             "row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank")
            .where(F.col("rank") <= top))
    return best.join(totals, "lang").selectExpr("lang", "CAST(rank AS BIGINT) AS rank", "phrase", "a", "l", "r", "n", "score")
