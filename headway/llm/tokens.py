"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np

TOKENIZER = "word_bpe_49k.json"
END_ID = 2

# Words remembered and words encoded at once. They bound memory and decide nothing about the ids.
REMEMBERED = 1_500_000
AT_ONCE = 500

_encoders: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    """The path of the tokenizer file the queries use."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def encoder(path: str) -> Encoder:
    """The encoder of this worker process; its memory of words lasts from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Grown:
    """An array that is added to; its room doubles."""

    def __init__(self, kind: str):
        self._room, self.size = np.empty(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self._room):
            room = np.empty(2 * (self.size + len(values)), self._room.dtype)
            room[:self.size] = self._room[:self.size]
            self._room = room
        self._room[self.size:self.size + len(values)] = values
        self.size += len(values)

    @property
    def values(self) -> np.ndarray:
        return self._room[:self.size]


class _Numbers(dict):
    """Words and their numbers; a new word gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Encodes with the tokenizers library; each word is encoded once and then looked up.

    For tokenizers that drop white space and never join characters across it, as the word-level ones do:
    the ids of a text are then the ids of its words one after the other. Ids are little-endian unsigned
    32-bit integers in bytes.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        # The ids of all words in one row, and where those of each word begin and end.
        self._numbers, self._ids, self._ends = _Numbers(), _Grown("<u4"), _Grown("i8")

    def encode(self, texts: Sequence[str | None], end_id: int | None = END_ID) -> list[bytes]:
        """The ids of each text, each followed by ``end_id``; a null text counts as empty."""
        if len(self._numbers) > REMEMBERED:
            self._forget()
        number = self._numbers.__getitem__
        found = []
        for text in texts:  # the words of one text at a time: they are still in the cache when looked up
            words = [] if text is None else text.encode().split()
            found.append(np.fromiter(map(number, words), np.int64, len(words)))
        if self._numbers.new:
            self._learn(self._numbers.new)
            self._numbers.new = []
        ids, ends = self._ids.values, np.r_[0, self._ends.values]
        end = b"" if end_id is None else np.uint32(end_id).tobytes()
        encoded = []
        for numbers in found:
            begins = ends[numbers]
            sizes = ends[numbers + 1] - begins
            upto = np.cumsum(sizes)
            # Each id's place is that of its word's first id and its own place in the word.
            at = np.repeat(begins - upto + sizes, sizes)
            at += np.arange(len(at))
            encoded.append(ids[at].tobytes() + end)
        return encoded

    def _learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), AT_ONCE):
            texts = [word.decode() for word in words[at:at + AT_ONCE]]
            encoding = self._tokenizer.encode(" ".join(texts), add_special_tokens=False)
            begins = list(accumulate((len(text) + 1 for text in texts), initial=0))
            starts = np.asarray([start for start, _ in encoding.offsets], np.int64)
            cuts = np.searchsorted(starts, begins)
            self._ends.add(self._ids.size + cuts[1:])
            self._ids.add(np.asarray(encoding.ids, "<u4"))
