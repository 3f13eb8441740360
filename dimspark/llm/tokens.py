"""Token ids of whole texts with a word-level cache.

For tokenizers that cut at white space before anything else and drop it
(as ``word_bpe_49k.json`` does), the ids of a text are the ids of its
space-separated words in order. Each different word of a batch is encoded
once by the tokenizers library and remembered; a text is then put together
with numpy.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np

from dimspark.llm.text import SPACED, SPACED_LOWER, Words, scan, word_bytes

MAX_WORDS = 3_000_000  # remembered words (about 100 MB); the cache starts anew beyond

_ENCODERS: dict[str, "WordEncoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> "WordEncoder":
    """This worker process's encoder: later tasks go on with its cache."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        normal = self.tokenizer.normalizer
        self.lower = normal is not None and normal.normalize_str("AZ") == "az"
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted word hashes
        self.slots = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)

    def _learn(self, words: list[str], keys: np.ndarray) -> None:
        slot = len(self.keys)
        for i in range(0, len(words), 4096):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words[i : i + 4096], add_special_tokens=False)]
            size = np.array([len(x) for x in found], np.int64)
            n = int(size.sum())
            self.ids = _grown(self.ids, self.used + n)
            self.start, self.size = _grown(self.start, slot + len(found)), _grown(self.size, slot + len(found))
            self.ids[self.used : self.used + n] = [x for ids in found for x in ids]
            self.start[slot : slot + len(found)] = self.used + np.cumsum(size) - size
            self.size[slot : slot + len(found)] = size
            self.used, slot = self.used + n, slot + len(found)
        at = np.searchsorted(self.keys, keys)
        self.slots = np.insert(self.slots, at, np.arange(len(self.keys), slot, dtype=np.int32))
        self.keys = np.insert(self.keys, at, keys)

    def _scan(self, texts) -> Words:
        """Words by hash; upper and lower case are one word where the
        tokenizer lower-cases, but for words that may be special tokens."""
        if not self.lower:
            return scan(texts, SPACED)
        w = scan(texts, SPACED_LOWER)
        marks = np.flatnonzero(w.data == 0x3C)
        if len(marks):
            at = np.searchsorted(w.end, marks, "right")
            exact = np.unique(at)
            for i in exact[exact < len(w.end)].tolist():
                w.hash[i] = np.uint64(hash_bytes(word_bytes(w, i)))
        return w

    def encode(self, texts, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, offsets): text i has
        ids[offsets[i]:offsets[i + 1]], with ``end`` as its last id if given."""
        w = self._scan(texts)
        keys, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        if len(self.keys) > MAX_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            self._learn([word_bytes(w, i).decode() for i in first[~known].tolist()], keys[~known])
            at = np.searchsorted(self.keys, keys)
        slot = self.slots[at][back] if len(keys) else np.zeros(0, np.int32)
        size = self.size[slot].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(ends[-1]) + np.repeat(self.start[slot] - ends[:-1], size)
        offsets = ends[w.first]
        ids = self.ids[source]
        if end is None:
            return ids, offsets
        n = len(w.first) - 1
        out = np.full(len(ids) + n, end, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
        return out, offsets + np.arange(n + 1)


def hash_bytes(word: bytes) -> int:
    """A hash that tells cases apart, for the few words with a ``<``."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
