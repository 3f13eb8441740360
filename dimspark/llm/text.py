"""Words of whole Arrow text columns, as byte spans and 64-bit hashes.

All operators of this package that work on words share this scan. It runs
inside tasks, on one Arrow batch at a time, with numpy only: no Python
object per word. A word's hash is a polynomial over random 64-bit byte
values, so equal words have equal hashes everywhere and unequal ones
differ with probability 1 - 2**-64 each.

Nulls count as empty texts. A text is always scanned whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit name for each ordered pair (a, b)."""
    return mix(a * U64(0xD6E8FEB86659FD93) + mix(b + U64(0x9E3779B97F4A7C15)))


def _table(is_word, lower: bool) -> np.ndarray:
    code = mix(np.arange(1, 257, dtype=np.uint64) * U64(_BASE)) | U64(1)
    if lower:
        code[65:91] = code[97:123]
    code[[i for i in range(256) if not is_word(i)]] = 0
    return code


# Byte classes. Both word patterns exclude ASCII characters only, so they
# can be applied to UTF-8 bytes: every byte of a longer character is 0x80 up.
SPACED = _table(lambda i: not (i == 0x20 or 0x09 <= i <= 0x0D), lower=False)  # [^\x20\x09-\x0D]+
SPACED_LOWER = _table(lambda i: not (i == 0x20 or 0x09 <= i <= 0x0D), lower=True)
ALNUM_LOWER = _table(  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
    lambda i: i >= 0x80 or 0x30 <= i <= 0x39 or 0x41 <= i <= 0x5A or 0x61 <= i <= 0x7A, lower=True
)


@dataclass
class Words:
    data: np.ndarray  # all texts' bytes, joined
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    start: np.ndarray  # byte span of each word in data
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # words of text i are first[i]:first[i + 1]

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    arr = texts.cast(pa.large_binary())
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and len(raw) else np.zeros(0, np.uint8)
    return data, off - off[0]


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        m = max(n, _BLOCK + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end] for each span, equal for equal contents."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def scan(texts, kind: np.ndarray = SPACED) -> Words:
    """All words of a string column."""
    data, off = text_bytes(texts)
    n = len(data)
    flag = (kind != 0)[data] if n else np.zeros(0, bool)
    before = np.zeros(n, bool)
    before[1:] = flag[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = flag[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    start = np.flatnonzero(flag & ~before)
    end = np.flatnonzero(flag & ~after) + 1
    del before, after, flag
    hashes = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # blocks of whole words keep the scratch arrays small
        j = max(i + 1, int(np.searchsorted(end, start[i] + _BLOCK, "right")))
        at = start[i]
        hashes[i:j] = span_hashes(kind[data[at : end[j - 1]]], start[i:j] - at, end[i:j] - at)
        i = j
    return Words(data, off, start, end, hashes, np.searchsorted(start, off))


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about max_bytes of text (one text at
    least): the memory of a task does not depend on Spark's batch size."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = text_bytes(b.column(b.schema.get_field_index(column)))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
            yield b.slice(i, j - i)
            i = j


def word_bytes(w: Words, i: int) -> bytes:
    return w.data[w.start[i] : w.end[i]].tobytes()
