"""Spans of texts that tokenizers treat by themselves, and a memory of them.

A span begins at a space that follows a character other than white space
and is not the text's last, and reaches to the next such place. Pre-token patterns that join at most
the spaces before a word never cross it, so what a tokenizer makes of a
text is what it makes of its spans, in order. A worker process remembers
the spans it has met by a 64-bit hash of their bytes; a text is then put
together with numpy. The memory starts anew when it is full.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from dimspark.llm.text import U64, mix, span_hashes

_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xA24BAED4963EE407)) | U64(1)
_BLOCK = 1 << 20


def _white_end(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is white space."""
    last = data[at - 1]
    out = (last == 0x20) | ((last >= 0x09) & (last <= 0x0D)) | ((last >= 0x1C) & (last <= 0x1F))
    far = np.flatnonzero((last >= 0x80) & (at >= 2))
    b, c = data[at[far] - 2].astype(np.int64), last[far].astype(np.int64)
    out[far] |= (b == 0xC2) & ((c == 0x85) | (c == 0xA0))  # U+0085, U+00A0
    far = far[at[far] >= 3]
    a, b, c = (data[at[far] - k].astype(np.int64) for k in (3, 2, 1))
    out[far] |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)  # U+1680
    out[far] |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))  # U+2000 to U+202F
    out[far] |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)  # U+205F
    out[far] |= (a == 0xE3) & (b == 0x80) & (c == 0x80)  # U+3000
    return out


def cut(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the spans of texts data[off[i]:off[i + 1]]:
    text i has the spans first[i]:first[i + 1], none if it is empty."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (off[np.minimum(np.searchsorted(off, at + 1), len(off) - 1)] != at + 1)]
    at = at[~_white_end(data, at)]
    begin = off[:-1][off[1:] > off[:-1]]
    start = np.unique(np.concatenate([at, begin]))
    first = np.searchsorted(start, off)
    return start, np.append(start[1:], len(data)) if len(start) else start, first


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # blocks of whole spans keep the scratch arrays small
        j = max(i + 1, int(np.searchsorted(end, start[i] + _BLOCK, "right")))
        at = start[i]
        out[i:j] = span_hashes(_CODES[data[at : end[j - 1]]], start[i:j] - at, end[i:j] - at)
        i = j
    return out


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[start:start + size] of all entries joined, and their offsets."""
    ends = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    out = np.empty(ends[-1], values.dtype)
    for i in range(0, len(size), _BLOCK):
        j = min(i + _BLOCK, len(size))
        n = int(ends[j] - ends[i])
        out[ends[i] : ends[j]] = values[np.arange(n) + np.repeat(start[i:j] - (ends[i:j] - ends[i]), size[i:j])]
    return out, ends


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class SpanMemory:
    """Lists of numbers per span. ``learn`` gets the bytes of unknown spans
    and returns, for each field, one sequence of numbers per span."""

    def __init__(self, fields: dict[str, type], learn: Callable[[list[bytes]], dict[str, Sequence]], max_bytes: int = 160 << 20):
        self.fields, self.learn, self.max_bytes = fields, learn, max_bytes
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted span hashes
        self.slot = np.zeros(0, np.int32)
        self.values = {k: np.zeros(1 << 12, t) for k, t in self.fields.items()}
        self.ends = {k: np.zeros(1 << 12, np.int64) for k in self.fields}  # slot s has values[ends[s]:ends[s + 1]]

    def _held(self) -> int:
        return 12 * len(self.keys) + sum(v.nbytes for v in self.values.values()) + sum(v.nbytes for v in self.ends.values())

    def _learn(self, spans: list[bytes], keys: np.ndarray) -> None:
        n = len(self.keys)
        for name, lists in self.learn(spans).items():
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            ends = self.ends[name] = _grown(self.ends[name], n + len(lists) + 1)
            used = int(ends[n])
            np.cumsum(size, out=ends[n + 1 : n + len(lists) + 1])
            ends[n + 1 : n + len(lists) + 1] += used
            total = int(ends[n + len(lists)])
            values = self.values[name] = _grown(self.values[name], total)
            if lists and isinstance(lists[0], bytes):
                values[used:total] = np.frombuffer(b"".join(lists), values.dtype)
            else:
                values[used:total] = np.fromiter((x for one in lists for x in one), values.dtype, total - used)
        at = np.searchsorted(self.keys, keys)
        self.slot = np.insert(self.slot, at, np.arange(n, n + len(keys), dtype=np.int32))
        self.keys = np.insert(self.keys, at, keys)

    def slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A slot for each span, known or learnt now; good until the next call."""
        keys, first, back = np.unique(hashes(data, start, end), return_index=True, return_inverse=True)
        if self._held() > self.max_bytes:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = first[~known].tolist()
            self._learn([data[start[i] : end[i]].tobytes() for i in new], keys[~known])
            at = np.searchsorted(self.keys, keys)
        return self.slot[at][back] if len(keys) else np.zeros(0, np.int32)

    def size(self, name: str, slots: np.ndarray) -> np.ndarray:
        return self.ends[name][slots + 1] - self.ends[name][slots]

    def gather(self, name: str, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The field's values of all slots joined, and their offsets."""
        return gather(self.values[name], self.ends[name][slots], self.size(name, slots))
