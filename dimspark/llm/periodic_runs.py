"""Periodic runs of words, found and collapsed.

A run is a stretch of consecutive words with smallest period q (words q
apart are equal) of at least ``min_length`` and 2 * q words that no
neighbouring word extends keeping q. Runs are maximal; they may overlap.

1. *Recursive frequency splitting.* Every word of a run stands in it at
   least twice, since the run has two whole periods. So a word that occurs
   once in a segment joins no run inside it and splits it; pieces below
   ``min_length`` are dropped; the pieces' own counts split them again,
   until nothing changes. A segment is looked at again only if it was
   split. Passes over all open segments of a batch do the bulk; segments
   that lose next to nothing a pass are finished one by one, where only the
   smaller pieces of a split are counted anew (n log n in all).
2. *Lag scan* of the surviving segments. Short lags compare the words
   themselves. For lags K to 2K, a run of period q in that range repeats
   some aligned block of K/2 words exactly q words later: each block looks
   up its equals K to 2K words on, and each equal pair is extended both
   ways as far as the words stay q apart equal. The extension bisects on
   hashes of spans, so a scan costs about n log n even if all is one run.
   A stretch found at several lags has the smallest of them as its period.

All runs lie whole inside one segment, so splitting loses none. A task
holds one slice of texts (about 4 MB, at least one whole text).

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; repeated rows are treated each; an empty table gives an
empty table; further columns are kept (a column named as an output column
is replaced).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.llm.substring_dedup import kept_texts
from dimspark.llm.text import U64, Words, mix, scan, slices

MIN_LENGTH = 12
SHORT = 16  # lags below are compared word by word
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_PATIENCE = 24  # passes over all open segments before the rest is finished one by one


def _pieces(alive: np.ndarray, head: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of alive places that no head cuts, long enough."""
    begin = alive & head
    begin[1:] |= alive[1:] & ~alive[:-1]
    last = alive.copy()
    last[:-1] &= ~alive[1:] | head[1:]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    keep = end - start >= min_length
    return start[keep], end[keep]


def _places(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _finish(codes: np.ndarray, start: int, end: int, min_length: int) -> list[tuple[int, int]]:
    """Stable pieces of one segment. After a split the largest piece keeps
    the counts, less those of the smaller pieces."""
    first: dict[int, int] = {}
    for c in codes[start:end].tolist():
        first[c] = first.get(c, 0) + 1
    out = []
    rare = [i for i in range(start, end) if first[int(codes[i])] == 1]
    work = [(start, end, first, rare)]
    while work:
        s, e, count, cuts = work.pop()
        if not cuts:
            out.append((s, e))
            continue
        cuts.sort()
        edges = [s - 1, *cuts, e]
        parts = [(a + 1, b) for a, b in zip(edges[:-1], edges[1:])]
        main = max(parts, key=lambda p: p[1] - p[0])
        if main[1] - main[0] < min_length:
            continue
        lost: set[int] = set()  # words whose count fell
        for i in cuts:
            count[int(codes[i])] -= 1
        for p in parts:
            if p == main:
                continue
            own: dict[int, int] = {}
            for c in codes[p[0] : p[1]].tolist():
                own[c] = own.get(c, 0) + 1
                count[c] -= 1
                lost.add(c)
            if p[1] - p[0] >= min_length:
                work.append((*p, own, [i for i in range(*p) if own[int(codes[i])] == 1]))
        # where the words that became rare stand in the main piece
        now = np.array([c for c in lost if count[c] == 1], codes.dtype)
        again = []
        if len(now):
            again = _find(codes, main, now)
        work.append((*main, count, again))
    return out


_INDEX: dict[str, np.ndarray] = {}


def _find(codes: np.ndarray, piece: tuple[int, int], wanted: np.ndarray) -> list[int]:
    """Places of words that occur once in the piece, by an index of all."""
    if _INDEX.get("codes") is not codes:
        order = np.argsort(codes, kind="stable")
        _INDEX.update(codes=codes, order=order, sorted=codes[order])
    order, by = _INDEX["order"], _INDEX["sorted"]
    out = []
    for c in wanted:
        lo, hi = np.searchsorted(by, c), np.searchsorted(by, c, "right")
        at = lo + np.searchsorted(order[lo:hi], piece[0])
        out.append(int(order[at]))
    return out


def split(codes: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Segments (start, end) that survive frequency splitting. codes: one
    number per word; text i is codes[first[i]:first[i + 1]]."""
    start, end = first[:-1], first[1:]
    start, end = start[end - start >= min_length], end[end - start >= min_length]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    alive, marks = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    for turn in range(_PATIENCE + 1):
        if not len(start):
            break
        if turn == _PATIENCE:
            rest = [p for s, e in zip(start.tolist(), end.tolist()) for p in _finish(codes, s, e, min_length)]
            _INDEX.clear()
            done.append((np.array([s for s, _ in rest], np.int64), np.array([e for _, e in rest], np.int64)))
            break
        at = _places(start, end)
        of = np.repeat(np.arange(len(start)), end - start)
        order = np.lexsort((codes[at], of))
        seg, word = of[order], codes[at][order]
        same = (seg[1:] == seg[:-1]) & (word[1:] == word[:-1])
        often = np.zeros(len(at), bool)
        often[1:] |= same
        often[:-1] |= same
        keep = np.empty(len(at), bool)
        keep[order] = often
        hurt = np.zeros(len(start), bool)
        hurt[of[~keep]] = True
        done.append((start[~hurt], end[~hurt]))
        before = start
        alive[at], marks[start] = keep & hurt[of], True
        start, end = _pieces(alive, marks, min_length)
        alive[at], marks[before] = False, False
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = (np.concatenate(x).astype(np.int64) for x in zip(*done))
    order = np.argsort(start)
    return start[order], end[order]


class _Spans:
    """Hashes of spans of a sequence, from running sums."""

    def __init__(self, seq: np.ndarray):
        self.seq = mix(seq.astype(np.uint64) + U64(0x51ED)) | U64(1)
        n = len(seq)
        base = 0x9E3779B97F4A7C15 | 1
        self.down = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        up = np.full(n + 1, base, np.uint64)
        up[0] = self.down[0] = 1
        up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(self.down, dtype=np.uint64)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.seq * up[:n], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start])

    def forward(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        """How many words from a and b on are equal, at most room."""
        lo, hi = np.zeros(len(a), np.int64), room.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self(a, a + mid) == self(b, b + mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def backward(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(a), np.int64), room.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self(a - mid, a) == self(b - mid, b)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def runs_of(codes: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, ...]:
    """(start, length, period) of all runs, by start, then period; starts
    are places in codes. codes: equal words have equal numbers; text i is
    codes[first[i]:first[i + 1]]."""
    start, end = split(codes, first, min_length)
    none = np.zeros(0, np.int64)
    if not len(start):
        return none, none, none
    # The segments, longest first, with a word between that nothing equals.
    order = np.argsort(start - end, kind="stable")
    start, end = start[order], end[order]
    size = end - start
    place = _places(start, end)
    of = np.repeat(np.arange(len(size)), size)
    seq = np.empty(len(place) + len(size), np.int64)
    base = np.cumsum(size + 1) - size - 1  # where each segment begins in seq
    seq[np.arange(len(place)) + of] = np.unique(codes[place], return_inverse=True)[1]
    seq[base + size] = -1 - np.arange(len(size))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # start, end in seq, lag

    def longest(least: int) -> int:
        """Words of seq that belong to segments of at least this length."""
        k = int(np.searchsorted(-size, -least, "right"))
        return int(base[k - 1] + size[k - 1]) if k else 0

    for q in range(1, SHORT):
        n = longest(max(min_length, 2 * q))
        if n <= q:
            break
        s, e = _stretches(seq[: n - q] == seq[q:n])
        keep = e - s + q >= max(min_length, 2 * q)
        found.append((s[keep], e[keep] + q, np.full(int(keep.sum()), q)))
    spans, k = None, SHORT
    while (n := longest(max(min_length, 2 * k))) > 0:
        spans = spans or _Spans(seq[:n])
        block = k // 2
        gram = spans(np.arange(n - block + 1), np.arange(block, n + 1))
        gram = np.unique(gram, return_inverse=True)[1].astype(np.int64)
        wide = n + 2 * k + 1
        index = np.sort(gram * wide + np.arange(len(gram)))
        at = np.arange(0, len(gram), block)  # aligned blocks
        lo = np.searchsorted(index, gram[at] * wide + at + k)
        hi = np.searchsorted(index, gram[at] * wide + at + 2 * k)
        pairs = hi - lo
        a = np.repeat(at, pairs)
        b = index[_places(lo, hi)] % wide
        # extended inside the segment of a; an equal block lies in the same
        # segment or the extension stops at the word between
        seg = np.searchsorted(base, a, "right") - 1
        left = base[seg]
        right = base[seg] + size[seg]
        inside = b + block <= right
        # a block whose predecessor is equal at the same lag adds nothing
        name = (b - a) * wide + a
        known = np.sort(name)
        where = np.searchsorted(known, name - block)
        inside &= known[np.minimum(where, len(known) - 1)] != name - block if len(known) else True
        a, b, left, right = a[inside], b[inside], left[inside], right[inside]
        q = b - a
        s = a - spans.backward(a, b, a - left)
        e = b + spans.forward(a, b, right - b)
        keep = e - s >= np.maximum(min_length, 2 * q)
        once = np.unique(s[keep] * wide + q[keep], return_index=True)[1]
        found.append((s[keep][once], e[keep][once], q[keep][once]))
        k *= 2
    s, e, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[new], e[new], q[new]  # the smallest lag of a stretch is its period
    seg = np.searchsorted(base, s, "right") - 1
    s, length = s - base[seg] + start[seg], e - s
    order = np.lexsort((q, s))
    return s[order], length[order], q[order].astype(np.int64)


def _collapse(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay: not those after the first period of a run."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) == 0


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """docs with n_words, runs (start, length and period of each, by start,
    then period) and collapsed (the text's kept words joined by one space)."""
    if min_length < 2:
        raise ValueError("min_length is at least 2")
    kept = [f for f in docs.schema.fields if f.name not in ("n_words", "runs", "collapsed")]
    source = text_col
    if text_col in ("n_words", "runs", "collapsed"):
        raise ValueError(f"the text column cannot be named {text_col}")
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]

    def run(batches):
        for b in slices(batches, source):
            w = scan(b.column(b.schema.get_field_index(source)))
            start, length, period = runs_of(w.hash, w.first, min_length)
            of = np.searchsorted(w.first, start, "right") - 1
            ends = np.searchsorted(of, np.arange(b.num_rows + 1)).astype(np.int32)
            rows = pa.StructArray.from_arrays(
                [pa.array(start - w.first[of]), pa.array(length), pa.array(period)], names=["start", "length", "period"]
            )
            text = kept_texts(w, _collapse(len(w.hash), start, length, period))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(w.count.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), rows), text],
                names=[*b.schema.names, "n_words", "runs", "collapsed"],
            )

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, T.StructType(kept + added))


# -- the registered query --------------------------------------------------------


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with the repetitions that the query puts in: with h the
    crc32 of the decimal id and g = h div 10, in a document with h % 10 = 0
    word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) div (3 + g % 8). Other texts stay; a null id is no hit."""
    fields = [docs.schema[id_col], T.StructField(text_col, T.StringType())]

    def run(batches):
        for b in slices(batches, text_col):
            ids, texts = b.column(0), b.column(1)
            h = [1 if x is None else zlib.crc32(str(x).encode()) for x in ids.to_pylist()]
            hit = np.array([x % 10 == 0 for x in h], bool)
            if hit.any():
                w = scan(texts)
                n = w.count
                source = np.arange(len(w.hash))
                for i in np.flatnonzero(hit & (n > 0)).tolist():
                    g, size, at = h[i] // 10, int(n[i]), int(w.first[i])
                    a = g % size
                    p = 1 + (size - a) // (3 + g % 8)
                    source[at + a : at + size] = at + a + np.arange(size - a) % p
                new = Words(w.data, w.offsets, w.start[source], w.end[source], w.hash[source], w.first)
                import pyarrow.compute as pc

                texts = pc.if_else(pa.array(hit), kept_texts(new, np.ones(len(source), bool)), texts.cast(pa.string()))
            yield pa.RecordBatch.from_arrays([ids, texts], names=[id_col, text_col])

    return docs.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: the runs of every document, and what is left without them."""
    docs = repeat_tails(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    least = F.transform("runs", lambda r: F.struct((-r.length).alias("size"), r.start, r.period))
    found = find_runs(docs).withColumn("longest", F.array_min(least))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.size")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("1000 * -longest.size div longest.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
