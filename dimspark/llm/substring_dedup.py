"""Substring deduplication by recompression.

Recompression rewrites a word sequence in rounds. A round first names
every maximal run of one symbol, then splits all symbols into a left and a
right class by a hash and names every left symbol followed by a right one
as a pair. A name is a 64-bit hash of its parts, so a run or pair has ONE
name in the whole corpus without a dictionary: equal substrings get equal
interior symbols in whichever document, task or retry they are read.

For a window of ``window`` words the symbols that lie wholly inside and do
not depend on what is outside form its core. Symbols that might merge with
the outside are popped from the two ends before each step. The popped
symbols plus the last core are the window's fingerprint: it has a few
entries, and two windows have equal fingerprints if and only if they have
equal words. A fingerprint is kept as 128 bits, half of them a polynomial
over the window's words with another base, so that of 2 * 10**12 windows
(some 100 TB of text) no two unlike ones are to be expected equal.

1. *Reveal.* Each window elects one symbol of its deepest core, the one
   with the least hash; neighbouring windows mostly elect the same one.
   The elected symbols, a fraction of the words, are counted over the
   corpus. A window whose symbol occurs once is unique and is done.
2. *Verify.* Fingerprints of the remaining windows are compared over the
   corpus; the first start (least id, then position) of each is kept.
3. Words covered by a window that is not a first start are removed.

Both exchanges go through :mod:`dimspark.llm.chunks`: one packed row per
chunk and hash bucket, answered by one bit per key.

Defined results: a null or empty text has no words and stays as it is; a
text of fewer than ``window`` words is never cut; repeated rows with one
id count as different occurrences, in an order fixed by the stored chunks;
an empty table gives an empty table; further columns are kept as they are,
but for those named as the two counts, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.llm import chunks as C
from dimspark.llm.text import U64, Words, mix, pair_hash, scan, span_hashes

ROUNDS = 3


def _elect(seq: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and hash of the least-hash symbol of seq[lo:hi] (never empty)."""
    rank = mix(seq ^ U64(0xA5A5A5A5A5A5A5A5))
    at, best = lo.copy(), rank[lo]
    for k in range(1, int((hi - lo).max(initial=0))):
        j = np.minimum(lo + k, hi - 1)
        r = rank[j]
        less = r < best
        at[less], best[less] = j[less], r[less]
    return at, best


def recompress(words: np.ndarray, start: np.ndarray, length: int, prints: bool) -> tuple[np.ndarray, ...]:
    """For the windows words[start:start + length]: the word position and
    hash of the elected symbol, and the fingerprint (if asked for)."""
    seq, place = words, np.arange(len(words))
    n_win = len(start)
    at, key = np.zeros(n_win, np.int64), np.zeros(n_win, np.uint64)
    done = np.zeros(n_win, np.uint64)  # fingerprints
    live, lo, hi = np.arange(n_win), start.astype(np.int64), start.astype(np.int64) + length
    left = right = np.zeros(n_win, np.uint64)
    for level in range(ROUNDS + 1):
        if not len(live):
            break
        if level == ROUNDS:
            i, key[live] = _elect(seq, lo, hi)
            at[live] = place[i]
            if prints:
                done[live] = pair_hash(pair_hash(left, right), span_hashes(seq, lo, hi))
            break
        old_seq, old_place, old_lo, old_hi = seq, place, lo, hi

        # Runs. The runs at both ends may go on outside: popped.
        head = np.ones(len(seq), bool)
        head[1:] = seq[1:] != seq[:-1]
        heads, run = np.flatnonzero(head), np.cumsum(head) - 1
        size = np.diff(np.append(heads, len(seq)))
        first, last = run[lo], run[hi - 1]
        stop = heads[first] + size[first]
        more = stop < hi
        if prints:
            left = pair_hash(left, seq[lo] + (np.minimum(stop, hi) - lo).astype(np.uint64) * U64(0x9E37))
            popped = pair_hash(right, seq[hi - 1] + (hi - heads[last]).astype(np.uint64) * U64(0x79B9))
            right = np.where(more, popped, right)
        lo, hi = first + 1, np.where(more, last, first + 1)
        seq, place = np.where(size > 1, pair_hash(seq[heads], size.astype(np.uint64)), seq[heads]), place[heads]

        # Pairs. A right symbol at the left end or a left symbol at the
        # right end may merge with the outside: popped.
        is_left = (mix(seq + U64(level + 1)) & U64(1)).astype(bool)
        full = lo < hi
        cut = full & ~is_left[np.minimum(lo, len(seq) - 1)]
        if prints:
            left = np.where(cut, pair_hash(left, seq[np.minimum(lo, len(seq) - 1)]), left)
        lo = lo + cut
        cut = (lo < hi) & is_left[hi - 1]
        if prints:
            right = np.where(cut, pair_hash(right, seq[hi - 1]), right)
        hi = hi - cut
        pair = np.zeros(len(seq), bool)
        pair[:-1] = is_left[:-1] & ~is_left[1:]
        new = np.ones(len(seq), bool)
        new[1:] = ~pair[:-1]
        index = np.cumsum(new) - 1
        named = np.where(pair, pair_hash(seq, np.append(seq[1:], U64(0))), seq)
        seq, place = named[new], place[new]

        # Windows whose core is used up elect from the core before.
        full = lo < hi
        if not full.all():
            gone = ~full
            i, k = _elect(old_seq, old_lo[gone], old_hi[gone])
            at[live[gone]], key[live[gone]] = old_place[i], k
            if prints:
                done[live[gone]] = pair_hash(left[gone], right[gone])
            live, lo, hi, left, right = live[full], lo[full], hi[full], left[full], right[full]
        lo, hi = index[lo], index[hi - 1] + 1
    return at, key, done


def _second(seq: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """The other half of the windows' fingerprints."""
    return span_hashes(mix(seq ^ U64(0x3C6EF372FE94F82A)), start, start + length)


def _windows(w: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word sequence with a separator after each text, the window starts in
    it, and the text of each window."""
    n = w.count
    seq = np.empty(len(w.hash) + len(n), np.uint64)
    doc = w.doc
    seq[np.arange(len(w.hash)) + doc] = w.hash
    seq[w.first[1:] + np.arange(len(n))] = mix(np.arange(len(n), dtype=np.uint64) + U64(0x5E9A5E9A))
    per = np.maximum(n - length + 1, 0)
    of = np.repeat(np.arange(len(n)), per)
    start = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + w.first[of] + of
    return seq, start, of


class _Chunk:
    """One chunk's windows, in the order of (id, position)."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, length: int, prints: bool):
        self.table = table.sort_by(id_col)
        self.ids = self.table[id_col].to_numpy()
        self.words = scan(self.table[text_col])
        self.seq, self.start, self.of = _windows(self.words, length)
        at, self.key, self.prints = recompress(self.seq, self.start, length, prints)
        self.second = _second(self.seq, self.start, length) if prints else None
        # runs of windows that elect the same occurrence count once
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (self.key[1:] != self.key[:-1])
        self.symbols, back, self.times = np.unique(self.key[new], return_inverse=True, return_counts=True)
        self.symbol_of = back[np.cumsum(new) - 1] if len(at) else np.zeros(0, np.int64)

    def asked(self, shared: np.ndarray) -> np.ndarray:
        """Windows whose symbol occurs elsewhere too."""
        return np.flatnonzero(shared[self.symbol_of]) if len(shared) else np.zeros(0, np.int64)

    def distinct(self, asked: np.ndarray) -> np.ndarray:
        """The first of the asked windows of each fingerprint, sorted by it."""
        order = np.lexsort((self.second[asked], self.prints[asked]))  # stable: the first start comes first
        one, two = self.prints[asked][order], self.second[asked][order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return order[new]


def _bits(parts: list[bytes]) -> np.ndarray:
    """Answers: a count (4 bytes), then that many bits, per bucket."""
    out = [np.unpackbits(np.frombuffer(p, np.uint8, offset=4), count=int.from_bytes(p[:4], "little")) for p in parts]
    return np.concatenate(out).astype(bool) if out else np.zeros(0, bool)


def _answer(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(4, "little") + np.packbits(flags).tobytes()


def _shared(key, table):
    """Which symbols occur in two chunks, or twice in one."""
    rows = table.select(["bucket", "chunk", "keys", "extra"]).to_pylist()
    keys = [C.unpack_keys(r["keys"]) for r in rows]
    many = [np.frombuffer(r["extra"], np.uint8) for r in rows]
    _, back, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    twice = np.zeros(len(count), bool)
    twice[back[np.concatenate(many) > 0]] = True
    flag = ((count > 1) | twice)[back]
    ends = np.cumsum([len(k) for k in keys])
    out = [(r["chunk"], r["bucket"], 0, _answer(f)) for r, f in zip(rows, np.split(flag, ends[:-1]))]
    return C.table_of(out, C.ANSWER)


def _first(key, table):
    """Which chunk holds the first start of each fingerprint."""
    rows = sorted(table.select(["bucket", "chunk", "keys", "extra"]).to_pylist(), key=lambda r: r["chunk"])
    keys = [C.unpack_keys(r["keys"]) for r in rows]
    extra = [np.ascontiguousarray(np.frombuffer(r["extra"], np.uint8).reshape(16, -1).T) for r in rows]
    all_keys = np.concatenate(keys)
    all_ids = np.concatenate([np.ascontiguousarray(x[:, :8]).view(np.int64).ravel() for x in extra])
    second = np.concatenate([np.ascontiguousarray(x[:, 8:]).view(np.uint64).ravel() for x in extra])
    order = np.lexsort((all_ids, second, all_keys))  # stable: ties fall to the earlier chunk
    head = np.ones(len(order), bool)
    head[1:] = (all_keys[order][1:] != all_keys[order][:-1]) | (second[order][1:] != second[order][:-1])
    flag = np.zeros(len(order), bool)
    flag[order[head]] = True
    ends = np.cumsum([len(k) for k in keys])
    out = [(r["chunk"], r["bucket"], 1, _answer(f)) for r, f in zip(rows, np.split(flag, ends[:-1]))]
    return C.table_of(out, C.ANSWER)


def kept_texts(w: Words, keep: np.ndarray) -> pa.Array:
    """Per text its kept words joined by one space."""
    start, size, doc = w.start[keep], (w.end - w.start)[keep], w.doc[keep]
    step = size + 1
    to = np.cumsum(step) - step
    source = np.arange(step.sum()) + np.repeat(start - to, step)
    out = w.data[np.minimum(source, max(len(w.data) - 1, 0))] if len(source) else np.zeros(0, np.uint8)
    out[to + size] = 32
    per = np.bincount(doc, weights=step, minlength=len(w.count)).astype(np.int64)
    ends = np.cumsum(per)
    raw = out.tobytes()
    return pa.array([raw[e - p : max(e - 1, e - p)].decode() for p, e in zip(per.tolist(), ends.tolist())], pa.string())


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    join_all: bool = False,
    words_col: str = "n_words",
    removed_col: str = "n_removed",
) -> tuple[DataFrame, C.Chunks]:
    """docs with repeated word windows cut from ``text_col``, plus the number
    of its words and of those removed (as the last two columns, named
    ``words_col`` and ``removed_col``; columns of these names are replaced).

    A text that loses words becomes its kept words joined by one space;
    with ``join_all`` every text does. The second value is the stored chunk
    table that the returned DataFrame still reads; drop it when done.
    """
    spark = docs.sparkSession
    docs = docs.drop(words_col, removed_col)
    stored = C.write_chunks(spark, docs, text_col)
    n, columns = stored.hash_buckets(), docs.columns

    def ask_symbols(key, table):
        c = _Chunk(table, id_col, text_col, window, prints=False)
        extra = (c.times > 1).astype(np.uint8)
        return C.table_of(list(C.ask_rows(key[0].as_py(), 0, c.symbols, extra, n)), C.ASK)

    def ask_prints(key, table, said):
        c = _Chunk(table, id_col, text_col, window, prints=True)
        asked = c.asked(_bits(C.answers(said, 0)))
        first = asked[c.distinct(asked)]
        keys, second = c.prints[first], c.second[first]
        ids = c.ids[c.of[first]].astype(np.int64)
        cut = C.bucket_cuts(keys, n)
        rows = []
        for b in np.flatnonzero(np.diff(cut)):
            part = slice(cut[b], cut[b + 1])
            planes = [x[part].view(np.uint8).reshape(-1, 8).T.tobytes() for x in (ids, second)]
            rows.append((int(b), key[0].as_py(), 1, C.pack_keys(keys[part]), b"".join(planes)))
        return C.table_of(rows, C.ASK)

    def cut_words(key, table, said):
        c = _Chunk(table, id_col, text_col, window, prints=True)
        asked = c.asked(_bits(C.answers(said, 0)))
        first = c.distinct(asked)
        mine = _bits(C.answers(said, 1))
        repeat = np.ones(len(asked), bool)
        if len(asked):
            repeat[first[mine]] = False
        hit = asked[repeat]
        change = np.zeros(len(c.words.hash) + 1, np.int64)
        begin = c.start[hit] - c.of[hit]  # back to word numbers without separators
        np.add.at(change, begin, 1)
        np.add.at(change, begin + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        removed = np.bincount(c.words.doc[gone], minlength=len(c.ids))
        text = kept_texts(c.words, ~gone)
        old = c.table[text_col].combine_chunks()
        if not join_all:
            import pyarrow.compute as pc

            text = pc.if_else(pa.array(removed > 0), text, old.cast(pa.string()))
        out = {k: (text if k == text_col else c.table[k]) for k in columns}
        out[words_col] = pa.array(c.words.count.astype(np.int64))
        out[removed_col] = pa.array(removed.astype(np.int64))
        return pa.table(list(out.values()), names=list(out))

    by_chunk = stored.df.groupBy(C.CHUNK)
    symbols = by_chunk.applyInArrow(ask_symbols, C.ASK)
    shared = C.store(spark, symbols.groupBy("bucket").applyInArrow(_shared, C.ANSWER), "recompress-shared")
    prints = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(ask_prints, C.ASK)
    firsts = C.store(spark, prints.groupBy("bucket").applyInArrow(_first, C.ANSWER), "recompress-firsts")
    schema = T.StructType(
        docs.schema.fields
        + [T.StructField(words_col, T.LongType()), T.StructField(removed_col, T.LongType())]
    )
    both = shared.unionByName(firsts)
    return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(cut_words, schema), stored


def query(spark, sf_dir: str) -> DataFrame:
    """op1: digests of the kept words of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut, stored = remove_repeats(docs, join_all=True)
    out = C.store(
        spark,
        cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")),
        "op1",
    )
    stored.drop()
    return out
