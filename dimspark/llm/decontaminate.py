"""Benchmark decontamination with suffix arrays over the training shards.

A task cuts its documents into shards of a few MB and builds a suffix
array of each: the starts of its words, sorted by the words that follow.
Only suffixes that begin with words of the benchmark are entered (a sparse
suffix array; no other suffix can begin a match), and they are ordered by
their first ``window`` words, as deep as a test suffix is searched. Every
test suffix of at least a window is then found by binary search, all of
them side by side; the entries between its bounds are the places where the
window occurs. Neighbouring places on one diagonal join to the longest
verbatim matches with their locations.

Equal windows of several items are searched once, and found places are
spelled out to items a few texts at a time: a passage that thousands of
items share costs no more memory than its matches in one text.

The benchmark is read in blocks of at most ``block_words`` words; a block
is what is broadcast, one at a time, so its size does not depend on the
benchmark's. Each further block is one more pass over the documents.

Defined results: null or empty documents have no words and no hits; items
without words have no windows; an item shorter than a window is one
window; items that share an id count as one; rows that repeat are each
judged and returned; an empty table on either side gives no hits; further
columns are not read by :func:`matches` and are kept by :func:`remove`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.chunks import discard, store
from dimspark.llm.text import ALNUM_LOWER, U64, scan, slices

BITS, PER_KEY = 21, 3  # word ranks packed into a sort key
AT_ONCE = 1 << 20  # places of items spelled out together, one text's at least


@dataclass
class Block:
    """A part of the benchmark: its vocabulary and its windows."""

    items: list[str]
    vocabulary: np.ndarray  # sorted word hashes; rank i + 1
    maybe: np.ndarray  # by the low 16 bits of a hash: may be in the vocabulary
    item: np.ndarray  # where window w stands: in item[owner[w]:owner[w + 1]],
    at: np.ndarray  # at these positions
    owner: np.ndarray
    length: np.ndarray  # of each window
    low: np.ndarray  # its packed words, least and greatest continuation
    high: np.ndarray
    window: int


def _packed(rank: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """Sort keys of the suffixes at start: window ranks, three to a key."""
    n_keys = -(-window // PER_KEY)
    padded = np.concatenate([rank, np.zeros(n_keys * PER_KEY, np.uint64)])
    keys = np.zeros((n_keys, len(start)), np.uint64)
    for k in range(n_keys * PER_KEY):
        word = padded[start + k] if k < window else np.zeros(len(start), np.uint64)
        keys[k // PER_KEY] = (keys[k // PER_KEY] << U64(BITS)) | word
    return keys


def make_block(ids: list[str], texts: list[str | None], window: int) -> Block:
    w = scan(pa.array(texts, pa.string()), ALNUM_LOWER)
    vocabulary = np.unique(w.hash)
    if len(vocabulary) >= (1 << BITS) - 1:
        raise ValueError("a benchmark block has more different words than a sort key holds")
    maybe = np.zeros(1 << 16, bool)
    maybe[(vocabulary & U64(0xFFFF)).astype(np.int64)] = True
    n = w.count
    per = np.where(n >= window, n - window + 1, np.minimum(n, 1))
    item = np.repeat(np.arange(len(n)), per)
    at = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    length = np.minimum(n[item], window)
    # ranks with a gap after each item, so that a short item's window ends with it
    rank = np.zeros(len(w.hash) + window * len(n), np.uint64)
    rank[np.arange(len(w.hash)) + window * w.doc] = np.searchsorted(vocabulary, w.hash).astype(np.uint64) + U64(1)
    start = w.first[item] + window * item + at
    low = _packed(rank, start, window)
    high = low.copy()
    for k in range(-(-window // PER_KEY) * PER_KEY):
        fill = U64(((1 << BITS) - 1) << (BITS * (PER_KEY - 1 - k % PER_KEY)))
        high[k // PER_KEY] |= np.where(length <= k, fill, U64(0))
    # equal windows are one (a short item's own length tells it apart)
    order = np.lexsort((item, length, *low[::-1]))
    head = np.ones(len(order), bool)
    same = (length[order][1:] == length[order][:-1]) & (low[:, order[1:]] == low[:, order[:-1]]).all(axis=0)
    head[1:] = ~same
    one = order[head]
    owner = np.append(np.flatnonzero(head), len(order))
    return Block(ids, vocabulary, maybe, item[order], at[order], owner, length[one], low[:, one], high[:, one], window)


def _search(keys: np.ndarray, sought: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of many packed words in the sorted suffixes, at once."""
    lo = np.zeros(sought.shape[1], np.int64)
    hi = np.full(sought.shape[1], keys.shape[1], np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        at = np.minimum(mid, keys.shape[1] - 1)
        less = np.full(len(lo), right)
        for k in range(len(keys) - 1, -1, -1):
            x = keys[k][at]
            less = np.where(x == sought[k], less, x < sought[k])
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    return lo


def find(texts, block: Block) -> tuple[np.ndarray, ...]:
    """Of a column of texts: words per text, hit words per text, and the
    occurrences of windows as (text, word, window number)."""
    w = scan(texts, ALNUM_LOWER)
    n, doc, first, window = w.count, w.doc, w.first, block.window
    none = np.zeros(0, np.int64)
    if not len(w.hash) or not len(block.item):
        return n, np.zeros(len(n), np.int64), none, none, none
    known = np.flatnonzero(block.maybe[(w.hash & U64(0xFFFF)).astype(np.int64)])
    slot = np.searchsorted(block.vocabulary, w.hash[known])
    slot = np.minimum(slot, len(block.vocabulary) - 1)
    same = block.vocabulary[slot] == w.hash[known]
    gap = window * doc  # as between items: a suffix ends with its text
    rank = np.zeros(len(w.hash) + window * len(n), np.uint64)
    rank[known[same] + gap[known[same]]] = slot[same].astype(np.uint64) + U64(1)

    # the sparse suffix array
    depth = int(min(block.length.min(), 4))
    enter = rank > 0
    for k in range(1, depth):
        enter[: len(rank) - k] &= rank[k:] > 0
        enter[len(rank) - k :] = False
    suffix = np.flatnonzero(enter)
    if not len(suffix):
        return n, np.zeros(len(n), np.int64), none, none, none
    keys = _packed(rank, suffix, window)
    order = np.lexsort(keys[::-1])
    suffix, keys = suffix[order], keys[:, order]
    lo, hi = _search(keys, block.low, right=False), _search(keys, block.high, right=True)
    count = np.maximum(hi - lo, 0)
    number = np.repeat(np.arange(len(count)), count)
    place = suffix[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[number]]
    text = np.searchsorted(first[:-1] + window * np.arange(len(n)), place, "right") - 1
    # empty texts share their successor's start: take the text that has words
    word = place - window * text
    cover = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + block.length[number], -1)
    hit = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=len(n))
    return n, hit, text, word - first[text], number


def longest(text: np.ndarray, word: np.ndarray, number: np.ndarray, block: Block) -> tuple[np.ndarray, ...]:
    """Window occurrences joined along diagonals to (text, item, position in
    the item, position in the text, length), a few texts at a time."""
    order = np.argsort(text, kind="stable")
    text, word, number = text[order], word[order], number[order]
    share = block.owner[number + 1] - block.owner[number]  # items that hold the window
    total, out, i = np.cumsum(share), [], 0
    while i < len(text):
        j = max(int(np.searchsorted(total, (total[i - 1] if i else 0) + AT_ONCE, "right")), i + 1)
        j = int(np.searchsorted(text, text[j - 1], "right")) if text[j - 1] == text[i] else int(np.searchsorted(text, text[j - 1]))
        n = share[i:j]
        entry = np.arange(n.sum()) + np.repeat(block.owner[number[i:j]] - (np.cumsum(n) - n), n)
        size = np.repeat(block.length[number[i:j]], n)
        out.append(_diagonals(np.repeat(text[i:j], n), np.repeat(word[i:j], n), block.item[entry], block.at[entry], size))
        i = j
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def _diagonals(text, word, item, at, size) -> tuple[np.ndarray, ...]:
    order = np.lexsort((word, word - at, item, text))
    text, word, item, at, size = text[order], word[order], item[order], at[order], size[order]
    head = np.ones(len(text), bool)
    head[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(word - at) != 0) | (np.diff(word) != 1)
    heads = np.flatnonzero(head)
    run = np.diff(np.append(heads, len(text)))
    return text[heads], item[heads], at[heads], word[heads], size[heads] + run - 1


MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
FOUND = "n_words long, n_hit long, matches array<struct<item_id:string,item_start:long,start:long,length:long>>"


def _pass(block, id_col: str, text_col: str, only_hits: bool):
    def run(batches):
        b = block.value
        for rows in slices(batches, text_col, 2 << 20):
            n, hit, text, word, number = find(rows.column(text_col), b)
            text, item, at, start, length = longest(text, word, number, b)
            order = np.argsort(text, kind="stable")
            flat = pa.StructArray.from_arrays(
                [
                    pa.array([b.items[i] for i in item[order].tolist()], pa.string()),
                    pa.array(at[order]), pa.array(start[order]), pa.array(length[order]),
                ],
                fields=list(MATCH),
            )
            ends = np.searchsorted(text[order], np.arange(rows.num_rows + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), flat)
            ids = rows.column(id_col)
            out = pa.table(
                [ids, rows.column("hash"), pa.array(n.astype(np.int64)), pa.array(hit.astype(np.int64)), found],
                names=[id_col, "hash", "n_words", "n_hit", "matches"],
            )
            if only_hits:
                out = out.filter(pa.array(hit > 0))
            yield from out.to_batches()

    return run


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[Block]:
    ids, texts, words = [], [], 0
    for row in items.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        n = int(scan(pa.array([row[1]], pa.string()), ALNUM_LOWER).count[0])
        if ids and words + n > block_words:
            yield make_block(ids, texts, window)
            ids, texts, words = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        words += n
    yield make_block(ids, texts, window)


def _merge(id_col: str):
    """Rows of one text from several passes: one result, as often as the
    first pass returned the text."""

    def merge(key, table):
        rows = table.to_pylist()
        copies = max(1, sum(r["pass"] == 0 for r in rows))
        found = {(m["item_id"], m["item_start"], m["start"], m["length"]) for r in rows for m in r["matches"]}
        hit: set[int] = set()
        for _, _, start, length in found:
            hit.update(range(start, start + length))
        names = [f.name for f in MATCH]
        one = [dict(zip(names, m)) for m in sorted(found, key=lambda m: (m[2], str(m[0]), m[1]))]
        return pa.table(
            [
                pa.array([rows[0][id_col]] * copies, table[id_col].type),
                pa.array([rows[0]["n_words"]] * copies, pa.int64()),
                pa.array([len(hit)] * copies, pa.int64()),
                pa.array([one] * copies, pa.list_(MATCH)),
            ],
            names=[id_col, "n_words", "n_hit", "matches"],
        )

    return merge


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = 1 << 20,
) -> DataFrame:
    """One row per document: id, n_words, n_hit (words inside an occurring
    window) and matches (the longest verbatim matches and where they are;
    item ids as strings)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(id_col, text_col, F.xxhash64(text_col).alias("hash"))
    schema = f"`{id_col}` {kind}, hash long, {FOUND}"
    blocks = _blocks(items, item_id_col, item_text_col, window, block_words)
    block, done, n = next(blocks), [], 0
    while True:
        more = next(blocks, None)
        shared = spark.sparkContext.broadcast(block)
        part = read.mapInArrow(_pass(shared, id_col, text_col, only_hits=n > 0), schema)
        if not n and more is None:
            return part.drop("hash")
        done.append(store(spark, part, "matches").withColumn("pass", F.lit(n)))
        shared.destroy()
        if more is None:
            break
        block, n = more, n + 1
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    return every.groupBy(id_col, "hash").applyInArrow(_merge(id_col), f"`{id_col}` {kind}, {FOUND}")


def _clean(shared, text_col: str):
    def run(batches):
        for rows in slices(batches, text_col, 2 << 20):
            _, hit, *_ = find(rows.column(text_col), shared.value)
            yield rows.filter(pa.array(hit == 0))

    return run


def remove(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = 1 << 20,
) -> DataFrame:
    """docs without those that hold a window of an item. One block is a
    filter in the plan; of several, each but the last is a pass of its own,
    so that one block at a time is held by the executors."""
    spark = docs.sparkSession
    blocks = _blocks(items, item_id_col, item_text_col, window, block_words)
    block, before = next(blocks), None
    while (more := next(blocks, None)) is not None:
        shared = spark.sparkContext.broadcast(block)
        docs = store(spark, docs.mapInArrow(_clean(shared, text_col), docs.schema), "decontaminated")
        shared.destroy()
        if before is not None:
            discard(before)
        block, before = more, docs
    return docs.mapInArrow(_clean(spark.sparkContext.broadcast(block), text_col), docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: hit words and items of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = matches(docs, items)
    ids = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
