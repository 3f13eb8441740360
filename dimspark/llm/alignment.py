"""Alignment of two tokenizers' ids, and how often each id pair is linked.

Tokenizer A is a byte-level BPE file of the tokenizers library, which gets
a space and the text; tokenizer B is a sentencepiece model, which adds that
space itself. Both cut the same bytes. Where an A and a B token end at the
same byte, they are linked, and the text is cut into groups.

Texts are cut into spans that neither tokenizer crosses
(:mod:`dimspark.llm.spans`); a worker remembers the ids, groups and links
of the spans it has met.

Counts over the corpus come from inverted pair bitmaps. A task puts its
documents into shards of at most 65,536 slots. For each linked id pair a
shard has the compressed bitmap of the slots that hold it (a sorted list of
slots, or plain bits where that is smaller), the union of what the shard's
slices of texts hold, and planes with the bits of its multiplicity less
one. Population counts of the bitmaps give documents, those of bitmap and
planes (times 1, 1, 2, 4, ...) give links; a task adds up its rows of a
pair before Spark adds up the tasks'. Pairs are dealt into hash buckets, a
row per shard and bucket. Postings then meet the scores of their bucket
(spread over salts, so that no task grows with the corpus), and each adds
its pair's score to the slots in it; the shards' sums go to their documents.

The pair table is bounded by the two vocabularies; what a pair holds in a
shard is bounded by the shard. No pair, hot or not, is gathered in one task.

Defined results: a null or empty text, and one whose A or B bytes are not
its own, has no tokens: counts of 0 and empty groups; repeated rows are
documents each; an empty table gives empty tables; further columns are not
read.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.chunks import discard, pack_keys, store, unpack_keys
from dimspark.llm.spans import SpanMemory, cut
from dimspark.llm.text import U64, mix, slices, text_bytes

BUCKETS = 64
SLOTS = 1 << 16  # documents of a shard
ENTRIES = 2 << 20  # (pair, document) entries of a shard
BLOCK = 1 << 19  # spans looked at together
SALT_BYTES = 32 << 20  # postings of one task on the way back

SCORE = "bucket int, keys binary, links binary, best binary"
POSTING = "shard long, bucket int, n_slots int, keys binary, docs binary, planes array<binary>"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- spans -----------------------------------------------------------------------


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for:
    printable ones themselves, the others from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Groups and links of spans, remembered by worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        byte_of = _byte_of()
        self.bytes_a: dict[int, bytes] = {}
        for entry, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(byte_of[c] for c in entry)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b: list[bytes] = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"{path_b}: the piece {piece} joins two words")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.memory = SpanMemory({"sizes": np.uint32, "links": np.uint64, "groups": np.uint8}, self._learn)

    def align(self, raw: bytes, a: list[int], b: list[int]) -> tuple[list[int], list[int], bytes]:
        """([n_a, n_b, 0], links, groups) of one span; links are B * 2**32 + A
        and each group begins with a semicolon. [0, 0, 1] if the bytes differ."""
        part_a, part_b = [self.bytes_a.get(i, b"") for i in a], [self.bytes_b[i] for i in b]
        if b"".join(part_a) != raw or b"".join(part_b) != raw:
            return [0, 0, 1], [], b""
        links, groups = [], []
        i = j = end_a = end_b = 0
        while i < len(a):
            i0, j0 = i, j
            end_a, i = end_a + len(part_a[i]), i + 1
            end_b, j = end_b + len(part_b[j]), j + 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a, i = end_a + len(part_a[i]), i + 1
                else:
                    end_b, j = end_b + len(part_b[j]), j + 1
            links.append(b[j - 1] << 32 | a[i - 1])
            groups.append(f";{','.join(map(str, a[i0:i]))}|{','.join(map(str, b[j0:j]))}")
        return [len(a), len(b), 0], links, "".join(groups).encode()

    def _learn(self, spans: list[bytes]) -> dict[str, list]:
        out: list[tuple] = []
        for k in range(0, len(spans), 4096):
            part = spans[k : k + 4096]
            texts = [s.decode() for s in part]
            a = self.a.encode_batch_fast(texts, add_special_tokens=False)
            b = self.b.encode([t[1:] for t in texts], num_threads=1)  # B adds the space
            out += [self.align(raw, x.ids, y) for raw, x, y in zip(part, a, b)]
        sizes, links, groups = zip(*out)
        return {"sizes": sizes, "links": links, "groups": groups}


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker process's aligner: later tasks go on with its memory."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


# -- compressed bitmaps ------------------------------------------------------------


def pack_bitmaps(key: np.ndarray, slot: np.ndarray, n_keys: int, n_slots: int) -> bytes:
    """One bitmap over n_slots for each of n_keys; (key, slot) are sorted.
    Sizes first (0xFFFFFFFF for plain bits), then listed slots, then bits."""
    size = np.bincount(key, minlength=n_keys)
    dense = size * 16 > n_slots
    plain = dense[key]
    row = np.cumsum(dense) - 1
    width = (n_slots + 7) // 8
    bits = np.zeros((int(dense.sum()), 8 * width), bool)
    bits[row[key[plain]], slot[plain]] = True
    head = np.where(dense, 0xFFFFFFFF, size).astype("<u4")
    return head.tobytes() + slot[~plain].astype("<u2").tobytes() + np.packbits(bits, axis=1, bitorder="little").tobytes()


def _parts(raw: bytes, n_keys: int, n_slots: int) -> tuple[np.ndarray, ...]:
    head = np.frombuffer(raw, "<u4", n_keys).astype(np.int64)
    dense = head == 0xFFFFFFFF
    head[dense] = 0
    listed = np.frombuffer(raw, "<u2", int(head.sum()), 4 * n_keys)
    bits = np.frombuffer(raw, np.uint8, offset=4 * n_keys + 2 * len(listed)).reshape(int(dense.sum()), (n_slots + 7) // 8)
    return dense, head, listed, bits


def popcounts(raw: bytes, n_keys: int, n_slots: int) -> np.ndarray:
    """How many slots each bitmap holds."""
    dense, size, _, bits = _parts(raw, n_keys, n_slots)
    size[dense] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    return size


def unpack_bitmaps(raw: bytes, n_keys: int, n_slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, slot) of all bits that are set."""
    dense, size, listed, bits = _parts(raw, n_keys, n_slots)
    row, slot = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))
    key = np.concatenate([np.repeat(np.arange(n_keys), size), np.flatnonzero(dense)[row]])
    return key, np.concatenate([listed.astype(np.int64), slot])


class _Shard:
    """Pairs of up to SLOTS documents, met slice by slice."""

    def __init__(self):
        self.pair, self.slot, self.times, self.entries, self.n = [], [], [], 0, 0

    def add(self, links: np.ndarray, slot: np.ndarray) -> None:
        """Links of documents; a document comes in one call, or in calls
        that follow each other."""
        pairs, back = np.unique(links, return_inverse=True)
        both, times = np.unique(back * SLOTS + slot, return_counts=True)
        self.pair.append(pairs[both // SLOTS])
        self.slot.append(both % SLOTS)
        self.times.append(times)
        self.entries += len(both)

    def rows(self, number: int) -> list[tuple]:
        """The shard's posting rows: one per bucket that has a pair."""
        if not self.entries:
            return []
        pair, slot, times = (np.concatenate(x) for x in (self.pair, self.slot, self.times))
        bucket = bucket_of(pair)
        order = np.lexsort((slot, pair, bucket))
        pair, slot, times, bucket = pair[order], slot[order], times[order], bucket[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (slot[1:] != slot[:-1])
        at = np.flatnonzero(new)
        times, pair, slot, bucket = np.add.reduceat(times, at), pair[at], slot[at], bucket[at]
        out, edge = [], np.searchsorted(bucket, np.arange(BUCKETS + 1))
        for k in np.flatnonzero(np.diff(edge)).tolist():
            s = slice(edge[k], edge[k + 1])
            keys, key = np.unique(pair[s], return_inverse=True)
            more, planes = times[s] - 1, []
            while more.any():
                odd = (more & 1).astype(bool)
                planes.append(pack_bitmaps(key[odd], slot[s][odd], len(keys), self.n))
                more >>= 1
            docs = pack_bitmaps(key, slot[s], len(keys), self.n)
            out.append((number, k, self.n, pack_keys(keys), docs, planes))
        return out


def bucket_of(pair: np.ndarray) -> np.ndarray:
    return (mix(pair.astype(np.uint64)) >> U64(32)).astype(np.int64) % BUCKETS


def _count_row(n_slots: int, keys: np.ndarray, docs: bytes, planes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    n_docs = popcounts(docs, len(keys), n_slots)
    links = n_docs.copy()
    for k, plane in enumerate(planes):
        links += popcounts(plane, len(keys), n_slots) << k
    return n_docs, links


# -- the jobs ------------------------------------------------------------------------


def _scan(paths: tuple[str, str], id_type: pa.DataType, digest: bool, entries: int):
    """Rows of documents and of postings, told apart by bucket."""

    def run(batches):
        from pyspark import TaskContext

        known, part, number, shard = aligner(*paths), TaskContext.get().partitionId(), 0, _Shard()

        def postings():
            rows = shard.rows(part << 24 | number)
            cols = list(zip(*rows)) if rows else [()] * 6
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, id_type),
                    *[pa.nulls(n, pa.int64())] * 3, pa.nulls(n, pa.string()),
                    pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary()),
                    pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.list_(pa.binary())),
                ],
                names=NAMES,
            )

        for b in slices(batches, "text"):
            i = 0
            while i < b.num_rows:  # a batch may fill a shard
                if shard.n >= SLOTS or shard.entries >= entries:
                    yield postings()
                    number, shard = number + 1, _Shard()
                part_of = b.slice(i, SLOTS - shard.n)
                yield _documents(known, part_of, shard, part << 24 | number, digest)
                i += part_of.num_rows
        yield postings()

    return run


NAMES = ["shard", "slot", "id", "n_a", "n_b", "n_links", "groups", "bucket", "n_slots", "keys", "docs", "planes"]


def _documents(known: Aligner, b: pa.RecordBatch, shard: _Shard, number: int, digest: bool) -> pa.RecordBatch:
    texts = b.column("text")
    texts = pc.fill_null(texts, "")
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    data, off = text_bytes(pc.binary_join_element_wise("", texts, " "))
    start, end, first = cut(data, off)
    n = b.num_rows
    slots = known.memory.slots(data, start, end)
    sizes = known.memory.gather("sizes", slots)[0].reshape(-1, 3).astype(np.int64)
    ends = np.zeros((len(slots) + 1, 3), np.int64)
    np.cumsum(sizes, axis=0, out=ends[1:])
    per = ends[first[1:]] - ends[first[:-1]]
    good = (per[:, 2] == 0) & ~empty
    doc = np.repeat(np.arange(n), np.diff(first))
    slots, doc = slots[good[doc]], doc[good[doc]]
    n_links = np.zeros(n, np.int64)
    text: list = [None] * n
    for i in range(0, len(slots), BLOCK):
        s, d = slots[i : i + BLOCK], doc[i : i + BLOCK]
        links, _ = known.memory.gather("links", s)
        of = np.repeat(d, known.memory.size("links", s))
        n_links += np.bincount(of, minlength=n)
        shard.add(links, of + shard.n)
        groups, at = known.memory.gather("groups", s)
        edges = np.append(np.flatnonzero(np.diff(d, prepend=-1)), len(d))
        view = memoryview(groups)
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
            k, lo, hi = int(d[x]), int(at[x]), int(at[y])
            if text[k] is None:
                text[k], lo = hashlib.sha256() if digest else [], lo + 1
            text[k].update(view[lo:hi]) if digest else text[k].append(bytes(view[lo:hi]))
    said = ["" if x is None else x.hexdigest() if digest else b"".join(x).decode() for x in text]
    out = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, number, np.int64)), pa.array(np.arange(shard.n, shard.n + n, dtype=np.int32)), b.column("id"),
            *[pa.array(np.where(good, x, 0)) for x in (per[:, 0], per[:, 1], n_links)], pa.array(said, pa.string()),
            pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
            pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.binary())),
        ],
        names=NAMES,
    )
    shard.n += n
    return out


def _count(batches):
    """(a, b, n_docs, n_links) of a task's postings, added up by pair."""
    held: list[tuple] = []
    size = 0

    def total():
        keys, docs, links = (np.concatenate(x) for x in zip(*held))
        keys, back = np.unique(keys, return_inverse=True)
        sums = np.zeros((2, len(keys)), np.int64)
        np.add.at(sums[0], back, docs)
        np.add.at(sums[1], back, links)
        return keys, sums[0], sums[1]

    for b in batches:
        for r in b.to_pylist():
            keys = unpack_keys(r["keys"])
            held.append((keys, *_count_row(r["n_slots"], keys, r["docs"], r["planes"])))
            size += len(keys)
            if size > 4 << 20:
                held = [total()]
                size = 0
    if held:
        keys, docs, links = total()
        for i in range(0, len(keys), 1 << 16):
            k = keys[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((k & U64(0xFFFFFFFF)).astype(np.int64)), pa.array((k >> U64(32)).astype(np.int64)),
                    pa.array(docs[i : i + (1 << 16)]), pa.array(links[i : i + (1 << 16)]),
                    pa.array(bucket_of(k).astype(np.int32)),
                ],
                names=["a", "b", "n_docs", "n_links", "bucket"],
            )


def _pack_scores(table: pa.Table) -> pa.Table:
    key = table["b"].to_numpy().astype(np.uint64) << U64(32) | table["a"].to_numpy().astype(np.uint64)
    order = np.argsort(key)
    links, best = table["n_links"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False)[order]
    return pa.table(
        {
            "bucket": pa.array(table["bucket"][:1].to_numpy(), pa.int32()),
            "keys": pa.array([pack_keys(key[order])], pa.binary()),
            "links": pa.array([links.astype("<i8").tobytes()], pa.binary()),
            "best": pa.array([np.packbits(best).tobytes()], pa.binary()),
        }
    )


SUMS = "shard long, slots binary, n_best binary, count_sum binary"


def _send_back(postings: pa.Table, scores: pa.Table) -> pa.Table:
    """Per posting row: the slots it holds, with the sums of their links'
    counts and of their links that are a B id's best."""
    out: list[tuple] = []
    if scores.num_rows:
        score = scores.slice(0, 1).to_pylist()[0]
        known = unpack_keys(score["keys"])
        count = np.frombuffer(score["links"], "<i8")
        best = np.unpackbits(np.frombuffer(score["best"], np.uint8), count=len(known)).astype(np.int64)
    for b in postings.to_batches():
        for i in range(b.num_rows):
            r = b.slice(i, 1).to_pylist()[0]
            keys, n = unpack_keys(r["keys"]), r["n_slots"]
            at = np.searchsorted(known, keys)
            sums = np.zeros((2, n), np.int64)
            for weight, raw in [(1, r["docs"]), *((1 << k, p) for k, p in enumerate(r["planes"]))]:
                key, slot = unpack_bitmaps(raw, len(keys), n)
                np.add.at(sums[0], slot, weight * best[at[key]])
                np.add.at(sums[1], slot, weight * count[at[key]])
            held = np.flatnonzero(sums[1])
            out.append((r["shard"], held.astype("<u2").tobytes(), *(x[held].astype("<i8").tobytes() for x in sums)))
    cols = list(zip(*out)) if out else [()] * 4
    return pa.table(
        {
            "shard": pa.array(cols[0], pa.int64()), "slots": pa.array(cols[1], pa.binary()),
            "n_best": pa.array(cols[2], pa.binary()), "count_sum": pa.array(cols[3], pa.binary()),
        }
    )


def _add_sums(docs: pa.Table, sums: pa.Table) -> pa.Table:
    """A shard's documents with the sums of all buckets."""
    total = np.zeros((2, SLOTS), np.int64)
    for r in sums.to_pylist():
        held = np.frombuffer(r["slots"], "<u2")
        for k, name in enumerate(("n_best", "count_sum")):
            total[k, held] += np.frombuffer(r[name], "<i8")
    slot = docs["slot"].to_numpy()
    names = ["id", "n_a", "n_b", "n_links", "groups"]
    return pa.table([*[docs[c] for c in names], pa.array(total[0, slot]), pa.array(total[1, slot])], names=[*names, "n_best", "count_sum"])


@dataclass
class Alignment:
    """documents: id, n_a, n_b, n_groups, n_links, n_best (links whose count
    is the highest of their B id), count_sum (their counts added up) and
    groups, as ``a1,a2|b1;a3|b2`` (or groups_sha256). pairs: a, b, n_docs,
    n_links, best. Both are stored; discard() what is not needed."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
    digest: bool = False,
    shard_entries: int = ENTRIES,
) -> Alignment:
    """Align all documents, and count the linked pairs over all of them."""
    spark = docs.sparkSession
    paths = (path_a or default_paths()[0], path_b or default_paths()[1])
    kind = docs.schema[id_col].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    schema = (
        f"shard long, slot int, id {kind}, n_a long, n_b long, n_links long, groups string, "
        "bucket int, n_slots int, keys binary, docs binary, planes array<binary>"
    )
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    stored = store(spark, source.mapInArrow(_scan(paths, id_type, digest, shard_entries), schema), "alignment")
    postings = stored.where("bucket IS NOT NULL").select("shard", "bucket", "n_slots", "keys", "docs", "planes")

    counted = postings.mapInArrow(_count, "a long, b long, n_docs long, n_links long, bucket int")
    counted = counted.groupBy("a", "b", "bucket").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    counted = store(spark, counted, "alignment-counts")
    highest = counted.groupBy("b").agg(F.max("n_links").alias("most"))
    pairs = counted.join(highest, "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"), "bucket")
    pairs = store(spark, pairs, "alignment-pairs")

    held = postings.agg(F.sum(F.length("keys") + F.length("docs"))).first()[0] or 0
    salts = max(1, int(held) // (BUCKETS * SALT_BYTES))
    scores = pairs.groupBy("bucket").applyInArrow(_pack_scores, SCORE)
    scores = scores.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = postings.withColumn("salt", F.pmod(F.xxhash64("shard"), F.lit(salts)).cast("int"))
    back = salted.groupBy("bucket", "salt").cogroup(scores.groupBy("bucket", "salt")).applyInArrow(_send_back, SUMS)
    found = stored.where("bucket IS NULL").select("shard", "slot", "id", "n_a", "n_b", "n_links", "groups")
    summed = found.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(
        _add_sums, f"id {kind}, n_a long, n_b long, n_links long, groups string, n_best long, count_sum long"
    )
    out = summed.select(
        F.col("id").alias(id_col), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256" if digest else "groups"),
    )
    out = store(spark, out, "aligned")
    discard(stored, counted)
    return Alignment(out, pairs)


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every document's groups, links and their counts over the corpus."""
    found = align(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
    discard(found.pairs)
    return found.documents
