"""Token ids in Huffman-coded block files.

A store is a folder with three tables: ``codebook`` (id, length), from which
the canonical code follows, ``blocks``, one row per block: its place
(part and ids before it there), its documents' ids and id counts, and the coded ids
(:mod:`dimspark.llm.huffman`), and ``parts``, the ids before each part. Parts are ranges of document ids and blocks
follow each other inside a part, so the ids stand in ascending order of
the document id. Any block can be decoded by itself.

Writing tokenizes once: documents are range-partitioned by id, their ids
are kept as plain bytes until the counts of the whole corpus are known,
then coded. The counts are one number per token id.

Defined results: a null or empty text has the end id alone; rows that
share a document id follow each other, each with its own entry; an empty
table gives an empty store; further columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimspark.llm import huffman
from dimspark.llm.chunks import width
from dimspark.llm.text import slices
from dimspark.llm.tokens import default_path, encoder
from dimspark.session import scratch_dir
from dimspark.sinks.folders import delete

BLOCK_IDS = 1 << 18


def _dtype(vocabulary: int):
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def _tokenize(path: str, end: int, kind):
    def run(batches):
        from pyspark import TaskContext

        words, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for b in slices(batches, "text", 2 << 20):
            ids, offsets = words.encode(b.column("text"), end)
            at = pa.array(offsets * kind.itemsize, pa.int64())
            raw = pa.py_buffer(ids.astype(kind).tobytes())
            joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [None, at.buffers()[1], raw])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(b.num_rows, part, np.int32)),
                    pa.array(before + offsets[:-1]),
                    b.column("doc_id"),
                    joined.cast(pa.binary()),
                ],
                names=["part", "at", "doc_id", "ids"],
            )
            before += int(offsets[-1])

    return run


def _plain(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of a column of id bytes."""
    arr = column.cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(arr.buffers()[2], np.uint8)[off[0] : off[-1]]
    return raw.view(kind), (off - off[0]) // kind.itemsize


def _count(kind, vocabulary: int):
    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for b in slices(batches, "ids", 8 << 20):
            total += np.bincount(_plain(b.column("ids"), kind)[0], minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    return run


def _code(shared, kind):
    def run(batches):
        code = huffman.canonical(shared.value)
        held, n, part, first = [], 0, None, 0

        def block():
            ids = np.concatenate([x for x, _, _ in held])
            sizes = np.concatenate([x for _, x, _ in held])
            docs = pa.concat_arrays([x for _, _, x in held])
            one = pa.array([0, len(docs)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                    pa.ListArray.from_arrays(one, docs), pa.ListArray.from_arrays(one, pa.array(sizes)),
                    pa.array([huffman.encode(ids, code)], pa.binary()),
                ],
                names=["part", "at", "n_ids", "doc_ids", "sizes", "payload"],
            )

        for b in slices(batches, "ids", BLOCK_IDS * kind.itemsize):
            ids, offsets = _plain(b.column("ids"), kind)
            parts, at, size = b.column("part").to_numpy(), b.column("at").to_numpy(), np.diff(offsets)
            breaks = np.flatnonzero((np.diff(parts) != 0) | (at[1:] != at[:-1] + size[:-1])) + 1
            for i, j in zip([0, *breaks.tolist()], [*breaks.tolist(), len(parts)]):
                if held and (n >= BLOCK_IDS or parts[i] != part or at[i] != first + n):
                    yield block()
                    held, n = [], 0
                if not held:
                    part, first = int(parts[i]), int(at[i])
                piece = ids[offsets[i] : offsets[j]].astype(np.int64)
                held.append((piece, size[i:j].astype(np.int64), b.column("doc_id").slice(i, j - i)))
                n += len(piece)
        if held:
            yield block()

    return run


def write(
    docs: DataFrame, path: str, end_id: int = 2, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write a store of the documents' token ids to a new folder."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_path()
    vocabulary = max(encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1)
    kind, doc_type = _dtype(vocabulary), docs.schema[id_col].dataType.simpleString()
    ordered = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange(width(spark, docs), "doc_id").sortWithinPartitions("doc_id")
    schema = f"part int, at long, doc_id {doc_type}, ids binary"
    path_ids = scratch_dir(spark, "token-ids")
    plain = ordered.mapInArrow(_tokenize(tokenizer, end_id, kind), schema)
    plain.write.option("compression", "zstd").parquet(path_ids)
    plain = spark.read.schema(schema).parquet(path_ids)
    counts = np.zeros(vocabulary, np.int64)
    for r in plain.select("ids").mapInArrow(_count(kind, vocabulary), "id int, n long").groupBy("id").agg(F.sum("n")).collect():
        counts[r[0]] = r[1]  # one row per token id
    lengths = huffman.code_lengths(counts)
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast(lengths)
    blocks = f"part int, at long, n_ids long, doc_ids array<{doc_type}>, sizes array<long>, payload binary"
    coded = plain.mapInArrow(_code(shared, kind), blocks)
    coded.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    delete(spark, path_ids)
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per part
    parts.select("part", F.coalesce(before, F.lit(0)).alias("base")).write.parquet(f"{path}/parts")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before
    it), n_tokens and ids; with ``digest`` ids_crc32 (of the ids as
    little-endian 32-bit numbers) in place of ids."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # one row per token id
    lengths = np.zeros(max((r.id for r in book), default=0) + 1, np.uint8)
    for r in book:
        lengths[r.id] = r.length
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = spark.read.schema("part int, base long").parquet(f"{path}/parts")
    shared = spark.sparkContext.broadcast(lengths)

    def run(batches):
        code = huffman.canonical(shared.value)
        for b in batches:
            for i in range(b.num_rows):
                ids = huffman.decode(b.column("payload")[i].as_buffer().to_pybytes(), code)
                docs, sizes = b.column("doc_ids").slice(i, 1).flatten(), b.column("sizes").slice(i, 1).flatten().to_numpy()
                ends = np.cumsum(sizes)
                start = b.column("base")[i].as_py() + b.column("at")[i].as_py() + ends - sizes
                if digest:
                    raw = memoryview(ids.astype("<u4").view(np.uint8))
                    crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                    last = pa.array(crc, pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([docs, pa.array(start), pa.array(sizes), last], names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
    doc_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    what = "ids_crc32 long" if digest else "ids array<int>"
    return blocks.join(parts, "part").mapInArrow(run, f"doc_id {doc_type}, start long, n_tokens long, {what}")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every document's ids, coded, written, read back and digested."""
    path = scratch_dir(spark, "token-store")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read(spark, path, digest=True)
