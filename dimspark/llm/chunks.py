"""Chunks of documents, and questions that chunks ask of hash buckets.

Counting or comparing all n-grams of a corpus by one row per occurrence
moves several times the corpus. Here documents are first put into chunks
of a few MB (a bucketed table, so later steps read a chunk's documents
together without shuffling texts again). A chunk then sends each hash
bucket ONE row: its distinct 64-bit keys of that bucket, sorted and
delta-coded by bytes. The bucket joins the keys of all chunks and answers
each chunk with a small value per key, in the same order. A key that
occurs in a third of all rows is one entry per chunk, so no bucket is hot.

Buckets are ranges of the key, so the answers of a chunk's buckets in
order line up with its sorted distinct keys.

At any corpus size the counts stay within bounds: the chunk table has at
most TABLE_BUCKETS buckets (a bucket then holds several chunks, which are
read one by one), chunks grow with the corpus up to MOST_CHUNK_BYTES, and
there are no more hash buckets than leave ROW_KEYS keys to a packed row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.llm.text import slices, text_bytes
from dimspark.session import scratch_dir
from dimspark.sinks.folders import delete

CHUNK_BYTES = 6 << 20
MOST_CHUNK_BYTES = 24 << 20
CHUNKS = 1 << 17  # chunks grow once there would be more
TABLE_BUCKETS = 1 << 16  # Spark refuses more than 100,000
ROW_KEYS = 16  # least keys a packed row has on average
KEY_BYTES = 6  # about one key per so many bytes of text


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CHUNK = "__dimspark_chunk"  # a name that no column of a user has


@dataclass
class Chunks:
    """Documents with a column CHUNK, stored bucketed by it."""

    spark: SparkSession
    table: str
    path: str
    buckets: int
    chunk_bytes: int

    @property
    def df(self) -> DataFrame:
        return self.spark.table(self.table)

    def hash_buckets(self, times: int = 1) -> int:
        """How many hash buckets chunks ask: ``times`` as many as the table
        has parts, but no more than leave a packed row ROW_KEYS keys."""
        return min(times * self.buckets, self.chunk_bytes // KEY_BYTES // ROW_KEYS)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        delete(self.spark, self.path)


def estimate(df: DataFrame) -> int | None:
    """A table's size by Spark's estimate (file sizes, for a scan); None if
    it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else None  # Spark takes an unknown size for the largest number


def width(spark: SparkSession, df: DataFrame, part_bytes: int = 16 << 20) -> int:
    """Number of partitions for a table of this size, or as many as it has
    if Spark has no estimate."""
    size = estimate(df)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, df.rdd.getNumPartitions() if size is None else size // part_bytes)


def chunk_size(size: int | None) -> int:
    """Bytes of text of a chunk, for a corpus of this size."""
    return CHUNK_BYTES if size is None else min(max(CHUNK_BYTES, size // CHUNKS), MOST_CHUNK_BYTES)


@contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """Actions inside leave no shuffle files behind."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)


def store(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared scratch folder and read it back: cuts
    the lineage, and a lost executor loses nothing. What the write shuffled
    is not needed again, so Spark deletes those files when it is done."""
    path = scratch_dir(spark, name)
    with cleaning(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables made by store() that nothing will read again."""
    for df in stored:
        delete(df.sparkSession, df.scratch_path)


def write_chunks(spark: SparkSession, docs: DataFrame, text: str, chunk_bytes: int | None = None) -> Chunks:
    """Store docs with a chunk number each. The scan is not shuffled: a task
    cuts the rows it reads. All columns are kept. The table's files are in
    the shared scratch folder."""
    chunk_bytes = chunk_bytes or chunk_size(estimate(docs))
    schema = T.StructType([T.StructField(CHUNK, T.LongType()), *docs.schema.fields])

    def number(batches):
        from pyspark import TaskContext

        chunk, used, n = TaskContext.get().partitionId() << 32, 0, 0
        for b in slices(batches, text, chunk_bytes // 4):
            size = len(text_bytes(b.column(b.schema.get_field_index(text)))[0]) + 64 * b.num_rows
            if n and used + size > chunk_bytes:
                chunk, used = chunk + 1, 0
            used, n = used + size, n + b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b.num_rows, chunk, np.int64)), *b.columns], names=[CHUNK, *b.schema.names]
            )

    buckets = min(width(spark, docs), TABLE_BUCKETS)
    name, path = f"dimspark_chunks_{uuid.uuid4().hex[:12]}", scratch_dir(spark, "chunks")
    written = docs.mapInArrow(number, schema).write.option("compression", "zstd").option("path", path)
    written.bucketBy(buckets, CHUNK).saveAsTable(name)
    return Chunks(spark, name, path, buckets, chunk_bytes)


# -- packed keys ---------------------------------------------------------------


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct uint64 keys as byte planes of their differences; the
    high planes are zeros, which Spark's shuffle compression removes."""
    if not len(keys):
        return b""
    d = np.diff(keys, prepend=np.uint64(0))
    return d.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(b, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def bucket_cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Positions in sorted keys where each of n equal key ranges begins."""
    step = (1 << 64) // n
    edges = np.array([i * step for i in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


ASK = "bucket int, chunk long, kind int, keys binary, extra binary"
ANSWER = "chunk long, bucket int, kind int, answer binary"


def ask_rows(chunk: int, kind: int, keys: np.ndarray, extra: np.ndarray | None, n: int) -> Iterator[tuple]:
    """The rows by which a chunk asks about its sorted distinct keys.
    extra: a fixed-width array with a value for each key."""
    cut = bucket_cuts(keys, n)
    for b in np.flatnonzero(np.diff(cut)):
        part = slice(cut[b], cut[b + 1])
        yield int(b), chunk, kind, pack_keys(keys[part]), b"" if extra is None else extra[part].tobytes()


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, cols)})


def answers(table: pa.Table, kind: int) -> bytes:
    """A chunk's answers of one kind, in key order."""
    import pyarrow.compute as pc

    t = table.filter(pc.equal(table["kind"], kind)).sort_by("bucket")
    return [bytes(x) for x in t["answer"].to_pylist()]
