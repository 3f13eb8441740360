"""Best-fit packing by a configuration linear program.

Documents are tokenized and cut into pieces of at most ``capacity`` ids.
The number of sequences depends on the histogram of piece lengths only,
at most ``capacity`` numbers, whatever the corpus. A configuration is a
multiset of lengths that fits one sequence; the program asks for the
fewest configurations that cover the histogram.

*Multiplicative weights.* A length's price starts a little more than in
proportion to the length (long pieces are harder to place) and shrinks
exponentially with the covered fraction of its pieces, so all lengths are
used up at the same pace. An unbounded knapsack over the capacity prices
configurations; one table gives the best configuration that contains each
length. Those that fill a sequence but for ``slack`` are taken, each for a
fraction of what is left, and the prices follow.

*Rounding.* Every step takes whole multiples only; pieces left at the end
(a few per configuration, or where nothing fills a sequence well) are
packed by best fit, longest first, also on the histogram.

The plan is a list of (configuration, times), bounded by the number of
steps. Spark then deals the pieces into it: the k-th piece of a length
takes the k-th place of that length. Ranks are counted per (length, salt)
cell, so a length that a third of all pieces share is no single group.

Defined results: a null or empty text is one piece, the end id alone; rows
that share an id are packed separately; an empty table gives an empty
table; further columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimspark.llm.chunks import store
from dimspark.llm.text import slices
from dimspark.llm.tokens import default_path, encoder

BULK = 1.5  # power of the length in its first price

Config = tuple[tuple[int, int], ...]  # ((length, how many), ...)


def _knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best price for each capacity and the length taken last (0: none)."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    n = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        if n[c]:
            v = best[c - sizes[: n[c]]] + price[: n[c]]
            i = int(v.argmax())
            if v[i] > best[c - 1]:
                best[c], last[c] = v[i], sizes[i]
                continue
        best[c] = best[c - 1]
    return best, last


def _config(last: np.ndarray, first: int, capacity: int) -> Config:
    """The best configuration that holds a piece of length ``first``."""
    count, c = {first: 1}, capacity - first
    while c > 0:
        s = int(last[c])
        if not s:
            c -= 1
            continue
        count[s] = count.get(s, 0) + 1
        c -= s
    return tuple(sorted(count.items(), reverse=True))


@dataclass
class Plan:
    capacity: int
    configs: list[tuple[Config, int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(k for _, k in self.configs)

    def places(self) -> list[tuple[int, int, int, int, int]]:
        """(length, first rank, first sequence, pieces per sequence, offset)
        by length and rank."""
        rank: dict[int, int] = {}
        out, sequence = [], 0
        for config, times in self.configs:
            offset = 0
            for length, n in config:
                at = rank.get(length, 0)
                out.append((length, at, sequence, n, offset))
                rank[length] = at + n * times
                offset += n * length
            sequence += times
        return sorted(out)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Best fit, longest first, on a histogram of lengths."""
    bins: dict[int, list[tuple[dict[int, int], int]]] = {}
    spaces: list[int] = []

    def put(space, config, times):
        if space not in bins:
            bins[space] = []
            bisect.insort(spaces, space)
        bins[space].append((config, times))

    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            i = bisect.bisect_left(spaces, s)
            if i == len(spaces):  # open sequences: as many of this length as fit
                per = capacity // s
                if n >= per:
                    put(capacity - per * s, {s: per}, n // per)
                    n %= per
                else:
                    put(capacity - n * s, {s: n}, 1)
                    n = 0
                continue
            space = spaces[i]
            config, times = bins[space].pop()
            if not bins[space]:
                del bins[space], spaces[i]
            take = min(n, times)
            put(space - s, config | {s: config.get(s, 0) + 1}, take)
            if times > take:
                put(space, config, times - take)
            n -= take
    merged: dict[Config, int] = {}
    for group in bins.values():
        for config, times in group:
            key = tuple(sorted(config.items(), reverse=True))
            merged[key] = merged.get(key, 0) + times
    return list(merged.items())


def plan(histogram: dict[int, int], capacity: int, rounds: int = 60, slack: float = 0.002, eta: float = 1.0) -> Plan:
    """Configurations that cover the histogram of piece lengths."""
    out = Plan(capacity)
    taken: dict[Config, int] = {}
    total = {s: n for s, n in histogram.items() if n}
    left = dict(total)
    if left.get(capacity):
        taken[((capacity, 1),)] = left.pop(capacity)
    for _ in range(rounds):
        sizes = np.array(sorted(s for s, n in left.items() if n), np.int64)
        if not len(sizes):
            break
        covered = np.array([1 - left[s] / total[s] for s in sizes.tolist()])
        price = (sizes / capacity) ** BULK * np.exp(-eta * covered)
        best, last = _knapsack(sizes, price, capacity)
        used = 0
        for s in sizes[::-1].tolist():
            config = _config(last, s, capacity)
            if not left[s] or sum(s * n for s, n in config) < (1 - slack) * capacity:
                continue
            most = min(left[s] // n for s, n in config)
            times = max(1, most // 4) if most else 0
            if times:
                taken[config] = taken.get(config, 0) + times
                for s, n in config:
                    left[s] -= n * times
                used += times
        if not used:
            break
    out.configs = list(taken.items()) + best_fit({s: n for s, n in left.items() if n}, capacity)
    return out


def _pieces(path: str, capacity: int, end: int, id_col: str, text_col: str):
    def cut(batches):
        words = encoder(path)
        for b in slices(batches, text_col, 2 << 20):
            ids, offsets = words.encode(b.column(text_col), end)
            raw = memoryview(ids.astype("<u4").view(np.uint8))
            size = np.diff(offsets)
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            at = offsets[row] + start
            crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
            doc = b.column(id_col).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def _deal(places):
    def deal(batches):
        length, first, sequence, per, offset = places.value
        key = (length << 40) | first
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(key, (size << 40) | rank, "right") - 1
            k = rank - first[i]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(sequence[i] + k // per[i]), pa.array(offset[i] + k % per[i] * size)],
                names=[*b.schema.names[:-1], "sequence_id", "offset"],
            )

    return deal


def pack(
    docs: DataFrame,
    capacity: int = 4096,
    end_id: int = 1,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and its
    sequence_id and offset there."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    cut = _pieces(tokenizer or default_path(), capacity, end_id, id_col, text_col)
    pieces = store(spark, docs.select(id_col, text_col).mapInArrow(cut, schema), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    found = plan(histogram, capacity).places()
    arrays = tuple(np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 5
    places = spark.sparkContext.broadcast(arrays)  # bounded by the steps of the plan

    salts = max(64, sum(histogram.values()) // 50_000)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    cells = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    cells = cells.select("length", "salt", base.alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    ranked = salted.withColumn("inside", inside).join(cells, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("base") + F.col("inside") - 1).alias("rank"))
    return ranked.mapInArrow(_deal(places), f"{schema}, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: every document's pieces in sequences of 4096 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
