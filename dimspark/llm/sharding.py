"""Sharding by a minimax contiguous partition (DataFrame operations only).

Equal texts are one atomic group, and groups are ordered by the digest of
their text. The capacity is the least one for which the groups, in order,
fit into the wanted number of contiguous shards: found by binary search,
each capacity checked greedily, filling every shard as far as it goes.

The search is exact over the groups, but needs few of their sizes on the
driver. It begins with the sizes of all groups with a common digest prefix
(``2 ** BITS`` of them at most). Any capacity that fits at that level
bounds the least one from above, the total and the largest group bound it
from below, and between these bounds a greedy cut can only fall into some
of the prefixes, a few per cut. Those alone are split by further digits,
or into their groups once there are at most ``MOST_GROUPS`` of these, and
searched again, until every prefix that a cut can fall into is split. The
others never hold a cut, so their sums are as good as their groups.

The cuts are then placed as near to equal shares as that capacity allows.
A document's slot is its cell's offset in the shard and its place in the
cell. A cell is a prefix in a shard; one with very many documents (copies
of a text) is dealt over salts, so that it is numbered in many tasks.

Defined results: a null text has no bytes and is grouped with empty texts;
repeated rows take a slot each; an empty table gives an empty table; with
fewer groups than shards the rest stay empty; further columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimspark.llm.chunks import store

BITS = 16
DIGEST = 32  # hexadecimal digits of a digest
MOST_GROUPS = 400_000  # groups of cut prefixes that the driver takes one by one
CELL_ROWS = 500  # least rows of a cell before it is dealt over salts


def fits(ends: list[int], capacity: int, shards: int) -> bool:
    """Greedy check: ends are the running sums of the ordered sizes."""
    at, done = 0, 0
    for _ in range(shards):
        at = bisect_right(ends, done + capacity, at)
        if at == len(ends):
            return True
        done = ends[at - 1] if at else 0
    return False


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Least capacity for which sizes fit, in order, into the shards."""
    ends = list(accumulate(sizes))
    if not ends:
        return 0
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        mid = (low + high) // 2
        if fits(ends, mid, shards):
            high = mid
        else:
            low = mid + 1
    return low


def cuts(sizes: list[int], shards: int) -> list[int]:
    """Index of the first size of each shard but the first."""
    capacity = smallest_capacity(sizes, shards)
    ends = [0, *accumulate(sizes)]
    n = len(sizes)
    least = [n]  # least[j]: the sizes from there on fit into j shards
    for _ in range(shards):
        least.append(bisect_left(ends, ends[least[-1]] - capacity))
    out, at = [], 0
    for k in range(shards - 1):
        target = ends[at] + (ends[n] - ends[at]) / (shards - k)
        near = bisect_left(ends, target)
        if near > at and near <= n and target - ends[near - 1] < ends[min(near, n)] - target:
            near -= 1
        most = bisect_right(ends, ends[at] + capacity) - 1
        at = min(max(near, least[shards - 1 - k], at), most)
        out.append(at)
    return out


def possible_cuts(sizes: list[int], shards: int, low: int, high: int) -> list[int]:
    """Indexes of the elements that a greedy cut may fall into, for any
    capacity from low to high: the k-th cut lies between the element ends
    that filling k shards to low reaches at least, and k shards to high at
    most."""
    ends = [0, *accumulate(sizes)]
    out: set[int] = set()
    first, last = 0, 0  # bounds of the place of the cut before
    for _ in range(shards - 1):
        first = ends[bisect_right(ends, first + low) - 1]
        last = min(last + high, ends[-1])
        out.update(range(bisect_right(ends, first) - 1, min(bisect_left(ends, last), len(sizes))))
    return sorted(out)


@dataclass(frozen=True, order=True)
class Part:
    """All groups whose digest begins so (a whole digest: one group)."""

    digest: str
    size: int
    n: int  # groups


def _digits(groups: DataFrame, parts: list[Part], digits: int) -> list[Part]:
    """The parts split by so many digits of the digest."""
    prefix = F.substring("digest", 1, len(parts[0].digest))
    inside = groups.where(prefix.isin([p.digest for p in parts]))  # a few prefixes per cut
    rows = inside.groupBy(F.substring("digest", 1, digits).alias("digest")).agg(F.sum("size"), F.count("*")).collect()
    return [Part(*r) for r in rows]


def plan(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """(least capacity, first digest of each shard but the first) for groups
    (digest, size). A digest above all others marks an empty shard."""
    first = groups.groupBy(F.substring("digest", 1, BITS // 4).alias("digest")).agg(F.sum("size"), F.count("*"))
    parts = sorted(Part(*r) for r in first.collect())  # 2 ** BITS rows at most
    if not parts:
        return 0, ["g"] * (shards - 1)
    largest = groups.agg(F.max("size")).first()[0]
    while True:
        sizes = [p.size for p in parts]
        high = smallest_capacity(sizes, shards)
        low = max(largest, -(-sum(sizes) // shards))
        open_ = [i for i in possible_cuts(sizes, shards, low, high) if parts[i].n > 1]
        if not open_:
            break
        level = min(len(parts[i].digest) for i in open_)
        chosen = [parts[i] for i in open_ if len(parts[i].digest) == level]
        whole = sum(p.n for p in chosen) <= MOST_GROUPS
        split = _digits(groups, chosen, DIGEST if whole else level + 2)
        parts = sorted({*parts} - {*chosen} | {*split})
    starts = [parts[i].digest if i < len(parts) else "g" for i in cuts([p.size for p in parts], shards)]
    return high, starts


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard and slot of every row of docs."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = store(
        spark,
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(text).alias("digest"),
        ),
        "shard-rows",
    )
    groups = store(spark, rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "shard-groups")
    _, starts = plan(groups.select("digest", "size"), shards)
    prefix = F.substring("digest", 1, BITS // 4)

    def of_shard(digest):  # bounded: one comparison per shard
        return sum((digest >= s).cast("int") for s in starts) if starts else F.lit(0)

    cell = groups.groupBy(prefix.alias("prefix"), of_shard(F.col("digest")).alias("shard")).agg(F.sum("n").alias("n"))
    most = max(CELL_ROWS, 2 * (groups.agg(F.sum("n")).first()[0] or 0) >> BITS)  # twice an even share
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("prefix")) - F.col("n")
    cell = cell.select("prefix", "shard", before.alias("cell_base"), (F.col("n") / most).cast("int").alias("salts"))
    cell = F.broadcast(cell)  # 2 ** BITS prefixes and 23 cuts through them

    placed = rows.withColumns({"prefix": prefix, "shard": of_shard(F.col("digest"))}).join(cell, ["prefix", "shard"])
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts") + 1)).drop("digest")
    full = placed.where("salts > 0").groupBy("prefix", "shard", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("prefix", "shard").orderBy("salt")) - F.col("n")
    full = full.select("prefix", "shard", "salt", before.alias("salt_base"))  # a row for so many documents
    inside = F.row_number().over(Window.partitionBy("prefix", "shard", "salt").orderBy("id", "text_crc32"))
    numbered = placed.withColumn("inside", inside).join(full, ["prefix", "shard", "salt"], "left")
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("cell_base") + F.coalesce("salt_base", F.lit(0)) + F.col("inside") - 1).alias("slot"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op7: documents in 24 shards of nearly equal bytes."""
    found = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))
