"""Tables bucketed alike, so that joins on their key do not shuffle.

Tables that are joined or grouped on one key again and again are written
with the same buckets of it. The bucket count comes from the rows of the
largest table and their width in memory (files are compressed, by how much
depends on the data), so a bucket stays a task's size as the data grow; a
join or a group-by on the key then reads each bucket in one task, without
an exchange. A key that holds a large share of the rows makes one bucket
large: for such keys ``write_clustered`` splits the rows by ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.sinks.writers import save_bucketed

# Of rows by their schema: a task that sorts, joins and aggregates a bucket of
# narrow rows needs some twenty times as much.
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 100_000  # what Spark allows (spark.sql.sources.bucketing.maxBuckets)


def plan_bytes(df: DataFrame) -> int | None:
    """A size for a table, from Spark's estimate: of what it is read from, if
    that is less than of the plan (the estimate of a join is the product of
    its sides). None if there is none."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    size = min(int(str(plan.stats().sizeInBytes())), read)
    return size if size < 1 << 60 else None


def row_bytes(df: DataFrame, rows: int | None = None) -> int:
    """The size of a table's rows in memory, by its schema. They are counted
    unless ``rows`` gives their number: for a scan that reads file footers
    only; a derived table should be staged, or come with a bound."""
    return (df.count() if rows is None else rows) * int(df._jdf.schema().defaultSize())


def buckets_for(
    *tables: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 1, rows: int | None = None
) -> int:
    """A bucket count for tables that shall be joined: a power of two, so
    that tables sized at different times still divide each other. ``rows``
    bounds the rows of each."""
    need = -(-max((row_bytes(t, rows) for t in tables), default=0) // bucket_bytes)
    n = 1
    while n < max(need, least):
        n *= 2
    return min(n, MAX_BUCKETS)


def save_colocated(
    spark: SparkSession,
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    sort_by: Mapping[str, Sequence[str]] | None = None,
    location: str | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    least: int = 1,
) -> int:
    """Save every table (name: rows and key columns) with the same number of
    buckets; the rows are dealt by the key first, so that a bucket is one
    file. Returns the number."""
    n = buckets_for(*(df for df, _ in tables.values()), bucket_bytes=bucket_bytes, least=least)
    for name, (df, keys) in tables.items():
        dealt = df.repartition(n, *[F.col(f"`{k}`") for k in keys])
        path = f"{location.rstrip('/')}/{name.rsplit('.', 1)[-1]}" if location else None
        save_bucketed(dealt, name, n, keys, (sort_by or {}).get(name, keys), path=path)
    return n
