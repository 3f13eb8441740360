"""Generated whole-number keys (K9), gapless and repeatable.

An identity column numbers rows as they are inserted. Here a batch's keys
are the places of its rows in a fixed order: the rows are range-partitioned
and sorted by the order columns and then by all others, staged once with
their place in their partition, the partitions are counted, and a prefix
sum over those few counts gives each partition's first key. The keys are
``start``, ``start + 1``, ... without a gap, and the same rows get the same
keys on every run and for every partitioning (rows that are equal in all
columns cannot be told apart, so it does not matter which gets which).

A later load goes on after the rows that are stored. All columns take part
in the ranges, so an order value that a third of the rows share is still
dealt over many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.session import scratch_dir
from dimspark.sinks.folders import delete
from dimspark.sinks.versioned import read_current, table_rows, write_delta, write_version

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place below


def _q(c: str):
    return F.col(f"`{c}`")


def with_surrogate_key(
    df: DataFrame,
    name: str,
    order: Sequence[str] = (),
    start: int = 1,
    partitions: int | None = None,
    staging: str | None = None,
) -> DataFrame:
    """df with ``name`` (bigint) as its first column: start, start + 1, ...
    in the order of ``order``, then of the other columns (NULLs first). Map
    columns cannot be ordered. An empty df stays empty."""
    spark = df.sparkSession
    staging = staging or scratch_dir(spark, "surrogate")
    rest = [f.name for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, T.MapType)]
    by = [_q(c) for c in [*order, *rest]]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *by).sortWithinPartitions(*by).select(
        F.monotonically_increasing_id().alias("__place"), *[_q(c) for c in df.columns]
    )
    placed.write.mode("overwrite").parquet(f"{staging}/rows")
    rows = spark.read.schema(placed.schema).parquet(f"{staging}/rows")
    part = F.shiftright("__place", _PLACE_BITS)
    counts = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    first = counts.select("__part", (F.lit(start) + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("__first"))
    first.write.mode("overwrite").parquet(f"{staging}/first")
    first = spark.read.schema("__part long, __first long").parquet(f"{staging}/first")
    place = F.col("__place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    keyed = rows.withColumn("__part", part).join(first, "__part")
    return keyed.select((F.col("__first") + place).alias(name), *[_q(c) for c in df.columns])


def append_with_key(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    name: str,
    order: Sequence[str] = (),
    load: int = 0,
    start: int = 1,
    partition_by: Sequence[str] = (),
) -> int:
    """Append df to the table under ``root`` with keys that go on after the
    rows stored before load ``load``; returns the number of rows added. Run
    again under its id, a load writes the same keys."""
    stored = read_current(spark, root, before=load)
    begin = start if stored is None else start + table_rows(spark, root, before=load)
    staging = scratch_dir(spark, "surrogate")
    keyed = with_surrogate_key(df, name, order, begin, staging=staging)
    write = write_version if stored is None else write_delta
    added = write(keyed, root, load, partition_by)
    delete(spark, staging)
    return added
