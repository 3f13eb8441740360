"""Writers, load modes and DDL.

Every load is one set-based write of a DataFrame; nothing inserts row by
row from the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimspark.schemas import TABLE_DDL, TABLE_PARTITIONS

LOAD_MODES = ("overwrite", "append")


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    balance: bool = True,
) -> None:
    """K1/K2: Parquet write, optionally partitioned into folders.

    With ``partition_by`` the rows are first rebalanced on the partition
    columns (a REBALANCE hint): each folder gets few files, and AQE
    splits a folder that holds a large share of the rows over several
    tasks instead of one.
    """
    _parquet_writer(_balanced(df, partition_by) if balance else df, partition_by, mode).parquet(path)


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df


def _parquet_writer(df: DataFrame, partition_by: Sequence[str], mode: str):
    writer = df.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> int:
    """write_parquet that returns the number of rows written (Q1, A11): an
    ``Observation`` counts them in the tasks that write them, so no second
    job reads the table to count it."""
    seen = Observation()
    counted = _balanced(df, partition_by).observe(seen, F.count(F.lit(1)).alias("rows"))
    _parquet_writer(counted, partition_by, mode).parquet(path)
    return int(seen.get["rows"])


def write_counted_by(df: DataFrame, path: str, column: str, values: int) -> dict[int, int]:
    """write_counted for a table partitioned by one whole-number column of
    at most ``values`` values: the rows of each. The histogram has a bin
    for every value, so its counts are exact."""
    seen = Observation()
    counts = F.histogram_numeric(F.col(column), F.lit(max(values, 2))).alias("rows")
    _parquet_writer(_balanced(df, [column]).observe(seen, counts), [column], "overwrite").parquet(path)
    return {int(b["x"]): int(b["y"]) for b in seen.get["rows"] or []}


def write_csv_quoted(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """K3: CSV with a header line and every field quoted."""
    df.write.mode(mode).option("header", header).option("quoteAll", True).option("escape", '"').csv(path)


def load(df: DataFrame, path: str, truncate: bool = False, partition_by: Sequence[str] = ()) -> None:
    """K4/K5/K6: append (default) or truncate-then-insert (``truncate``).

    Columns are matched by name against an existing table, not by
    position: ``df`` is written with its own column names.
    """
    write_parquet(df, path, partition_by, mode="overwrite" if truncate else "append")


def write_clustered(
    df: DataFrame,
    path: str,
    partition_keys: Sequence[str],
    clustering: Sequence[str] = (),
    num_partitions: int | None = None,
) -> None:
    """Rows laid out by partition key, sorted by clustering column.

    Range partitioning on (partition key, clustering column) puts the rows
    of one key in one file or a few adjacent ones, ordered as in a
    wide-row table, so a lookup on the key reads few files and row groups
    (min/max statistics). Because the clustering column is part of the
    range, a key holding a large share of the rows is split over several
    tasks and files instead of landing in one.
    """
    cols = [*partition_keys, *clustering]
    count = [] if num_partitions is None else [num_partitions]  # without one AQE sizes the ranges by their rows
    parts = df.repartitionByRange(*count, *[F.col(c) for c in cols])
    parts.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def save_bucketed(
    df: DataFrame, table: str, buckets: int, keys: Sequence[str], sort_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Bucketed, sorted catalog table so later joins on ``keys`` co-locate.

    The write itself has no shuffle: each task writes one file per bucket
    it holds, so a hot key does not load one writer. A later bucketed join
    reads a bucket in one task without a shuffle, so AQE cannot split a
    bucket that a hot key made large; for keys that may hold a large share
    of the rows, ``write_clustered`` (range-split keys) is the safer layout.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    if sort_by:
        w = w.sortBy(*sort_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def create_table(
    spark: SparkSession, name: str, ddl: str | None = None, partitioned_by: Sequence[str] | None = None,
    location: str | None = None,
) -> None:
    """K8: CREATE TABLE IF NOT EXISTS ... USING parquet [PARTITIONED BY]."""
    short = name.rsplit(".", 1)[-1]  # the DDL is looked up without the database
    cols = ddl or TABLE_DDL[short]
    parts = TABLE_PARTITIONS.get(short, []) if partitioned_by is None else list(partitioned_by)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet"
    if parts:
        sql += f" PARTITIONED BY ({', '.join(parts)})"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def drop_table(spark: SparkSession, name: str) -> None:
    """K8: DROP TABLE IF EXISTS."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K8: CREATE DATABASE IF NOT EXISTS (the keyspace / database step).

    ``location`` puts the database folder in a shared place (otherwise the
    session's warehouse folder)."""
    sql = f"CREATE DATABASE IF NOT EXISTS {name}"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def drop_database(spark: SparkSession, name: str) -> None:
    """K8: DROP DATABASE IF EXISTS ... CASCADE."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def insert_into(df: DataFrame, table: str, truncate: bool = False) -> None:
    """K4/K5 on a catalog table: INSERT INTO (append) or INSERT OVERWRITE
    (``truncate``). Columns are matched by name: ``df`` is put in the
    table's column order first (partition columns last), since the insert
    itself maps columns by position."""
    cols = df.sparkSession.table(table).columns
    df.select(*[F.col(f"`{c}`") for c in cols]).write.insertInto(table, overwrite=truncate)
