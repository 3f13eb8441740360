"""Data quality checks and the row-count report.

Each check is a single aggregation job (no per-table ``count()`` called
twice, no collect of data rows); only the small result is brought back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.operators.aggregates import count_report


class DataQualityError(ValueError):
    pass


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, count) for every table, in one job."""
    return count_report(tables, "table", "count")


def check_non_empty(tables: Mapping[str, DataFrame], raise_on_fail: bool = True) -> dict[str, int]:
    """Q1: every table must hold at least one row; raises otherwise."""
    counts = {r["table"]: r["count"] for r in row_counts(tables).collect()}
    return check_counts(counts) if raise_on_fail else counts


def counts_frame(spark: SparkSession, counts: Mapping[str, int], label: str = "table", name: str = "count") -> DataFrame:
    """Q4/A11 from counts that the writes have taken: (table, count) rows."""
    return spark.createDataFrame(list(counts.items()), f"`{label}` string, `{name}` bigint")


def check_counts(counts: Mapping[str, int]) -> dict[str, int]:
    """Q1 on counts that the writes have taken; runs no job."""
    empty = [t for t, n in counts.items() if n < 1]
    if empty:
        raise DataQualityError(f"Data quality check failed: {', '.join(empty)} contained 0 rows")
    return dict(counts)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q2: one row, one NULL count per column, in a single pass."""
    cols = list(columns or df.columns)
    return df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in cols])


def check_no_nulls(df: DataFrame, columns: Sequence[str]) -> None:
    """Q2 as a check: raise if any listed column holds a NULL."""
    row = null_counts(df, columns).collect()[0]
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise DataQualityError(f"NULL values found: {bad}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q3: keys that occur more than once, with their counts."""
    return (
        df.groupBy(*[F.col(f"`{k}`") for k in keys])
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Q3 as a check: raise if a key occurs twice."""
    if not duplicate_keys(df, keys).isEmpty():
        raise DataQualityError(f"duplicate keys on {list(keys)}")
