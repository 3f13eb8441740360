"""First-wins / last-wins de-duplication by key (A5, K11, K13 canonical).

``dropDuplicates([k])`` keeps an arbitrary row, which differs between
runs. Here the winner per key is the row with the smallest (first) or
largest (last) value of ``order``, ties broken by the remaining columns,
so the result is one fixed row per key.

Plan shape: one aggregate on the key (sort-based, as its buffer is a
struct: it spills instead of failing), with a partial (map-side) aggregate
of a single struct per key and partition. A key that holds a
third of all rows therefore shuffles one row per map task, never the
whole group; no window over an unbounded partition is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _q(c: str):
    return F.col(f"`{c}`")


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[_q(k) for k in keys]).distinct()
    # Rank by the order columns, then by the other columns (ties). A value
    # column that is also an order column is carried once, in the order
    # part: rows tied on the order agree on it anyway.
    extra = [c for c in rest if c not in order]
    ranked = F.struct(
        F.struct(*[_q(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("o"),
        F.struct(*[_q(c) for c in extra]).alias("r"),
    )
    agg = F.max(ranked) if last else F.min(ranked)

    def value(c: str):
        if c in order:
            return F.col("__pick.o").getField(f"o{order.index(c)}").alias(c)
        return F.col("__pick.r").getField(c).alias(c)

    return (
        df.groupBy(*[_q(k) for k in keys])
        .agg(agg.alias("__pick"))
        .select(*[_q(k) for k in keys], *[value(c) for c in rest])
        .select(*[_q(c) for c in df.columns])
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` (NULLs first)."""
    return _pick(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order`` (NULLs last)."""
    return _pick(df, keys, order, last=True)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A3/A4: row-level DISTINCT over ``columns`` (all when omitted)."""
    return (df.select(*[_q(c) for c in columns]) if columns else df).distinct()
