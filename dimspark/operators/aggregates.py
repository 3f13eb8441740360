"""Aggregations.

All are single group-bys with partial aggregation, so a hot group is
combined map-side and never shipped whole to one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(c: str):
    return F.col(f"`{c}`")


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """A2: COUNT(*) GROUP BY keys; NULL is a group of its own."""
    return df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def sum_text_as_int(c) -> Column:
    """SUM over a text column of whole numbers, as a whole number.

    Non-numbers count as NULL (try_cast). Numbers are read and added as
    64-bit integers, exactly; a 32-bit total would pass 2^31.
    """
    col = _q(c) if isinstance(c, str) else c
    return F.sum(col.try_cast("bigint"))


def round_avg(c, digits: int = 2) -> Column:
    """ROUND(AVG(c), digits) over a column read as double."""
    col = _q(c) if isinstance(c, str) else c
    return F.round(F.avg(col.try_cast("double")), digits)


def two_level_avg(
    df: DataFrame,
    inner_key: str | Sequence[str],
    value: str,
    mapping: DataFrame,
    outer_key: str,
    digits: int = 2,
    name: str = "avg",
) -> DataFrame:
    """Average per inner group (rounded), then per outer group (rounded).

    ``mapping`` assigns inner groups to outer groups (its distinct rows
    are used, as ``select(inner, outer).distinct()`` does). The double
    rounding is part of the result. Both steps are hash aggregates; the
    second one reads only one row per inner group.
    """
    inner = [inner_key] if isinstance(inner_key, str) else list(inner_key)
    first = df.groupBy(*[_q(k) for k in inner]).agg(round_avg(value, digits).alias(name))
    m = mapping.select(*[_q(k) for k in inner], _q(outer_key)).distinct()
    return m.join(first, inner, "inner").groupBy(_q(outer_key)).agg(F.round(F.avg(_q(name)), digits).alias(name))


def pivot_sum(
    df: DataFrame,
    group_cols: Sequence[str],
    pivot_col: str,
    values: Sequence[str],
    value_col: str,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """One column per pivot value holding SUM(value_col); missing = NULL.

    The value list is passed in, so Spark does not run a separate job to
    find the distinct pivot values and the output schema is fixed.
    """
    out = df.groupBy(*[_q(g) for g in group_cols]).pivot(pivot_col, list(values)).agg(F.sum(_q(value_col)))
    if aliases:
        out = out.select(*[_q(c).alias(aliases.get(c, c)) for c in out.columns])
    return out


def count_report(tables: Mapping[str, DataFrame], label: str = "table", name: str = "count") -> DataFrame:
    """One (label, count) row per table, as a single job."""
    parts = [df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(t).alias(label), _q(name)) for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
