"""Incremental appends to a partitioned fact.

``new_rows`` gives the rows of a batch that are not stored yet, each
identity once. Identities are compared null-safely: a NULL part equals a
NULL part, as two deliveries of one record do. Rows of the batch that
share an identity are one row, the first by their other columns.

The stored side is read only where the batch can have a match: the
batch's partitions (a few year-month pairs for an hourly load) become a
filter on the partition columns, which the scan answers by skipping
folders. Both sides carry only the identity into the join, and each holds
an identity once, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.operators.dedupe import keep_first

MAX_PARTITIONS = 400  # pairs named one by one in the filter; beyond, a range


def _q(c: str):
    return F.col(f"`{c}`")


def partition_filter(batch: DataFrame, columns: Sequence[str]) -> Column | None:
    """A condition on partition columns that holds for every partition the
    batch has rows of: each one by name, or, for very many, the range of
    the first column. None for a batch without rows. Reads the batch's
    partition columns; brings at most MAX_PARTITIONS + 1 rows back."""
    found = batch.select(*[_q(c) for c in columns]).distinct().limit(MAX_PARTITIONS + 1).collect()
    if not found:
        return None
    if len(found) <= MAX_PARTITIONS:
        return reduce(or_, [reduce(and_, [_q(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, r)]) for r in found])
    first = columns[0]
    lo, hi, nulls = batch.agg(F.min(_q(first)), F.max(_q(first)), F.max(_q(first).isNull())).first()
    inside = _q(first).between(lo, hi)
    return inside | _q(first).isNull() if nulls else inside


def not_stored(
    batch: DataFrame, stored: DataFrame, identity: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Rows of batch whose identity no stored row has (null-safe). Identity
    and partition columns have the same names on both sides."""
    if partition_by:
        inside = partition_filter(batch, partition_by)
        if inside is None:
            return batch
        stored = stored.where(inside)
    s = stored.select(*[_q(c).alias(f"__s{i}") for i, c in enumerate(identity)])
    same = reduce(and_, [_q(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(identity)])
    return batch.join(s, same, "left_anti")


def new_rows(
    batch: DataFrame,
    stored: DataFrame | None,
    identity: Sequence[str],
    partition_by: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Rows to append: each identity of the batch once, none that is stored.

    The partitions are those of the batch as it comes: finding them reads
    their columns alone, not the rows picked."""
    rest = [c for c in batch.columns if c not in identity]
    once = keep_first(batch, list(identity), [*order, *[c for c in rest if c not in order]])
    if stored is None:
        return once
    if partition_by:
        inside = partition_filter(batch, partition_by)
        if inside is None:
            return once
        stored = stored.where(inside)
    return not_stored(once, stored, identity)
