"""Keyed upserts and incremental loads.

Parquet tables have no MERGE, so each upsert is expressed as
aggregate + join on the key. ``dimspark.sinks.upserted`` stores the result
by hash partitions, of which a load rewrites those it touches; the path
being read is never overwritten.

Each function takes the stored table (``existing``, may be ``None`` on
the first load) and a new batch (``incoming``), and returns the table as
it should be after the load. Re-running a load with the same batch
returns the same table (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.operators.dedupe import keep_first, keep_last
from dimspark.operators.lookup import null_key_spread, zero_of


def _q(c: str):
    return F.col(f"`{c}`")


def insert_new_keys(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """K11 ``ON CONFLICT (key) DO NOTHING``: first row per key wins.

    Within the batch the first row by ``order`` is kept; a key already
    stored keeps its stored row.
    """
    new = new_key_rows(existing, incoming, keys, order)
    if existing is None:
        return new
    return existing.unionByName(new.select(*[_q(c) for c in existing.columns]))


def new_key_rows(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows K11 adds: the first batch row of every key not stored yet.

    Stored rows never change under DO NOTHING, so an insert-only table can
    be loaded by writing just these rows (a delta)."""
    batch = keep_first(incoming, keys, order)
    if existing is None:
        return batch
    return batch.join(existing.select(*[_q(k) for k in keys]), list(keys), "left_anti")


def upsert_update(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    update_cols: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """K12 ``ON CONFLICT (key) DO UPDATE SET c = EXCLUDED.c`` for ``update_cols``.

    Per key, the columns in ``update_cols`` take the last value by
    ``order``; all other columns keep the first value ever inserted.
    ``columns`` are the stored value columns (default: every column of
    ``incoming`` that is neither a key nor an order column). Rows that tie
    on ``order`` are ranked by their values, so the result is fixed.
    One partially aggregated group-by over the batch, then (for a stored
    table) a full outer join on the key.
    """
    keys, order, update_cols = list(keys), list(order), list(update_cols)
    if columns is None:
        columns = [c for c in incoming.columns if c not in keys and c not in order]
    values = [c for c in columns if c not in keys]
    others = [c for c in values if c not in update_cols]
    # One struct per row: the order, then every value column (ties ranked
    # by the values). Its minimum is the first row of the key, its maximum
    # the last; the values are read from those two structs, so each
    # partial-aggregate row carries two structs, not one per column.
    ordk = F.struct(*[_q(c).alias(f"__o{i}") for i, c in enumerate(order)], *[_q(c) for c in values])
    aggs = []
    if others:
        aggs.append(F.min(ordk).alias("__first"))
    if update_cols:
        aggs.append(F.max(ordk).alias("__last"))
    cols = [*keys, *values]
    batch = (
        incoming.groupBy(*[_q(k) for k in keys])
        .agg(*aggs)
        .select(
            *[_q(k) for k in keys],
            *[F.col("__first").getField(c).alias(c) for c in others],
            *[F.col("__last").getField(c).alias(c) for c in update_cols],
        )
    )
    if existing is None:
        return batch.select(*[_q(c) for c in cols])
    batch = batch.withColumn("__in_batch", F.lit(True))
    e = existing.select(
        *[_q(c) if c in keys else _q(c).alias(f"__e_{c}") for c in cols], F.lit(True).alias("__in_existing")
    )
    j = e.join(batch, keys, "full")
    out = []
    for c in cols:
        if c in keys:
            out.append(_q(c))
        elif c in update_cols:
            # EXCLUDED.c when the key is in the batch, else the stored value.
            out.append(F.when(F.col("__in_batch"), _q(c)).otherwise(F.col(f"`__e_{c}`")).alias(c))
        else:
            # First insert wins: the stored value when the key was stored.
            out.append(F.when(F.col("__in_existing"), F.col(f"`__e_{c}`")).otherwise(_q(c)).alias(c))
    return j.select(*out)


def upsert_replace(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Primary-key insert where the last write wins (whole row)."""
    batch = keep_last(incoming, keys, order)
    if existing is None:
        return batch
    kept = existing.join(batch.select(*[_q(k) for k in keys]), list(keys), "left_anti")
    return kept.unionByName(batch.select(*[_q(c) for c in existing.columns]))


def skip_loaded(new: DataFrame, loaded: DataFrame, new_keys: Sequence[str], loaded_keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``loaded``.

    Same result as the correlated ``NOT IN (SELECT ... WHERE s.k = se.k)``:
    a left anti join on plain equality, so rows with a NULL key are kept.
    The loaded side is reduced to its distinct keys first (a partially
    aggregated group-by): a stored fact has many rows per key, and only
    the key set matters, so far fewer rows are shuffled into the join.
    """
    l = loaded.select(*[_q(k).alias(f"__sk{i}") for i, k in enumerate(loaded_keys)]).distinct()
    l = l.withColumn("__nk", zero_of(l.columns))
    # Rows with a NULL key are kept and match nothing: spread them over
    # all partitions instead of hashing them all to one.
    n = new.withColumn("__nk", null_key_spread(new, new_keys))
    conds = [n[f"`{a}`"] == l[f"__sk{i}"] for i, a in enumerate(new_keys)] + [n["__nk"] == l["__nk"]]
    return n.join(l, conds, "left_anti").drop("__nk")
