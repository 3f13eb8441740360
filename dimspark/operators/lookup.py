"""Fact-to-dimension lookup joins.

``lookup_left`` is the canonical fact match: the dimension is collapsed
to at most one row per lookup key first, so the left join keeps exactly
one output row per fact row (J6). ``left_join_all`` and ``inner_join``
keep the fan-out of the reference's plain joins (J1, J2).

Scale notes: the dimension side is reduced (NULL keys dropped, one row
per key via a partially aggregated group-by) before it meets the facts.
Spark then picks broadcast-hash or sort-merge by size; with AQE on, a
fact partition swollen by one hot key is split into several tasks at
run time (skew join). ``salt_buckets`` adds static salting on top for
plans that run without AQE: fact rows get a salt from a hash of their
own columns and the (already unique) dimension rows are copied once per
salt value, so the result is exact and no row is dropped.

Fact rows whose key has a NULL can never match, but an outer join keeps
them, and in a shuffled join they all hash to one partition. The left
joins therefore add one join key, ``__nk``: 0 for rows with a full key and
a hash of the row otherwise. On the dimension side it is 0 too, computed
from the key so that the optimizer cannot fold the equality into a filter
and drop it from the exchange. NULL-key rows then spread over all
partitions and still match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.operators.dedupe import keep_first


def _q(c: str):
    return F.col(f"`{c}`")


def _conds(facts: DataFrame, dim: DataFrame, fact_keys, dim_keys):
    return [facts[f"`{a}`"] == dim[f"`{b}`"] for a, b in zip(fact_keys, dim_keys)]


def null_key_spread(df: DataFrame, keys: Sequence[str]):
    """0 when every key column is set, else an odd hash of the whole row
    (the same row always gets the same value)."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | _q(k).isNull()
    hashable = [_q(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.when(any_null, F.xxhash64(*hashable).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("bigint"))


def zero_of(keys: Sequence[str]):
    """0, as an expression over the key columns that is not a constant."""
    return F.pmod(F.xxhash64(*[_q(k) for k in keys]), F.lit(1)).cast("bigint")


def lookup_left(
    facts: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str] | None = None,
    salt_buckets: int = 0,
) -> DataFrame:
    """Left join to at most one dimension row per key.

    The dimension row kept per key is the first by ``order`` (default:
    the value columns). Fact columns come first, then ``values``. Misses
    give NULL values (T21); NULL fact keys never match.
    """
    fact_keys, dim_keys, values = list(fact_keys), list(dim_keys), list(values)
    tmp_keys = [f"__lk{i}" for i in range(len(dim_keys))]
    tmp_vals = [f"__lv{i}" for i in range(len(values))]
    d = dim.select(
        *[_q(k).alias(t) for k, t in zip(dim_keys, tmp_keys)],
        *[_q(v).alias(t) for v, t in zip(values, tmp_vals)],
    ).where(F.expr(" AND ".join(f"{t} IS NOT NULL" for t in tmp_keys)))
    ord_cols = [tmp_vals[values.index(o)] for o in order] if order else tmp_vals
    d = keep_first(d, tmp_keys, ord_cols)
    f = facts.withColumn("__nk", null_key_spread(facts, fact_keys))
    d = d.withColumn("__nk", zero_of(tmp_keys))
    join_keys = list(zip(fact_keys, tmp_keys))
    if salt_buckets and salt_buckets > 1:
        f = f.withColumn("__salt", F.pmod(F.xxhash64(*[_q(c) for c in facts.columns]), F.lit(salt_buckets)))
        d = d.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
    conds = [f[f"`{a}`"] == d[b] for a, b in join_keys] + [f["__nk"] == d["__nk"]]
    if salt_buckets and salt_buckets > 1:
        conds.append(f["__salt"] == d["__salt"])
    out = f.join(d, conds, "left")
    return out.select(*[f[f"`{c}`"] for c in facts.columns], *[d[t].alias(v) for t, v in zip(tmp_vals, values)])


def left_join_all(
    facts: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Plain left equi-join; a fact matching k dimension rows gives k rows."""
    d = dim.select(
        *[_q(k).alias(f"__lk{i}") for i, k in enumerate(dim_keys)], *[_q(v) for v in values],
        zero_of(dim_keys).alias("__nk"),
    )
    f = facts.withColumn("__nk", null_key_spread(facts, fact_keys))
    conds = [f[f"`{a}`"] == d[f"__lk{i}"] for i, a in enumerate(fact_keys)] + [f["__nk"] == d["__nk"]]
    return f.join(d, conds, "left").select(*[f[f"`{c}`"] for c in facts.columns], *[d[f"`{v}`"] for v in values])


def inner_join(
    facts: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Inner equi-join; misses are dropped, multiple matches fan out."""
    d = dim.select(*[_q(k).alias(f"__lk{i}") for i, k in enumerate(dim_keys)], *[_q(v) for v in values])
    conds = [facts[f"`{a}`"] == d[f"__lk{i}"] for i, a in enumerate(fact_keys)]
    return facts.join(d, conds, "inner").select(*[facts[f"`{c}`"] for c in facts.columns], *[d[f"`{v}`"] for v in values])


def full_join_using(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """FULL OUTER join USING key; the key column is coalesced."""
    return left.join(right, key if isinstance(key, str) else list(key), "full")


def join_chain(first: DataFrame, others: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Inner joins of several tables on one shared key, in order."""
    out = first
    for o in others:
        out = out.join(o, key if isinstance(key, str) else list(key), "inner")
    return out
