"""Casts and renames.

Spark 4 runs with ANSI mode on: ``cast('x' as int)`` raises. Text read
from CSV or JSON goes through ``try_cast`` so a bad value becomes NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.functions.common import as_col


def try_cast(c, to: str) -> Column:
    """Cast that yields NULL instead of failing."""
    return as_col(c).try_cast(to)


def cast_type_columns(
    df: DataFrame, from_type: str = "double", to: str = "int", wide: Iterable[str] = (), wide_to: str = "bigint"
) -> DataFrame:
    """P10: cast every column whose type is ``from_type`` to ``to``.

    One ``select`` built from ``df.dtypes``; doubles are cut towards zero.
    Columns named in ``wide`` (identifiers that may pass 2^31) go to
    ``wide_to`` instead, so they are never cut to NULL.
    """
    wide = set(wide)

    def target(name: str) -> str:
        return wide_to if name in wide else to

    return df.select(
        [
            (try_cast(F.col(f"`{name}`"), target(name)) if dtype == from_type else F.col(f"`{name}`")).alias(name)
            for name, dtype in df.dtypes
        ]
    )


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns named in ``names``, in its order, under their new names."""
    return df.selectExpr(*(f"`{old}` AS `{new}`" for old, new in names.items()))


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename in place, other columns untouched."""
    return df.withColumnsRenamed(dict(renames))


def as_id(df: DataFrame, name: str) -> Column:
    """A whole-number id column as bigint. Text is cast with NULL for what is
    no number; a number is cast directly, so that a filter on the id still
    reaches the scan."""
    c = F.col(f"`{name}`")
    return c.try_cast("bigint") if dict(df.dtypes)[name] == "string" else c.cast("bigint")
