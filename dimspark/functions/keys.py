"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimspark.functions.common import as_col


def concat_text(*cols) -> Column:
    """``a || b`` with each side cast to text; NULL if any is NULL."""
    return F.concat(*[as_col(c).cast("string") for c in cols])


def md5_key(*cols) -> Column:
    """Deterministic hash key ``md5(a || b || ...)``.

    Repeatable across runs and engines (same digest as the SQL form for
    whole-second timestamps), unlike a generated sequence.
    """
    return F.md5(concat_text(*cols))


def increasing_id() -> Column:
    """K9: unique, increasing, not repeatable between runs."""
    return F.monotonically_increasing_id()
