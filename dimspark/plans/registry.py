"""Registry of driver queries and their DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None):
    """Register ``fn`` as query ``name``; ``sql`` is its oracle (or None)."""

    def deco(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = (run, sql)
        return fn

    return deco


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps out as TIMESTAMP_NTZ: collected values then do not depend
    on the Python process time zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
