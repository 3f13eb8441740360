"""Registered queries of the operators, and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimspark.llm import (
    alignment,
    byte_bpe,
    chat,
    decontaminate,
    lm_score,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    sharding,
    substring_dedup,
    token_output,
    toxicity,
)
from dimspark.llm.ship import ship
from dimspark.session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_quality": quality.query,
    "op3_near_dedup": near_dedup.query,
    "op4_token_output": token_output.query,
    "op5_lm_score": lm_score.query,
    "op6_toxicity": toxicity.query,
    "op7_sharding": sharding.query,
    "op8_decontaminate": decontaminate.query,
    "op9_chat_format": chat.query,
    "op10_packing": packing.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_alignment": alignment.query,
    "op13_byte_bpe": byte_bpe.query,
}

# Only what SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op5_lm_score": lm_score.SQL}


def _with_settings(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        ship(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _with_settings(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
