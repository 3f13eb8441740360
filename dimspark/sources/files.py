"""File sources.

All readers take a directory (or several) and read every matching file
in one distributed scan; nothing walks files on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.schemas import LOG_SCHEMA, SONG_SCHEMA

Paths = str | Sequence[str]


def _paths(p: Paths) -> list[str]:
    return [p] if isinstance(p, str) else list(p)


def read_json_dir(spark: SparkSession, paths: Paths, schema: T.StructType | None = None, glob: str = "*.json") -> DataFrame:
    """Every ``glob`` file below ``paths``, at any depth, one scan.

    With ``schema`` no inference pass is made (S1, S2).
    """
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    return r.json(_paths(paths))


def read_songs(spark: SparkSession, paths: Paths, glob: str = "*.json") -> DataFrame:
    """Song records with the declared schema."""
    return read_json_dir(spark, paths, SONG_SCHEMA, glob)


def read_logs(spark: SparkSession, paths: Paths, glob: str = "*.json") -> DataFrame:
    """Activity log records with the declared 18-column schema."""
    return read_json_dir(spark, paths, LOG_SCHEMA, glob)


def read_json_mapped(
    spark: SparkSession,
    paths: Paths,
    schema: T.StructType,
    mapping: Mapping[str, str],
    epoch_ms: Sequence[str] = (),
) -> DataFrame:
    """Bulk staging load with a field mapping.

    ``mapping`` gives, in target order, target column -> JSON field (the
    role of a JSON-paths file); fields are matched by name (``'auto'``
    when target and field names agree). Columns in ``epoch_ms`` are read
    as milliseconds since the epoch into timestamps.
    """
    df = read_json_dir(spark, paths, schema)
    cols = []
    for target, field in mapping.items():
        c = F.col(f"`{field}`")
        if target in epoch_ms:
            c = F.timestamp_millis(c.cast("long"))
        cols.append(c.alias(target))
    return df.select(*cols)


def read_csv_dir(
    spark: SparkSession,
    paths: Paths,
    sep: str = ",",
    schema: T.StructType | None = None,
    glob: str = "*.csv",
) -> DataFrame:
    """CSV files with a header line, any separator, all in one scan.

    Without ``schema`` every column is text (no inference pass).
    """
    r = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    if schema is not None:
        r = r.schema(schema)
    return r.csv(_paths(paths))


def read_records(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> DataFrame:
    """Typed immigration records (Parquet or CSV with a header)."""
    if fmt == "parquet":
        return spark.read.parquet(*_paths(paths))
    if fmt == "csv":
        return read_csv_dir(spark, paths)
    raise ValueError(fmt)


def read_parquet_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read back a (partitioned) Parquet table; partition columns come last."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_table(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A catalog table by name, or the result of a SQL query."""
    text = name_or_sql.strip()
    if " " in text:
        return spark.sql(text)
    return spark.table(text)
