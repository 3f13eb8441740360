"""S9-S11 with bad rows: a CSV scan that sets unreadable records apart.

A record is bad if it has too few or too many fields, or a field that does
not fit its column's type. The files are scanned once: every record is
staged with what was read of it, good ones and bad ones in folders of
their own, and both are counted while they are written. Bad records keep
their text and the file they came from.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.plans.quality import DataQualityError
from dimspark.session import scratch_dir

RECORD = "__record"


@dataclass
class CheckedCsv:
    """good: the rows of the schema; bad: (file, record)."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int

    def require(self, max_bad: int = 0) -> DataFrame:
        """The good rows, if no more than max_bad records are bad."""
        if self.n_bad > max_bad:
            raise DataQualityError(f"{self.n_bad} of {self.n_bad + self.n_good} CSV records are bad")
        return self.good


def read_csv_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    glob: str = "*.csv",
    multi_line: bool = False,
    staging: str | None = None,
) -> CheckedCsv:
    """Read all files with the schema and stage what was read. ``multi_line``
    allows line breaks inside quotes (such a file is then one task's)."""
    staging = staging or scratch_dir(spark, "checked_csv")
    seen = Observation()
    read = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())]))
        .option("header", header)
        .option("sep", sep)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", False)  # a record is judged whole, whatever columns are used
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    bad = F.col(RECORD).isNotNull()
    judged = read.select("*", F.col("_metadata.file_path").alias("__file"), bad.alias("__bad"))
    judged = judged.observe(seen, F.count_if(F.col("__bad")).alias("bad"), F.count_if(~F.col("__bad")).alias("good"))
    judged.write.mode("overwrite").partitionBy("__bad").parquet(staging)
    kept = T.StructType([*schema.fields, *(T.StructField(n, T.StringType()) for n in (RECORD, "__file"))])
    stored = spark.read.schema(kept.add("__bad", T.BooleanType())).parquet(staging)
    good = stored.where(~F.col("__bad")).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    wrong = stored.where(F.col("__bad")).select(F.col("__file").alias("file"), F.col(RECORD).alias("record"))
    counts = seen.get
    return CheckedCsv(good, wrong, int(counts["good"]), int(counts["bad"]))
