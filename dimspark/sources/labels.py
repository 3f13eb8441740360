"""Label text sections -> (code, label) rows.

A label file holds many code lists, each in a section that starts at a
line beginning with a start marker. The section used is the text between
the first line that begins with the start *or* the end marker and the
next such line (both lines excluded); the pair pattern is then applied
to that text, like ``re.findall`` over the joined lines.

Spark plan: label files are read as lines, so a large file is split over
many tasks like any text input, and parsed once: the lines are staged as
Parquet with the block they were read from and a row id. The staged lines
are counted by block, a prefix sum over a file's block counts gives the
number of each block's first line, and with it every line gets its number
in its file. A line's number is a property of the file: it does not depend
on how the scan was split, and later steps read staged numbers and never
scan the text again. The per-block table has one row per input split.

The marker lines are few; one aggregate gives, per file and section, the
numbers of its first two markers, for all sections at once, and that small
table is joined back to the lines. The pairs are then extracted line by
line. Nothing holds a whole file: no row, task, group or driver call sees
more than one line of text.

A pair pattern is applied to each section line with its line break, so
it must not match across lines. The four fixed patterns below each match
within one line (one code per line), which gives the same pairs as
``findall`` over the joined section text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimspark.functions.textfn import regex_pairs
from dimspark.session import scratch_dir

# Label-file sections as (start marker, end marker, pattern
# of one code/label entry), as used for the four code dimensions.
LABEL_SECTIONS = {
    "mode": ("value i94model", "/* I94ADDR", "\t(\\d) = '(.*)'"),
    "visa": ("/* I94VISA", "/* COUNT", "(\\d) = (\\w+)\n"),
    "port": ("/* I94PORT", "/* ARRDATE", "'(.*)'\t=\t'(.*)'"),
    "country": ("/* I94CIT & I94RES", "/* I94PORT", "(\\d{3}) = *'(.*)'"),
}

def read_label_files(spark: SparkSession, paths: str | Sequence[str], staging: str | None = None) -> DataFrame:
    """One row per line of every label file: (file, pos, line), ``pos`` being
    the number of the line in its file, from 0. The lines are staged under
    ``staging`` (default: a new folder under the shared scratch folder)."""
    p = [paths] if isinstance(paths, str) else list(paths)
    staging = staging or scratch_dir(spark, "label_lines")
    parsed = spark.read.text(p).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    parsed.write.mode("overwrite").parquet(f"{staging}/lines")
    lines = spark.read.schema("file string, block long, row long, line string").parquet(f"{staging}/lines")
    number_blocks(lines).write.mode("overwrite").parquet(f"{staging}/blocks")
    blocks = spark.read.schema("file string, block long, shift long").parquet(f"{staging}/blocks")
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("row") + F.col("shift")).alias("pos"), "line")


def number_blocks(lines: DataFrame) -> DataFrame:
    """(file, block, shift): what turns a line's row id into its number in
    the file. Rows of one block are read in file order by one task, so they
    have consecutive ids; a block begins after the lines of those before."""
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("n").over(before), F.lit(0))
    return blocks.select("file", "block", (begin - F.col("first")).alias("shift"))


def text_lines(df: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """(file, pos, line) rows of label text held in a string column, one
    text per row (tests and small inline texts). ``key`` names the column
    that tells texts apart (default: one text in ``df``)."""
    src = F.col(key).cast("string") if key else F.lit("text")
    return df.select(src.alias("file"), F.posexplode(F.split(F.col(text), "\n")).alias("i", "line")).select(
        "file", F.col("i").cast("bigint").alias("pos"), "line"
    )


def _starts(line: Column, prefixes: Sequence[str]) -> Column:
    cond = None
    for p in prefixes:
        c = F.startswith(line, F.lit(p))
        cond = c if cond is None else cond | c
    return cond


def section_ranges(lines: DataFrame, sections: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """(section, file, p0, p1): the numbers of the first two lines of each
    file that begin with a section's start or end marker, for all sections
    in one pass (T19). A file with fewer than two such lines has none."""
    line = F.col("line")
    hits = F.filter(
        F.array(*[F.when(_starts(line, [start, end]), F.lit(name)) for name, (start, end, _) in sections.items()]),
        lambda x: x.isNotNull(),
    )
    marks = lines.where(_starts(line, [m for s in sections.values() for m in s[:2]]))
    marks = marks.select(F.explode(hits).alias("section"), "file", "pos")
    first = marks.groupBy("section", "file").agg(F.min("pos").alias("p0"))
    return (
        marks.join(first, ["section", "file"])
        .where(F.col("pos") > F.col("p0"))
        .groupBy("section", "file")
        .agg(F.min("p0").alias("p0"), F.min("pos").alias("p1"))
    )


def section_lines(lines: DataFrame, sections: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """The (section, file, pos, line) rows strictly between the markers of
    each section of each file."""
    inside = (F.col("pos") > F.col("p0")) & (F.col("pos") < F.col("p1"))
    return lines.join(section_ranges(lines, sections), "file").where(inside).select("section", "file", "pos", "line")


def all_label_pairs(lines: DataFrame, sections: Mapping[str, tuple[str, str, str]] = LABEL_SECTIONS) -> DataFrame:
    """(section, file, pos, code, label) of all sections of every file.

    Each section line is matched with its line break, as in the joined
    text of the file.
    """
    text = F.concat(F.col("line"), F.lit("\n"))
    pairs = None
    for name, (_, _, pattern) in sections.items():
        own = regex_pairs(text, pattern)
        pairs = F.when(F.col("section") == name, own) if pairs is None else pairs.when(F.col("section") == name, own)
    found = section_lines(lines, sections).select("section", "file", "pos", F.explode(pairs).alias("p"))
    return found.select("section", "file", "pos", F.col("p.code").alias("code"), F.col("p.label").alias("label"))


def label_pairs(lines: DataFrame, start: str, end: str, pattern: str, with_file: bool = False) -> DataFrame:
    """(code, label) rows of one section of every file in ``lines``."""
    keep = ["file", "pos"] if with_file else []
    return all_label_pairs(lines, {"section": (start, end, pattern)}).select(*keep, "code", "label")


def named_label_pairs(lines: DataFrame, name: str, with_file: bool = False) -> DataFrame:
    """``label_pairs`` for one of the sections in ``LABEL_SECTIONS``."""
    start, end, pattern = LABEL_SECTIONS[name]
    return label_pairs(lines, start, end, pattern, with_file)
