"""A corpus pipeline: toxicity, near duplicates, repeated passages,
benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor
kept; its result is written as Parquet and read again as the next one's
docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.llm import decontaminate, near_dedup, packing, substring_dedup, toxicity
from dimspark.llm.ship import ship
from dimspark.session import apply_runtime_conf, scratch_dir
from dimspark.sinks.folders import delete

PASSAGE_WORDS = 50  # passages that repeat are cut from this length on

# Columns of the stages' own, under names that no column of a user has.
SCORE, WORDS, REMOVED = "__dimspark_toxicity", "__dimspark_words", "__dimspark_removed"

_finished: list = []  # chunk tables of stages whose results have been written


def _ready(spark: SparkSession) -> None:
    apply_runtime_conf(spark)
    ship(spark)
    while _finished:  # a stage begins: the one before has been written
        _finished.pop().drop()


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 1/2 stay, with their columns as they are. A
    null or empty text is scored as one without words; rows of one text have
    one score; of an empty table nothing is left."""
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs, model, score_col=SCORE)
    return scored.where(F.col(SCORE) < 0.5).drop(SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group (five-word shingles, similarity 0.8) the least id stays,
    of equal ids the least text. Texts without a word are in no group: of
    those one row for each id and text stays, and rows without an id all do."""
    _ready(spark)
    return near_dedup.keep_one(docs, shingle=5, percent=80, bands=32, rows=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier place too (a smaller id, or earlier
    in the text) are cut out; ``n_chars`` is then the new length. A text
    without a repeat, a null and an empty one stay as they are, and a text
    that loses all its words stays as an empty one."""
    _ready(spark)
    cut, stored = substring_dedup.remove_repeats(docs, window=PASSAGE_WORDS, words_col=WORDS, removed_col=REMOVED)
    _finished.append(stored)
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.when(F.col(REMOVED) > 0, size).otherwise(F.col("n_chars"))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item stay, as
    they are; texts without words hold none. With an empty benchmark all
    stay."""
    _ready(spark)
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 ids, dealt into sequences. A null or empty text
    is a piece of the end id alone; rows of one id are pieces of their own."""
    _ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# A trained model and a tokenizer decide: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to packed sequences. What a stage wrote
    is deleted once the next one has been written; the last result stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
