"""Views that lay the driver's tables out in the reference's shapes.

The test tables are TPC-H-like; the reference works on song records and
an activity log. These views rename and derive columns (nothing is
sampled or capped) so every library builder runs over the whole tables:

* ``songs_v`` (song records) from ``part``
* ``plays_v`` (activity log) from lineitem JOIN orders JOIN customer JOIN part
* ``events_log_v`` (activity log) from ``events``

Each view exists twice: as a DataFrame and as a SQL CTE for the DuckDB
oracle. They must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared schemas of the driver tables, as Spark reads them. A scan with a
# declared schema skips the schema-inference job (a footer read) that
# ``spark.read.parquet`` runs otherwise, once per table read.
DRIVER_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = DRIVER_TABLES.get(name)
    return spark.read.schema(ddl).parquet(path) if ddl else spark.read.parquet(path)


# Part names are few; a block of part keys makes a title, so that a bounded
# number of songs share one at any scale factor.
SONGS_PER_TITLE = 8


def _title() -> Column:
    return F.concat_ws(" ", "p_name", (F.col("p_partkey") / SONGS_PER_TITLE).cast("bigint").cast("string"))


TITLE_SQL = f"p_name || ' ' || CAST(p_partkey // {SONGS_PER_TITLE} AS VARCHAR)"


def songs_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("song_id"),
        _title().alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("artist_location"),
        F.col("p_size").cast("double").alias("artist_latitude"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").alias("year"),
    )


SONGS_V_SQL = f"""songs_v AS (
  SELECT p_partkey AS song_id, {TITLE_SQL} AS title, p_brand AS artist_id, p_brand AS artist_name,
         p_type AS artist_location, CAST(p_size AS DOUBLE) AS artist_latitude,
         CAST(NULL AS DOUBLE) AS artist_longitude, p_retailprice AS duration, p_size AS year
  FROM part)"""


def plays_v(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """``parts`` sets the number of parts in which lines and orders are joined
    (without it AQE sizes them, by their compressed bytes)."""
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    if parts is not None:
        l, o = l.repartition(parts, "l_orderkey"), o.repartition(parts, "o_orderkey")
    j = (
        l.join(o, l["l_orderkey"] == o["o_orderkey"])
        .join(c, o["o_custkey"] == c["c_custkey"])
        .join(p, l["l_partkey"] == p["p_partkey"])
    )
    return j.select(
        F.col("p_brand").alias("artist"),
        F.col("c_name").alias("firstName"),
        F.col("l_linestatus").alias("gender"),
        F.col("l_linenumber").alias("itemInSession"),
        F.col("c_mktsegment").alias("lastName"),
        F.col("p_retailprice").alias("length"),
        F.col("o_orderpriority").alias("level"),
        F.col("o_orderstatus").alias("location"),
        # Null-safe test (a NULL flag is 'Home' either way): ``page = 'NextSong'``
        # then simplifies to ``l_returnflag <=> 'N'``, which reaches the scan.
        F.when(F.col("l_returnflag").eqNullSafe("N"), F.lit("NextSong")).otherwise(F.lit("Home")).alias("page"),
        F.col("l_orderkey").alias("sessionId"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string")).otherwise(_title()).alias("song"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_linestatus").alias("userAgent"),
        F.col("o_custkey").alias("userId"),
    )


PLAYS_V_SQL = f"""plays_v AS (
  SELECT p.p_brand AS artist, c.c_name AS firstName, l.l_linestatus AS gender,
         l.l_linenumber AS itemInSession, c.c_mktsegment AS lastName, p.p_retailprice AS length,
         o.o_orderpriority AS level, o.o_orderstatus AS location,
         CASE WHEN l.l_returnflag = 'N' THEN 'NextSong' ELSE 'Home' END AS page,
         l.l_orderkey AS sessionId,
         CASE WHEN l.l_linenumber = 1 THEN NULL ELSE {TITLE_SQL} END AS song,
         l.l_shipdate AS ts, l.l_linestatus AS userAgent, o.o_custkey AS userId
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""


def events_log_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.lit(None).cast("string").alias("artist"),
        F.col("props").alias("firstName"),
        F.lit(None).cast("string").alias("gender"),
        F.col("event_id").alias("itemInSession"),
        F.col("event_type").alias("lastName"),
        F.col("value").alias("length"),
        F.col("event_type").alias("level"),
        F.lit(None).cast("string").alias("location"),
        F.when(F.col("event_type").eqNullSafe("error"), F.lit("Error")).otherwise(F.lit("NextSong")).alias("page"),
        F.col("user_id").alias("sessionId"),
        F.lit(None).cast("string").alias("song"),
        F.col("ts"),
        F.lit(None).cast("string").alias("userAgent"),
        F.col("user_id").alias("userId"),
    )


EVENTS_LOG_V_SQL = """events_log_v AS (
  SELECT CAST(NULL AS VARCHAR) AS artist, props AS firstName, CAST(NULL AS VARCHAR) AS gender,
         event_id AS itemInSession, event_type AS lastName, value AS length, event_type AS level,
         CAST(NULL AS VARCHAR) AS location,
         CASE WHEN event_type = 'error' THEN 'Error' ELSE 'NextSong' END AS page,
         user_id AS sessionId, CAST(NULL AS VARCHAR) AS song, ts,
         CAST(NULL AS VARCHAR) AS userAgent, user_id AS userId
  FROM events)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
