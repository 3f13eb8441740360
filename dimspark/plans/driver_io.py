"""Driver queries that write and read back files (S1-S2, S9, S14, K2, K3, C9, stream).

Files go to a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``), never to a machine-local temp folder. The
returned DataFrame reads the written files back, so the whole round
trip is checked against the oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.operators.surrogate import append_with_key
from dimspark.plans import immigration as im
from dimspark.plans import music, query_tables as qt
from dimspark.plans.driver import (
    ARTISTS_FIRST_SQL,
    LOOKUP_SQL,
    SONGPLAYS_LOOKUP_SQL,
    SONGS_T_SQL,
    USERS_UPSERT_SQL,
    _songplays_lookup,
    _time_sql,
)
from dimspark.plans.driver_tables import EVENT_ROWS_SQL, SONGS_SESSIONS_SQL, SONGS_USERS_SQL, _event_rows
from dimspark.plans.driver_views import PLAYS_V_SQL, SONGS_V_SQL, events_log_v, plays_v, songs_v, table, with_ctes
from dimspark.plans.loads import load_music_warehouse, stage
from dimspark.plans.quality import row_counts
from dimspark.plans.registry import ntz, register
from dimspark.schemas import LOG_SCHEMA, STAGING_EVENTS_MAPPING
from dimspark.session import scratch_dir
from dimspark.sinks.colocated import buckets_for
from dimspark.sinks.folders import delete
from dimspark.sinks.writers import (
    create_database,
    create_table,
    drop_database,
    drop_table,
    insert_into,
    save_bucketed,
    write_clustered,
    write_csv_quoted,
    write_parquet,
)
from dimspark.sources.files import read_json_mapped, read_logs, read_parquet_table, read_table
from dimspark.sources.labels import LABEL_SECTIONS, all_label_pairs, named_label_pairs, read_label_files
from dimspark.sources.staging import clean_strings
from dimspark.streaming.log_stream import read_latest, start_log_stream


@register(
    "parquet_roundtrip",
    "SELECT CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month, "
    "COUNT(*) AS count, COUNT(song_id) AS matched FROM ("
    + SONGPLAYS_LOOKUP_SQL
    + ") GROUP BY 1, 2",
)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + S14: songplays written partitioned by (year, month), read back."""
    sp = _songplays_lookup(spark, sf_dir)
    sp = sp.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    path = scratch_dir(spark, "songplays")
    write_parquet(sp, path, ["year", "month"])
    back = read_parquet_table(spark, path)
    return back.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("count"), F.count("song_id").alias("matched")
    )


@register(
    "csv_roundtrip",
    with_ctes(PLAYS_V_SQL, EVENT_ROWS_SQL)
    + """, r AS (
  SELECT TRY_CAST(CAST(sessionId AS VARCHAR) AS BIGINT) AS session_id,
         TRY_CAST(CAST(itemInSession AS VARCHAR) AS BIGINT) AS item_session,
         artist AS artist_name, song AS song_title,
         TRY_CAST(CAST(length AS VARCHAR) AS FLOAT) AS duration
  FROM ev)
SELECT session_id, item_session, artist_name, song_title, duration FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY session_id, item_session
    ORDER BY artist_name DESC NULLS LAST, song_title DESC NULLS LAST, duration DESC NULLS LAST) AS rn
  FROM r) WHERE rn = 1""",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 K3 S9 P5 + C6: event rows compacted to quoted CSV, read back as
    text, then the session table (last wins; no load order in the CSV,
    so ties go by the row values)."""
    rows = qt.compact_events(_event_rows(spark, sf_dir), positional=False)
    path = scratch_dir(spark, "event_csv")
    write_csv_quoted(rows, path)
    back = qt.read_event_csv(spark, path)
    return qt.songs_sessions(qt.compact_events(back, positional=False), order=["artist"])


def _log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw activity-log records (ts in epoch ms)."""
    logs = events_log_v(spark, sf_dir)
    return logs.select(
        *[F.col(c) for c in logs.columns if c not in ("ts", "userId", "sessionId", "itemInSession")],
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("userId").cast("string").alias("userId"),
        F.col("sessionId").cast("bigint").alias("sessionId"),
        F.col("itemInSession").cast("bigint").alias("itemInSession"),
    )


@register("json_time_dim", _time_sql("CAST(dayofweek(start_time) AS INTEGER)"))
def json_time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + T2 + C4: log JSON (ms epoch) read with the declared schema,
    time dimension built from it."""
    path = scratch_dir(spark, "log_json")
    _log_json(spark, sf_dir).write.json(path)
    return ntz(music.build_time(read_logs(spark, path), "number"), "start_time")


# An availableNow stream stops by itself once the files present are loaded;
# this bound only turns a stuck stream into an error.
STREAM_TIMEOUT_SEC = 1800


@register("stream_users", USERS_UPSERT_SQL)
def stream_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.10: log files arrive in three deliveries, in time order; after
    each the stream loads what is new and stops. The users table after the
    last one equals the one-shot upsert."""
    src, target = scratch_dir(spark, "log_json"), scratch_dir(spark, "stream_tables")
    ckpt, raw = scratch_dir(spark, "stream_ckpt"), _log_json(spark, sf_dir)
    first, second = (F.unix_millis(F.lit(d).cast("timestamp")) for d in ("2024-01-11", "2024-01-21"))
    late = F.coalesce(F.col("ts"), F.lit(0)) >= second
    for part in (F.coalesce(F.col("ts"), F.lit(0)) < first, (F.col("ts") >= first) & ~late, late):
        raw.where(part).write.mode("append").json(src)
        q = start_log_stream(spark, src, target, ckpt)
        if not q.awaitTermination(STREAM_TIMEOUT_SEC):
            q.stop()
            raise TimeoutError(f"log stream did not finish within {STREAM_TIMEOUT_SEC} s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_latest(spark, f"{target}/users")


@register(
    "warehouse_incremental",
    with_ctes(PLAYS_V_SQL)
    + """, p AS (SELECT * FROM plays_v WHERE page = 'NextSong' AND itemInSession <> 2)
SELECT 'songs' AS "table", COUNT(DISTINCT p_partkey) AS count FROM part
UNION ALL SELECT 'artists', COUNT(DISTINCT p_brand) FROM part
UNION ALL SELECT 'users', COUNT(DISTINCT userId) FROM p
UNION ALL SELECT 'time', COUNT(DISTINCT date_trunc('second', ts)) FROM plays_v WHERE page = 'NextSong'
UNION ALL SELECT 'songplays', COUNT(*) FROM p""",
)
def warehouse_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 (S7 K4 K5 K11 K12 J7 Q4): three warehouse loads on versioned tables.

    Load 1 stages the log before 1997, loads 2 and 3 the whole log. The
    second item of every session has no user (NULL). Every play with a
    user is stored once: also the later plays of sessions stored by load
    1, and none twice by load 3.
    """
    root = scratch_dir(spark, "warehouse")
    logs = stage(plays_v(spark, sf_dir), f"{root}/_log")  # joined once for the three loads
    logs = logs.withColumn("userId", F.when(F.col("itemInSession") != 2, F.col("userId")))
    songs = songs_v(spark, sf_dir)
    cut = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    for staged in (logs.where(F.col("ts") < cut), logs, logs):
        load_music_warehouse(spark, staged, songs, root)
    names = ["songs", "artists", "users", "time", "songplays"]
    return row_counts({n: read_latest(spark, f"{root}/{n}") for n in names})


# Staged plays for the reload query. Of every order's lines: the third has
# no item number, the fourth no session, the fifth no start time, the sixth
# no user; the first three are staged twice in one batch. Its SQL counts
# every valid play once, with NULL items equal.
RELOAD_SQL = with_ctes(SONGS_V_SQL, PLAYS_V_SQL, SONGS_T_SQL, ARTISTS_FIRST_SQL, LOOKUP_SQL) + """,
staged AS (SELECT CASE WHEN itemInSession <> 3 THEN itemInSession END AS item, sessionId, date_trunc('second', ts) AS t,
                  userId, level, location, userAgent, song, artist, length
           FROM plays_v WHERE page = 'NextSong' AND itemInSession NOT IN (4, 5, 6)),
once AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY userId, sessionId, item, t
           ORDER BY level NULLS FIRST, location NULLS FIRST, userAgent NULLS FIRST, song NULLS FIRST,
                    artist NULLS FIRST, length NULLS FIRST) AS rn FROM staged) WHERE rn = 1)
SELECT s.userId AS user_id, s.sessionId AS session_id, CAST(s.item AS BIGINT) AS item_in_session, s.t AS start_time,
       s.level, lk.song_id, lk.artist_id
FROM once s
LEFT JOIN lk ON s.song = lk.title AND s.artist = lk.name AND s.length = lk.duration"""


@register("warehouse_reloads", RELOAD_SQL)
def warehouse_reloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of overlapping, repeated and incomplete plays
    into the fact partitioned by (year, month). Load 1 stages the log before
    1997, load 2 all of it, load 3 all of it again."""
    root, songs = scratch_dir(spark, "reloads"), songs_v(spark, sf_dir)
    p = stage(plays_v(spark, sf_dir), f"{root}/_log")  # joined once for the three loads
    line = F.col("itemInSession")
    logs = p.withColumns(
        {
            "itemInSession": F.when(line != 3, line),
            "sessionId": F.when(line != 4, F.col("sessionId")),
            "ts": F.when(line != 5, F.col("ts")),
            "userId": F.when(line != 6, F.col("userId")),
            "__times": F.when(line <= 3, 2).otherwise(1),
        }
    )
    logs = logs.withColumn("__times", F.explode(F.sequence(F.lit(1), "__times"))).drop("__times")
    cut = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    for staged in (logs.where(F.col("ts") < cut), logs, logs):
        load_music_warehouse(spark, staged, songs, root)
    fact = read_latest(spark, f"{root}/songplays")
    names = ["user_id", "session_id", "item_in_session", "start_time", "level", "song_id", "artist_id"]
    return ntz(fact.select(*names), "start_time")


@register(
    "increasing_key",
    """SELECT ROW_NUMBER() OVER (ORDER BY (l_shipdate >= TIMESTAMP '1997-01-01') NULLS FIRST, l_shipdate NULLS FIRST,
         l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST) AS play_id,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem""",
)
def increasing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: all line items numbered 1 to n over two loads (before 1997, and
    after), each in the order of its date, order and line; the second load
    is written twice under its id, as after a failure."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    root, order = scratch_dir(spark, "keyed"), ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    late = F.coalesce(F.col("l_shipdate") >= F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"), F.lit(False))
    append_with_key(spark, rows.where(~late), root, "play_id", order, load=0)
    for _ in range(2):
        append_with_key(spark, rows.where(late), root, "play_id", order, load=1)
    return read_latest(spark, root)


@register(
    "session_item_stored",
    "SELECT artist_name, song_title, duration FROM (" + SONGS_SESSIONS_SQL + ") WHERE session_id = 6930 AND item_session = 2",
)
def session_item_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 on the stored table (K14 O5 F7): written range-clustered by
    (session_id, item_session), read back; the lookup filter is pushed to
    the Parquet scan and skips row groups by min/max statistics."""
    t = qt.songs_sessions(_event_rows(spark, sf_dir), order=["ts"])
    path = scratch_dir(spark, "songs_sessions")
    write_clustered(t, path, ["session_id"], ["item_session"])
    return qt.session_item(spark.read.parquet(path), 6930, 2)


@register(
    "user_history_bucketed",
    "SELECT item_session, artist_name, song_title, first_name, last_name FROM ("
    + SONGS_USERS_SQL
    + ") WHERE user_id = 681 AND session_id = 1046 ORDER BY item_session",
)
def user_history_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on a bucketed table (K14): bucketed by the user, as many buckets as
    its size asks for, so that a lookup reads one, sorted by session and item.
    Lines are joined in as many parts, and dealt by the user before the rows
    of a key are reduced: a task joins, reduces or writes one part, whose
    size the number of buckets bounds."""
    lines = table(spark, sf_dir, "lineitem").count()
    n = buckets_for(qt.songs_users(_event_rows(spark, sf_dir), order=["ts"]), bucket_bytes=64 << 20, least=8, rows=lines)
    t = qt.songs_users(_event_rows(spark, sf_dir, parts=n), order=["ts"], buckets=n)
    name = "songs_users_" + uuid.uuid4().hex[:12]
    save_bucketed(t, name, n, ["user_id"], ["session_id", "item_session"], path=scratch_dir(spark, name))
    return qt.user_session_history(spark.table(name), 681, 1046)


# ------------------------------------------------------------ label text files

# Label files written from ``customer``: one file per block of 5,000 customer
# keys (the key is unique, so no file grows with skew), with the four
# sections in their own layouts. Before, between and after the sections
# stand lines that look like entries of another one, and the country section
# is opened again at the end: none of these may come out. A customer with a
# negative balance gets an entry that the section's pattern skips.
LABEL_BLOCK = 5000


def _label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, k1, k2, line): k1 numbers the parts of a file, k2 the customers."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_name", "c_mktsegment", (F.col("c_acctbal") >= 0).alias("good"),
        (F.col("c_custkey") / LABEL_BLOCK).cast("bigint").alias("grp"),
    )
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    code, digit = F.format_string("%03d", F.col("c_nationkey")), (F.col("c_custkey") % 10).cast("string")
    lines = {
        1: F.format_string("%s =  '%s (before)'", code, name),
        3: F.when(F.col("good"), F.format_string("%s =  '%s'", code, name)).otherwise(F.format_string("%s = %s", code, name)),
        5: F.when(F.col("good"), F.format_string("'%s'\t=\t'%s, %s   '", digit, name, code)).otherwise(
            F.format_string("%s =  '%s (after)'", code, name)
        ),
        7: F.format_string("\t%s = '%s (between)'", digit, segment),
        9: F.when(F.col("good"), F.format_string("\t%s = '%s'", digit, segment)).otherwise(
            F.format_string("\t%s = %s", digit, segment)
        ),
        12: F.when(F.col("good"), F.format_string("   %s = %s", digit, segment)).otherwise(
            F.format_string("   %s = %s ", digit, segment)
        ),
        14: F.format_string("   %s = %s", digit, name),
        16: F.format_string("%s =  '%s (repeated)'", code, name),
    }
    entry = [F.struct(F.lit(k).alias("k1"), F.col("c_custkey").alias("k2"), line.alias("line")) for k, line in lines.items()]
    entries = c.select("grp", F.explode(F.array(*entry)).alias("e"))
    marker = {0: "/* Label descriptions", 15: LABEL_SECTIONS["country"][0]}
    for k, section in ((2, "country"), (4, "port"), (8, "mode"), (11, "visa")):
        marker[k] = LABEL_SECTIONS[section][0]
    marker |= {6: LABEL_SECTIONS["port"][1], 10: LABEL_SECTIONS["mode"][1], 13: LABEL_SECTIONS["visa"][1]}
    heads = [
        F.struct(F.lit(k).alias("k1"), F.lit(0).cast("bigint").alias("k2"),
                 F.concat(F.lit(f"{text} - block "), F.col("grp").cast("string"), F.lit(" */")).alias("line"))
        for k, text in marker.items()
    ]
    markers = c.select("grp").distinct().select("grp", F.explode(F.array(*heads)).alias("e"))
    return entries.unionByName(markers).select("grp", "e.k1", "e.k2", "e.line")


LABEL_PAIRS_SQL = f"""lab AS (
  SELECT c_custkey // {LABEL_BLOCK} AS block, printf('%03d', c_nationkey) AS code, c_name AS label,
         CAST(c_custkey % 10 AS VARCHAR) AS digit, c_mktsegment AS segment,
         c_name || ', ' || printf('%03d', c_nationkey) || '   ' AS port
  FROM customer WHERE c_acctbal >= 0)"""


def _labels_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the label files, written and read back."""
    path = scratch_dir(spark, "label_text")
    # One task per block (repartition by the block), lines in file order;
    # the partitioned writer then puts each block in a file of its own.
    (
        _label_text(spark, sf_dir)
        .repartition("grp")
        .sortWithinPartitions("grp", "k1", "k2")
        .select("grp", "line")
        .write.partitionBy("grp")
        .text(path)
    )
    lines = read_label_files(spark, path)
    delete(spark, path)
    return lines


def _block(pairs: DataFrame, *columns: str) -> DataFrame:
    return pairs.select(F.regexp_extract("file", r"grp=(\d+)", 1).cast("bigint").alias("block"), *columns)


@register("label_sections", with_ctes(LABEL_PAIRS_SQL) + "SELECT block, code, label FROM lab")
def label_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S13 T14 T19 (H1): label text files written from the customer table,
    read back line by line; the country section of every file (between its
    first two marker lines) gives the (code, label) pairs."""
    return _block(named_label_pairs(_labels_written(spark, sf_dir), "country", with_file=True), "code", "label")


@register(
    "label_all_sections",
    with_ctes(LABEL_PAIRS_SQL)
    + """SELECT block, 'country' AS section, code, label FROM lab
UNION ALL SELECT block, 'port', digit, port FROM lab
UNION ALL SELECT block, 'mode', digit, segment FROM lab
UNION ALL SELECT block, 'visa', digit, segment FROM lab""",
)
def label_all_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four sections of every file, from one parse and in
    one pass over the numbered lines."""
    return _block(all_label_pairs(_labels_written(spark, sf_dir)), "section", "code", "label")


def _code_dim_sql(id_name: str, code: str, name: str, label: str) -> str:
    return with_ctes(LABEL_PAIRS_SQL) + f"""SELECT {id_name}, {name} FROM (
  SELECT TRY_CAST({code} AS INTEGER) AS {id_name}, {label} AS {name},
         ROW_NUMBER() OVER (PARTITION BY TRY_CAST({code} AS INTEGER) ORDER BY {label}) AS rn FROM lab)
WHERE rn = 1"""


def _code_dim(spark: SparkSession, sf_dir: str, section: str) -> DataFrame:
    pairs = named_label_pairs(_labels_written(spark, sf_dir), section)
    return im.build_code_dim(pairs, f"{section}_id", section)


@register("label_country_dim", _code_dim_sql("country_id", "code", "country", "label"))
def label_country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 (S13 P9 A5): DIM_country from the written label files, one row
    per integer code (first label in label order)."""
    return _code_dim(spark, sf_dir, "country")


@register("label_mode_dim", _code_dim_sql("mode_id", "digit", "mode", "segment"))
def label_mode_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 (S13 P9 A5): DIM_mode from the mode section."""
    return _code_dim(spark, sf_dir, "mode")


@register("label_visa_dim", _code_dim_sql("visa_id", "digit", "visa", "segment"))
def label_visa_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 (S13 P9 A5): DIM_visa from the visa section."""
    return _code_dim(spark, sf_dir, "visa")


@register(
    "label_port_list",
    with_ctes(LABEL_PAIRS_SQL) + "SELECT digit AS port_id, rtrim(port) AS airport FROM lab",
)
def label_port_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11 (S13 T15): the port list from the port section, labels trimmed on
    the right."""
    return im.port_list(named_label_pairs(_labels_written(spark, sf_dir), "port"))


# ------------------------------------------------- staging load, raw event CSV


@register(
    "staged_events_mapped",
    """SELECT CAST(NULL AS VARCHAR) AS artist, CAST(NULL AS VARCHAR) AS auth,
       CASE WHEN trim(props) <> '' THEN props END AS firstname, CAST(NULL AS VARCHAR) AS gender,
       CAST(event_id AS BIGINT) AS iteminsession,
       CASE WHEN trim(event_type) <> '' THEN event_type END AS lastname, value AS length,
       CASE WHEN trim(event_type) <> '' THEN event_type END AS level, CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS VARCHAR) AS method, CASE WHEN event_type = 'error' THEN 'Error' ELSE 'NextSong' END AS page,
       CAST(NULL AS DOUBLE) AS registration, CAST(user_id AS BIGINT) AS sessionid, CAST(NULL AS VARCHAR) AS song,
       CAST(NULL AS INTEGER) AS status, date_trunc('millisecond', ts) AS ts, CAST(NULL AS VARCHAR) AS useragent,
       CAST(user_id AS VARCHAR) AS userid
FROM events""",
)
def staged_events_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as JSON lines (ts in epoch ms) bulk-loaded into
    the staging table: fields matched through the mapping, ts read as a
    millisecond timestamp, blank text as NULL."""
    src = scratch_dir(spark, "log_json")
    _log_json(spark, sf_dir).write.json(src)
    staged = clean_strings(read_json_mapped(spark, src, LOG_SCHEMA, STAGING_EVENTS_MAPPING, epoch_ms=["ts"]))
    return ntz(staged, "ts")


# The columns of a raw event CSV file, in file order.
RAW_EVENT_FIELDS = [
    "artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
    "method", "page", "registration", "sessionId", "song", "status", "ts", "userId",
]


def _raw_event_csv(spark: SparkSession, sf_dir: str) -> str:
    """The activity log as raw 17-column event CSV files with a header, in
    two folders (song plays and other pages); other pages have no artist."""
    p = plays_v(spark, sf_dir)
    play = F.col("page") == "NextSong"
    raw = p.select(
        F.when(play, F.col("artist")).alias("artist"),
        F.lit("Logged In").alias("auth"),
        "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
        F.lit("PUT").alias("method"),
        "page",
        F.lit(None).cast("double").alias("registration"),
        "sessionId", "song",
        F.lit(200).alias("status"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        "userId",
    ).select(*RAW_EVENT_FIELDS)
    root = scratch_dir(spark, "event_data")
    kind = F.when(play, F.lit("plays")).otherwise(F.lit("other")).alias("kind")
    raw = raw.select("*", kind).hint("rebalance", "kind")
    raw.write.partitionBy("kind").option("header", True).csv(root)
    return root


@register(
    "event_csv_positional",
    with_ctes(PLAYS_V_SQL)
    + """SELECT artist, firstName, gender, CAST(itemInSession AS VARCHAR) AS itemInSession, lastName,
       CAST(length AS VARCHAR) AS length, level, location, CAST(sessionId AS VARCHAR) AS sessionId, song,
       CAST(userId AS VARCHAR) AS userId
FROM plays_v WHERE page = 'NextSong'""",
)
def event_csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 (S9 P5 F6 K3 U1): raw event CSV files of two folders read in one
    scan, 11 columns picked by position, rows without an artist dropped,
    written as one quoted CSV table and read back (all text)."""
    raw = qt.read_event_csv(spark, _raw_event_csv(spark, sf_dir))
    compact = qt.compact_events(raw, positional=True)
    out = scratch_dir(spark, "event_datafile_new")
    write_csv_quoted(compact, out)
    return qt.read_event_csv(spark, out)


# ------------------------------------------------------------ catalog tables


def _new_database(spark: SparkSession) -> str:
    """A fresh database whose folder is under the shared checkpoint folder."""
    name = "dw_" + uuid.uuid4().hex[:12]
    create_database(spark, name, scratch_dir(spark, name))
    return name


def _read_and_drop(spark: SparkSession, db: str, sql: str) -> DataFrame:
    """The result of a SQL text, kept; the database is dropped."""
    out = stage(read_table(spark, sql), scratch_dir(spark, "catalog_result"))
    drop_database(spark, db)
    return out


@register("catalog_users", USERS_UPSERT_SQL)
def catalog_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users table created from its DDL, loaded twice with
    truncate-then-insert (the second load replaces the first), read back
    by SQL; the database is dropped at the end."""
    db = _new_database(spark)
    create_table(spark, f"{db}.users")
    logs = events_log_v(spark, sf_dir)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    insert_into(music.build_users(logs.where(F.col("ts") < cut), "upsert"), f"{db}.users", truncate=True)
    insert_into(music.build_users(logs, "upsert"), f"{db}.users", truncate=True)
    return _read_and_drop(spark, db, f"SELECT user_id, first_name, last_name, gender, level FROM {db}.users")


@register("catalog_time", _time_sql("CAST(dayofweek(start_time) AS INTEGER)"))
def catalog_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time table created from its DDL (partitioned by year and
    month), loaded by two appends (log before and after a cut; their start
    times are disjoint), read back by SQL; the database is dropped."""
    db = _new_database(spark)
    create_table(spark, f"{db}.time")
    logs = events_log_v(spark, sf_dir)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    insert_into(music.build_time(logs.where(F.col("ts") < cut), "number"), f"{db}.time")
    insert_into(music.build_time(logs.where(F.col("ts") >= cut), "number"), f"{db}.time")
    t = _read_and_drop(spark, db, f"SELECT start_time, hour, day, week, month, year, weekday FROM {db}.time")
    return ntz(t, "start_time")


@register("catalog_recreate", USERS_UPSERT_SQL)
def catalog_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a table that is dropped and created again from its DDL is empty:
    what was loaded before the drop (every event's user under another id)
    is gone. Dropping a table that is not there is no error."""
    db = _new_database(spark)
    logs = events_log_v(spark, sf_dir)
    drop_table(spark, f"{db}.users")
    create_table(spark, f"{db}.users")
    insert_into(music.build_users(logs.withColumn("userId", F.col("userId") + 1_000_000), "upsert"), f"{db}.users")
    drop_table(spark, f"{db}.users")
    create_table(spark, f"{db}.users")
    insert_into(music.build_users(logs, "upsert"), f"{db}.users")
    return _read_and_drop(spark, db, f"SELECT user_id, first_name, last_name, gender, level FROM {db}.users")
