"""Driver queries: query-first tables, keyed loads, keys and checks.

C6-C8 (K13, F7, O1), J4, J7, K10, A11/Q1-Q4, O2, over the whole driver
tables (see ``driver_views``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.functions.keys import md5_key
from dimspark.functions.timefn import cut_to_second
from dimspark.operators.dedupe import keep_last
from dimspark.operators.lookup import full_join_using
from dimspark.operators.upsert import skip_loaded
from dimspark.plans import music, query_tables as qt
from dimspark.plans.driver import (
    ARTISTS_FIRST_SQL,
    LOOKUP_SQL,
    PLAYS_SQL,
    SONGPLAYS_LOOKUP_SQL,
    SONGS_T_SQL,
    _songplays_lookup,
)
from dimspark.plans.driver_views import PLAYS_V_SQL, SONGS_V_SQL, plays_v, songs_v, table, with_ctes
from dimspark.plans.loads import stage_counted
from dimspark.plans.quality import counts_frame, duplicate_keys, null_counts
from dimspark.plans.registry import register
from dimspark.session import scratch_dir
from dimspark.sinks.folders import delete

# ------------------------------------------------------- query-first tables


def _event_rows(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Event rows that have an artist (the C9 filter), with ts for ordering."""
    p = plays_v(spark, sf_dir, parts)
    return p.where(F.col("artist").isNotNull() & (F.col("artist") != ""))


EVENT_ROWS_SQL = """ev AS (SELECT * FROM plays_v WHERE artist IS NOT NULL AND artist <> '')"""

SONGS_SESSIONS_SQL = (
    with_ctes(PLAYS_V_SQL, EVENT_ROWS_SQL)
    + """, r AS (
  SELECT TRY_CAST(CAST(sessionId AS VARCHAR) AS BIGINT) AS session_id,
         TRY_CAST(CAST(itemInSession AS VARCHAR) AS BIGINT) AS item_session,
         artist AS artist_name, song AS song_title,
         TRY_CAST(CAST(length AS VARCHAR) AS FLOAT) AS duration, ts
  FROM ev)
SELECT session_id, item_session, artist_name, song_title, duration FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY session_id, item_session
    ORDER BY ts DESC NULLS LAST, artist_name DESC NULLS LAST, song_title DESC NULLS LAST,
             duration DESC NULLS LAST) AS rn
  FROM r) WHERE rn = 1"""
)

SONGS_USERS_SQL = (
    with_ctes(PLAYS_V_SQL, EVENT_ROWS_SQL)
    + """, r AS (
  SELECT TRY_CAST(CAST(userId AS VARCHAR) AS BIGINT) AS user_id,
         TRY_CAST(CAST(sessionId AS VARCHAR) AS BIGINT) AS session_id,
         TRY_CAST(CAST(itemInSession AS VARCHAR) AS BIGINT) AS item_session,
         firstName AS first_name, lastName AS last_name, artist AS artist_name, song AS song_title, ts
  FROM ev)
SELECT user_id, session_id, item_session, first_name, last_name, artist_name, song_title FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, session_id, item_session
    ORDER BY ts DESC NULLS LAST, first_name DESC NULLS LAST, last_name DESC NULLS LAST,
             artist_name DESC NULLS LAST, song_title DESC NULLS LAST) AS rn
  FROM r) WHERE rn = 1"""
)

MUSIC_HIST_SQL = (
    with_ctes(PLAYS_V_SQL, EVENT_ROWS_SQL)
    + """, r AS (
  SELECT song AS song_title, TRY_CAST(CAST(userId AS VARCHAR) AS BIGINT) AS user_id,
         firstName AS first_name, lastName AS last_name, ts
  FROM ev)
SELECT song_title, user_id, first_name, last_name FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY song_title, user_id
    ORDER BY ts DESC NULLS LAST, first_name DESC NULLS LAST, last_name DESC NULLS LAST) AS rn
  FROM r) WHERE rn = 1"""
)


@register("songs_sessions_table", SONGS_SESSIONS_SQL)
def songs_sessions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 table, K13: PRIMARY KEY (session_id, item_session), last write wins."""
    return qt.songs_sessions(_event_rows(spark, sf_dir), order=["ts"])


@register(
    "session_item_lookup",
    "SELECT artist_name, song_title, duration FROM (" + SONGS_SESSIONS_SQL + ") WHERE session_id = 6930 AND item_session = 2",
)
def session_item_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 query (F7): artist, title, length at session 6930, item 2."""
    return qt.session_item(qt.songs_sessions(_event_rows(spark, sf_dir), order=["ts"]), 6930, 2)


@register("songs_users_table", SONGS_USERS_SQL)
def songs_users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 table, K13: PRIMARY KEY ((user_id, session_id), item_session)."""
    return qt.songs_users(_event_rows(spark, sf_dir), order=["ts"])


@register(
    "user_session_history",
    "SELECT item_session, artist_name, song_title, first_name, last_name FROM ("
    + SONGS_USERS_SQL
    + ") WHERE user_id = 681 AND session_id = 1046 ORDER BY item_session",
)
def user_session_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 query (F7, O1): one user session, ordered by item."""
    return qt.user_session_history(qt.songs_users(_event_rows(spark, sf_dir), order=["ts"]), 681, 1046)


@register("music_hist_table", MUSIC_HIST_SQL)
def music_hist_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 table, K13: PRIMARY KEY (song_title, user_id)."""
    return qt.music_hist(_event_rows(spark, sf_dir), order=["ts"])


@register(
    "title_listeners",
    "SELECT user_id, first_name, last_name FROM (" + MUSIC_HIST_SQL + ") WHERE song_title = 'blue gear 1'",
)
def title_listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 query (F7): every listener of one title, once per user."""
    return qt.song_listeners(qt.music_hist(_event_rows(spark, sf_dir), order=["ts"]), "blue gear 1")


# ------------------------------------------------------------- keyed loads


@register(
    "pk_last_wins",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
    ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""",
)
def pk_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary key (user_id, event_type), last write by (ts, event_id) wins."""
    return keep_last(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@register(
    "skip_loaded",
    """SELECT * FROM orders n
WHERE n.o_orderdate >= TIMESTAMP '1998-01-01'
  AND NOT EXISTS (SELECT 1 FROM orders old WHERE old.o_orderdate < TIMESTAMP '1998-01-01'
                  AND old.o_custkey = n.o_custkey AND old.o_orderpriority = n.o_orderpriority)""",
)
def skip_loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows whose (customer, priority) is not loaded yet.

    Loaded = orders before 1998, new = the rest (a correlated NOT IN in
    the reference, a left anti join here).
    """
    o = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    loaded = o.where(F.col("o_orderdate") < cut)
    new = o.where(F.col("o_orderdate") >= cut)
    keys = ["o_custkey", "o_orderpriority"]
    return skip_loaded(new, loaded, keys, keys)


@register(
    "songs_artists_full",
    """SELECT COALESCE(s.s_suppkey, c.c_custkey) AS key, s.s_name, c.c_name
FROM supplier s FULL OUTER JOIN customer c ON s.s_suppkey = c.c_custkey""",
)
def songs_artists_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers FULL OUTER JOIN all customers USING key; the key is
    coalesced, a miss leaves the other side's columns NULL."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    return full_join_using(s, c, "key").select("key", "s_name", "c_name")


@register(
    "songs_full_artists",
    with_ctes(SONGS_V_SQL, ARTISTS_FIRST_SQL)
    + """SELECT COALESCE(s.artist_id, a.artist_id) AS artist_id, s.song_id, s.title, s.year, s.duration,
       a.name, a.location, a.latitude, a.longitude
FROM songs_v s FULL OUTER JOIN artists_t a ON s.artist_id = a.artist_id""",
)
def songs_full_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All songs FULL OUTER JOIN all artists USING artist_id (one row per
    artist, so no song is repeated, D13)."""
    songs = songs_v(spark, sf_dir)
    artists = music.build_artists(songs, "first_wins")
    return full_join_using(songs.select("artist_id", "song_id", "title", "year", "duration"), artists, "artist_id")


@register(
    "hash_key",
    """SELECT event_id, md5(CAST(user_id AS VARCHAR) || CAST(date_trunc('second', ts) AS VARCHAR)) AS event_key
FROM events""",
)
def hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5(user || second) per event."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", md5_key("user_id", cut_to_second("ts")).alias("event_key"))


@register(
    "hash_key_collisions",
    "SELECT songplay_id, COUNT(*) AS count FROM (" + SONGPLAYS_LOOKUP_SQL + ") GROUP BY 1 HAVING COUNT(*) > 1",
)
def hash_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 on K10 keys: songplay ids md5(session || second) shared by several
    plays (two plays of one session in the same second, D14)."""
    return duplicate_keys(_songplays_lookup(spark, sf_dir), ["songplay_id"])


# ---------------------------------------------------------- report, checks

COUNT_REPORT_SQL = (
    with_ctes(SONGS_V_SQL, PLAYS_V_SQL, SONGS_T_SQL, ARTISTS_FIRST_SQL, LOOKUP_SQL, PLAYS_SQL)
    + """SELECT 'staging_events' AS "table", COUNT(*) AS count FROM plays_v
UNION ALL SELECT 'staging_songs', COUNT(*) FROM songs_v
UNION ALL SELECT 'artists', COUNT(*) FROM artists_t
UNION ALL SELECT 'songs', COUNT(*) FROM songs_t
UNION ALL SELECT 'time', COUNT(DISTINCT start_time) FROM plays
UNION ALL SELECT 'users', COUNT(DISTINCT TRY_CAST(CAST(userId AS VARCHAR) AS BIGINT)) FROM plays
UNION ALL SELECT 'songplays', COUNT(*) FROM plays p LEFT JOIN lk
  ON p.song = lk.title AND p.artist = lk.name AND p.length = lk.duration"""
)


@register("count_report", COUNT_REPORT_SQL)
def count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of the seven tables of a full music load. The
    two sources are staged once, every table is built from what is staged,
    and its rows are counted by the write (an ``Observation``): each source
    is scanned once, and nothing is read to be counted."""
    root = scratch_dir(spark, "count_report")
    counts: dict[str, int] = {}
    logs, counts["staging_events"] = stage_counted(plays_v(spark, sf_dir), f"{root}/staging_events")
    songs, counts["staging_songs"] = stage_counted(songs_v(spark, sf_dir), f"{root}/staging_songs")

    def written(name: str, df: DataFrame) -> DataFrame:
        back, counts[name] = stage_counted(df, f"{root}/{name}")
        return back

    artists_t = written("artists", music.build_artists(songs, "first_wins"))
    songs_t = written("songs", music.build_songs(songs, "distinct"))
    written("time", music.build_time(logs, "number"))
    written("users", music.build_users(logs, "upsert"))
    written("songplays", music.build_songplays(logs, songs_t, artists_t, match="lookup"))
    delete(spark, root)
    return counts_frame(spark, counts)


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register(
    "null_check",
    "SELECT "
    + ", ".join(f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in ORDERS_COLS)
    + " FROM orders",
)
def null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: NULL count per column of orders (expected 0)."""
    return null_counts(table(spark, sf_dir, "orders"), ORDERS_COLS)


@register(
    "unique_check",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
)
def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: (order, line) pairs that are not unique."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("limit_sorted", "SELECT * FROM customer ORDER BY c_name, c_custkey LIMIT 5")
def limit_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: first rows of a table in a fixed order (the preview is the
    feature); a top-k over the whole table, no global sort."""
    return table(spark, sf_dir, "customer").orderBy("c_name", "c_custkey").limit(5)
