"""Registered driver queries: one per reference operator group.

Each query is a function ``(spark, sf_dir) -> DataFrame`` that runs a
library builder over the whole driver tables (through the views in
``driver_views``), paired with an equivalent DuckDB SQL text used as the
correctness oracle. Output timestamps are returned as TIMESTAMP_NTZ so
that collecting them does not depend on the Python process time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.plans import music
from dimspark.plans.registry import ntz, register
from dimspark.plans.driver_views import (
    EVENTS_LOG_V_SQL,
    PLAYS_V_SQL,
    SONGS_V_SQL,
    events_log_v,
    plays_v,
    songs_v,
    table,
    with_ctes,
)

# ---------------------------------------------------------------- music facts

SONGS_T_SQL = """songs_t AS (
  SELECT DISTINCT song_id, title, artist_id, year, duration FROM songs_v WHERE song_id IS NOT NULL)"""

ARTISTS_FIRST_SQL = """artists_t AS (
  SELECT artist_id, name, location, latitude, longitude FROM (
    SELECT artist_id, artist_name AS name, artist_location AS location,
           artist_latitude AS latitude, artist_longitude AS longitude,
           ROW_NUMBER() OVER (PARTITION BY artist_id ORDER BY artist_name NULLS FIRST,
             artist_location NULLS FIRST, artist_latitude NULLS FIRST, artist_longitude NULLS FIRST) AS rn
    FROM songs_v WHERE artist_id IS NOT NULL) WHERE rn = 1)"""

LOOKUP_SQL = """lk AS (
  SELECT title, name, duration, song_id, artist_id FROM (
    SELECT s.title, a.name, s.duration, s.song_id, s.artist_id,
           ROW_NUMBER() OVER (PARTITION BY s.title, a.name, s.duration
                              ORDER BY s.song_id NULLS FIRST, s.artist_id NULLS FIRST) AS rn
    FROM songs_t s JOIN artists_t a ON s.artist_id = a.artist_id
    WHERE s.title IS NOT NULL AND a.name IS NOT NULL AND s.duration IS NOT NULL) WHERE rn = 1)"""

PLAYS_SQL = """plays AS (
  SELECT *, date_trunc('second', ts) AS start_time FROM plays_v WHERE page = 'NextSong')"""

SONGPLAY_SELECT_SQL = """md5(CAST(p.sessionId AS VARCHAR) || CAST(p.start_time AS VARCHAR)) AS songplay_id,
       p.start_time, p.userId AS user_id, p.level, {s}.song_id, {s}.artist_id,
       p.sessionId AS session_id, p.location, p.userAgent AS user_agent"""

SONGPLAYS_LOOKUP_SQL = (
    with_ctes(SONGS_V_SQL, PLAYS_V_SQL, SONGS_T_SQL, ARTISTS_FIRST_SQL, LOOKUP_SQL, PLAYS_SQL)
    + "SELECT "
    + SONGPLAY_SELECT_SQL.format(s="lk")
    + """
FROM plays p LEFT JOIN lk ON p.song = lk.title AND p.artist = lk.name AND p.length = lk.duration"""
)


def _songplays_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = songs_v(spark, sf_dir)
    songs_t = music.build_songs(songs, "distinct")
    artists_t = music.build_artists(songs, "first_wins")
    return music.build_songplays(plays_v(spark, sf_dir), songs_t, artists_t, match="lookup")


@register("songplays_lookup_left", SONGPLAYS_LOOKUP_SQL)
def songplays_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every play once; song/artist NULL on a miss."""
    return ntz(_songplays_lookup(spark, sf_dir), "start_time")


@register(
    "songplays_left3",
    with_ctes(SONGS_V_SQL, PLAYS_V_SQL, PLAYS_SQL)
    + "SELECT "
    + SONGPLAY_SELECT_SQL.format(s="s")
    + """
FROM plays p LEFT JOIN songs_v s ON p.song = s.title AND p.artist = s.artist_name AND p.length = s.duration""",
)
def songplays_left3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join on three attributes; fans out on duplicate song records."""
    sp = music.build_songplays(plays_v(spark, sf_dir), songs_v(spark, sf_dir), match="left3")
    return ntz(sp, "start_time")


@register(
    "songplays_inner2",
    with_ctes(SONGS_V_SQL, PLAYS_V_SQL, PLAYS_SQL)
    + "SELECT DISTINCT "
    + SONGPLAY_SELECT_SQL.format(s="s")
    + """
FROM plays p JOIN songs_v s ON p.song = s.title AND p.artist = s.artist_name""",
)
def songplays_inner2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner join on title and artist, DISTINCT rows."""
    sp = music.build_songplays(plays_v(spark, sf_dir), songs_v(spark, sf_dir), match="inner2")
    return ntz(sp, "start_time")


@register(
    "plays_per_song",
    with_ctes(SONGS_V_SQL, PLAYS_V_SQL, SONGS_T_SQL, ARTISTS_FIRST_SQL, LOOKUP_SQL, PLAYS_SQL)
    + """SELECT lk.song_id, COUNT(*) AS count
FROM plays p LEFT JOIN lk ON p.song = lk.title AND p.artist = lk.name AND p.length = lk.duration
GROUP BY lk.song_id""",
)
def plays_per_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays per song; unknown songs are the NULL group."""
    return music.plays_per_song(_songplays_lookup(spark, sf_dir))


@register(
    "matched_plays",
    "SELECT * FROM (" + SONGPLAYS_LOOKUP_SQL + ") WHERE song_id IS NOT NULL AND artist_id IS NOT NULL",
)
def matched_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C17 F2: plays whose song and artist are known."""
    return ntz(music.matched_plays(_songplays_lookup(spark, sf_dir)), "start_time")


# ----------------------------------------------------------- music dimensions


@register("songs_table", with_ctes(SONGS_V_SQL, SONGS_T_SQL) + "SELECT * FROM songs_t")
def songs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs dimension, distinct rows."""
    return music.build_songs(songs_v(spark, sf_dir), "distinct")


@register("artists_first_wins", with_ctes(SONGS_V_SQL, ARTISTS_FIRST_SQL) + "SELECT * FROM artists_t")
def artists_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artists dimension, one row per artist_id."""
    return music.build_artists(songs_v(spark, sf_dir), "first_wins")


@register(
    "artists_distinct",
    with_ctes(SONGS_V_SQL)
    + """SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
       artist_latitude AS latitude, artist_longitude AS longitude
FROM songs_v WHERE artist_id IS NOT NULL""",
)
def artists_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artists dimension as DISTINCT rows (several per artist possible)."""
    return music.build_artists(songs_v(spark, sf_dir), "distinct")


@register(
    "songs_first_wins",
    with_ctes(SONGS_V_SQL)
    + """SELECT song_id, title, artist_id, year, duration FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY title ORDER BY song_id) AS rn
  FROM songs_v WHERE song_id IS NOT NULL) WHERE rn = 1""",
)
def songs_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ON CONFLICT (title) DO NOTHING, load order = song_id."""
    from dimspark.operators.upsert import insert_new_keys

    songs = songs_v(spark, sf_dir).where(F.col("song_id").isNotNull()).select(*music.SONG_COLUMNS)
    return insert_new_keys(None, songs, ["title"], ["song_id"]).select(*music.SONG_COLUMNS)


USERS_UPSERT_SQL = (
    with_ctes(EVENTS_LOG_V_SQL)
    + """, u AS (
  SELECT TRY_CAST(CAST(userId AS VARCHAR) AS BIGINT) AS user_id, firstName AS first_name,
         lastName AS last_name, gender, level, ts, sessionId, itemInSession
  FROM events_log_v
  WHERE page = 'NextSong' AND userId IS NOT NULL AND trim(CAST(userId AS VARCHAR)) <> '')
SELECT user_id,
       arg_min_null(first_name, (ts, sessionId, itemInSession)) AS first_name,
       arg_min_null(last_name, (ts, sessionId, itemInSession)) AS last_name,
       arg_min_null(gender, (ts, sessionId, itemInSession)) AS gender,
       arg_max_null(level, (ts, sessionId, itemInSession)) AS level
FROM u WHERE user_id IS NOT NULL GROUP BY user_id"""
)


@register("users_upsert", USERS_UPSERT_SQL)
def users_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user, names first seen, level last seen."""
    return music.build_users(events_log_v(spark, sf_dir), "upsert")


@register("users_upsert_incremental", USERS_UPSERT_SQL)
def users_upsert_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K12 in two loads: the first half of the log, then the rest merged in.

    Must equal the one-shot upsert (full outer join + coalesce rules).
    """
    logs = events_log_v(spark, sf_dir)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first = music.build_users(logs.where(F.col("ts") < cut), "upsert")
    return music.build_users(logs.where(F.col("ts") >= cut), "upsert", existing=first)


@register(
    "users_distinct",
    with_ctes(EVENTS_LOG_V_SQL)
    + """SELECT DISTINCT TRY_CAST(CAST(userId AS VARCHAR) AS BIGINT) AS user_id, firstName AS first_name,
       lastName AS last_name, gender, level
FROM events_log_v
WHERE page = 'NextSong' AND userId IS NOT NULL AND trim(CAST(userId AS VARCHAR)) <> ''
  AND TRY_CAST(CAST(userId AS VARCHAR) AS BIGINT) IS NOT NULL""",
)
def users_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as DISTINCT rows (a level change gives a second row)."""
    return music.build_users(events_log_v(spark, sf_dir), "distinct")


def _time_sql(weekday_sql: str) -> str:
    return (
        with_ctes(EVENTS_LOG_V_SQL)
        + """, st AS (SELECT DISTINCT date_trunc('second', ts) AS start_time FROM events_log_v
               WHERE page = 'NextSong' AND ts IS NOT NULL)
SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(weekofyear(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year, """
        + weekday_sql
        + " AS weekday FROM st"
    )


@register("time_dim_number", _time_sql("CAST(dayofweek(start_time) AS INTEGER)"))
def time_dim_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time dimension, weekday as a number (0 = Sunday)."""
    return ntz(music.build_time(events_log_v(spark, sf_dir), "number"), "start_time")


@register("time_dim_name", _time_sql("dayname(start_time)"))
def time_dim_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time dimension, weekday as full day name."""
    return ntz(music.build_time(events_log_v(spark, sf_dir), "name"), "start_time")


@register("time_dim_short", _time_sql("strftime(start_time, '%a')"))
def time_dim_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time dimension, weekday as three-letter name."""
    return ntz(music.build_time(events_log_v(spark, sf_dir), "short"), "start_time")
