"""Query-first tables and their point lookups.

The reference models one wide-row table per question: a partition key,
a clustering column, and "last insert wins" per primary key. Here each
table is a DataFrame keyed the same way (``keep_last`` per primary key),
stored hash-partitioned on the partition key and sorted on the
clustering column (``dimspark.sinks.writers.write_clustered``), and the
lookups are plain filters that Spark prunes on the stored layout.

Input rows are the compacted event rows (C9) with the columns
artist, firstName, gender, itemInSession, lastName, length, level,
location, sessionId, song, userId (all text in the CSV form; any type is
accepted, casts are ``try_cast``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.functions.casts import as_id
from dimspark.operators.dedupe import keep_last

# The kept event columns, in output order, and their
# positions in the raw event CSV rows.
EVENT_COLUMNS = [
    "artist",
    "firstName",
    "gender",
    "itemInSession",
    "lastName",
    "length",
    "level",
    "location",
    "sessionId",
    "song",
    "userId",
]
EVENT_POSITIONS = [0, 2, 3, 4, 5, 6, 7, 8, 12, 13, 16]


def compact_events(raw: DataFrame, positional: bool = True) -> DataFrame:
    """C9 (P5, F6): keep 11 columns and drop rows without an artist.

    ``positional``: pick the columns by position from a raw CSV read
    (``_c0``... or any header) and name them; else select them by name.
    """
    if positional:
        cols = raw.columns
        df = raw.select(*[F.col(f"`{cols[p]}`").alias(n) for p, n in zip(EVENT_POSITIONS, EVENT_COLUMNS)])
    else:
        df = raw.select(*EVENT_COLUMNS)
    a = F.col("artist").cast("string")
    return df.where(a.isNotNull() & (a != ""))


def _last_wins(rows: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    extra = [c for c in order if c not in keys and c not in cols]
    picked = keep_last(rows.select(*keys, *cols, *extra), list(keys), list(order))
    return picked.select(*keys, *cols)


def songs_sessions(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """C6 table: PRIMARY KEY (session_id, item_session)."""
    rows = events.select(
        as_id(events, "sessionId").alias("session_id"),
        as_id(events, "itemInSession").alias("item_session"),
        F.col("artist").alias("artist_name"),
        F.col("song").alias("song_title"),
        F.col("length").cast("string").try_cast("float").alias("duration"),
        *[F.col(c) for c in order],
    )
    return _last_wins(rows, ["session_id", "item_session"], ["artist_name", "song_title", "duration"], order)


def songs_users(events: DataFrame, order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """C7 table: PRIMARY KEY ((user_id, session_id), item_session). With
    ``buckets`` the rows are dealt by user into that many parts first: the
    parts of a table that is stored in as many buckets of the user."""
    rows = events.select(
        as_id(events, "userId").alias("user_id"),
        as_id(events, "sessionId").alias("session_id"),
        as_id(events, "itemInSession").alias("item_session"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        F.col("artist").alias("artist_name"),
        F.col("song").alias("song_title"),
        *[F.col(c) for c in order],
    )
    if buckets is not None:
        rows = rows.repartition(buckets, "user_id")
    return _last_wins(
        rows,
        ["user_id", "session_id", "item_session"],
        ["first_name", "last_name", "artist_name", "song_title"],
        order,
    )


def music_hist(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """C8 table: PRIMARY KEY (song_title, user_id)."""
    rows = events.select(
        F.col("song").alias("song_title"),
        as_id(events, "userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        *[F.col(c) for c in order],
    )
    return _last_wins(rows, ["song_title", "user_id"], ["first_name", "last_name"], order)


def session_item(table: DataFrame, session_id: int, item_session: int) -> DataFrame:
    """C6 query: artist, title and length heard at (session, item)."""
    return table.where((F.col("session_id") == session_id) & (F.col("item_session") == item_session)).select(
        "artist_name", "song_title", "duration"
    )


def user_session_history(table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """C7 query: artist, title and user name for one user session, by item."""
    return (
        table.where((F.col("user_id") == user_id) & (F.col("session_id") == session_id))
        .orderBy("item_session")
        .select("item_session", "artist_name", "song_title", "first_name", "last_name")
    )


def song_listeners(table: DataFrame, song_title: str) -> DataFrame:
    """C8 query: every user (first and last name) who heard a title."""
    return table.where(F.col("song_title") == song_title).select("user_id", "first_name", "last_name")


def read_event_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All event CSV files of a folder tree in one scan, header skipped,
    every field as text."""
    return (
        spark.read.option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("escape", '"')
        .csv(paths if isinstance(paths, str) else list(paths))
    )
