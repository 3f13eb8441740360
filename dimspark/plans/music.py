"""Music star schema: songs, artists, users, time, songplays.

Inputs use the raw field names of the two JSON sources:

* song records: song_id, title, artist_id, artist_name, artist_location,
  artist_latitude, artist_longitude, duration, year
* activity log: artist, auth, firstName, gender, itemInSession, lastName,
  length, level, location, method, page, registration, sessionId, song,
  status, ts, userAgent, userId

``ts`` may be epoch milliseconds (as in the raw log) or already a
timestamp. Canonical choices (each one has a parameter for the other
variants of the reference):

* fact match: at most one dimension row per play (``match="lookup"``),
* users: upsert; names first seen, level last seen (``mode="upsert"``),
* time: distinct start times of song plays, cut to the second,
* play id: md5(session_id || start_time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.functions.casts import as_id
from dimspark.functions.keys import increasing_id, md5_key
from dimspark.functions.timefn import cut_to_second, epoch_ms_to_second, epoch_ms_to_timestamp, time_parts
from dimspark.operators.dedupe import distinct_rows, keep_first
from dimspark.operators.lookup import inner_join, left_join_all, lookup_left
from dimspark.operators.aggregates import count_by
from dimspark.operators.upsert import upsert_update

# Fixed value: the page name of a song play in the activity log.
PLAY_PAGE = "NextSong"

SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]
ARTIST_COLUMNS = ["artist_id", "name", "location", "latitude", "longitude"]
USER_COLUMNS = ["user_id", "first_name", "last_name", "gender", "level"]
TIME_COLUMNS = ["start_time", "hour", "day", "week", "month", "year", "weekday"]
SONGPLAY_COLUMNS = [
    "songplay_id",
    "start_time",
    "user_id",
    "level",
    "song_id",
    "artist_id",
    "session_id",
    "location",
    "user_agent",
]

# Total order of log rows for first/last-wins: time, then position.
LOG_ORDER = ("ts", "sessionId", "itemInSession")


def start_time(df: DataFrame, ts: str = "ts", precision: str = "second") -> Column:
    """T1/T2 on the log's ``ts``, whatever its type."""
    dtype = df.schema[ts].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return cut_to_second(ts) if precision == "second" else F.col(ts).cast("timestamp")
    if precision == "second":
        return epoch_ms_to_second(ts)
    if precision == "ms":
        return epoch_ms_to_timestamp(ts)
    raise ValueError("precision must be 'second' or 'ms'")


def song_plays(logs: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """the log rows that are song plays."""
    return logs.where(F.col("page") == F.lit(page))


def build_songs(songs: DataFrame, mode: str = "distinct", order: Sequence[str] = ("song_id",)) -> DataFrame:
    """Songs table. ``distinct`` = SELECT DISTINCT ... WHERE song_id IS NOT NULL;
    ``first_wins`` = one row per song_id, first by ``order`` (K11)."""
    base = songs.where(F.col("song_id").isNotNull())
    if mode == "distinct":
        return distinct_rows(base, SONG_COLUMNS)
    if mode == "first_wins":
        extra = [c for c in order if c not in SONG_COLUMNS]
        picked = keep_first(base.select(*SONG_COLUMNS, *extra), ["song_id"], list(order))
        return picked.select(*SONG_COLUMNS)
    raise ValueError(mode)


def build_artists(songs: DataFrame, mode: str = "distinct", order: Sequence[str] | None = None) -> DataFrame:
    """Artists table from song records (P2 renames, F2, A3 or K11)."""
    base = songs.where(F.col("artist_id").isNotNull()).select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )
    if mode == "distinct":
        return base.distinct()
    if mode == "first_wins":
        return keep_first(base, ["artist_id"], list(order or ARTIST_COLUMNS[1:]))
    raise ValueError(mode)


def _user_rows(logs: DataFrame) -> DataFrame:
    uid = F.col("userId").cast("string")
    return song_plays(logs).where(uid.isNotNull() & (F.trim(uid) != "")).select(
        as_id(logs, "userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        *LOG_ORDER,
    )


def build_users(
    logs: DataFrame, mode: str = "upsert", existing: DataFrame | None = None
) -> DataFrame:
    """Users table.

    ``upsert`` (K12): one row per user; names and gender as first seen,
    level as last seen (order: ts, sessionId, itemInSession), merged into
    ``existing`` if given. ``distinct`` (A3): every distinct row, so a user
    whose level changed appears twice.
    """
    rows = user_rows(logs)
    if mode == "distinct":
        return rows.select(*USER_COLUMNS).distinct()
    if mode == "upsert":
        return upsert_users(rows, existing)
    raise ValueError(mode)


def user_rows(logs: DataFrame) -> DataFrame:
    """The users' columns of every song play with a user, and its order."""
    return _user_rows(logs).where(F.col("user_id").isNotNull())


def upsert_users(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """K12 on rows from ``user_rows``."""
    return upsert_update(existing, rows, ["user_id"], list(LOG_ORDER), ["level"]).select(*USER_COLUMNS)


def build_time(
    logs: DataFrame,
    weekday_style: str = "number",
    source: str = "plays",
    precision: str = "second",
) -> DataFrame:
    """C4: time dimension: distinct start times and their parts.

    ``source="plays"`` uses song plays only, ``"all"`` every log row.
    """
    rows = song_plays(logs) if source == "plays" else logs
    st = rows.select(start_time(rows, "ts", precision).alias("start_time")).where(F.col("start_time").isNotNull())
    return st.distinct().select("start_time", *time_parts("start_time", weekday_style))


def songs_lookup(songs_table: DataFrame, artists_table: DataFrame) -> DataFrame:
    """Songs joined to artists on artist_id: (title, name, duration, song_id, artist_id)."""
    a = artists_table.select(F.col("artist_id").alias("a_artist_id"), "name")
    return songs_table.join(a, songs_table["artist_id"] == a["a_artist_id"], "inner").select(
        "title", "name", "duration", "song_id", "artist_id"
    )


def _plays_with_time(logs: DataFrame, precision: str) -> DataFrame:
    plays = song_plays(logs)
    return plays.withColumn("start_time", start_time(plays, "ts", precision))


def valid_plays(logs: DataFrame, precision: str = "second") -> DataFrame:
    """The song plays the fact may hold, with what it is built from: user,
    session and start time are NOT NULL there. ``userId`` and
    ``itemInSession`` come as whole numbers."""
    plays = _plays_with_time(logs, precision)
    used = ["start_time", "userId", "level", "sessionId", "location", "userAgent", "song", "artist", "length", "itemInSession"]
    plays = plays.withColumns({c: as_id(plays, c) for c in ("userId", "itemInSession")}).select(*used)
    return plays.where("userId IS NOT NULL AND sessionId IS NOT NULL AND start_time IS NOT NULL")


def _songplay_select(df: DataFrame, key: str, item: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    if key == "md5":
        sid = md5_key("sessionId", "start_time")
    elif key == "increasing":
        sid = increasing_id()
    else:
        raise ValueError(key)
    return df.select(
        sid.alias("songplay_id"),
        "start_time",
        as_id(df, "userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *([as_id(df, "itemInSession").alias("item_in_session")] if item else []),
        *keep,
    )


def build_songplays(
    logs: DataFrame,
    songs: DataFrame,
    artists: DataFrame | None = None,
    match: str = "lookup",
    key: str = "md5",
    precision: str = "second",
    salt_buckets: int = 0,
    item: bool = False,
) -> DataFrame:
    """Songplays fact.

    * ``lookup`` (J6, canonical): ``songs`` and ``artists`` are the built
      dimension tables; every play gives exactly one row, song_id and
      artist_id are NULL on a miss (T21).
    * ``left3`` (J1): ``songs`` are raw song records; left join on
      (title, artist name, duration); a play matching several records
      gives several rows.
    * ``inner2`` (J2): ``songs`` are raw song records; inner join on
      (title, artist name), then DISTINCT rows; misses are dropped.

    ``item`` adds item_in_session, the play's number in its session: with
    the session it tells any two plays apart (songplay_id does not).
    """
    # Only what the fact or the match uses: the spread of NULL keys hashes
    # whole rows, and no other column is read for it.
    used = ["start_time", "userId", "level", "sessionId", "location", "userAgent", "song", "artist", "length"]
    used += ["itemInSession"] if item else []
    plays = _plays_with_time(logs, precision).select(*used)
    return songplays_of(plays, songs, artists, match, key, salt_buckets, item)


def songplays_of(
    plays: DataFrame,
    songs: DataFrame,
    artists: DataFrame | None = None,
    match: str = "lookup",
    key: str = "md5",
    salt_buckets: int = 0,
    item: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """C5 on plays that have their start_time (as from ``valid_plays``);
    ``keep`` names further columns of plays that stay."""
    if match == "lookup":
        if artists is None:
            raise ValueError("lookup match needs the artists table")
        lk = songs_lookup(songs, artists)
        joined = lookup_left(
            plays, lk, ["song", "artist", "length"], ["title", "name", "duration"], ["song_id", "artist_id"],
            salt_buckets=salt_buckets,
        )
        return _songplay_select(joined, key, item, keep)
    if match == "left3":
        joined = left_join_all(
            plays, songs, ["song", "artist", "length"], ["title", "artist_name", "duration"], ["song_id", "artist_id"]
        )
        return _songplay_select(joined, key, item, keep)
    if match == "inner2":
        joined = inner_join(plays, songs, ["song", "artist"], ["title", "artist_name"], ["song_id", "artist_id"])
        if key == "md5":
            # The md5 key is a function of (sessionId, start_time): DISTINCT on the
            # raw columns first, then hash once per distinct row. Same result,
            # narrower shuffle rows and fewer hashes than hashing the fan-out.
            cols = ["start_time", "userId", "level", "song_id", "artist_id", "sessionId", "location", "userAgent"]
            cols += ["itemInSession"] if item else []
            return _songplay_select(joined.select(*cols, *keep).distinct(), key, item, keep)
        return _songplay_select(joined, key, item, keep).distinct()
    raise ValueError(match)


def matched_plays(songplays: DataFrame) -> DataFrame:
    """C17: plays whose song and artist are known."""
    return songplays.where(F.col("song_id").isNotNull() & F.col("artist_id").isNotNull())


def plays_per_song(songplays: DataFrame) -> DataFrame:
    """COUNT(*) GROUP BY song_id (unknown songs form the NULL group)."""
    return count_by(songplays, ["song_id"], "count")
