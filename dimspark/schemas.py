"""Declared schemas of the raw sources and target tables (§1.4).

Reading with a declared schema skips the inference pass over the data.
Spark's JSON and CSV readers make every field nullable whatever the
schema says, so NOT NULL is enforced by checks (``plans.quality``), not
by the flags below.

Identifiers that count events (session ids, item numbers, user ids) are
64-bit here, where the reference declares 32-bit int: at the target scale
they pass 2^31, and a 32-bit column would fail the cast or turn them into
NULLs. Values that fit in 32 bits read the same either way.
"""

from pyspark.sql import types as T

# Field names and types of the raw sources and the tables.
SONG_SCHEMA = T.StructType(
    [
        T.StructField("num_songs", T.IntegerType()),
        T.StructField("artist_id", T.StringType()),
        T.StructField("artist_latitude", T.DoubleType()),
        T.StructField("artist_longitude", T.DoubleType()),
        T.StructField("artist_location", T.StringType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("artist", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("level", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("registration", T.DoubleType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("song", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("ts", T.LongType()),
        T.StructField("userAgent", T.StringType()),
        T.StructField("userId", T.StringType()),
    ]
)

# Staging table of the activity log (S5/S6): staging column -> JSON field,
# in staging-table order (the role of the JSON-paths file). ``ts`` arrives
# as epoch milliseconds and is staged as a timestamp.
STAGING_EVENTS_MAPPING = {
    "artist": "artist",
    "auth": "auth",
    "firstname": "firstName",
    "gender": "gender",
    "iteminsession": "itemInSession",
    "lastname": "lastName",
    "length": "length",
    "level": "level",
    "location": "location",
    "method": "method",
    "page": "page",
    "registration": "registration",
    "sessionid": "sessionId",
    "song": "song",
    "status": "status",
    "ts": "ts",
    "useragent": "userAgent",
    "userid": "userId",
}

# Target tables (DDL for ``sinks.writers.create_table``).
TABLE_DDL = {
    "songplays": "songplay_id STRING, start_time TIMESTAMP, user_id BIGINT, level STRING, song_id STRING, "
    "artist_id STRING, session_id BIGINT, location STRING, user_agent STRING, year INT, month INT",
    "users": "user_id BIGINT, first_name STRING, last_name STRING, gender STRING, level STRING",
    "songs": "song_id STRING, title STRING, artist_id STRING, year INT, duration DOUBLE",
    "artists": "artist_id STRING, name STRING, location STRING, latitude DOUBLE, longitude DOUBLE",
    "time": "start_time TIMESTAMP, hour INT, day INT, week INT, month INT, year INT, weekday INT",
}

TABLE_PARTITIONS = {
    "songplays": ["year", "month"],
    "songs": ["year"],
    "time": ["year", "month"],
}
