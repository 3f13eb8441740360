"""Music star schema builders over JSON fixtures."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from conftest import rows
from dimspark.plans import music
from dimspark.sources.files import read_logs, read_songs
from fixtures import LOGS_DEC, LOGS_NOV, SONGS, write_log_tree, write_song_tree


def _load(spark, tmp_dir):
    return read_songs(spark, write_song_tree(tmp_dir)), read_logs(spark, write_log_tree(tmp_dir))


def test_sources_read_all_levels(spark, tmp_dir):
    songs, logs = _load(spark, tmp_dir)
    assert songs.count() == len(SONGS)
    assert logs.count() == len(LOGS_NOV) + len(LOGS_DEC)
    assert dict(logs.dtypes)["ts"] == "bigint"


def test_songs_and_artists(spark, tmp_dir):
    songs, _ = _load(spark, tmp_dir)
    distinct = music.build_songs(songs, "distinct")
    assert distinct.count() == 6  # SO3 twice collapses
    first = music.build_artists(songs, "first_wins")
    assert first.count() == 3
    assert music.build_artists(songs, "distinct").count() == 4  # AR1 has two locations


def test_songplays_increasing_key(spark, tmp_dir):
    songs, logs = _load(spark, tmp_dir)
    songs_t, artists_t = music.build_songs(songs, "distinct"), music.build_artists(songs, "first_wins")
    keyed = music.build_songplays(logs, songs_t, artists_t, key="increasing")
    ids = [r["songplay_id"] for r in keyed.collect()]
    assert len(ids) == 7 and ids == sorted(set(ids))  # K9: unique, in row order


def test_songplays_lookup_keeps_every_play(spark, tmp_dir):
    songs, logs = _load(spark, tmp_dir)
    songs_t = music.build_songs(songs, "distinct")
    artists_t = music.build_artists(songs, "first_wins")
    sp = music.build_songplays(logs, songs_t, artists_t, "lookup")
    n_plays = logs.where(F.col("page") == "NextSong").count()
    assert sp.count() == n_plays == 7
    got = {(r["session_id"], r["start_time"]): (r["song_id"], r["artist_id"]) for r in sp.collect()}
    # (Echo, Twins, 99.5) exists under SO5 and SO6: the lookup keeps one (the smallest id).
    assert got[(182, dt.datetime(2018, 11, 4, 10, 0, 0))] in {("SO3", "AR2"), ("SO5", "AR3")}
    matched = music.matched_plays(sp)
    assert matched.count() == 5
    # songplay id = md5(session || start second)
    r = sp.where(F.col("session_id") == 183).first()
    assert r["songplay_id"] == hashlib.md5(b"1832018-12-31 23:59:59").hexdigest()
    # salting gives the same rows
    salted = music.build_songplays(logs, songs_t, artists_t, "lookup", salt_buckets=4)
    assert rows(salted) == rows(sp)


def test_songplays_variants_fan_out(spark, tmp_dir):
    songs, logs = _load(spark, tmp_dir)
    left3 = music.build_songplays(logs, songs, match="left3")
    # Hit/Band/180.5 matches two identical SO3 records, Echo two song ids.
    assert left3.count() == 7 + 1 + 1
    inner2 = music.build_songplays(logs, songs, match="inner2")
    # plays with a (title, artist) match; DISTINCT removes the SO3 copy.
    assert inner2.where(F.col("song_id").isNull()).count() == 0
    assert inner2.count() == rows(inner2).__len__() == len(set(rows(inner2)))


def test_plays_per_song_null_group(spark, tmp_dir):
    songs, logs = _load(spark, tmp_dir)
    sp = music.build_songplays(logs, music.build_songs(songs), music.build_artists(songs, "first_wins"))
    counts = {r["song_id"]: r["count"] for r in music.plays_per_song(sp).collect()}
    assert counts[None] == 2 and sum(counts.values()) == 7


def test_users_upsert_and_distinct(spark, tmp_dir):
    _, logs = _load(spark, tmp_dir)
    up = {r["user_id"]: r for r in music.build_users(logs, "upsert").collect()}
    assert set(up) == {10, 11}  # empty and NULL user ids dropped
    assert up[10]["level"] == "paid" and up[10]["first_name"] == "Ann"
    distinct = music.build_users(logs, "distinct")
    assert distinct.where(F.col("user_id") == 10).count() == 2


def test_users_upsert_incremental_equals_one_shot(spark, tmp_dir):
    _, logs = _load(spark, tmp_dir)
    cut = 1543622400000  # 2018-12-01
    first = music.build_users(logs.where(F.col("ts") < cut), "upsert")
    merged = music.build_users(logs.where(F.col("ts") >= cut), "upsert", existing=first)
    assert rows(merged) == rows(music.build_users(logs, "upsert"))
    again = music.build_users(logs.where(F.col("ts") >= cut), "upsert", existing=merged)
    assert rows(again) == rows(merged)


def test_time_dimension(spark, tmp_dir):
    _, logs = _load(spark, tmp_dir)
    t = music.build_time(logs, "number")
    # 7 plays, two of them in the same second
    assert t.count() == 6
    sun = t.where(F.col("start_time") == F.lit("2018-11-04 10:00:00").cast("timestamp")).first()
    assert sun["weekday"] == 0 and sun["week"] == 44
    dec31 = t.where(F.col("day") == 31).first()
    assert dec31["week"] == 1 and dec31["year"] == 2018
    assert music.build_time(logs, "name").where(F.col("weekday") == "Sunday").count() >= 1
    assert music.build_time(logs, source="all").count() == 8
    ms_t = music.build_time(logs, precision="ms")
    assert ms_t.count() == 7
