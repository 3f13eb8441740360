"""Sources, sinks, query-first tables and the file stream."""

from __future__ import annotations

import csv
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from dimspark.plans import music, query_tables as qt
from dimspark.plans.quality import (
    DataQualityError,
    check_no_nulls,
    check_non_empty,
    check_unique,
    duplicate_keys,
    null_counts,
)
from dimspark.session import scratch_dir
from dimspark.sinks.writers import (
    create_database,
    create_table,
    drop_table,
    load,
    save_bucketed,
    write_clustered,
    write_csv_quoted,
    write_parquet,
)
from dimspark.sources.files import read_json_mapped, read_logs, read_parquet_table, read_table
from dimspark.sources.staging import clean_strings, templated_path
from dimspark.streaming.log_stream import committed_versions, read_latest, start_log_stream
from fixtures import LOGS_DEC, LOGS_NOV, ms, write_json_lines, write_log_tree

RAW_HEADER = ["artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length", "level",
              "location", "method", "page", "registration", "sessionId", "song", "status", "ts", "userId"]


def _raw_event(artist, first, gender, item, last, length, level, location, session, song, user):
    return [artist, "Logged In", first, gender, str(item), last, length, level, location, "PUT", "NextSong",
            "1.5e12", str(session), song, "200", "1541106106796", str(user)]


def _write_raw_csv(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(RAW_HEADER)
        for r in records:
            w.writerow(r)


def test_event_csv_compaction_and_query_tables(spark, tmp_dir):
    root = os.path.join(tmp_dir, "event_data")
    _write_raw_csv(os.path.join(root, "2018-11", "a.csv"), [
        _raw_event("Faithless", "Ava", "F", 4, "Rob", "495.3073", "free", "Dallas, TX", 338, "Music Matters", 8),
        _raw_event("", "Kaylee", "F", 0, "Summers", "", "free", "Phoenix", 139, "", 8),  # no artist: dropped
        _raw_event("Down To The Bone", "Sylvie", "F", 0, "Cruz", "333.76", "free", "Washington", 182,
                   "Keep On Keepin' On", 10),
    ])
    _write_raw_csv(os.path.join(root, "2018-12", "b.csv"), [
        _raw_event("Three Drives", "Sylvie", "F", 1, "Cruz", "411.6", "free", "Washington", 182, "Greece 2000", 10),
        _raw_event("Sebastien Tellier", "Sylvie", "F", 2, "Cruz", "377.73", "free", "Washington", 182, "Kilometer", 10),
        _raw_event("The Black Keys", "Jacqueline", "F", 50, "Lynch", "196.91", "paid", "Atlanta", 559,
                   "All Hands Against His Own", 29),
        _raw_event("The Black Keys", "Jacqueline", "F", 51, "Lynch", "196.91", "paid", "Atlanta", 559,
                   "All Hands Against His Own", 29),
        _raw_event("A, \"quoted\" band", "Tegan", "F", 3, "Levine", "100.0", "paid", "Portland", 611,
                   "All Hands Against His Own", 80),
    ])
    raw = qt.read_event_csv(spark, root)
    events = qt.compact_events(raw, positional=True)
    assert events.columns == qt.EVENT_COLUMNS
    assert events.count() == 7
    out = scratch_dir(spark, "compact")
    write_csv_quoted(events, out)
    text = open(glob.glob(os.path.join(out, "part-*.csv"))[0]).read().splitlines()
    assert text[0] == ",".join(f'"{c}"' for c in qt.EVENT_COLUMNS)
    back = qt.read_event_csv(spark, out)
    assert rows(back) == rows(events)

    sessions = qt.songs_sessions(back, ["artist"])
    hit = qt.session_item(sessions, 338, 4).collect()
    assert len(hit) == 1 and (hit[0]["artist_name"], hit[0]["song_title"]) == ("Faithless", "Music Matters")
    assert abs(hit[0]["duration"] - 495.3073) < 1e-3
    hist = qt.user_session_history(qt.songs_users(back, ["firstName"]), 10, 182).collect()
    assert [r["song_title"] for r in hist] == ["Keep On Keepin' On", "Greece 2000", "Kilometer"]
    listeners = rows(qt.song_listeners(qt.music_hist(back, ["firstName"]), "All Hands Against His Own"))
    assert listeners == [(29, "Jacqueline", "Lynch"), (80, "Tegan", "Levine")]


def test_write_clustered_layout(spark, tmp_dir):
    df = spark.createDataFrame([(s, i, f"t{s}-{i}") for s in range(5) for i in (3, 1, 2)], "session_id int, item int, t string")
    path = os.path.join(tmp_dir, "clustered")
    write_clustered(df, path, ["session_id"], ["item"], num_partitions=2)
    back = spark.read.parquet(path)
    assert rows(back) == rows(df)
    # within every file, rows are ordered by (session, item)
    for f in glob.glob(os.path.join(path, "*.parquet")):
        got = [(r["session_id"], r["item"]) for r in spark.read.parquet(f).collect()]
        assert got == sorted(got)


def test_partitioned_parquet_roundtrip_and_load_modes(spark, tmp_dir):
    _, logs = None, read_logs(spark, write_log_tree(tmp_dir))
    t = music.build_time(logs, "number")
    path = os.path.join(tmp_dir, "time")
    write_parquet(t, path, ["year", "month"])
    assert "_SUCCESS" in os.listdir(path)
    assert os.path.isdir(os.path.join(path, "year=2018", "month=11"))
    back = read_parquet_table(spark, path)
    assert back.columns[-2:] == ["year", "month"]
    assert back.where("month = 12").count() == 3
    load(t, os.path.join(tmp_dir, "t2"))
    load(t, os.path.join(tmp_dir, "t2"))
    assert spark.read.parquet(os.path.join(tmp_dir, "t2")).count() == 2 * t.count()
    load(t, os.path.join(tmp_dir, "t2"), truncate=True)
    assert spark.read.parquet(os.path.join(tmp_dir, "t2")).count() == t.count()


def test_ddl_and_bucketed_table(spark, tmp_dir):
    create_database(spark, "sparkify")
    drop_table(spark, "sparkify.users")
    create_table(spark, "sparkify.users", "user_id BIGINT, level STRING", partitioned_by=[])
    assert read_table(spark, "sparkify.users").columns == ["user_id", "level"]
    assert read_table(spark, "SELECT count(*) AS n FROM sparkify.users").first()["n"] == 0
    drop_table(spark, "sparkify.users")
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "k int, v int")
    save_bucketed(df, "sparkify.bucketed", 4, ["k"], ["v"], path=os.path.join(tmp_dir, "bucketed"))
    assert spark.table("sparkify.bucketed").count() == 30
    drop_table(spark, "sparkify.bucketed")


def test_staging_json_mapping_and_cleanup(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stage", "e.json")
    write_json_lines(path, [{"userId": " ", "ts": ms(2018, 11, 1, 0, 0, 1, 500), "Artist": "", "song": "x" * 300}])
    schema = T.StructType([T.StructField("userId", T.StringType()), T.StructField("ts", T.LongType()),
                           T.StructField("Artist", T.StringType()), T.StructField("song", T.StringType())])
    df = read_json_mapped(spark, os.path.dirname(path), schema,
                          {"user_id": "userId", "start_time": "ts", "artist": "Artist", "song": "song"}, epoch_ms=["start_time"])
    r = clean_strings(df, truncate_to=256).first()
    assert r["user_id"] is None and r["artist"] is None and len(r["song"]) == 256
    assert r["start_time"] == dt.datetime(2018, 11, 1, 0, 0, 1, 500000)
    assert templated_path("log_data/{year}/{month}/{ds}-events.json", dt.date(2018, 11, 4)) == \
        "log_data/2018/11/2018-11-04-events.json"


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "k int, v string")
    counts = check_non_empty({"t": df})
    assert counts == {"t": 3}
    with pytest.raises(DataQualityError):
        check_non_empty({"t": df, "empty": df.where("k > 10")})
    assert null_counts(df).first().asDict() == {"k": 0, "v": 1}
    with pytest.raises(DataQualityError):
        check_no_nulls(df, ["v"])
    check_no_nulls(df, ["k"])
    assert rows(duplicate_keys(df, ["k"])) == [(2, 2)]
    with pytest.raises(DataQualityError):
        check_unique(df, ["k"])


def test_log_stream_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "incoming")
    write_json_lines(os.path.join(src, "2018-11.json"), LOGS_NOV)
    target = scratch_dir(spark, "tables")
    ckpt = scratch_dir(spark, "ckpt")
    q = start_log_stream(spark, src, target, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert committed_versions(spark, f"{target}/users") == [0]
    # a later file arrives: the next run continues from the checkpoint
    write_json_lines(os.path.join(src, "2018-12.json"), LOGS_DEC)
    q = start_log_stream(spark, src, target, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert committed_versions(spark, f"{target}/users") == [0, 1]
    batch_logs = spark.createDataFrame(LOGS_NOV + LOGS_DEC, read_logs(spark, src).schema)
    assert rows(read_latest(spark, f"{target}/users")) == rows(music.build_users(batch_logs, "upsert"))
    assert rows(read_latest(spark, f"{target}/time")) == rows(music.build_time(batch_logs, "number"))


def test_songs_users_dealt_into_buckets(spark):
    """Every user's rows are in one of the parts asked for; the rows are the same."""
    cols = "userId bigint, sessionId bigint, itemInSession bigint, firstName string, lastName string, artist string, song string, ts bigint"
    data = [(u, s, 1, f"f{u}", "l", "a", f"s{t}", t) for u in range(20) for s in range(3) for t in (1, 2)]
    events = spark.createDataFrame(data, cols)
    dealt = qt.songs_users(events, ["ts"], buckets=16)
    assert rows(dealt) == rows(qt.songs_users(events, ["ts"]))
    assert dealt.rdd.getNumPartitions() == 16
    parts = dealt.select("user_id", F.spark_partition_id().alias("p")).distinct()
    assert parts.count() == 20
