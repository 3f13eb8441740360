"""End-to-end loads (E1, E2, E4) on fixtures."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dimspark.plans import loads
from dimspark.plans.quality import DataQualityError
from dimspark.sinks.versioned import committed_versions, read_latest
from dimspark.sources.files import read_logs, read_songs
from fixtures import LOGS_DEC, LOGS_NOV, write_json_lines, write_log_tree, write_song_tree
from test_labels_and_immigration import LABEL_TEXT, _csv, _demo, _temps


def test_load_music_lake(spark, tmp_dir):
    out = os.path.join(tmp_dir, "lake")
    counts = loads.load_music_lake(spark, write_song_tree(tmp_dir), write_log_tree(tmp_dir), out)
    assert counts == {"songs": 6, "artists": 3, "users": 2, "time": 6, "songplays": 7}
    assert os.path.isdir(os.path.join(out, "songplays", "year=2018", "month=12"))
    sp = spark.read.parquet(os.path.join(out, "songplays"))
    assert sp.where("month = 11").count() == 4


def test_load_music_warehouse_modes(spark, tmp_dir):
    root = os.path.join(tmp_dir, "dw")
    songs = read_songs(spark, write_song_tree(tmp_dir))
    nov = os.path.join(tmp_dir, "nov")
    write_json_lines(os.path.join(nov, "a.json"), LOGS_NOV)
    ev_nov = read_logs(spark, nov)
    ev_all = read_logs(spark, write_log_tree(tmp_dir))
    c1 = loads.load_music_warehouse(spark, ev_nov, songs, root)
    assert c1["songplays"] == 4 and c1["users"] == 1
    # the whole log again: plays of the loaded session (10, 182) are skipped
    c2 = loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="skip_sessions")
    assert c2["songplays"] == 4 + 2  # one play has no user
    assert committed_versions(spark, os.path.join(root, "songplays")) == [0, 1]
    users = {r["user_id"]: r["level"] for r in read_latest(spark, os.path.join(root, "users")).collect()}
    assert users == {10: "paid", 11: "free"}
    c3 = loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="append")
    assert c3["songplays"] == 6 + 6
    c4 = loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="overwrite", truncate_dims=True)
    assert c4["songplays"] == 6 and c4["songs"] == 6
    with pytest.raises(ValueError):
        loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="bogus")


def test_load_new_logs_versions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "inc")
    nov, dec = os.path.join(tmp_dir, "n"), os.path.join(tmp_dir, "d")
    write_json_lines(os.path.join(nov, "a.json"), LOGS_NOV)
    write_json_lines(os.path.join(dec, "b.json"), LOGS_DEC)
    assert loads.load_new_logs(spark, nov, root) == 0
    assert loads.load_new_logs(spark, dec, root) == 1
    all_logs = spark.createDataFrame(LOGS_NOV + LOGS_DEC, read_logs(spark, nov).schema)
    from dimspark.plans import music

    assert rows(read_latest(spark, os.path.join(root, "users"))) == rows(music.build_users(all_logs, "upsert"))


def test_load_immigration(spark, tmp_dir):
    lab = os.path.join(tmp_dir, "labels")
    os.makedirs(lab)
    with open(os.path.join(lab, "labels.SAS"), "w") as f:
        f.write(LABEL_TEXT)
    airports = _csv(tmp_dir, "airports", ",", ["type", "name", "continent", "iso_country", "iso_region", "municipality", "iata_code"],
                    [["small_airport", "Alcan Field", "NA", "US", "US-AK", "Alcan", "ALC"],
                     ["large_airport", "DFW Intl", "NA", "US", "US-TX", "Dallas", "DFW"]])
    _demo(spark, tmp_dir)
    _temps(spark, tmp_dir)
    rec = spark.createDataFrame(
        [(1.0, "DFW", 2.0, "TX", 1.0, 582.0, 582.0, 2016.0, 4.0, 1980.0, "F", 20580.0, 20573.0),
         (2.0, "ZZZ", 2.0, "TX", 1.0, 582.0, 582.0, 2016.0, 4.0, 1980.0, "F", 20580.0, 20573.0)],
        "cicid double, i94port string, i94visa double, i94addr string, i94mode double, i94cit double, "
        "i94res double, i94yr double, i94mon double, i94bir double, gender string, depdate double, arrdate double",
    )
    rec_path = os.path.join(tmp_dir, "records")
    rec.write.parquet(rec_path)
    # temperatures only for Dallas-like cities: the label cities are Alcan, Dallas/Fort Worth, ...
    temps = _csv(tmp_dir, "temps2", ",", ["dt", "AverageTemperature", "City"],
                 [["2012-01-01", "20.0", "Dallas/Fort Worth"]])
    demo = _csv(tmp_dir, "demo2", ";", ["City", "State", "Total Population", "Number of Veterans", "Foreign-born",
                                        "Average Household Size", "State Code", "Race", "Count"],
                [["Dallas/Fort Worth", "Texas", "10", "1", "2", "2.5", "TX", "Asian", "4"]])
    out = os.path.join(tmp_dir, "cap")
    counts = loads.load_immigration(spark, lab, airports, demo, temps, rec_path, out)
    assert counts == {"DIM_airports": 2, "DIM_visa": 3, "DIM_mode": 3, "DIM_country": 3, "DIM_state": 1,
                      "FACT_immigration": 1}
    assert os.path.isdir(os.path.join(out, "FACT_immigration", "im_yr=2016", "im_mon=4"))
    # no temperature for any valid city -> empty state table -> the check fails the load
    empty_t = _csv(tmp_dir, "temps3", ",", ["dt", "AverageTemperature", "City"], [["2012-01-01", "20.0", "Paris"]])
    with pytest.raises(DataQualityError):
        loads.load_immigration(spark, lab, airports, demo, empty_t, rec_path, os.path.join(tmp_dir, "cap2"))
    assert spark.read.parquet(os.path.join(out, "DIM_state")).where(F.col("avg_temp") == 20.0).count() == 1


def test_fact_loads_write_deltas(spark, tmp_dir):
    """Appending loads write only their new rows; compaction folds the
    deltas into one full version with the same rows."""
    from dimspark.sinks.versioned import DELTA_PREFIX, VERSION_PREFIX, compact, read_current, version_path

    root = os.path.join(tmp_dir, "dw")
    songs = read_songs(spark, write_song_tree(tmp_dir))
    nov = os.path.join(tmp_dir, "nov")
    write_json_lines(os.path.join(nov, "a.json"), LOGS_NOV)
    ev_all = read_logs(spark, write_log_tree(tmp_dir))
    loads.load_music_warehouse(spark, read_logs(spark, nov), songs, root)
    loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="skip_sessions")
    fact = os.path.join(root, "songplays")
    names = {n for n in os.listdir(fact) if n.startswith((VERSION_PREFIX, DELTA_PREFIX))}
    assert names == {os.path.basename(version_path(fact, 0)), os.path.basename(version_path(fact, 1, delta=True))}
    assert spark.read.parquet(version_path(fact, 1, delta=True)).count() == 2  # the new plays only
    before = rows(read_current(spark, fact))
    assert len(before) == 6
    compact(spark, fact)
    assert committed_versions(spark, fact) == [0, 1, 2]
    assert rows(spark.read.parquet(version_path(fact, 2))) == before
    assert rows(read_current(spark, fact)) == before


def test_warehouse_compacts_after_many_deltas(spark, tmp_dir):
    """With compact_after=1, the second delta triggers a compaction; the
    tables read the same before and after, and later loads still land."""
    from dimspark.sinks.versioned import deltas_since_base, read_current

    root = os.path.join(tmp_dir, "dw")
    songs = read_songs(spark, write_song_tree(tmp_dir))
    nov = os.path.join(tmp_dir, "nov")
    write_json_lines(os.path.join(nov, "a.json"), LOGS_NOV)
    ev_nov, ev_all = read_logs(spark, nov), read_logs(spark, write_log_tree(tmp_dir))
    loads.load_music_warehouse(spark, ev_nov, songs, root, compact_after=1)
    loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="append", compact_after=1)
    c3 = loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="append", compact_after=1)
    fact = os.path.join(root, "songplays")
    assert deltas_since_base(spark, fact) == 0  # two deltas were folded into a full version
    assert c3["songplays"] == 4 + 6 + 6
    c4 = loads.load_music_warehouse(spark, ev_all, songs, root, fact_mode="append", compact_after=1)
    assert c4["songplays"] == 4 + 6 + 6 + 6
    assert read_current(spark, os.path.join(root, "time")).count() == c4["time"]


def test_every_valid_play_is_stored_once(spark, tmp_dir):
    """Default mode: plays without a user are not loaded, reloads add
    nothing, later plays of a stored session are added, and an append that
    is run again under its id stores its plays once."""
    from dimspark.sinks.versioned import read_latest, version_path

    root = os.path.join(tmp_dir, "dw")
    songs = read_songs(spark, write_song_tree(tmp_dir))
    logs = read_logs(spark, write_log_tree(tmp_dir)).where("page = 'NextSong'")
    n = logs.where("trim(userId) <> ''").count()
    blank = logs.withColumn("userId", F.when(F.col("itemInSession") % 2 == 0, F.lit(" ")))
    both = logs.unionByName(blank)
    first = logs.orderBy("ts").limit(2)  # the session goes on later
    assert loads.load_music_warehouse(spark, first, songs, root)["songplays"] == 2
    for _ in range(3):
        assert loads.load_music_warehouse(spark, both, songs, root)["songplays"] == n
    c = loads.load_music_warehouse(spark, logs, songs, root, fact_mode="append", load_id=50)
    os.remove(os.path.join(version_path(f"{root}/songplays", 50, delta=True), "_SUCCESS"))  # died after the fact write
    again = loads.load_music_warehouse(spark, logs, songs, root, fact_mode="append", load_id=50)
    assert c["songplays"] == again["songplays"] == 2 * n
    assert read_latest(spark, f"{root}/songplays").where("user_id IS NULL").count() == 0


def test_stream_goes_on_from_a_stored_root(spark, tmp_dir):
    """A stream without a checkpoint, on a root that holds versions: the
    stored rows stay, its own rows are added."""
    from dimspark.sinks.versioned import read_latest, write_version
    from dimspark.plans import music
    from dimspark.streaming.log_stream import start_log_stream

    src, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "tables")
    write_json_lines(os.path.join(src, "a.json"), LOGS_NOV)
    stored = read_logs(spark, src)
    for v in range(4):
        other = stored.withColumn("userId", F.lit("9"))
        write_version(music.build_users(other, "upsert"), f"{root}/users", v)
    for k in range(2):  # the second time the checkpoint is lost
        q = start_log_stream(spark, src, root, os.path.join(tmp_dir, f"ckpt{k}"))
        q.awaitTermination()
        users = {r["user_id"] for r in read_latest(spark, f"{root}/users").collect()}
        assert users == {9, *(r["user_id"] for r in music.build_users(stored, "upsert").collect())}
