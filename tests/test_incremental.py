"""Incremental facts, upserted tables and counted writes."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dimspark.operators import surrogate
from dimspark.operators.incremental import MAX_PARTITIONS, new_rows, not_stored, partition_filter
from dimspark.plans import loads, music
from dimspark.schemas import LOG_SCHEMA, SONG_SCHEMA
from dimspark.sinks import upserted, versioned
from dimspark.sinks.writers import write_counted, write_counted_by

T0 = 1541106106000  # 2018-11-01


def _play(item, session=7, user="10", ts=T0, **more):
    play = dict(artist="A", auth="Logged In", firstName="F", gender="F", itemInSession=item, lastName="L", length=1.0,
                level="free", location="X", method="PUT", page="NextSong", registration=0.0, sessionId=session, song="S",
                status=200, ts=ts, userAgent="U", userId=user)
    return play | more


SONGS = [dict(num_songs=1, artist_id="a1", artist_latitude=None, artist_longitude=None, artist_location="", artist_name="A",
              song_id="s1", title="S", duration=1.0, year=2000)]


@pytest.fixture()
def songs(spark):
    return spark.createDataFrame(SONGS, SONG_SCHEMA)


def _logs(spark, plays):
    return spark.createDataFrame(plays, LOG_SCHEMA)


def test_reloads_store_every_valid_play_once(spark, songs, tmp_dir):
    """One whole play, one without an item, one without a session, one
    without a time, one staged twice: three valid ones, whatever is loaded again."""
    root = os.path.join(tmp_dir, "dw")
    five = [_play(1), _play(None, ts=T0 + 60_000), _play(2, session=None), _play(3, ts=None), _play(4), _play(4)]
    for _ in range(3):
        assert loads.load_music_warehouse(spark, _logs(spark, five), songs, root)["songplays"] == 3
    fact = versioned.read_latest(spark, f"{root}/songplays")
    assert sorted((r.item_in_session or 0, r.session_id, r.song_id) for r in fact.collect()) == [
        (0, 7, "s1"), (1, 7, "s1"), (4, 7, "s1")
    ]
    later = [*five, _play(5, ts=T0 + 3_000_000_000), _play(None, ts=T0 + 61_000)]
    assert loads.load_music_warehouse(spark, _logs(spark, later), songs, root)["songplays"] == 5
    assert os.path.isdir(os.path.join(root, "songplays", "d=000000000003", "year=2018", "month=12"))


def test_a_load_without_new_plays_and_compaction(spark, songs, tmp_dir):
    root = os.path.join(tmp_dir, "dw")
    logs = _logs(spark, [_play(i, ts=T0 + i * 2_000_000_000) for i in range(1, 5)])
    for _ in range(4):  # deltas without a row, folded at the third load
        counts = loads.load_music_warehouse(spark, logs, songs, root, compact_after=1)
        assert counts == {"songs": 1, "artists": 1, "users": 1, "time": 4, "songplays": 4}
    assert versioned.read_latest(spark, f"{root}/songplays").count() == 4
    assert any(n.startswith("v=") and n != "v=000000000000" for n in os.listdir(f"{root}/songplays"))


def test_stored_plays_are_read_from_the_batch_months_only(spark, songs, tmp_dir):
    root = os.path.join(tmp_dir, "dw")
    month = 2_678_400_000
    loads.load_music_warehouse(spark, _logs(spark, [_play(i, ts=T0 + i * month) for i in range(12)]), songs, root)
    stored = versioned.read_latest(spark, f"{root}/songplays")
    batch = music.valid_plays(_logs(spark, [_play(1, ts=T0 + month), _play(99, ts=T0 + month)]))
    batch = loads._with_year_month(batch).select(
        *[F.col(a).alias(b) for a, b in zip(["userId", "sessionId", "itemInSession", "start_time"], loads.PLAY_IDENTITY)],
        "year", "month",
    )
    new = not_stored(batch, stored, loads.PLAY_IDENTITY, loads.FACT_PARTITIONS)
    plan = new._jdf.queryExecution().toString()
    filters = re.search(r"PartitionFilters: \[(.+?)\], PushedFilters", plan)
    assert filters and "month" in filters[1] and "year" in filters[1]
    assert "Join LeftAnti" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert [r.item_in_session for r in new.collect()] == [99]
    scan = new._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoop" not in scan


def test_new_rows_against_brute_force(spark):
    import random

    rng = random.Random(1)

    def some(n):
        return [(rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]), rng.choice([None, 5, 6]), rng.randrange(9)) for _ in range(n)]

    schema = "k int, s string, p int, v int"
    for stored_rows in ([], some(8)):
        batch = some(30)
        want = {}
        for k, s, p, v in sorted(batch, key=lambda r: (r[3], r[2] is not None, r[2] or 0)):
            if (k, s) not in {(a, b) for a, b, _, _ in stored_rows}:
                want.setdefault((k, s), (k, s, p, v))
        stored = spark.createDataFrame([(k, s, v, p) for k, s, p, v in stored_rows], "k int, s string, v int, p int")
        got = new_rows(spark.createDataFrame(batch, schema), stored, ["k", "s"], order=["v"])
        assert rows(got) == sorted(want.values(), key=repr)
    one = spark.createDataFrame(some(40), schema)
    assert rows(new_rows(one, None, ["k", "s"])) == rows(new_rows(one, one.limit(0), ["k", "s"]))


def test_partition_filter_by_name_and_by_range(spark):
    few = spark.createDataFrame([(2018, 11), (2018, None), (2018, 11)], "year int, month int")
    stored = spark.range(0, 36).select((2016 + F.col("id") / 12).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"))
    stored = stored.unionByName(few)
    assert rows(stored.where(partition_filter(few, ["year", "month"])).distinct()) == [(2018, 11), (2018, None)]
    many = spark.range(MAX_PARTITIONS + 5).select((1000 + F.col("id")).cast("int").alias("year"), F.lit(1).alias("month"))
    inside = stored.where(partition_filter(many, ["year", "month"]))
    assert inside.count() == 0
    assert partition_filter(few.limit(0), ["year", "month"]) is None
    assert not_stored(few.limit(0), stored, ["year", "month"], ["year", "month"]).count() == 0


# -- counted writes -----------------------------------------------------------------


def test_writes_count_their_rows(spark, tmp_dir):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    assert write_counted(df, f"{tmp_dir}/a") == 1000
    assert write_counted(df, f"{tmp_dir}/b", ["k"]) == 1000
    assert write_counted(df.where("id < 0"), f"{tmp_dir}/c") == 0
    assert write_counted(df.where("id < 0"), f"{tmp_dir}/d", ["k"]) == 0
    parts = df.withColumn("part", (F.col("id") % 50).cast("int"))
    assert write_counted_by(parts, f"{tmp_dir}/e", "part", 60) == dict.fromkeys(range(50), 20)
    assert write_counted_by(parts.where("id < 0"), f"{tmp_dir}/f", "part", 60) == {}


def _executions(spark):
    return spark._jsparkSession.sharedState().statusStore().executionsList()


def _plans_since(spark, n):
    found = _executions(spark)
    return [found.apply(i).physicalPlanDescription() for i in range(n, found.size())]


def test_count_report_scans_lineitem_once(spark):
    from dimspark.plans import catalog

    before = _executions(spark).size()
    out = catalog.queries()["count_report"](spark, "/root/testdata/sf0.001")
    assert {r["table"]: r["count"] for r in out.collect()}["staging_events"] == spark.read.parquet(
        "/root/testdata/sf0.001/lineitem.parquet"
    ).count()
    plans = [p for p in _plans_since(spark, before) if "lineitem.parquet" in p]
    assert len(plans) == 2  # the staging write, and the count of this test


def test_no_count_job_after_a_load(spark, songs, tmp_dir):
    """Every job of a load writes, or finds the touched months or parts."""
    root = os.path.join(tmp_dir, "dw")
    logs = _logs(spark, [_play(i) for i in range(5)])
    loads.load_music_warehouse(spark, logs, songs, root)
    before = _executions(spark).size()
    loads.load_music_warehouse(spark, logs, songs, root)
    plans = _plans_since(spark, before)
    reads = [p for p in plans if "InsertIntoHadoopFsRelationCommand" not in p]
    assert len(plans) - len(reads) == 7  # two staged tables, five loaded ones
    assert all("count(1)" not in p for p in reads) and len(reads) == 2


# -- upserted tables ------------------------------------------------------------------


def _change(stored, batch):
    from dimspark.operators.upsert import upsert_update

    return upsert_update(stored, batch, ["id"], ["t"], ["level"], ["name", "level"])


def _batch(spark, ids, t, level):
    return spark.createDataFrame([(i, f"n{i}-{t}", level, t) for i in ids], "id long, name string, level string, t int")


def test_upsert_rewrites_touched_partitions_only(spark, tmp_dir):
    root = f"{tmp_dir}/users"
    first = upserted.upsert(spark, root, _batch(spark, range(200), 0, "free"), ["id"], _change, rows_per_part=10)
    assert first["parts_total"] == 20 and first["rows"] == 200 == first["rows_written"]
    second = upserted.upsert(spark, root, _batch(spark, [3, 3, 1000], 1, "paid"), ["id"], _change)
    folder = [n for n in os.listdir(f"{root}/u=000000000001") if n.startswith(upserted.PART)]
    assert second["parts_touched"] == second["parts_written"] == len(folder) <= 2
    assert second["rows"] == 201 and second["rows_written"] < 201
    got = {r.id: (r.name, r.level) for r in upserted.read_upserted(spark, root).collect()}
    assert got == {i: (f"n{i}-0", "free") for i in range(200)} | {3: ("n3-0", "paid"), 1000: ("n1000-1", "paid")}
    # the table before the second load, and through the versioned reader
    assert upserted.read_upserted(spark, root, before=1).where("level = 'paid'").count() == 0
    assert versioned.read_latest(spark, root).count() == versioned.table_rows(spark, root) == 201
    # a load without rows touches nothing
    third = upserted.upsert(spark, root, _batch(spark, [], 2, "x"), ["id"], _change)
    assert third["parts_written"] == 0 and third["rows"] == 201
    with pytest.raises(ValueError):
        upserted.upsert(spark, root, _batch(spark, [1], 2, "x"), ["name"], _change)


def test_a_dead_upsert_counts_for_nothing(spark, tmp_dir):
    root = f"{tmp_dir}/users"
    upserted.upsert(spark, root, _batch(spark, range(50), 0, "free"), ["id"], _change, rows_per_part=10)
    upserted.upsert(spark, root, _batch(spark, [1, 2], 1, "paid"), ["id"], _change, load=5)
    os.remove(f"{root}/u=000000000005/{upserted.MANIFEST}")  # died before its record
    assert upserted.read_upserted(spark, root).where("level = 'paid'").count() == 0
    again = upserted.upsert(spark, root, _batch(spark, [1, 2], 1, "paid"), ["id"], _change, load=5)
    assert again["rows"] == 50 and upserted.committed_loads(spark, root) == [0, 5]
    assert upserted.read_upserted(spark, root).where("level = 'paid'").count() == 2


def test_resize_and_removal_of_old_parts(spark, tmp_dir):
    root = f"{tmp_dir}/users"
    upserted.upsert(spark, root, _batch(spark, range(30), 0, "free"), ["id"], _change, rows_per_part=30)
    upserted.upsert(spark, root, _batch(spark, range(20, 90), 1, "paid"), ["id"], _change)
    want = rows(upserted.read_upserted(spark, root))
    assert upserted.resize(spark, root, rows_per_part=9)["parts_total"] == 10
    assert rows(upserted.read_upserted(spark, root)) == want
    assert upserted.remove_old(spark, root) == 2
    assert rows(upserted.read_upserted(spark, root)) == want and upserted.upserted_rows(spark, root) == 90
    assert sorted(os.listdir(root)) == ["u=000000000002"]


def test_a_null_key_and_a_table_kept_otherwise(spark, tmp_dir):
    root = f"{tmp_dir}/users"
    versioned.write_version(_batch(spark, [1, 2], 0, "free").select("id", "name", "level"), root, 0)
    batch = _batch(spark, [2, 3], 1, "paid").unionByName(spark.createDataFrame([(None, "n", "l", 1)], "id long, name string, level string, t int"))
    upserted.upsert(spark, root, batch, ["id"], _change, load=1, adopt=versioned.read_latest(spark, root))
    got = {(r.id, r.level) for r in versioned.read_latest(spark, root).collect()}
    assert got == {(1, "free"), (2, "paid"), (3, "paid"), (None, "l")}
    assert versioned.next_version(spark, root) == 2


def test_stored_users_equal_the_whole_log(spark, songs, tmp_dir):
    """Users loaded in three parts, by partitions, equal one load of all."""
    plays = [_play(i, user=str(i % 9), ts=T0 + 1000 * i, level="paid" if i % 4 else "free") for i in range(60)]
    for k in range(3):
        loads.load_users(spark, _logs(spark, plays[20 * k : 20 * k + 20]), f"{tmp_dir}/u", k)
    assert rows(versioned.read_latest(spark, f"{tmp_dir}/u")) == rows(music.build_users(_logs(spark, plays), "upsert"))


# -- generated keys ---------------------------------------------------------------------


def test_keys_are_gapless_repeatable_and_go_on(spark, tmp_dir):
    import random

    rng = random.Random(2)
    # a third of the rows share one order value; NULLs; equal rows
    data = [(rng.choice([0, 0, None, *range(40)]), rng.choice(["a", None, "b"]), rng.randrange(50)) for _ in range(700)]
    df = spark.createDataFrame(data, "t int, s string, v int")
    seen = []
    for parts, shuffled in ((1, df), (7, df.repartition(5)), (40, df.repartition(3, "v"))):
        keyed = surrogate.with_surrogate_key(shuffled, "k", ["t"], start=10, partitions=parts)
        assert keyed.columns == ["k", "t", "s", "v"]
        seen.append(sorted((tuple(r) for r in keyed.collect()), key=lambda r: r[0]))
    assert seen[0] == seen[1] == seen[2]
    assert [r[0] for r in seen[0]] == list(range(10, 710))
    order = [(r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3]) for r in seen[0]]
    assert order == sorted(order)
    assert surrogate.with_surrogate_key(df.limit(0), "k", ["t"]).count() == 0

    root = f"{tmp_dir}/t"
    assert surrogate.append_with_key(spark, df, root, "k", ["t"], load=3) == 700
    for _ in range(2):  # run again under its id
        assert surrogate.append_with_key(spark, df.where("v < 9"), root, "k", ["t"], load=4) == sum(r[2] < 9 for r in data)
    surrogate.append_with_key(spark, df.limit(0), root, "k", ["t"], load=5)
    keys = sorted(r.k for r in versioned.read_latest(spark, root, spark.read.parquet(f"{root}/v=000000000003").schema).collect())
    assert keys == list(range(1, versioned.table_rows(spark, root) + 1))


def test_plays_numbered_over_loads(spark, songs, tmp_dir):
    root = os.path.join(tmp_dir, "dw")
    first = [_play(i, ts=T0 + 1000 * i) for i in (3, 1, 2)]
    loads.load_music_warehouse(spark, _logs(spark, first), songs, root, key="identity")
    for _ in range(2):
        more = [*first, _play(None, ts=T0 + 500_000), _play(9, ts=T0 - 5_000_000_000)]
        loads.load_music_warehouse(spark, _logs(spark, more), songs, root, key="identity")
    got = {r.item_in_session: r.songplay_id for r in versioned.read_latest(spark, f"{root}/songplays").collect()}
    assert got == {1: 1, 2: 2, 3: 3, 9: 4, None: 5}


def test_partitions_are_found_in_the_batch_as_it_comes(spark, monkeypatch):
    """Finding the batch's partitions does not pick its rows a second time."""
    from dimspark.operators import incremental

    seen, find = [], incremental.partition_filter
    monkeypatch.setattr(incremental, "partition_filter", lambda df, cols: seen.append(df) or find(df, cols))
    batch = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (2, 1, "c"), (None, 2, "d")], "k int, p int, v string")
    stored = spark.createDataFrame([(2, 1), (3, 1)], "k int, p int")
    assert rows(new_rows(batch, stored, ["k"], ["p"])) == sorted([(1, 1, "a"), (None, 2, "d")], key=repr)
    assert len(seen) == 1 and "Aggregate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_reloads_join_their_log_once(spark, monkeypatch):
    from dimspark.plans import driver_io

    for query in ("warehouse_reloads", "warehouse_incremental"):
        staged = []

        def load(spark_, logs, songs, root, load=loads.load_music_warehouse, staged=staged):
            staged.append(logs)
            return load(spark_, logs, songs, root)

        monkeypatch.setattr(driver_io, "load_music_warehouse", load)
        getattr(driver_io, query)(spark, "/root/testdata/sf0.001")
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in staged]
        assert len(plans) == 3 and all("Join" not in p for p in plans), query
