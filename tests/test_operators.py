"""Operators: dedupe, lookup joins, upserts, aggregates, broadcast check."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dimspark.operators.aggregates import count_by, count_report, pivot_sum, two_level_avg
from dimspark.operators.dedupe import distinct_rows, keep_first, keep_last
from dimspark.operators.lookup import full_join_using, join_chain, lookup_left
from dimspark.operators.upsert import insert_new_keys, skip_loaded, upsert_replace, upsert_update


def test_keep_first_last_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "z", 1), (2, None, 5), (None, "n", 0)], "k int, v string, o int")
    assert rows(keep_first(df, ["k"], ["o"])) == rows(spark.createDataFrame([(1, "z", 1), (2, None, 5), (None, "n", 0)], df.schema))
    # tie on o=2: broken by the other columns, so always the same row
    assert rows(keep_last(df, ["k"], ["o"])) == rows(spark.createDataFrame([(1, "b", 2), (2, None, 5), (None, "n", 0)], df.schema))
    assert distinct_rows(df, ["k"]).count() == 3


def test_keep_first_hot_key(spark):
    # one key holds most rows: the partial aggregate reduces it map-side
    df = spark.range(0, 20000).select((F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1))).alias("k"),
                                      F.col("id").alias("o"))
    out = keep_first(df, ["k"], ["o"])
    assert out.where("k = -1").first()["o"] == 1
    assert out.count() == 1 + len(range(0, 20000, 3))


def test_lookup_left_at_most_one_match(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz")], "id int, key string")
    dim = spark.createDataFrame([("a", 10), ("a", 5), ("b", 7), (None, 1)], "key string, val int")
    out = lookup_left(facts, dim, ["key"], ["key"], ["val"])
    assert rows(out) == rows(spark.createDataFrame([(1, "a", 5), (2, "b", 7), (3, None, None), (4, "zz", None)], "id int, key string, val int"))
    salted = lookup_left(facts, dim, ["key"], ["key"], ["val"], salt_buckets=3)
    assert rows(salted) == rows(out)


def test_full_join_and_chain(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(2, "p"), (3, "q")], "k int, b string")
    assert rows(full_join_using(a, b, "k")) == [(1, "x", None), (2, "y", "p"), (3, None, "q")]
    c = spark.createDataFrame([(2, 9)], "k int, c int")
    assert rows(join_chain(a, [b, c], "k")) == [(2, "y", "p", 9)]


def test_insert_new_keys_idempotent(spark):
    existing = spark.createDataFrame([("s1", "old")], "id string, v string")
    batch = spark.createDataFrame([("s1", "new"), ("s2", "b"), ("s2", "a")], "id string, v string")
    once = insert_new_keys(existing, batch, ["id"], ["v"])
    assert rows(once) == [("s1", "old"), ("s2", "a")]
    assert rows(insert_new_keys(once, batch, ["id"], ["v"])) == rows(once)


def test_upsert_update_and_replace(spark):
    existing = spark.createDataFrame([(1, "Ann", "free"), (2, "Bob", "free")], "id int, name string, level string")
    batch = spark.createDataFrame([(1, "Annie", "paid", 5), (1, "Anna", "free", 3), (3, "Cy", "paid", 1)],
                                  "id int, name string, level string, ts int")
    up = upsert_update(existing, batch, ["id"], ["ts"], ["level"])
    assert rows(up) == [(1, "Ann", "paid"), (2, "Bob", "free"), (3, "Cy", "paid")]
    assert rows(upsert_update(up, batch, ["id"], ["ts"], ["level"])) == rows(up)
    rep = upsert_replace(existing, batch.drop("ts"), ["id"], ["level", "name"])
    assert rows(rep) == [(1, "Annie", "paid"), (2, "Bob", "free"), (3, "Cy", "paid")]


def test_skip_loaded_keeps_null_keys(spark):
    loaded = spark.createDataFrame([(10, 182)], "user_id int, session_id int")
    new = spark.createDataFrame([(10, 182, "a"), (10, 183, "b"), (None, 182, "c")], "userId int, sessionId int, x string")
    out = skip_loaded(new, loaded, ["userId", "sessionId"], ["user_id", "session_id"])
    assert rows(out, "x") == [("b",), ("c",)]


def test_aggregates(spark):
    df = spark.createDataFrame([("TX", "Asian", 5), ("TX", "White", 7), ("NY", "White", 1), ("TX", "Asian", 1)],
                               "s string, r string, c int")
    p = pivot_sum(df, ["s"], "r", ["Asian", "White", "Other"], "c", {"Asian": "num_asian"})
    assert rows(p) == [("NY", None, 1, None), ("TX", 6, 7, None)]
    assert p.columns == ["s", "num_asian", "White", "Other"]
    assert rows(count_by(df, ["s"])) == [("NY", 1), ("TX", 3)]
    rep = count_report({"a": df, "b": df.where("s = 'NY'")})
    assert rows(rep) == [("a", 4), ("b", 1)]
    vals = spark.createDataFrame([("c1", 1.0), ("c1", 2.0), ("c2", 4.0)], "city string, v double")
    mapping = spark.createDataFrame([("c1", "S"), ("c2", "S"), ("c1", "S")], "city string, state string")
    out = two_level_avg(vals, "city", "v", mapping, "state")
    assert rows(out) == [("S", 2.75)]


def test_unknown_modes_raise(spark):
    from dimspark.plans import music

    df = spark.createDataFrame([("s", "t", "a", 1, 1.0)], "song_id string, title string, artist_id string, year int, duration double")
    with pytest.raises(ValueError):
        music.build_songs(df, "bogus")
