"""Skewed input: one key holds a third of all rows.

Every keyed operator must stay exact on such data, and its plan must
combine rows map-side (partial aggregation) before the shuffle, so the
hot key ships one partial row per map task instead of its whole group.
"""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import rows
from dimspark.operators.aggregates import count_by, pivot_sum, two_level_avg
from dimspark.operators.dedupe import keep_first, keep_last
from dimspark.operators.lookup import lookup_left
from dimspark.operators.upsert import upsert_replace, upsert_update

N = 6000


def _skewed(spark):
    rnd = random.Random(7)
    data = []
    for i in range(N):
        k = "hot" if i % 3 == 0 else f"k{rnd.randrange(400)}"
        data.append((i, k, rnd.choice(["free", "paid"]), rnd.randrange(50), rnd.choice(["A", "B", "C"])))
    return data, spark.createDataFrame(data, "id long, k string, level string, ts int, seg string").repartition(8)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_last_wins_on_hot_key(spark):
    data, df = _skewed(spark)
    first = keep_first(df, ["k"], ["ts", "id"])
    last = keep_last(df, ["k"], ["ts", "id"])
    want_first, want_last = {}, {}
    for r in data:
        k = r[1]
        if k not in want_first or (r[3], r[0]) < (want_first[k][3], want_first[k][0]):
            want_first[k] = r
        if k not in want_last or (r[3], r[0]) > (want_last[k][3], want_last[k][0]):
            want_last[k] = r
    assert rows(first) == sorted(want_first.values(), key=repr)
    assert rows(last) == sorted(want_last.values(), key=repr)
    assert "partial_min" in _plan(first) and "partial_max" in _plan(last)


def test_upserts_on_hot_key(spark):
    data, df = _skewed(spark)
    users = upsert_update(None, df.select("k", "seg", "level", "ts", "id"), ["k"], ["ts", "id"], ["level"],
                          columns=["seg", "level"])
    got = {r["k"]: (r["seg"], r["level"]) for r in users.collect()}
    by_key = {}
    for r in data:
        by_key.setdefault(r[1], []).append(r)
    for k, rs in by_key.items():
        # ties on (ts, id) cannot occur: id is unique
        first = min(rs, key=lambda r: (r[3], r[0]))
        last = max(rs, key=lambda r: (r[3], r[0]))
        assert got[k] == (first[4], last[2])
    assert "partial_min" in _plan(users) and "partial_max" in _plan(users)
    replaced = upsert_replace(None, df, ["k"], ["ts", "id"])
    assert replaced.count() == len(by_key)


def test_salted_lookup_equals_plain_lookup(spark):
    data, facts = _skewed(spark)
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k7", 4)], "k string, v int")
    plain = lookup_left(facts, dim, ["k"], ["k"], ["v"])
    salted = lookup_left(facts, dim, ["k"], ["k"], ["v"], salt_buckets=8)
    assert plain.count() == N
    assert rows(plain) == rows(salted)
    assert plain.where("k = 'hot'").select("v").distinct().collect()[0]["v"] == 1


def test_aggregates_on_hot_key(spark):
    data, df = _skewed(spark)
    counts = {r["k"]: r["count"] for r in count_by(df, ["k"]).collect()}
    assert counts["hot"] == N // 3 and sum(counts.values()) == N
    piv = pivot_sum(df, ["k"], "seg", ["A", "B", "C"], "ts")
    hot = piv.where("k = 'hot'").first()
    for s in "ABC":
        assert hot[s] == sum(r[3] for r in data if r[1] == "hot" and r[4] == s)
    assert "partial_" in _plan(piv)
    mapping = df.select("k", F.when(F.col("k") == "hot", "H").otherwise("O").alias("grp"))
    avg = {r["grp"]: r["avg"] for r in two_level_avg(df, "k", "ts", mapping, "grp").collect()}
    hot_avg = round(sum(r[3] for r in data if r[1] == "hot") / (N // 3), 2)
    assert avg["H"] == hot_avg


def test_null_keys_spread_and_never_match(spark):
    """A third of the facts have a NULL key: left joins and the skip-loaded
    anti join keep them (values NULL), match none of them, and give the
    same rows as without the spreading column."""
    from dimspark.operators.lookup import left_join_all, null_key_spread
    from dimspark.operators.upsert import skip_loaded

    data = [(i, None if i % 3 == 0 else f"k{i % 50}", i % 7) for i in range(3000)]
    facts = spark.createDataFrame(data, "id long, k string, s int").repartition(8)
    dim = spark.createDataFrame([(f"k{j}", j) for j in range(0, 50, 2)], "k string, v int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force shuffled joins
    try:
        got = lookup_left(facts, dim, ["k"], ["k"], ["v"])
        want = {i: (None if k is None or int(k[1:]) % 2 else int(k[1:])) for i, k, _ in data}
        assert {r["id"]: r["v"] for r in got.collect()} == want
        assert got.count() == len(data)
        all3 = left_join_all(facts, dim, ["k"], ["k"], ["v"])
        assert rows(all3) == rows(got)
        loaded = spark.createDataFrame([("k2", 1), (None, 2)], "k string, s int")
        kept = skip_loaded(facts, loaded, ["k"], ["k"])
        assert sorted(r["id"] for r in kept.collect()) == sorted(i for i, k, _ in data if k != "k2")
        # NULL-key rows have many values of the extra key, and the plan still
        # deals both sides by it: the optimizer has not folded it away
        b = facts.withColumn("b", null_key_spread(facts, ["k"]))
        assert b.where("k IS NULL").select("b").distinct().count() == 1000
        assert b.where("k IS NULL AND b = 0 OR k IS NOT NULL AND b <> 0").count() == 0
        for out in (got, all3, kept):
            plan = _plan(out)
            assert len([x for x in plan.split("hashpartitioning(")[1:] if "__nk" in x.split(")")[0]]) >= 2, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
