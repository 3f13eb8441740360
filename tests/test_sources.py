"""Path files, checked CSV, byte-bounded text, run folders, co-located tables."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from dimspark.functions.textfn import truncate_bytes
from dimspark.plans.quality import DataQualityError
from dimspark.sinks import colocated
from dimspark.sources import jsonpaths as J
from dimspark.sources import runs as R
from dimspark.sources.checked_csv import read_csv_checked
from dimspark.sources.staging import clean_strings

# -- path files -------------------------------------------------------------------


def test_paths_are_parsed():
    assert J.parse_path("$.a.b") == ["a", "b"]
    assert J.parse_path("$['a'][\"b c\"][12].d") == ["a", "b c", 12, "d"]
    assert J.parse_path(r"$['it\'s.x']") == ["it's.x"]
    for bad in ("a.b", "$", "$[0]", "$.a[", "$.a[x]", "$..a", "$['a'"):
        with pytest.raises(ValueError):
            J.parse_path(bad)


def test_paths_compile_to_the_least_schema():
    paths = [J.parse_path(p) for p in ("$.a.b[1].c", "$.a.b[0].d", "$.e", "$.a.b[3].c")]
    kinds = [T.LongType(), T.StringType(), T.DoubleType(), T.LongType()]
    assert J.compile_schema(paths, kinds).simpleString() == "struct<a:struct<b:array<struct<c:bigint,d:string>>>,e:double>"
    for one, two in (("$.a", "$.a.b"), ("$.a[0]", "$.a.b"), ("$.a.b", "$.a"), ("$.ab", "$.Ab")):
        with pytest.raises(ValueError):
            J.compile_schema([J.parse_path(one), J.parse_path(two)], [T.LongType()] * 2)
    with pytest.raises(ValueError):
        J.compile_schema([["a"], ["a"]], [T.LongType(), T.StringType()])


def test_nested_log_through_a_path_file(spark, tmp_dir):
    records = [
        {"u": {"id": 7, "x.y": "dot"}, "l": [[1, 2], [3]], "t": 1500, "more": {"big": "x" * 50}},
        {"u": {"id": "no number"}, "l": [[5]], "t": None},
        {"l": None}, {},
    ]
    os.makedirs(f"{tmp_dir}/in/day=1")
    with open(f"{tmp_dir}/in/day=1/a.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)
    with open(f"{tmp_dir}/paths", "w") as f:
        json.dump({"jsonpaths": ["$.t", "$.l[1][0]", "$.l[0][1]", "$.u['x.y']", "$.u.id"]}, f)
    target = T.StructType.fromDDL("at timestamp, b bigint, c bigint, d string, id bigint")
    df = J.read_json_paths(spark, f"{tmp_dir}/in", f"{tmp_dir}/paths", target, epoch_ms=["at"])
    assert rows(df.select(F.unix_millis("at"), "b", "c", "d", "id")) == sorted(
        [(1500, 3, 2, "dot", 7), (None,) * 5, (None,) * 5, (None,) * 5], key=repr
    )
    assert "more" not in df._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        J.read_json_paths(spark, f"{tmp_dir}/in", f"{tmp_dir}/paths", T.StructType(target.fields[:2]))
    with pytest.raises(FileNotFoundError):
        J.read_path_file(spark, f"{tmp_dir}/none")


# -- CSV with bad rows ----------------------------------------------------------------


def test_bad_records_are_set_apart(spark, tmp_dir):
    good = ['1;"a;b";2.5', '2;"say ""hi""";', "3;;1"]
    bad = ["4;x", "5;x;1;2", "6,x,1", "y;x;1", "7;x;wide"]
    for name, lines in (("a.csv", good + bad[:2]), ("b.csv", bad[2:]), ("c.csv", [])):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("\n".join(["k;name;v", *lines]) + "\n")
    schema = T.StructType.fromDDL("k int, name string, v double")
    found = read_csv_checked(spark, tmp_dir, schema, sep=";")
    assert rows(found.good) == sorted([(1, "a;b", 2.5), (2, 'say "hi"', None), (3, None, 1.0)], key=repr)
    assert rows(found.bad.select("record")) == sorted((b,) for b in bad)
    assert {os.path.basename(r.file): r.record for r in found.bad.collect()}.keys() == {"a.csv", "b.csv"}
    assert (found.n_good, found.n_bad) == (3, 5)
    # fewer columns asked for: the same records are good
    assert found.good.select("k").count() == 3 and found.good.count() == 3
    assert found.require(max_bad=5) is found.good
    with pytest.raises(DataQualityError):
        found.require()


def test_csv_without_records_or_without_bad_ones(spark, tmp_dir):
    schema = T.StructType.fromDDL("k int, name string")
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("k,name\n")
    empty = read_csv_checked(spark, tmp_dir, schema)
    assert (empty.n_good, empty.n_bad, empty.good.count(), empty.bad.count()) == (0, 0, 0, 0)
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write('k,name\n1,"two\nlines"\n')
    assert read_csv_checked(spark, tmp_dir, schema, multi_line=True).require().collect()[0].name == "two\nlines"


# -- byte-bounded text ------------------------------------------------------------------


def test_truncate_bytes_against_python(spark):
    rng = random.Random(5)
    texts = ["", "a", "é", "€", "😀", "a😀", None, "́" * 9] + ["".join(rng.choice("aé€😀") for _ in range(rng.randrange(12))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for width in (0, 1, 2, 3, 4, 5, 11, 40):
        got = {r.i: r.x for r in df.select("i", truncate_bytes("t", width).alias("x")).collect()}
        for i, t in enumerate(texts):
            want = None if t is None else t.encode()[:width].decode(errors="ignore")
            assert got[i] == want, (t, width)
    cleaned = clean_strings(df.withColumn("u", F.col("t")), truncate_to_bytes={"t": 5})
    assert cleaned.where("octet_length(t) > 5").count() == 0 and cleaned.where("octet_length(u) > 5").count() > 0
    with pytest.raises(ValueError):
        truncate_bytes("t", -1)


# -- run folders ----------------------------------------------------------------------------

START = dt.datetime(2018, 11, 30, 22)


def _hours(spark, root, hours):
    for h in hours:
        t = START + h * R.HOUR
        spark.createDataFrame([(h,)], "h int").write.json(f"{root}/{t:%Y/%m/%d/%H}")
    return root + "/{year}/{month}/{day}/{hour}"


def test_only_folders_of_the_range_are_read(spark, tmp_dir):
    template = _hours(spark, tmp_dir, [0, 1, 3, 4, 9])
    plan = R.plan_runs(spark, template, START + R.HOUR, START + 5 * R.HOUR)
    assert list(plan.present) == [START + h * R.HOUR for h in (1, 3, 4)]
    assert plan.missing == [START + 2 * R.HOUR]
    df = R.read_runs(spark, plan, lambda paths: spark.read.schema("h int").json(paths))
    assert {f.split("/")[-2] for f in df.inputFiles()} == {"23", "01", "02"}
    assert rows(df) == [(1,), (3,), (4,)]
    assert R.read_runs(spark, R.plan_runs(spark, template, START + 6 * R.HOUR, START + 8 * R.HOUR), None) is None
    with pytest.raises(ValueError):
        list(R.run_times(START, START + R.HOUR, dt.timedelta(0)))
    # one folder for several runs is read once
    daily = R.plan_runs(spark, tmp_dir + "/{year}/{month}/{day}/23", START, START + 2 * R.HOUR)
    assert R.read_runs(spark, daily, lambda paths: spark.read.schema("h int").json(paths)).count() == 1


def test_back_fill_loads_each_run_once(spark, tmp_dir):
    template, seen = _hours(spark, f"{tmp_dir}/in", [0, 2, 3]), []

    def load(df, load_id):
        seen.append((load_id, [r.h for r in df.collect()]))
        if len(seen) == 2:
            raise RuntimeError("fails once")

    def run(hours):
        return R.back_fill(spark, template, START, START + hours * R.HOUR, f"{tmp_dir}/ledger", load,
                           lambda paths: spark.read.schema("h int").json(paths))

    with pytest.raises(RuntimeError):
        run(4)
    again = run(5)
    assert [len(again[k]) for k in ("loaded", "before", "missing")] == [2, 1, 2]
    first = R.load_id(START)
    assert seen == [(first, [0]), (first + 120, [2]), (first + 120, [2]), (first + 180, [3])]
    assert run(5)["loaded"] == [] and again["missing"] == [START + R.HOUR, START + 4 * R.HOUR]


# -- co-located tables ------------------------------------------------------------------------


def test_join_and_group_by_of_colocated_tables_do_not_shuffle(spark, tmp_dir):
    a = spark.range(2000).select((F.col("id") % 400).alias("k"), F.col("id").alias("v"))
    b = spark.range(300).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w"))
    n = colocated.save_colocated(spark, {"co_a": (a, ["k"]), "co_b": (b, ["key"])}, location=tmp_dir, least=4)
    assert n == 4
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("co_a").join(spark.table("co_b"), F.col("k") == F.col("key"))
        out = j.groupBy("k").agg(F.sum("v").alias("v"), F.max("w").alias("w"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        want = a.join(b, F.col("k") == F.col("key")).groupBy("k").agg(F.sum("v").alias("v"), F.max("w").alias("w"))
        assert rows(out) == rows(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE co_a")
        spark.sql("DROP TABLE co_b")
    assert len([f for f in os.listdir(f"{tmp_dir}/co_a") if f.endswith(".parquet")]) == 4


def test_colocated_query_has_no_exchange(spark):
    from dimspark.plans import catalog

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.queries()["colocated_orders"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan and "Join" in plan


def test_bucket_count_grows_with_the_table(spark):
    df = spark.range(1 << 20)  # 8 MB by estimate
    assert colocated.buckets_for(df, bucket_bytes=8 << 20) == 1
    assert colocated.buckets_for(df, bucket_bytes=1 << 20) == 8
    assert colocated.buckets_for(df, bucket_bytes=1) == colocated.buckets_for(df, bucket_bytes=16) == colocated.MAX_BUCKETS
    assert colocated.buckets_for(df, least=5) == 8
    one, two = spark.range(1 << 20), spark.range(1 << 10)
    assert colocated.plan_bytes(one.join(two, "id")) <= colocated.plan_bytes(one) + colocated.plan_bytes(two)


def test_bucket_count_is_by_rows_not_by_compressed_bytes(spark, tmp_dir):
    """Rows that compress well take as much memory in a bucket as others."""
    spark.range(1 << 18).select((F.col("id") % 2).alias("k"), F.lit(1).cast("bigint").alias("v")).write.parquet(f"{tmp_dir}/flat")
    df = spark.read.parquet(f"{tmp_dir}/flat")
    assert colocated.plan_bytes(df) < 1 << 20
    assert colocated.buckets_for(df, bucket_bytes=1 << 20) == 4  # 16 bytes a row
    assert colocated.buckets_for(df, bucket_bytes=1 << 20, rows=1 << 20) == 16


def test_lake_load_writes_its_sources_compressed(spark, monkeypatch):
    from dimspark.plans import driver_sources

    roots = []
    monkeypatch.setattr(driver_sources, "delete", lambda _, path: roots.append(path))
    out = driver_sources.lake_load(spark, "/root/testdata/sf0.001")
    files = [f for r in roots for _, _, names in os.walk(r) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert out.count() == lines.where("l_returnflag = 'N'").count()
