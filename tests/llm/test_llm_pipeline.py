"""The pipeline's stages against brute force on a small table, and the
registered queries on the smallest given one."""

from __future__ import annotations

import os
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from dimspark.llm import queries

from test_llm_operators import brute_components, brute_hits, brute_removed, encoded, shingles

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    words = [a + b for a in ("ba", "ko", "li", "mu", "ne") for b in ("ra", "so", "ti", "vu", "we", "x")]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n)) + "."

    insult = "zounkwit"
    passage, item = prose(60), prose(14)
    texts = [prose(rng.randint(20, 80)) + (f" you {insult}. {prose(5)} such a {insult}." if k % 4 == 0 else "") for k in range(160)]
    near = prose(120)
    texts += [near, near, near + " extra", None, "", passage + " " + prose(40), prose(30) + " " + passage, prose(9) + " " + item]
    path = str(tmp_path_factory.mktemp("corpus"))
    # columns named as the operators' own, or as their inner ones
    more = "toxicity string, n_words int, n_removed long, kept boolean, __row string, __chunk int"
    d = [(i, t, "en", f"s{i % 2}", len(t or ""), f"tox{i}", 7 * i, -i, i % 2 == 0, f"row{i}", 5) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + more
    spark.createDataFrame(d, schema).write.parquet(f"{path}/documents.parquet")
    lab = [(i, 1, int(i % 4 == 0)) for i in range(160)]
    spark.createDataFrame(lab, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, tables[-1], folder)
        assert k == 4 or out.columns == columns
        if k < 4:  # no column of the user's is touched but the text and its length
            bad = "toxicity <> concat('tox', doc_id) OR n_words <> 7 * doc_id OR n_removed <> -doc_id OR __chunk <> 5"
            assert out.where(f"{bad} OR __row <> concat('row', doc_id) OR kept <> (doc_id % 2 = 0)").count() == 0
        out.write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    start, clean, near, cut, safe, packed = tables
    texts = rows_of(start)
    kept = rows_of(clean)
    assert sum((i not in kept) == (i < 160 and i % 4 == 0) for i in texts) >= len(texts) - 2
    want = brute_components({i: shingles(t, 5) for i, t in kept.items()}, 80)
    assert set(rows_of(near)) == {i for i in want if want[i] == i}
    removed = brute_removed(rows_of(near).items(), corpus_pipeline.PASSAGE_WORDS)
    assert any(n for _, n, _ in removed.values())
    for i, t in rows_of(cut).items():
        assert t == (removed[i][2] if removed[i][1] else kept[i])
    assert all(r.n_chars == len(r.text or "") for r in cut.collect())
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = brute_hits([(i, t) for i, t in rows_of(cut).items()], items, 10)
    assert any(n for _, n, _ in hits.values())
    assert set(rows_of(safe)) == {i for i, h in hits.items() if not h[1]}
    assert {r.doc_id: r.length for r in packed.collect() if r.piece == 0} == {i: len(encoded(t, 1)) for i, t in rows_of(safe).items()}


def test_run_equals_its_stages_on_nothing_and_something(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 100
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_registered_queries(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = queries.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


NATIVE = ("op7_sharding", "op9_chat_format")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_have_no_python(spark, name):
    plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "ExistingRDD", "Cartesian", "NestedLoop") if x in plan]


