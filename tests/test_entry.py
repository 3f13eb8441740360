"""Driver contract: entry() and every registered query against its DuckDB oracle (sf0.001)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from dimspark.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        return ("~nan",) if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "songplay_id", "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"
    ]


def test_every_query_has_an_oracle():
    missing = set(catalog.queries()) - set(catalog.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _canon(sdf.columns, srows) == _canon(dcols, drows)


# Operators no registered query may contain: all-pairs joins, Python
# evaluation (UDFs, pandas functions), windows over whole groups, and
# limits (outside the query whose limit is the feature).
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "InPandas", "InArrow",
             "Window")
LIMITS = ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject")
LIMIT_IS_FEATURE = {"limit_sorted"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_plan_shape(spark, name):
    df = entry.queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, (name, bad)
    if name not in LIMIT_IS_FEATURE:
        assert not [op for op in LIMITS if op in plan], name


def test_flagship_scans_are_pruned(spark):
    """The fact query reads only the columns it uses, and its NULL-key and
    song-play filters reach the Parquet scans."""
    df = entry.entry(spark)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unused in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey", "o_totalprice", "o_orderdate",
                   "c_acctbal", "c_nationkey", "c_name", "c_mktsegment"):
        assert unused not in plan, unused
    # the song-play filter (page = 'NextSong' on the view) reaches the lineitem scan
    assert "PushedFilters: [EqualNullSafe(l_returnflag,N), IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan


def test_date_filter_pushed_to_scan(spark):
    df = entry.queries()["skip_loaded"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan
    assert "GreaterThanOrEqual(o_orderdate," in plan


def test_point_lookups_are_pruned(spark):
    """The key of a point lookup reaches the scan, and a lookup in the
    bucketed table reads one bucket."""
    plan = _plan(entry.queries()["session_item_lookup"](spark, SF))
    assert "EqualTo(l_orderkey,6930)" in plan
    plan = _plan(entry.queries()["user_session_history"](spark, SF))
    assert "EqualTo(o_custkey,681)" in plan and "EqualTo(o_orderkey,1046)" in plan
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # shows the buckets read in the plan
    spark.conf.set(auto, "false")
    try:
        plan = _plan(entry.queries()["user_history_bucketed"](spark, SF))
    finally:
        spark.conf.unset(auto)
    assert "SelectedBucketsCount: 1 out of 8" in plan


LOADING = {"parquet_roundtrip", "csv_roundtrip", "json_time_dim", "stream_users", "warehouse_incremental",
           "session_item_stored", "user_history_bucketed", "label_sections", "label_country_dim", "staged_events_mapped",
           "event_csv_positional", "catalog_users", "catalog_time", "count_report", "warehouse_reloads", "label_all_sections",
           "label_mode_dim", "label_visa_dim", "label_port_list", "increasing_key",
           "staged_jsonpaths", "csv_checked", "templated_load", "colocated_orders", "lake_load", "immigration_load",
           "catalog_recreate", "state_join_chain"}


def test_builders_are_lazy(spark):
    """Building a query's DataFrame runs no job (but where writing and
    reading back is what the query shows)."""
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    for name in sorted(set(catalog.queries()) - LOADING):
        sc.setJobGroup(f"lazy-{name}", name)
        entry.queries()[name](spark, SF)
        assert not tracker.getJobIdsForGroup(f"lazy-{name}"), name
    sc.setJobGroup("tests", "tests")
