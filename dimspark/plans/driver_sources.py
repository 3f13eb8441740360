"""Driver queries over written sources and layouts: path files, checked CSV,
run folders, byte-bounded text, co-located tables, and whole loads."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.functions.textfn import truncate_bytes
from dimspark.plans import loads, music
from dimspark.plans.driver import ARTISTS_FIRST_SQL, LOOKUP_SQL, PLAYS_SQL, SONGS_T_SQL
from dimspark.plans.driver_capstone import FACT_SQL, airports_v, demo_v, ports_v, records_v, temp_v
from dimspark.plans.driver_views import EVENTS_LOG_V_SQL, PLAYS_V_SQL, SONGS_V_SQL, plays_v, songs_v, table, with_ctes
from dimspark.plans.registry import ntz, register
from dimspark.schemas import SONG_SCHEMA
from dimspark.session import scratch_dir
from dimspark.sinks.colocated import save_colocated
from dimspark.sinks.folders import delete, write_text
from dimspark.sinks.writers import write_csv_quoted
from dimspark.sources.checked_csv import read_csv_checked
from dimspark.sources.jsonpaths import read_json_paths
from dimspark.sources.labels import LABEL_SECTIONS
from dimspark.sources.runs import plan_runs, read_runs

# ------------------------------------------------------------------ JSON path file


@register(
    "staged_jsonpaths",
    """SELECT event_id, user_id, event_type AS kind, CASE WHEN user_id % 3 > 0 THEN value END AS second,
       CAST(NULL AS DOUBLE) AS tenth, date_trunc('millisecond', ts) AS ts,
       CASE WHEN event_type <> 'click' THEN props END AS note
FROM events""",
)
def staged_jsonpaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested log (objects, arrays of unlike length, a field name
    with a dot, records without some fields) loaded through a path file."""
    e = table(spark, sf_dir, "events")
    nested = e.select(
        F.struct(
            F.col("user_id").alias("id"),
            F.struct(
                F.col("event_type").alias("kind"),
                F.when(F.col("event_type") != "click", F.col("props")).alias("a.note"),
            ).alias("tags"),
        ).alias("actor"),
        F.when(F.col("user_id") % 3 > 0, F.array(F.col("event_id").cast("double"), F.col("value")))
        .otherwise(F.array(F.lit(1.0)))
        .alias("measures"),
        F.struct(
            F.array(F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").alias("n"))).alias("steps")
        ).alias("session"),
        F.lit("not read").alias("other"),
    )
    source, paths = scratch_dir(spark, "nested_log"), scratch_dir(spark, "paths")
    nested.write.json(source)
    found = [
        "$.session.steps[0].n", "$.actor.id", "$['actor']['tags'].kind", "$.measures[1]", "$.measures[9]",
        "$['session'].steps[0]['at']", '$.actor.tags["a.note"]',
    ]
    write_text(spark, f"{paths}/log_paths.json", json.dumps({"jsonpaths": found}))
    target = T.StructType.fromDDL(
        "event_id bigint, user_id bigint, kind string, second double, tenth double, ts timestamp, note string"
    )
    return ntz(read_json_paths(spark, source, f"{paths}/log_paths.json", target, epoch_ms=["ts"]), "ts")


# ------------------------------------------------------------------ CSV with bad rows

# One record per customer: plain, quoted with separators and quotes in it,
# short, over-long, with semicolons, or with text for a number.
CSV_RECORD_SQL = '''rec AS (
  SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation, c_custkey % 6 AS kind,
         CASE c_custkey % 6
           WHEN 0 THEN c_custkey || ',' || c_name || ',' || c_nationkey
           WHEN 1 THEN c_custkey || ',"' || c_name || ', the ""' || c_mktsegment || '""",' || c_nationkey
           WHEN 2 THEN c_custkey || ',' || c_name
           WHEN 3 THEN c_custkey || ',' || c_name || ',' || c_nationkey || ',"' || c_mktsegment || '"'
           WHEN 4 THEN c_custkey || ';' || c_name || ';' || c_nationkey
           ELSE c_custkey || ',' || c_name || ',n' || c_nationkey END AS record,
         CASE WHEN c_custkey % 6 = 1 THEN c_name || ', the "' || c_mktsegment || '"' ELSE c_name END AS text
  FROM customer)'''


@register(
    "csv_checked",
    with_ctes(CSV_RECORD_SQL)
    + """SELECT k, text AS name, nation, CAST(NULL AS VARCHAR) AS record FROM rec WHERE kind < 2
UNION ALL SELECT NULL, NULL, NULL, record FROM rec WHERE kind >= 2
UNION ALL SELECT count(*) FILTER (WHERE kind < 2), 'good and bad', CAST(count(*) FILTER (WHERE kind >= 2) AS INTEGER), 'counted' FROM rec""",
)
def csv_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV of good and bad records; the bad ones come back as they
    stand, and both kinds are counted by the scan itself."""
    c = table(spark, sf_dir, "customer")
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    nation, segment = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    kinds = [
        F.concat_ws(",", key, name, nation),
        F.concat(key, F.lit(',"'), name, F.lit(', the ""'), segment, F.lit('""",'), nation),
        F.concat_ws(",", key, name),
        F.concat(key, F.lit(","), name, F.lit(","), nation, F.lit(',"'), segment, F.lit('"')),
        F.concat_ws(";", key, name, nation),
        F.concat(key, F.lit(","), name, F.lit(",n"), nation),
    ]
    record = F.element_at(F.array(*kinds), (F.col("c_custkey") % 6 + 1).cast("int"))
    path = scratch_dir(spark, "csv_with_bad_rows")
    c.select(record.alias("value")).write.text(path)
    schema = T.StructType.fromDDL("k bigint, name string, nation int")
    found = read_csv_checked(spark, path, schema, header=False, glob="*.txt")
    delete(spark, path)
    good = found.good.withColumn("record", F.lit(None).cast("string"))
    bad = found.bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], "record")
    counts = spark.createDataFrame([(found.n_good, "good and bad", found.n_bad, "counted")], good.schema)
    return good.unionByName(bad).unionByName(counts)


# ------------------------------------------------------------------ byte-bounded text


@register(
    "truncate_bytes",
    """WITH t AS (SELECT doc_id, repeat('a', CAST(doc_id % 5 AS INTEGER)) || replace(text, ' ', '😀') AS x FROM documents)
SELECT doc_id, CASE WHEN strlen(x) <= 240 THEN x
  ELSE left(x, list_max(list_filter(range(0, 241), lambda k: strlen(left(x, k)) <= 240))) END AS x FROM t""",
)
def truncate_bytes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRUNCATECOLUMNS counts bytes: texts with characters of one to
    four bytes cut to at most 240 bytes, between characters."""
    d = table(spark, sf_dir, "documents")
    x = F.concat(F.repeat(F.lit("a"), (F.col("doc_id") % 5).cast("int")), F.replace("text", F.lit(" "), F.lit("😀")))
    return d.select("doc_id", truncate_bytes(x, 240).alias("x"))


# ------------------------------------------------------------------ scheduled runs


@register(
    "templated_load",
    """SELECT strftime(ts, '%Y-%m-%d') AS run, event_id, user_id FROM events
WHERE ts >= TIMESTAMP '2023-12-29' AND ts < TIMESTAMP '2024-01-11'
UNION ALL SELECT * FROM (VALUES ('2023-12-29', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)),
  ('2023-12-30', NULL, NULL), ('2023-12-31', NULL, NULL))""",
)
def templated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirteen daily runs by a path template: the folders that exist are
    read (and no other), a missing run comes as a row without an event."""
    root = scratch_dir(spark, "daily_events")
    day = {"year": F.date_format("ts", "yyyy"), "month": F.date_format("ts", "MM"), "day": F.date_format("ts", "dd")}
    e = table(spark, sf_dir, "events").withColumns(day)
    e.select("event_id", "user_id", *day, F.date_format("ts", "yyyy-MM-dd").alias("run")).hint("rebalance", *day).write.partitionBy(
        *day
    ).json(root)
    template = root + "/year={year}/month={month}/day={day}"
    plan = plan_runs(spark, template, dt.datetime(2023, 12, 29), dt.datetime(2024, 1, 11), dt.timedelta(days=1))
    schema = "run string, event_id bigint, user_id bigint"
    read = read_runs(spark, plan, lambda paths: spark.read.schema(schema).json(paths))
    missing = spark.createDataFrame([(t.strftime("%Y-%m-%d"), None, None) for t in plan.missing], schema)
    return missing if read is None else read.unionByName(missing)


# ------------------------------------------------------------------ co-located tables


@register(
    "colocated_orders",
    """SELECT o_orderkey, o_custkey, COUNT(*) AS lines, COUNT(DISTINCT l_partkey) AS parts, MIN(l_shipdate) AS first_ship,
       MAX(l_linenumber) AS last_line
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey""",
)
def colocated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines stored in the same buckets of the order key,
    as many as their size asks for; the join and the group-by that follow
    read bucket by bucket, without an exchange."""
    tag = uuid.uuid4().hex[:12]
    o, l = f"orders_{tag}", f"lines_{tag}"
    save_colocated(
        spark,
        {
            o: (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"]),
            l: (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_linenumber"), ["l_orderkey"]),
        },
        location=scratch_dir(spark, "colocated"),
        least=4,
    )
    j = spark.table(o).join(spark.table(l), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderkey", "o_custkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("l_partkey").alias("parts"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_linenumber").alias("last_line"),
    )


# ------------------------------------------------------------------ whole loads

_TEXT_SONGS_SQL = SONGS_V_SQL.replace("p_partkey AS song_id", "CAST(p_partkey AS VARCHAR) AS song_id")


@register(
    "lake_load",
    with_ctes(_TEXT_SONGS_SQL, PLAYS_V_SQL, SONGS_T_SQL, ARTISTS_FIRST_SQL, LOOKUP_SQL, PLAYS_SQL)
    + """SELECT md5(CAST(p.sessionId AS VARCHAR) || CAST(p.start_time AS VARCHAR)) AS songplay_id, p.start_time,
       p.userId AS user_id, p.level, lk.song_id, lk.artist_id, p.sessionId AS session_id, p.location,
       p.userAgent AS user_agent, CAST(year(p.start_time) AS INTEGER) AS year, CAST(month(p.start_time) AS INTEGER) AS month
FROM plays p LEFT JOIN lk ON p.song = lk.title AND p.artist = lk.name AND p.length = lk.duration""",
)
def lake_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 (S1 S2 K1 K2 C1-C5 Q1): song and log JSON written as they arrive,
    compressed (as text they were two thirds of the bytes written), loaded
    into the five lake tables; the fact read back."""
    root = scratch_dir(spark, "lake")
    types = {f.name: f.dataType for f in SONG_SCHEMA.fields}
    songs = songs_v(spark, sf_dir).withColumn("num_songs", F.lit(1))
    songs.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()]).write.json(f"{root}/song_data/A/B/C", compression="gzip")
    logs = plays_v(spark, sf_dir)
    logs = logs.withColumns(
        {"ts": F.unix_millis(F.col("ts").cast("timestamp")), "userId": F.col("userId").cast("string")}
    )
    logs.write.option("zlib.compress.level", "BEST_SPEED").json(f"{root}/log_data/2018/11", compression="gzip")
    counts = loads.load_music_lake(spark, f"{root}/song_data", f"{root}/log_data", f"{root}/out", glob="*.json.gz")
    delete(spark, f"{root}/song_data")
    delete(spark, f"{root}/log_data")
    fact = spark.read.parquet(f"{root}/out/songplays")
    if fact.count() != counts["songplays"]:
        raise AssertionError("the fact does not hold what its load counted")
    return ntz(fact, "start_time")


def _label_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label file: the ports, and a few codes of the other sections."""
    ports = ports_v(spark, sf_dir).select(F.concat(F.lit("'"), "code", F.lit("'\t=\t'"), "label", F.lit("'")).alias("value"))
    nations = table(spark, sf_dir, "nation").select(F.format_string("%03d =  '%s'", "n_nationkey", "n_name").alias("value"))
    codes = {"mode": ["\t1 = 'Air'", "\t2 = 'Sea'"], "visa": ["   1 = Business", "   2 = Pleasure"]}
    parts = []
    for i, (name, rows) in enumerate((("country", nations), ("port", ports), ("mode", None), ("visa", None))):
        start, end, _ = LABEL_SECTIONS[name]
        body = [start, *codes.get(name, [])]
        parts.append(spark.createDataFrame([(4 * i, k, x) for k, x in enumerate(body)], "part int, k long, value string"))
        if rows is not None:
            parts.append(rows.select(F.lit(4 * i + 1).alias("part"), F.xxhash64("value").alias("k"), "value"))
        if name != "country":  # its end marker opens the port section
            parts.append(spark.createDataFrame([(4 * i + 2, 0, end)], "part int, k long, value string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("part", "k").select("value")


@register("immigration_load", FACT_SQL)
def immigration_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 (S10-S13 K2 C10-C16 Q1 Q3): label text, comma and semicolon CSV
    files and records written as they arrive, loaded into five dimensions
    and the fact; the fact (one record per line item) read back."""
    root = scratch_dir(spark, "immigration")
    _label_file(spark, sf_dir).coalesce(1).write.text(f"{root}/labels")
    write_csv_quoted(airports_v(spark, sf_dir), f"{root}/airports")
    write_csv_quoted(temp_v(spark, sf_dir), f"{root}/temperatures")
    demo_v(spark, sf_dir).write.option("header", True).option("sep", ";").csv(f"{root}/demographics")
    records_v(spark, sf_dir).write.parquet(f"{root}/records")
    loads.load_immigration(
        spark, f"{root}/labels", f"{root}/airports", f"{root}/demographics", f"{root}/temperatures", f"{root}/records",
        f"{root}/out", from_year="1992",
    )
    for name in ("labels", "airports", "temperatures", "demographics", "records"):
        delete(spark, f"{root}/{name}")
    return spark.read.parquet(f"{root}/out/FACT_immigration")


# ------------------------------------------------------------------ SQL text and time variants


@register(
    "lateral_alias",
    with_ctes(EVENTS_LOG_V_SQL)
    + """SELECT DISTINCT date_trunc('second', ts) AS start_time, CAST(hour(start_time) AS INTEGER) AS hour,
       CAST(day(start_time) AS INTEGER) AS day, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year FROM events_log_v WHERE ts IS NOT NULL""",
)
def lateral_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One SQL text whose later items use an earlier alias."""
    view = "events_" + uuid.uuid4().hex[:12]
    table(spark, sf_dir, "events").createOrReplaceTempView(view)
    out = spark.sql(
        "SELECT DISTINCT CAST(date_trunc('SECOND', ts) AS TIMESTAMP_NTZ) AS start_time, hour(start_time) AS hour, "
        f"day(start_time) AS day, month(start_time) AS month, year(start_time) AS year FROM {view} WHERE ts IS NOT NULL"
    )
    spark.catalog.dropTempView(view)
    return out


@register(
    "time_dim_all_ms",
    """SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
       CAST(weekofyear(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
       CAST(year(start_time) AS INTEGER) AS year, CAST(dayofweek(start_time) AS INTEGER) AS weekday
FROM (SELECT DISTINCT date_trunc('millisecond', ts) AS start_time FROM events WHERE ts IS NOT NULL)""",
)
def time_dim_all_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time dimension of every log row, milliseconds kept
    (``source="all"``, ``precision="ms"``)."""
    e = table(spark, sf_dir, "events")
    logs = e.select(F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"), F.lit("Home").alias("page"))
    return ntz(music.build_time(logs, "number", source="all", precision="ms"), "start_time")
