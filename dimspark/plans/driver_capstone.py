"""Driver queries for the immigration builders.

Views (each as DataFrame and as oracle CTE):

* ``demo_v`` (city demographics, all text): one row per (nation, market
  segment); City = 'Nation_<key>', State = region name, State Code =
  region key, Race = segment, Count = customers; the city columns are
  customer aggregates of the nation.
* ``temp_v`` (temperatures, text): one row per order; City of the
  customer's nation, dt = order date, AverageTemperature = total price,
  NULL for status 'P'.
* ``ports_v`` (label port list): 'P<nation>' -> 'NATION_<k>, <suffix>',
  suffix = two letters of the region for regions 0-2, the full region
  name otherwise (so F8 drops some).
* ``airports_v`` (airport codes): one per supplier, iata_code = its
  nation's port; type 'closed' / NULL / 'small_airport' by balance.
* ``records_v`` (immigration records, doubles): one per line item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.functions.casts import cast_type_columns
from dimspark.functions.textfn import py_title, regex_pairs
from dimspark.functions.timefn import SAS_EPOCH, sas_days_to_date
from dimspark.plans import immigration as im
from dimspark.plans.driver_views import table, with_ctes
from dimspark.plans.loads import stage
from dimspark.plans.registry import register
from dimspark.session import scratch_dir
from dimspark.sources.staging import clean_strings

SEGMENTS = {
    "AUTOMOBILE": "num_auto",
    "BUILDING": "num_building",
    "FURNITURE": "num_furniture",
    "HOUSEHOLD": "num_household",
    "MACHINERY": "num_machinery",
}


def demo_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    seg = c.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("cnt"))
    tot = c.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("neg"),
        F.count(F.when(F.col("c_acctbal") > 5000, 1)).alias("rich"),
        F.round(F.avg("c_acctbal") / 1000, 2).alias("hh"),
    )
    j = seg.join(tot, "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(
        r, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return j.select(
        F.concat(F.lit("Nation_"), F.col("n_nationkey").cast("string")).alias("City"),
        F.col("r_name").alias("State"),
        F.col("n_regionkey").cast("string").alias("State Code"),
        F.col("total").cast("string").alias("Total Population"),
        F.col("neg").cast("string").alias("Number of Veterans"),
        F.col("rich").cast("string").alias("Foreign-born"),
        F.col("hh").cast("string").alias("Average Household Size"),
        F.col("c_mktsegment").alias("Race"),
        F.col("cnt").cast("string").alias("Count"),
    )


DEMO_V_SQL = """demo_v AS (
  SELECT 'Nation_' || CAST(n.n_nationkey AS VARCHAR) AS "City", r.r_name AS "State",
         CAST(n.n_regionkey AS VARCHAR) AS "State Code",
         CAST(t.total AS VARCHAR) AS "Total Population", CAST(t.neg AS VARCHAR) AS "Number of Veterans",
         CAST(t.rich AS VARCHAR) AS "Foreign-born", CAST(t.hh AS VARCHAR) AS "Average Household Size",
         s.c_mktsegment AS "Race", CAST(s.cnt AS VARCHAR) AS "Count"
  FROM (SELECT c_nationkey, c_mktsegment, COUNT(*) AS cnt FROM customer GROUP BY 1, 2) s
  JOIN (SELECT c_nationkey, COUNT(*) AS total, COUNT(*) FILTER (WHERE c_acctbal < 0) AS neg,
               COUNT(*) FILTER (WHERE c_acctbal > 5000) AS rich, ROUND(AVG(c_acctbal) / 1000, 2) AS hh
        FROM customer GROUP BY 1) t ON s.c_nationkey = t.c_nationkey
  JOIN nation n ON n.n_nationkey = s.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey)"""


def temp_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).alias("AverageTemperature"),
        F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")).alias("City"),
    )


TEMP_V_SQL = """temp_v AS (
  SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS dt,
         CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_totalprice AS VARCHAR) END AS "AverageTemperature",
         'Nation_' || CAST(c.c_nationkey AS VARCHAR) AS "City"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


def ports_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    suffix = F.when(F.col("r_regionkey") < 3, F.substring("r_name", 1, 2)).otherwise(F.col("r_name"))
    return j.select(
        F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("port_id"),
        F.concat(F.upper("n_name"), F.lit(", "), suffix, F.lit("   ")).alias("label"),
    ).select(F.col("port_id").alias("code"), "label")


PORTS_V_SQL = """ports_v AS (
  SELECT 'P' || CAST(n.n_nationkey AS VARCHAR) AS code,
         upper(n.n_name) || ', ' || CASE WHEN r.r_regionkey < 3 THEN substr(r.r_name, 1, 2) ELSE r.r_name END
           || '   ' AS label
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _title_sql(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


VALID_CITIES_SQL = f"""ports AS (SELECT code AS port_id, rtrim(label) AS airport FROM ports_v),
valid AS (
  SELECT DISTINCT port_id, {_title_sql("split_part(airport, ', ', 1)")} AS city
  FROM ports WHERE length(string_split(airport, ', ')[-1]) = 2)"""


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return im.valid_ports_cities(im.port_list(ports_v(spark, sf_dir)))


def supplier_ports_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A port label list that grows with the data: one port per supplier,
    'S<key>' -> 'SUPPLIER#..., <suffix>' (suffix as in ``ports_v``)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    suffix = F.when(F.col("r_regionkey") < 3, F.substring("r_name", 1, 2)).otherwise(F.col("r_name"))
    return j.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code"),
        F.concat(F.upper("s_name"), F.lit(", "), suffix, F.lit("   ")).alias("label"),
    )


SUPPLIER_PORTS_V_SQL = """ports_v AS (
  SELECT 'S' || CAST(s.s_suppkey AS VARCHAR) AS code,
         upper(s.s_name) || ', ' || CASE WHEN r.r_regionkey < 3 THEN substr(r.r_name, 1, 2) ELSE r.r_name END
           || '   ' AS label
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@register("valid_port_cities", with_ctes(SUPPLIER_PORTS_V_SQL, VALID_CITIES_SQL) + "SELECT * FROM valid")
def valid_port_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 (F8 T15 T16 T17 T18): US ports and their title-cased cities, over
    a port list of one port per supplier."""
    return im.valid_ports_cities(im.port_list(supplier_ports_v(spark, sf_dir)))


@register("title_case", f"SELECT p_partkey, {_title_sql('p_name')} AS title FROM part")
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Python-style title case of every part name."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", py_title("p_name").alias("title"))


CLEAN_TEMP_SQL = """tc AS (
  SELECT TRY_CAST(dt AS DATE) AS dt, TRY_CAST("AverageTemperature" AS DOUBLE) AS "AverageTemperature", "City"
  FROM temp_v
  WHERE "AverageTemperature" IS NOT NULL AND "City" IN (SELECT city FROM valid)
    AND TRY_CAST(dt AS DATE) > DATE '1998-01-01')"""


def _clean_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return im.clean_temperatures(temp_v(spark, sf_dir), "1998", _valid(spark, sf_dir))


@register("clean_dates", with_ctes(TEMP_V_SQL, PORTS_V_SQL, VALID_CITIES_SQL, CLEAN_TEMP_SQL) + "SELECT * FROM tc")
def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 (P9 F2 F4/J8 F5): temperatures of valid cities after 1998."""
    return _clean_temp(spark, sf_dir).select("dt", "AverageTemperature", "City")


TEMP_STATE_SQL = """tps AS (
  SELECT d."State Code", ROUND(AVG(c.avg_temp), 2) AS avg_temp
  FROM (SELECT DISTINCT "City", "State Code" FROM demo_v) d
  JOIN (SELECT "City", ROUND(AVG("AverageTemperature"), 2) AS avg_temp FROM tc GROUP BY 1) c ON d."City" = c."City"
  GROUP BY 1)"""


@register(
    "two_level_avg",
    with_ctes(DEMO_V_SQL, TEMP_V_SQL, PORTS_V_SQL, VALID_CITIES_SQL, CLEAN_TEMP_SQL, TEMP_STATE_SQL)
    + "SELECT * FROM tps",
)
def two_level_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average per city, rounded, then per state, rounded."""
    return im.temperature_per_state(demo_v(spark, sf_dir), _clean_temp(spark, sf_dir))


PIVOT_SQL = (
    """pv AS (SELECT "State Code", """
    + ", ".join(
        f"""CAST(SUM(CASE WHEN "Race" = '{k}' THEN TRY_CAST("Count" AS BIGINT) END) AS BIGINT) AS {v}"""
        for k, v in SEGMENTS.items()
    )
    + """ FROM demo_v GROUP BY 1)"""
)


@register("state_pivot", with_ctes(DEMO_V_SQL, PIVOT_SQL) + "SELECT * FROM pv")
def state_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SUM(Count) per state, one column per segment (explicit value list)."""
    return im.race_pivot(demo_v(spark, sf_dir), SEGMENTS)


SUMMARY_SQL = """sm AS (
  SELECT "State Code", "State",
         CAST(SUM(TRY_CAST("Total Population" AS BIGINT)) AS BIGINT) AS total_population,
         CAST(SUM(TRY_CAST("Number of Veterans" AS BIGINT)) AS BIGINT) AS num_veterans,
         CAST(SUM(TRY_CAST("Foreign-born" AS BIGINT)) AS BIGINT) AS foreign_born,
         ROUND(AVG(TRY_CAST("Average Household Size" AS DOUBLE)), 2) AS avg_hh_size
  FROM (SELECT * FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY "State Code", "City"
            ORDER BY "State" NULLS FIRST, "Total Population" NULLS FIRST, "Number of Veterans" NULLS FIRST,
                     "Foreign-born" NULLS FIRST, "Average Household Size" NULLS FIRST) AS rn
          FROM demo_v) WHERE rn = 1)
  GROUP BY 1, 2)"""


@register("state_summary", with_ctes(DEMO_V_SQL, SUMMARY_SQL) + "SELECT * FROM sm")
def state_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per city, then sums and rounded average per state."""
    return im.state_summary(demo_v(spark, sf_dir))


@register(
    "state_join_chain",
    with_ctes(DEMO_V_SQL, TEMP_V_SQL, PORTS_V_SQL, VALID_CITIES_SQL, CLEAN_TEMP_SQL, TEMP_STATE_SQL, PIVOT_SQL, SUMMARY_SQL)
    + """SELECT sm."State Code" AS state_id, sm."State" AS state, total_population, num_veterans, foreign_born,
       avg_hh_size, """
    + ", ".join(SEGMENTS.values())
    + """, avg_temp
FROM sm JOIN pv ON sm."State Code" = pv."State Code" JOIN tps ON sm."State Code" = tps."State Code\"""",
)
def state_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State dimension = summary JOIN pivot JOIN temperature. The
    demographics, which three branches read, are staged once."""
    d = stage(demo_v(spark, sf_dir), scratch_dir(spark, "demographics"))
    return im.build_state(d, im.temperature_per_state(d, _clean_temp(spark, sf_dir)), SEGMENTS)


def airports_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    bal = F.col("s_acctbal")
    return s.select(
        F.col("s_name").alias("name"),
        F.when(bal < 0, F.lit("closed")).when(bal < 1000, F.lit(None).cast("string")).otherwise(F.lit("small_airport")).alias("type"),
        F.lit("NA").alias("continent"),
        F.lit("US").alias("iso_country"),
        F.concat(F.lit("US-"), F.col("s_nationkey").cast("string")).alias("iso_region"),
        F.concat(F.lit("Town "), F.col("s_suppkey").cast("string")).alias("municipality"),
        F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("iata_code"),
    )


AIRPORTS_V_SQL = """airports_v AS (
  SELECT s_name AS name,
         CASE WHEN s_acctbal < 0 THEN 'closed' WHEN s_acctbal < 1000 THEN NULL ELSE 'small_airport' END AS type,
         'NA' AS continent, 'US' AS iso_country, 'US-' || CAST(s_nationkey AS VARCHAR) AS iso_region,
         'Town ' || CAST(s_suppkey AS VARCHAR) AS municipality, 'P' || CAST(s_nationkey AS VARCHAR) AS iata_code
  FROM supplier)"""


@register(
    "valid_airports",
    with_ctes(PORTS_V_SQL, AIRPORTS_V_SQL)
    + """SELECT port_id, airport, name, type, continent, iso_country, iso_region, municipality FROM (
  SELECT p.port_id, p.airport, a.name, a.type, a.continent, a.iso_country, a.iso_region, a.municipality,
         ROW_NUMBER() OVER (PARTITION BY p.port_id ORDER BY p.airport NULLS FIRST, a.name NULLS FIRST,
           a.type NULLS FIRST, a.continent NULLS FIRST, a.iso_country NULLS FIRST, a.iso_region NULLS FIRST,
           a.municipality NULLS FIRST) AS rn
  FROM (SELECT code AS port_id, rtrim(label) AS airport FROM ports_v) p
  JOIN (SELECT * FROM airports_v WHERE iata_code IS NOT NULL AND type <> 'closed') a ON p.port_id = a.iata_code)
WHERE rn = 1""",
)
def valid_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11 (S13 T15 F2 F3 P3 J9 A5): label ports joined to open airports."""
    return im.build_airports(im.port_list(ports_v(spark, sf_dir)), airports_v(spark, sf_dir))


def records_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = l.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit(SAS_EPOCH).cast("date")).cast("double")
    return j.select(
        F.col("l_orderkey").cast("double").alias("cicid"),
        F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("i94port"),
        F.col("l_linenumber").cast("double").alias("i94visa"),
        F.col("l_returnflag").alias("i94addr"),
        (F.col("l_tax") * 100).alias("i94mode"),
        F.col("l_partkey").cast("double").alias("i94cit"),
        F.col("l_suppkey").cast("double").alias("i94res"),
        F.year("l_shipdate").cast("double").alias("i94yr"),
        F.month("l_shipdate").cast("double").alias("i94mon"),
        (F.col("l_quantity") + 1950.5).alias("i94bir"),
        F.col("l_linestatus").alias("gender"),
        F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(days + F.col("l_quantity")).alias("depdate"),
        days.alias("arrdate"),
    )


RECORDS_V_SQL = """records_v AS (
  SELECT CAST(l_orderkey AS DOUBLE) AS cicid, 'P' || CAST(s_nationkey AS VARCHAR) AS i94port,
         CAST(l_linenumber AS DOUBLE) AS i94visa, l_returnflag AS i94addr, l_tax * 100 AS i94mode,
         CAST(l_partkey AS DOUBLE) AS i94cit, CAST(l_suppkey AS DOUBLE) AS i94res,
         CAST(year(l_shipdate) AS DOUBLE) AS i94yr, CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
         l_quantity + 1950.5 AS i94bir, l_linestatus AS gender,
         CASE WHEN l_linenumber = 1 THEN 0.0
              ELSE CAST(datediff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) + l_quantity END AS depdate,
         CAST(datediff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS arrdate
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


def _int(x: str) -> str:
    return f"TRY_CAST(trunc({x}) AS INTEGER)"


def _bigint(x: str) -> str:
    return f"TRY_CAST(trunc({x}) AS BIGINT)"


def _sas(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL AND {x} <> 0 THEN CAST(DATE '1960-01-01' + CAST(floor({x}) AS INTEGER) AS DATE) END"


FACT_SQL = (
    with_ctes(PORTS_V_SQL, VALID_CITIES_SQL, RECORDS_V_SQL)
    + f""", f AS (
  SELECT {_bigint('cicid')} AS im_id, i94port AS port_id, {_int('i94visa')} AS visa_id, i94addr AS state_id,
         {_int('i94mode')} AS mode_id, {_bigint('i94cit')} AS country_id_cit, {_bigint('i94res')} AS country_id_res,
         {_int('i94yr')} AS im_yr, {_int('i94mon')} AS im_mon, {_int('i94bir')} AS bir_yr, gender,
         {_sas(_int('depdate'))} AS depdate, {_sas(_int('arrdate'))} AS arrdate
  FROM records_v WHERE i94port IN (SELECT port_id FROM valid))
SELECT im_id, port_id, visa_id, state_id, mode_id, country_id_cit, country_id_res, im_yr, im_mon, bir_yr,
       gender, depdate, arrdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY im_id ORDER BY port_id NULLS FIRST, visa_id NULLS FIRST,
    state_id NULLS FIRST, mode_id NULLS FIRST, country_id_cit NULLS FIRST, country_id_res NULLS FIRST,
    im_yr NULLS FIRST, im_mon NULLS FIRST, bir_yr NULLS FIRST, gender NULLS FIRST, depdate NULLS FIRST,
    arrdate NULLS FIRST) AS rn FROM f) WHERE rn = 1"""
)


@register("fact_immigration", FACT_SQL)
def fact_immigration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C16 (P4 J8 P10 T12 A5): immigration fact over every line item."""
    return im.build_fact_immigration(records_v(spark, sf_dir), _valid(spark, sf_dir))


@register(
    "cast_all_doubles",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    + ", ".join(f"{_int(c)} AS {c}" for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    + ", l_returnflag, l_linestatus, l_shipdate FROM lineitem",
)
def cast_all_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: every double column of lineitem to int (cut towards zero)."""
    return cast_type_columns(table(spark, sf_dir, "lineitem"), "double", "int")


@register(
    "sas_dates",
    """SELECT l_orderkey, l_linenumber, """
    + _sas("CASE WHEN l_linenumber = 1 THEN 0 ELSE datediff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) END")
    + """ AS ship_date FROM lineitem""",
)
def sas_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SAS day numbers (0 on first lines) back to dates; 0 -> NULL."""
    l = table(spark, sf_dir, "lineitem")
    days = F.when(F.col("l_linenumber") == 1, F.lit(0)).otherwise(
        F.datediff(F.col("l_shipdate").cast("date"), F.lit(SAS_EPOCH).cast("date"))
    )
    return l.select("l_orderkey", "l_linenumber", sas_days_to_date(days).alias("ship_date"))


@register(
    "semi_filter",
    """SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers in a key list, as a left-semi join."""
    keys = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey")
    )
    return table(spark, sf_dir, "orders").join(keys, "o_custkey", "left_semi")


@register(
    "code_pairs",
    """SELECT page_id, m[1] AS code, m[2] AS label FROM (
  SELECT page_id, UNNEST(list_zip(regexp_extract_all(url, '/([a-z]{2})/(\\d+)', 1),
                                  regexp_extract_all(url, '/([a-z]{2})/(\\d+)', 2))) AS m FROM pages)""",
)
def code_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (code, label) regex match of every page URL."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.explode(regex_pairs("url", r"/([a-z]{2})/(\d+)")).alias("m")).select(
        "page_id", F.col("m.code").alias("code"), F.col("m.label").alias("label")
    )


@register(
    "code_dim",
    """SELECT id, label FROM (
  SELECT TRY_CAST(m[2] AS INTEGER) AS id, m[1] AS label,
         ROW_NUMBER() OVER (PARTITION BY TRY_CAST(m[2] AS INTEGER) ORDER BY m[1] NULLS FIRST) AS rn
  FROM (SELECT UNNEST(list_zip(regexp_extract_all(url, '/([a-z]{2})/(\\d+)', 1),
                               regexp_extract_all(url, '/([a-z]{2})/(\\d+)', 2))) AS m FROM pages))
WHERE rn = 1""",
)
def code_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 (S13 T14 P9 A5): (code, label) pairs -> one row per integer id."""
    pairs = code_pairs(spark, sf_dir).select(F.col("label").alias("code"), F.col("code").alias("label"))
    return im.build_code_dim(pairs, "id", "label")


@register(
    "blank_to_null",
    """SELECT doc_id, CASE WHEN trim(t) <> '' THEN t END AS text, CASE WHEN trim(lang) <> '' THEN lang END AS lang,
       CASE WHEN trim(source) <> '' THEN source END AS source
FROM (SELECT doc_id, CASE WHEN n_chars % 10 = 0 THEN '  ' WHEN n_chars % 10 = 1 THEN '' ELSE text END AS t,
             lang, source FROM documents)""",
)
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BLANKSASNULL / EMPTYASNULL over every text column (whole texts)."""
    d = table(spark, sf_dir, "documents")
    r = F.col("n_chars") % 10
    staged = d.select(
        "doc_id",
        F.when(r == 0, F.lit("  ")).when(r == 1, F.lit("")).otherwise(F.col("text")).alias("text"),
        "lang",
        "source",
    )
    return clean_strings(staged)


@register("truncate_columns", "SELECT page_id, left(url, 24) AS url FROM pages")
def truncate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRUNCATECOLUMNS of a varchar(24) staging column."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return clean_strings(p, blanks_as_null=False, truncate_to=24)
