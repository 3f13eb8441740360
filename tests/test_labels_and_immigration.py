"""Label sections and immigration builders."""

from __future__ import annotations

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from conftest import rows
from dimspark.plans import immigration as im
from dimspark.sources.files import read_csv_dir
from dimspark.sources.labels import LABEL_SECTIONS, all_label_pairs, label_pairs, named_label_pairs, read_label_files, text_lines

LABEL_TEXT = (
    "/* I94YR - 4 digit year */\n"
    "/* I94CIT & I94RES - This format shows all the valid and invalid codes */\n"
    "value i94cntyl\n"
    "582 =  'MEXICO'\n"
    "236 =  'AFGHANISTAN'\n"
    "101 =  'ALBANIA'\n"
    "101 =  'ALBANIA AGAIN'\n"
    ";\n"
    "/* I94PORT - This format shows all the valid and invalid codes */\n"
    "value $i94prtl\n"
    "\t'ALC'\t=\t'ALCAN, AK             '\n"
    "\t'CDA'\t=\t'COEUR D\\'ALENE, ID'\n"
    "\t'DFW'\t=\t'DALLAS/FORT WORTH, TX'\n"
    "\t'WSA'\t=\t'WINSTON-SALEM, NC'\n"
    "\t'XXX'\t=\t'NOT REPORTED/UNKNOWN'\n"
    "\t'TOR'\t=\t'TORONTO, ONTARIO'\n"
    ";\n"
    "/* ARRDATE is the Arrival Date in the USA */\n"
    "/* I94MODE - There are missing values as well as not reported (9) */\n"
    "value i94model\n"
    "\t1 = 'Air'\n"
    "\t2 = 'Sea'\n"
    "\t9 = 'Not reported' ;\n"
    "/* I94ADDR - There is lots of invalid codes */\n"
    "/* I94VISA - Visa codes collapsed into three categories */\n"
    "   1 = Business\n"
    "   2 = Pleasure\n"
    "   3 = Student\n"
    "/* COUNT - Used for summary statistics */\n"
)


def _expected(text: str, start: str, end: str, pattern: str):
    """The documented section rule, computed in plain Python."""
    lines = text.splitlines(keepends=True)
    idx = [k for k, v in enumerate(lines) if v.startswith(start) or v.startswith(end)]
    return re.findall(pattern, "".join(lines[idx[0]:idx[1]][1:]))


def test_label_sections_match_python_rule(spark, tmp_dir):
    p = os.path.join(tmp_dir, "labels", "I94_SAS_Labels_Descriptions.SAS")
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as f:
        f.write(LABEL_TEXT)
    df = read_label_files(spark, os.path.dirname(p))
    assert df.count() == len(LABEL_TEXT.splitlines())
    for name, (start, end, pattern) in LABEL_SECTIONS.items():
        got = [(r["code"], r["label"]) for r in named_label_pairs(df, name, with_file=True).orderBy("pos").collect()]
        assert got == _expected(LABEL_TEXT, start, end, pattern), name
        assert got, name


def test_label_file_split_over_many_tasks(spark, tmp_dir):
    """A label file read in many small blocks (one task each) gives the
    same sections as the whole file; two files keep their own sections."""
    d = os.path.join(tmp_dir, "labels_split")
    os.makedirs(d)
    filler = "".join(f"/* note {i} */\n" for i in range(200))
    texts = {"a.SAS": filler + LABEL_TEXT + filler, "b.SAS": LABEL_TEXT.replace("MEXICO", "CANADA")}
    for fname, text in texts.items():
        with open(os.path.join(d, fname), "w") as f:
            f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        df = read_label_files(spark, d)
        assert df.rdd.getNumPartitions() > 10
        for name, (start, end, pattern) in LABEL_SECTIONS.items():
            got = named_label_pairs(df, name, with_file=True).orderBy("file", "pos").collect()
            by_file = {}
            for r in got:
                by_file.setdefault(os.path.basename(r["file"]), []).append((r["code"], r["label"]))
            for fname, text in texts.items():
                assert by_file.get(fname, []) == _expected(text, start, end, pattern), (name, fname)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_numbers_do_not_depend_on_the_split(spark, tmp_dir):
    """The same numbers and pairs under three split sizes; files of one
    line, without a line, and without a last line break."""
    d = os.path.join(tmp_dir, "labels_sizes")
    os.makedirs(d)
    texts = {"a": LABEL_TEXT * 3, "b": "x", "c": "", "d": "\n\n" + LABEL_TEXT.rstrip("\n"), "e": "é\n" * 500}
    for fname, text in texts.items():
        with open(os.path.join(d, fname), "w") as f:
            f.write(text)
    want = {(f, i, x) for f, t in texts.items() for i, x in enumerate(t.splitlines())}
    old, pairs = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    try:
        for size in ("64", "700", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = read_label_files(spark, d)
            got = [(os.path.basename(r.file), r.pos, r.line) for r in df.collect()]
            assert len(got) == len(want) and set(got) == want
            pairs.append(sorted(tuple(r) for r in all_label_pairs(df).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert pairs[0] == pairs[1] == pairs[2] and {r[0] for r in pairs[0]} == set(LABEL_SECTIONS)


def _labels_df(spark):
    return text_lines(spark.createDataFrame([(LABEL_TEXT,)], "text string"))


def test_code_dims_and_ports(spark):
    df = _labels_df(spark)
    mode = im.build_code_dim(named_label_pairs(df, "mode"), "mode_id", "mode")
    assert rows(mode) == [(1, "Air"), (2, "Sea"), (9, "Not reported")]
    country = im.build_code_dim(named_label_pairs(df, "country"), "country_id", "country")
    assert country.count() == 3  # duplicate 101 kept once
    assert country.where("country_id = 101").first()["country"] == "ALBANIA"
    ports = im.port_list(named_label_pairs(df, "port"))
    assert ports.where("port_id = 'ALC'").first()["airport"] == "ALCAN, AK"
    cities = {r["port_id"]: r["city"] for r in im.valid_ports_cities(ports).collect()}
    assert cities == {
        "ALC": "Alcan",
        "CDA": "Coeur D\\'Alene",
        "DFW": "Dallas/Fort Worth",
        "WSA": "Winston-Salem",
    }


def _csv(tmp_dir, name, sep, header, body):
    d = os.path.join(tmp_dir, name)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part.csv"), "w") as f:
        f.write(sep.join(header) + "\n")
        for r in body:
            f.write(sep.join(r) + "\n")
    return d


def test_airports(spark, tmp_dir):
    ports = spark.createDataFrame([("ALC", "ALCAN, AK"), ("DFW", "DALLAS/FORT WORTH, TX"), ("ZZZ", "NOWHERE, ZZ")],
                                  "port_id string, airport string")
    hdr = ["ident", "type", "name", "continent", "iso_country", "iso_region", "municipality", "iata_code"]
    body = [
        ["a1", "small_airport", "Alcan Field", "NA", "US", "US-AK", "Alcan", "ALC"],
        ["a2", "closed", "Old Alcan", "NA", "US", "US-AK", "Alcan", "ALC"],
        ["a3", "large_airport", "DFW Intl", "NA", "US", "US-TX", "Dallas", "DFW"],
        ["a4", "medium_airport", "DFW Second", "NA", "US", "US-TX", "Dallas", "DFW"],
        ["a5", "", "No type", "NA", "US", "US-ZZ", "Nowhere", "ZZZ"],
        ["a6", "heliport", "No code", "NA", "US", "US-TX", "Dallas", ""],
    ]
    codes = read_csv_dir(spark, _csv(tmp_dir, "airports", ",", hdr, body))
    out = im.build_airports(ports, codes)
    got = {r["port_id"]: r["name"] for r in out.collect()}
    # closed dropped, NULL type dropped, one row per port (first by airport, name)
    assert got == {"ALC": "Alcan Field", "DFW": "DFW Intl"}


def _demo(spark, tmp_dir):
    hdr = ["City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
           "Number of Veterans", "Foreign-born", "Average Household Size", "State Code", "Race", "Count"]
    races = ["American Indian and Alaska Native", "Asian", "Black or African-American", "Hispanic or Latino", "White"]
    body = []
    for race, n in zip(races, [10, 20, 30, 40, 50]):  # a city with five race rows: population once
        body.append(["Dallas", "Texas", "33", "1", "1", "1000", "100", "200", "2.5", "TX", race, str(n)])
    body.append(["Austin", "Texas", "30", "1", "1", "500", "", "100", "3.0", "TX", "Asian", "7"])
    body.append(["Albany", "New York", "35", "1", "1", "300", "30", "60", "2.25", "NY", "White", "300"])
    body.append(["Nome", "Alaska", "35", "1", "1", "30", "3", "6", "2.0", "AK", "White", "30"])
    return read_csv_dir(spark, _csv(tmp_dir, "demo", ";", hdr, body), sep=";")


def _temps(spark, tmp_dir):
    hdr = ["dt", "AverageTemperature", "AverageTemperatureUncertainty", "City", "Country"]
    body = [
        ["2009-12-01", "1.0", "0.1", "Dallas", "United States"],
        ["2010-01-01", "50.0", "0.1", "Dallas", "United States"],  # on the boundary: excluded
        ["2012-01-01", "20.0", "0.1", "Dallas", "United States"],
        ["2012-02-01", "21.04", "0.1", "Dallas", "United States"],
        ["2012-01-01", "", "0.1", "Dallas", "United States"],  # NULL temperature
        ["2012-01-01", "10.0", "0.1", "Austin", "United States"],
        ["2012-01-01", "5.0", "0.1", "Albany", "United States"],
        ["2012-01-01", "99.0", "0.1", "Paris", "France"],  # not a valid city
    ]
    return read_csv_dir(spark, _csv(tmp_dir, "temps", ",", hdr, body))


def test_state_dimension(spark, tmp_dir):
    demo, temps = _demo(spark, tmp_dir), _temps(spark, tmp_dir)
    valid = spark.createDataFrame([("DAL", "Dallas"), ("AUS", "Austin"), ("ALB", "Albany")], "port_id string, city string")
    clean = im.clean_temperatures(temps, "2010", valid)
    assert clean.count() == 4
    assert clean.where(F.col("dt") == F.lit(dt.date(2010, 1, 1))).count() == 0
    per_state = {r["State Code"]: r["avg_temp"] for r in im.temperature_per_state(demo, clean).collect()}
    # Dallas avg(20, 21.04) = 20.52, Austin 10 -> TX = avg(20.52, 10) = 15.26
    assert per_state == {"TX": 15.26, "NY": 5.0}
    state = {r["state_id"]: r for r in im.build_state(demo, im.temperature_per_state(demo, clean)).collect()}
    assert set(state) == {"TX", "NY"}  # AK has no temperature: dropped by the inner join
    tx = state["TX"]
    assert tx["total_population"] == 1500 and tx["num_veterans"] == 100 and tx["avg_hh_size"] == 2.75
    assert tx["num_asian"] == 27 and tx["num_white"] == 50
    assert state["NY"]["num_asian"] is None  # race missing in a state -> NULL after the pivot


def test_fact_immigration(spark):
    schema = ("cicid double, i94port string, i94visa double, i94addr string, i94mode double, i94cit double, "
              "i94res double, i94yr double, i94mon double, i94bir double, gender string, depdate double, arrdate double")
    recs = spark.createDataFrame(
        [
            (1.0, "ALC", 2.0, "AK", 1.0, 582.0, 582.0, 2016.0, 4.0, 1980.0, "F", None, 20573.0),
            (1.0, "ALC", 2.0, "AK", 1.0, 582.0, 582.0, 2016.0, 4.0, 1980.0, "F", None, 20573.0),  # duplicate
            (2.0, "DFW", 1.0, "TX", 1.0, 236.0, 236.0, 2016.0, 4.0, 1990.7, "M", 0.0, 20574.0),
            (3.0, "XXX", 1.0, "TX", 1.0, 236.0, 236.0, 2016.0, 4.0, 1990.0, "M", 20580.0, 20574.0),  # port not valid
        ],
        schema,
    )
    valid = spark.createDataFrame([("ALC", "Alcan"), ("DFW", "Dallas")], "port_id string, city string")
    fact = im.build_fact_immigration(recs, valid)
    assert fact.columns == list(im.FACT_NAMES.values())
    got = {r["im_id"]: r for r in fact.collect()}
    assert set(got) == {1, 2}
    assert got[1]["arrdate"] == dt.date(2016, 4, 29) and got[1]["depdate"] is None
    assert got[2]["depdate"] is None and got[2]["bir_yr"] == 1990
    assert dict(fact.dtypes)["visa_id"] == "int"


def test_label_pairs_generic(spark):
    df = text_lines(spark.createDataFrame([("/* A\n1 = x\n2 = y\n/* B\n3 = z\n",)], "text string"))
    got = label_pairs(df, "/* A", "/* B", r"(\d) = (\w)", with_file=True).orderBy("pos").collect()
    assert [(r["code"], r["label"]) for r in got] == [("1", "x"), ("2", "y")]
