"""Load profiles and column lifespans against brute force and edge cases."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from quorum.operators import drift, profile
from quorum.plans import drift as drift_plan
from quorum.plans import general

COLS = [profile.Profiled("code", pattern="^[0-9]{2}$"), profile.Profiled("n", True, low=1, high=100)]


def loads(spark, data):
    return spark.createDataFrame(data, "day string, code string, n bigint").withColumn("load_day", F.lit("clash")).withColumn("value", F.lit(1))


def test_base_aggregates_against_brute_force(spark):
    rng = random.Random(4)
    data = [(rng.choice(["d1", "d2", None]), rng.choice(["11", "22", "x", None]), rng.choice([None, 0, 5, 5, 7, 200, -3, 10**12])) for _ in range(400)]
    got = {(r.load_day, r.column_name): r for r in profile.base_aggregates(profile.value_counts(loads(spark, data), F.col("day"), COLS), COLS).collect()}
    for d in ("d1", "d2"):
        ns = sorted(x[2] for x in data if x[0] == d and x[2] is not None)
        r = got[d, "n"]
        assert (r.n_rows, r.n_nulls) == (sum(x[0] == d for x in data), sum(x[0] == d and x[2] is None for x in data))
        assert (r.n_distinct, r.least, r.greatest, r.median) == (len(set(ns)), ns[0], ns[-1], statistics.median_low(ns))
        assert r.n_off_range == sum(v < 1 or v > 100 for v in ns)
        assert got[d, "code"].n_off_pattern == sum(x[0] == d and x[1] == "x" for x in data)
    assert len(got) == 4


def test_findings(spark):
    data = [("d1", f"{i % 50 + 10}", 10 + i % 5) for i in range(200)] + [("d2", None if i % 3 == 0 else "10", 60) for i in range(200)] + [("d3", "1x", 0)]
    got = {(r.load_day, r.column_name, r.finding) for r in profile.findings(profile.exact_profile(loads(spark, data), F.col("day"), COLS)).collect()}
    assert got == {("d2", "code", "nulls"), ("d2", "code", "distinct"), ("d2", "n", "distinct"), ("d2", "n", "shift"), ("d3", "code", "nulls"), ("d3", "code", "pattern"), ("d3", "n", "shift"), ("d3", "n", "range")}


def test_classifier_finds_the_changed_column(spark):
    rng = random.Random(1)
    data = [(d, f"{rng.randrange(10, 99)}", rng.randrange(1, 8) * (30 if d == "d3" else 1)) for d in ("d1", "d2", "d3") for _ in range(1500)]
    got = {(r.load_day, r.column_name): r for r in profile.discrimination(loads(spark, data), F.col("day"), COLS).collect()}
    assert abs(got["d2", "n"].auc - 0.5) < 0.06
    assert got["d3", "n"].auc > 0.85 and got["d3", "n"].column_auc > 0.85 and got["d3", "n"].ablation > 0.3
    assert abs(got["d3", "code"].column_auc - 0.5) < 0.06 and abs(got["d3", "code"].ablation) < 0.06


def test_classifier_tells_the_damaged_loads(spark):
    zips = spark.read.parquet("/root/testdata/sf0.01/zip_code_to_l2_district.parquet")
    at, cols = general.PROFILED["zip_code_to_l2_district"]
    rows = profile.profile_loads(zips, F.date_format(at, "yyyy-MM-dd"), cols).collect()
    found = {}
    for r in profile.findings(profile.exact_profile(zips, F.date_format(at, "yyyy-MM-dd"), cols)).collect():
        found.setdefault((r.load_day, r.column_name), set()).add(r.finding)
    moved = {k for k, f in found.items() if f & {"shift", "distinct"}}
    assert moved == {(r.load_day, r.column_name) for r in rows if r.column_differs} - {k for k, f in found.items() if f == {"nulls"}}
    assert {k[0] for k in moved} <= {r.load_day for r in rows if r.load_differs}
    clean = {r.load_day for r in rows} - {k[0] for k in found}
    assert not any(r.load_differs for r in rows if r.load_day in clean)


def test_profile_of_nothing(spark):
    assert profile.profile_loads(loads(spark, []), F.col("day"), COLS).count() == 0
    assert profile.profile_loads(loads(spark, [("d1", None, None)]), F.col("day"), COLS).where("auc IS NULL").count() == 2


def test_split_line(spark):
    cases = {('a,"b, ""c""",, d ', False): ["a", 'b, "c"', "", "d"], ("a\t\tb", True): ["a", "", "b"], ('"x"\t""', True): ["x", ""], (",", False): ["", ""]}
    df = spark.createDataFrame([(i, line, tab) for i, (line, tab) in enumerate(cases)], "i int, l string, t boolean")
    got = df.select("i", drift.split_line(F.col("l"), F.col("t")).alias("x")).sort("i").collect()
    assert [r.x for r in got] == list(cases.values())


def found(spark, files):
    """files: list of (name, table_name, header, records)."""
    at = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(f"id{i}", at + dt.timedelta(hours=i), f[0], f[1], "c.s.by_path") for i, f in enumerate(files)], "id string, loaded_at timestamp, source_file_name string, table_name string, table_path string")
    lines = spark.createDataFrame([(f"id{i}", n, line) for i, f in enumerate(files) for n, line in enumerate([f[2], *f[3]])], "file_load_id string, line_no int, raw_line string")
    numbered = drift.numbered_files(log)
    headers, records = drift.file_lines(lines, numbered)
    cell = drift.cells(records)
    cat = drift.catalogue(headers, cell)
    spans = drift.lifespans(cat)
    ren = drift.renamings(spans, cell)
    alias = drift.aliases(cat, spans, ren)
    return {tuple(r) for r in drift.changes(cat, spans, ren).collect()}, {(r.file, r.line_no): r["values"] for r in drift.consistent_records(headers, records, alias).collect()}


def test_changes(spark):
    files = [
        ("S--A--2024-01-02.csv", "t", "﻿ID, Old ,Gone,n", ["1,a,x,5", "2,b,y,6", "", None, "3,c,z,7"]),
        ("S--A--2024-01-03.csv", None, '"ID","New","n","More"', ['1,a,5.5,"01/02/2024"', "2,b,6,12/31/2023", "4,q,7,"]),
        ("S--A--2024-01-03.csv", None, "n,ID,New,More", ["1,1,1,1"]),  # loaded again
        ("S--A--2024-01-09.csv", "t", "ID,n,New,Old", ["1,,a,k", "2,,b,k"]),
    ]
    got, table = found(spark, files)
    assert got == {
        ("t", 2, "renamed", "Old", "New"), ("t", 2, "removed", "Gone", ""), ("t", 2, "added", "", "More"), ("t", 2, "retyped", "n", "n"), ("t", 3, "removed", "More", ""), ("t", 3, "added", "", "Old"),
    }
    assert table["S--A--2024-01-02.csv", 1] == {"ID": "1", "New": "a", "Gone": "x", "n": "5"}
    assert table["S--A--2024-01-03.csv", 1] == {"ID": "1", "New": "a", "More": "2024-01-02", "n": "5.5"}
    assert table["S--A--2024-01-09.csv", 2] == {"ID": "2", "New": "b", "Old": "k", "n": None} and len(table) == 8


def test_changes_of_nothing(spark):
    got, table = found(spark, [("S--A--2024-01-02.csv", "t", "ID,a", [])])
    assert got == set() and table == {}


def test_query_runs_on_whole_tables(spark, small):
    assert drift_plan.p5_found(spark, small).count() > 0
