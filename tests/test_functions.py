"""Golden values of the scalar functions."""

import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quorum.functions import civic, columns, ids, names, numbers, similarity, text


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).sort("i").collect()]


def test_salted_uuid(spark):
    h = hashlib.md5(b"asalt-salt").hexdigest()
    want = f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}"
    got = spark.createDataFrame([("a", None)], "x string, y string").select(ids.salted_uuid("x", "y", salt="salt")).first()[0]
    assert got == want


def test_fingerprint_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("~",)], "x string")
    assert df.select(ids.fingerprint("x")).distinct().count() == 3


def test_base64_ids(spark):
    assert column(spark, ["aWQ6MQ==", "not base64!", None], "string", ids.decode_base64_id) == ["id:1", None, None]


def test_slugify(spark):
    got = column(spark, ["  Mayor -- of St. Paul/ ", "A&B  C", "", None], "string", lambda c: text.slugify(c))
    assert got == ["mayor-of-st-paul", "ab-c", "", ""]


def test_boolean_words(spark):
    assert column(spark, [" YES ", "0", "maybe", "", None], "string", text.to_boolean) == [True, False, None, None, None]


def test_phone_and_party(spark):
    assert column(spark, ["(555) 1-2", "none", None], "string", text.digits_only) == ["5551 2".replace(" ", ""), None, None]
    assert column(spark, ["democratic", "Nonpartisan Independent", " ", None, "Whig"], "string", text.party) == ["Democrat", "Independent", None, None, "Other"]


def test_suffixes(spark):
    cases = {"John Smith Jr": "John Smith", "John Smith Sr.": "John Smith", "John Smith iii": "John Smith", "Junior Smith": "Junior Smith", "John Smith Jrx": "John Smith Jrx", "John Smith Jr Jr": "John Smith", "": "", None: None}
    assert column(spark, list(cases), "string", text.without_suffix) == list(cases.values())


def test_office_keys(spark):
    cases = {
        "City of Aurora": ("aurora", "other", None), "Lincoln Twp": ("lincoln", "other", None), "Beverly City Council At-Large": ("beverly", "council", "atlarge"), "Acworth City Council At-large Post 4": ("acworth", "council", "4"),
        "Topeka City Council 7": ("topeka", "council", "7"), "Carpentersville Village Board": ("carpentersville", "council", None), "Plainfield School Board": ("plainfield", "school", None), "City Council": ("", "council", None), "42nd Ward": ("42nd", "other", None),
    }
    df = spark.createDataFrame([(c,) for c in cases], "n string").select("n", *civic.office_match_keys(F.col("n")))
    assert {r.n: (" ".join(r.locality_key), r.office_category, r.seat_designator) for r in df.collect()} == cases


def test_census_codes(spark):
    assert column(spark, ["12", "-666666666", None], "string", civic.census_estimate) == [12, None, None]
    assert column(spark, ["-555555555", "-222222222", "7"], "string", civic.census_margin) == [0.0, None, 7.0]
    df = spark.createDataFrame([("3", "4"), ("3", "-333333333")], "a string, b string")
    assert [r[0] for r in df.select(civic.census_margin_rss(F.col("a"), F.col("b"))).collect()] == [5.0, None]


def test_election_day(spark):
    got = column(spark, [2021, 2022, 2024, 2027], "int", civic.november_election_day)
    assert [str(d) for d in got] == ["2021-11-02", "2022-11-08", "2024-11-05", "2027-11-02"]


def test_stage_depth(spark):
    assert column(spark, ["general special runoff", "primary", "recall", None], "string", civic.stage_depth) == [4, 1, 0, 0]


def test_date_gate_and_flags(spark):
    df = spark.sql("SELECT date'2024-01-01' e, CAST(NULL AS date) n, true f, false g, CAST(NULL AS boolean) u")
    r = df.select(civic.not_before(F.col("f"), F.col("e"), F.col("n")).alias("a"), civic.not_before(F.col("f"), F.col("n"), F.col("e")).alias("b"), civic.all_false(F.col("g"), F.col("u")).alias("c")).first()
    assert (r.a, r.b, r.c) == (False, True, False)


def test_json_fields_never_raise(spark):
    docs = ['{"a": "12.0"}', '{"a": ""}', "{broken", None]
    assert column(spark, docs, "string", lambda c: text.json_field(c, "a", "int_via_float")) == [12, None, None, None]
    assert column(spark, docs, "string", lambda c: text.json_field(c, "a", "date")) == [None] * 4


def test_wilson(spark):
    df = spark.createDataFrame([(5, 10), (0, 0), (11, 10)], "k int, n int").select(*numbers.wilson(F.col("k"), F.col("n")))
    assert [tuple(r) for r in df.collect()] == [(50.0, 23.7, 76.3), (None, None, None), (None, None, None)]


def test_projection_interval_encloses(spark):
    df = spark.createDataFrame([(150.0, 100.0), (1.0, 100.0), (float("nan"), 10.0)], "p double, s double")
    rows = df.select(*numbers.projection_interval(F.col("p"), F.col("s"), F.lit(-0.1), F.lit(0.1), F.lit(False))).collect()
    assert all(r.lower <= r.point <= r.upper for r in rows[:2]) and rows[0].point == 150 and rows[1].lower == 3


def test_human_names(spark):
    cases = {
        'Dr. Jannet "Jan the Man" Cynthia St. Jons Sr': ("Dr.", "Jannet", "Cynthia", "St. Jons", "Sr", "Jan the Man"), "Jane Marie Smith": (None, "Jane", "Marie", "Smith", None, None),
        "John O'Brien III": (None, "John", None, "O'Brien", "III", None), "Ms. Maria de la Cruz": ("Ms.", "Maria", None, "de la Cruz", None, None), "de la Cruz, Maria Ana": (None, "Maria", "Ana", "de la Cruz", None, None), None: (None,) * 6,
    }
    names.register(spark)
    df = spark.createDataFrame([(i, n) for i, n in enumerate(cases)], "i int, n string")
    got = df.selectExpr("i", "parse_human_name(n) p").select("i", "p.*").sort("i").collect()
    assert [tuple(r)[1:] for r in got] == list(cases.values())


@settings(max_examples=200, deadline=None)
@given(st.text("abcdé ", max_size=9), st.text("abcdé ", max_size=9))
def test_jaro_winkler_equals_duckdb(a, b):
    if a.isascii() and b.isascii() and a and b:
        want = duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert similarity.jaro_winkler_of(a, b) == pytest.approx(want, abs=1e-9)
    assert similarity.jaro_winkler_of(a, b) == pytest.approx(similarity.jaro_winkler_of(b, a), abs=0.08)


def test_column_policies(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, name string, phone string, fresh string")
    family = {"id": "key", "name": "person", "phone": "contact"}
    assert columns.in_families(df, family, ["key", "person"]) == ["id", "name"]
    assert columns.excluding(df, family, ["contact"]) == ["id", "name"]
    assert columns.matching(df, "(General|fre).*") == ["fresh"]
    other = spark.createDataFrame([("1", "a")], "id string, name string")
    assert columns.compare_schemas({"x": df, "y": other}) == [("fresh", "missing", ["y"]), ("id", "type int, string", ["x", "y"]), ("phone", "missing", ["y"])]
