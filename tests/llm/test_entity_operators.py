"""Names, metric joins, matching and groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorum.llm import components, matching, metric, names, queries, variants
from quorum.session import table

VOCABULARY = names.Vocabulary({"robert": 90, "bob": 40, "susan": 80, "sue": 30, "jose": 50, "joseph": 70, "joe": 60, "patrick": 40, "patricia": 41, "pat": 30}, {"robert": {"bob"}, "bob": {"robert"}, "susan": {"sue"}, "sue": {"susan"}, "jose": {"joe"}, "joseph": {"joe"}, "joe": {"jose", "joseph"}, "pat": {"patrick", "patricia"}, "patrick": {"pat"}, "patricia": {"pat"}})


def levenshtein(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


@pytest.mark.parametrize("first, last, want", [
    ("Robert", "Stone", ("robert", "stone")), ("Stone, Robert", None, ("robert", "stone")), (None, "Robert De la Cruz", ("robert", "de la cruz")), ("STONE", "bob", ("bob", "stone")),
    ("Dr. Robert", "Stone, Jr", ("robert", "stone")), ("R.", "Stone PhD", ("r.", "stone")), ("Stone", "R.B.", ("r.b.", "stone")), (None, None, ("", "")), ("", "", ("", "")), ("Robert (Bob)", "O’Brien", ("robert (bob)", "o'brien")),
])
def test_split_name(first, last, want):
    assert names.split_name(first, last, VOCABULARY) == want


def test_given_names():
    assert names.given_names("robet", [], VOCABULARY)[0] == ["robert"]
    assert names.given_names("robt.", [], VOCABULARY)[0] == ["robert"]
    assert names.given_names("r.b.", [], VOCABULARY) == ([], [], ["r"], [], True)
    forms, wider, letters, stems, initial = names.given_names("joe", ["José"], VOCABULARY)
    assert forms == ["joe", "jose"] and set(wider) == {"joe", "jose", "joseph"} and letters == ["j"] and not stems and not initial
    assert names.given_names("l.", ["lexi"], VOCABULARY)[3:] == (["lex"], True)
    assert [names.short_stem(x) for x in ("eddie", "kenny", "nick", "mo", "amy")] == ["ed", "ken", "nic", "mo", "am"]


def test_parts():
    assert names.surname_parts("de la cruz-stone") == ["delacruz", "stone"] and names.surname_parts("mc loberley") == []
    assert names.place_of("County of St. Falillake Board of Supervisors D12") == "saint falillake"
    assert names.body_of("Member, Mt. Aldorworth City Council V") == "council" and names.body_of(None, "Fire District Board") == "fire" and names.body_of("x") == ""
    seats = [("7.0", None, None), ("VII", None, None), ("7th", None, None), ("District 07", None, None), (None, "Board (Area 7)", None), ("At-Large", "Board D7", None), ("", "Board VII", None), (None, "Board", "District 7")]
    assert {names.seat_of(*s) for s in seats} == {"7"} and names.seat_of("0", "Mayor of Xenia", None) == ""


def test_offices_without_a_common_wording():
    towns = ["Springfield Sheriff", "Springfield Judge", "Springfield Water Board", "Town of Springfield Council", "Springfield Library District", "City of Springfield Assessor"]
    assert {names.place_of(t) for t in towns} == {"springfield"} and len({names.body_of(t) for t in towns}) == len(towns)
    assert names.body_of("Cook County Sheriff") != names.body_of("Cook County Assessor")
    assert names.place_of("Springfield Dogcatcher", "Dogcatcher") == "springfield" and names.body_of("Springfield Dogcatcher", None, "Dogcatcher") == "dogcatcher"


def test_one_edit():
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(120)]
    for a in words:
        for b in words:
            swap = any(a[:i] + a[i + 1] + a[i] + a[i + 2 :] == b for i in range(len(a) - 1))
            assert names.one_edit(a, b) == (levenshtein(a, b) <= 1 or swap)


@pytest.mark.parametrize("cell, block", [(256, 1024), (8, 5), (3, 1024)])
def test_radius_join_against_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(metric, "CELL", cell)
    monkeypatch.setattr(metric, "BLOCK", block)
    rng = random.Random(cell)
    data = [(rng.choice(["g", "g", "h"]), "".join(rng.choice("abcd") for _ in range(rng.randrange(3, 8)))) for _ in range(150)]
    data += [("g", ""), ("g", "x" * 400), ("g", "x" * 401), ("g", None), (None, "a"), *data[:9]]
    got = [tuple(r) for r in metric.radius_join(spark.createDataFrame(data, "grp string, name string").withColumn("pivot", F.lit(0)), 2).collect()]
    clean = {(g, n) for g, n in data if g is not None and n is not None}
    want = {(g, a, b, levenshtein(a, b)) for g, a in clean for h, b in clean if g == h and a < b and abs(len(a) - len(b)) <= 2 and levenshtein(a, b) <= 2}
    assert len(got) == len(set(got)) and set(got) == want
    assert metric.radius_join(spark.createDataFrame([], "grp string, name string"), 2).count() == 0


CANDIDATES = "unique_id string, source_name string, state string, first_name string, last_name string, first_name_aliases string, official_office_name string, email string, phone string"


def candidates(spark, rows):
    filler = [(f"f|{i}", "s", "ZZ", f, f"Filler{i}", f'["{f}", "{n}"]', f"Fillertown{i % 3} Mayor", None, None) for i, (f, n) in enumerate([("robert", "bob"), ("bob", "robert"), ("susan", "sue"), ("sue", "susan"), ("peter", "pete"), ("pete", "peter")] * 6)]
    return spark.createDataFrame([(u, "s", "CA", f, l, a, o, e, p) for u, f, l, a, o, e, p in rows] + filler, CANDIDATES).withColumn("place", F.lit("clash"))


def test_variants(spark):
    rows = [
        ("1", "Robert", "Stonewall", None, "Mayor of Springfield", None, None), ("2", "Bob", "Stonewal", "[]", "Springfield County Clerk", None, None), ("3", "Stonewall, Robert", None, None, "Mayor of Springfield", None, None),
        ("4", "Susan", "Stonewall", None, "Springfield Mayor", None, None), ("5", "R.", "Stonewall", "not json", "Springfield Mayor", None, None), ("6", "Robert", "Stonewall", None, "Mayor of Shelbyville", None, None),
        ("7", "Robert", "Stonewall-Mills", None, "Springfield Mayor", None, None), ("8", None, None, None, None, None, None), ("9", "Robert", "Marsh", None, "Springfield Mayor", None, None), ("1", "Robert", "Stonewall", None, "Mayor of Springfield", None, None),
    ]
    got = {(r.id_1, r.id_2) for r in variants.pairs_of(*variants.same_person(candidates(spark, rows))).where("id_1 NOT LIKE 'f|%'").collect()}
    same = ["1", "2", "3", "5", "7"]
    assert got == {(a, b) for a in same for b in same if a < b}


def test_links_are_planned_in_parts(spark, monkeypatch):
    """A plan is made anew after each of its stages, so the driver's memory goes by the largest one."""
    exchanges = {}

    def noted(cut):
        def run(df):
            plan = df._jdf.queryExecution().executedPlan().toString()
            exchanges[len(exchanges)] = plan.count("Exchange ")
            return cut(df)

        return run

    monkeypatch.setattr(variants, "cut", noted(variants.cut))
    monkeypatch.setattr(metric, "cut", noted(metric.cut))
    variants.same_person(table(spark, "/root/testdata/sf0.001", "dummy_data"))
    assert len(exchanges) > 15 and max(exchanges.values()) <= 10, exchanges


def test_contact_of_one_person_under_many_spellings(spark):
    spelled = ["Stonewall", "Stonewal", "Stonwall", "Stonewell", "Stonewalll"]
    rows = [(str(i), "Robert", n, None, "Mayor of Springfield" if i else None, None, "5551234567") for i, n in enumerate(spelled)]
    parts = names.parts_of_records(candidates(spark, rows), VOCABULARY)
    assert variants.placeholders(parts).count() == 0 and variants.contacts(parts, "unique_id").count() == len(spelled)
    others = rows + [(f"x{i}", "Ann", n, None, "Mayor of Springfield", None, "5551234567") for i, n in enumerate(["Marsh", "Quill", "Ferro", "Lindqvist"])]
    assert [r.contact for r in variants.placeholders(names.parts_of_records(candidates(spark, others), VOCABULARY)).collect()] == ["5551234567"]


def test_rare_names_are_related_by_a_table(spark):
    rows = [("1", "Zebulon", "Stonewall", '["zebulon", "zeke"]', "Mayor of Springfield", None, None), ("2", "Zebulon", "Ferro", '["zebulon", "zeke"]', "Shelbyville Mayor", None, None),
            ("3", "Zebulon", "Marsh", None, "Springfield Mayor", None, None), ("4", "Zeke", "Marsh", None, "Springfield Clerk", None, None), ("5", "Zebulonn", "Marsh", None, "Springfield Clerk", None, None)]
    member, linked = variants.same_person(candidates(spark, rows))
    got = {(r.id_1, r.id_2) for r in variants.pairs_of(member, linked).where("id_1 NOT LIKE 'f|%'").collect()}
    assert got == {("3", "4"), ("3", "5"), ("4", "5")}
    person = {r.unique_id: r.person for r in variants.persons_of(member, linked).collect()}
    assert person["3"] == person["4"] == person["5"] != person["1"]


def test_names_with_relatives_of_their_own_are_no_misspellings():
    v = names.Vocabulary({"gabriel": 800, "gabriela": 40, "gabriell": 3, "gabe": 200, "gabby": 90, "gabrielle": 300}, {"gabriel": {"gabe"}, "gabe": {"gabriel", "gabriell"}, "gabriell": {"gabe"}, "gabriela": {"gabby", "gabrielle"}, "gabby": {"gabriela", "gabrielle"}, "gabrielle": {"gabby", "gabriela"}})
    assert v.snap("gabriela") == ["gabriela"] and "gabriell" not in v.count and "gabriel" in v.snap("gabriell")


def test_variants_of_nothing(spark):
    member, linked = variants.same_person(candidates(spark, []).limit(0))
    assert variants.pairs_of(member, linked).count() == 0


def test_mixture_separates():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0.9, 0.05, (300, 3)), rng.normal(0.2, 0.2, (900, 3))])
    g = (x.min(axis=1) > 0.6).astype(float)
    for _ in range(10):
        g = matching.Mixture(x, np.ones(len(x)), g).posterior(x)
    assert g[:300].min() > 0.9 and g[300:].max() < 0.5


def test_transitivity(spark):
    rows = [("a", "b", "s", "t", 0.99), ("b", "c", "t", "u", 0.9), ("a", "c", "s", "u", 0.4), ("d", "e", "s", "t", 0.99), ("e", "f", "t", "u", 0.8), ("d", "f", "s", "u", 0.01)]
    df = spark.createDataFrame(rows, "a_cls string, b_cls string, a_source_name string, b_source_name string, gamma double")
    got = {(r.a_cls, r.b_cls): r.gamma for r in matching._transitive(df).collect()}
    assert got["a", "c"] == pytest.approx(0.99 * 0.9) and got["e", "f"] == pytest.approx(0.01 / 0.99) and got["d", "e"] == 0.99
    assert len(got) == 6


ELECTED = CANDIDATES + ", district_identifier string, office_type string, candidate_office string, district_raw string, city string"


def test_matching(spark, small):
    officials = table(spark, small, "dummy_data_elected")
    got = queries.p1_found(spark, small).collect()
    assert got and len(got) == len(set(got)) and all(r.id_1 < r.id_2 and r.id_1.split("|")[0] != r.id_2.split("|")[0] for r in got)
    twice = matching.found(*matching.match_across_sources(officials.unionAll(officials).withColumn("gamma", F.lit(1)))).select("id_1", "id_2").collect()
    assert {tuple(r) for r in twice} == {tuple(r) for r in got}
    blank = officials.withColumns({c: F.lit(None).cast("string") for c in ("first_name", "last_name", "first_name_aliases", "official_office_name", "district_identifier", "email", "phone", "city")})
    assert matching.found(*matching.match_across_sources(blank)).count() == 0
    assert matching.found(*matching.match_across_sources(officials.limit(0))).count() == 0


def brute_groups(members):
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for i, label in members:
        if i is not None and label is not None:
            by.setdefault(label, []).append(i)
    for ids in by.values():
        for i in ids:
            a, b = top(ids[0]), top(i)
            parent[max(a, b)] = min(a, b)
    size = {}
    for x in parent:
        size[top(x)] = size.get(top(x), 0) + 1
    return {(x, top(x)) for x in parent if size[top(x)] > 1}


def random_members(n_ids, n_labels, seed):
    rng = random.Random(seed)
    return [(f"{rng.randrange(n_ids):04d}", f"l{k}") for k in range(n_labels) for _ in range(rng.choice([1, 2, 2, 3]))]


CHAIN = [(f"{i:03d}", f"l{j}") for i in range(70) for j in (i, i + 1)]
DEEP = [(f"{i:04d}", f"l{j}") for i in range(100) for j in (i, i + 1)] + [("0050", f"x{i}") for i in range(5)] + [(f"y{i}", f"x{i}") for i in range(5)] + [("p", "q"), ("r", "q")]
CASES = {
    "giant a hundred deep": DEEP,
    "sorted chain, deeper than the frontiers": CHAIN,
    "hub and chain": CHAIN + [(f"h{i:02d}", "hub") for i in range(40)],
    "random, one giant": random_members(60, 60, 1),
    "random, many small": random_members(4000, 150, 2),
    "repeats and nulls": [("a", "x"), ("a", "x"), ("b", "x"), (None, "x"), ("c", None), ("d", "y")],
    "nothing": [],
}


@pytest.mark.parametrize("case", CASES)
def test_groups_against_union_find(spark, case):
    df = spark.createDataFrame(CASES[case], "id string, label string").withColumn("f", F.lit("clash"))
    got = [tuple(r) for r in components.connected_groups(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_groups(CASES[case])


def test_a_deep_giant_is_peeled_whole(spark):
    edges = components.spokes(spark.createDataFrame(DEEP, "id string, label string"))
    assert {r.v for r in components.peel(edges).collect()} == {i for i, _ in DEEP} - {"p", "r"}


def test_llm_queries_and_sql(spark, small):
    from tools import compare

    con, sql = compare.connect(small), queries.oracle_sql()
    for name in sql:
        assert compare.canon(queries.queries()[name](spark, small).toPandas()) == compare.canon(con.execute(sql[name]).fetchdf()), name
