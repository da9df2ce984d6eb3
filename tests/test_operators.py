"""Operators against small cases with nulls, ties, repeats, empty tables and clashing names."""

import datetime as dt

from pyspark.sql import functions as F

from quorum.operators import aggregates, graph, incremental, joins, quality, reshape, windows
from quorum.operators import references as ref
from quorum.operators import skew
from quorum.plans import catalogue
from quorum.session import table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_orphans(spark):
    child = spark.createDataFrame([(" {A} ", ts("2024-01-05")), ("b", ts("2024-01-05")), ("c", ts("2024-01-05")), (None, ts("2024-01-05")), ("x", None), ("x", ts("2024-02-01")), ("x", ts("2024-02-01"))], "id string, at timestamp").withColumn("_fk", F.lit(1))
    parent = spark.createDataFrame([("a", ts("2024-01-01"), None), ("B", ts("2024-02-01"), None), ("c", ts("2023-01-01"), ts("2024-01-05")), ("c", ts("2023-01-01"), None), (None, None, None)], "k string, born timestamp, died timestamp")
    p = ref.parent_lifespans(parent, ref.plain_id(F.col("k")), F.col("born"), F.col("died"))
    got = ref.orphan_references(child, ref.plain_id(F.col("id")), F.col("at"), p)
    assert sorted((r._fk, r.reason) for r in got.collect()) == [("b", "late"), ("c", "deleted"), ("x", "missing"), ("x", "missing"), ("x", "missing")]
    counts = ref.orphan_counts(got, []).collect()
    assert {(r.month, r.reason): r.n_rows for r in counts} == {("2024-01", "late"): 1, ("2024-01", "deleted"): 1, (None, "missing"): 1, ("2024-02", "missing"): 2}
    assert ref.orphan_references(child.limit(0), F.col("id"), F.col("at"), p).count() == 0
    assert ref.orphan_references(child, ref.plain_id(F.col("id")), F.col("at"), p.limit(0)).count() == 6


def test_balanced_by_key(spark):
    data = [("hot", i % 300, i) for i in range(3000)] + [("cold", 1, 1), (None, None, 5), ("cold", None, 9)]
    df = spark.createDataFrame(data, "key string, s int, t int").withColumn("n_rows", F.lit(0))
    got = rows(skew.balanced_by_key(df, F.col("key"), F.col("s"), F.col("t")))
    assert got == sorted([("hot", 3000, 300, 2999), ("cold", 2, 1, 9), (None, 1, 0, 5)], key=str)
    assert skew.balanced_by_key(df.limit(0), F.col("key"), F.col("s"), F.col("t")).count() == 0
    plan = skew.balanced_by_key(df, F.col("key"), F.col("s"), F.col("t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and plan.count("hashpartitioning") == 2  # repeats of a pair, then ranges, then only states
    assert {r.key: round(r.share, 3) for r in skew.key_shares(df, F.col("key")).collect()}["hot"] == 0.999


def test_hot_pairs_are_folded_before_the_ranges(spark):
    rows_ = [("hot", None, i) for i in range(3000)] + [("hot", "v", i) for i in range(3000)] + [(f"k{i % 7}", f"v{i}", i) for i in range(100)] + [(None, "v", None)]
    df = spark.createDataFrame(rows_, "key string, s string, t int").repartition(6)
    got = {r.key: (r.n_rows, r.n_distinct, r.latest) for r in skew.balanced_by_key(df, F.col("key"), F.col("s"), F.col("t")).collect()}
    assert got["hot"] == (6000, 1, 2999) and got[None] == (1, 1, None) and sum(v[0] for v in got.values()) == len(rows_)
    folded = skew.folded_pairs(df, F.col("key"), F.col("s"), F.col("t"))
    assert folded.count() == 103 and {(r._s, r._n) for r in folded.where("_k = 'hot'").collect()} == {(None, 3000), ("v", 3000)}


def test_latest_by_struct_equals_window(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 3, "b"), (1, 1, "z"), (2, None, "q"), (None, 1, "n")], "k int, o int, v string")
    a = windows.latest_by_struct(df, ["k"], ["o", "v"])
    b = windows.latest_per_key(df, ["k"], [F.col("o").desc_nulls_last(), F.col("v").desc()])
    assert rows(a) == rows(b)


def test_totals_keep_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, None)], "k string, v int")
    got = windows.with_totals(df, ["k"], total=F.sum("v"), n=F.count(F.lit(1)))
    assert rows(got) == sorted([("a", 1, 3, 2), ("a", 2, 3, 2), (None, 5, 5, 2), (None, None, 5, 2)], key=str)
    assert got.columns == ["k", "v", "total", "n"]


def test_sessions(spark):
    at = [ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:30"), ts("2024-01-01 00:01:01")]
    df = spark.createDataFrame([("u", t) for t in at], "u string, t timestamp")
    assert [r.session_no for r in windows.sessions_by_gap(df, "u", "t", 30).sort("t").collect()] == [1, 1, 2]


def test_merge_providers(spark):
    a = spark.createDataFrame([(1, "a1"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, "b2"), (3, "b3")], "k int, v string")
    c = spark.createDataFrame([(3, "c3"), (None, "cn")], "k int, w string")
    got = joins.merge_providers({"a": a, "b": b, "c": c}, "k", {"v": ["a", "b"], "w": ["c"]})
    assert rows(got) == sorted([(1, "a1", None, ["a"]), (2, "b2", None, ["a", "b"]), (3, "b3", "c3", ["b", "c"]), (None, None, "cn", ["c"])], key=str)


def test_anti_on_any_has_no_nested_loop(spark):
    left = spark.createDataFrame([(1, "a", None), (2, None, "p"), (3, None, None)], "i int, e string, p string")
    right = spark.createDataFrame([("a", "x"), (None, "p"), (None, None)], "e string, p string")
    got = joins.anti_on_any(left, right, ["e", "p"])
    assert [r.i for r in got.collect()] == [3]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_nearest_and_one_to_one(spark):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    a = spark.createDataFrame([("a1", "s", d(0)), ("a2", "s", d(3)), ("a3", "t", d(0))], "a string, st string, x date")
    b = spark.createDataFrame([("b1", "s", d(2)), ("b2", "s", d(4)), ("b3", "s", d(40))], "b string, st string, y date")
    near = joins.nearest_within(a, b, "a", "b", ["st"], "x", "y", 10)
    assert rows(near.select("left_id", "right_id", "diff")) == [("a1", "b1", 2), ("a1", "b2", 4), ("a2", "b1", 1), ("a2", "b2", 1)]
    assert rows(joins.best_right(near)) == [("a1", "b1", 2), ("a2", "b1", 1)]
    assert rows(joins.one_to_one(near)) == [("a2", "b1", 1)]


def test_in_range(spark):
    p = spark.createDataFrame([(1, "s", 5.0), (2, "s", None), (3, "t", 5.0)], "i int, g string, v double")
    r = spark.createDataFrame([("s", 0.0, 5.0), ("s", 5.0, 9.0), ("s", 6.0, 1.0), ("s", None, 9.0)], "g string, lo double, hi double")
    assert rows(joins.in_range(p, r, ["g"], "v", "lo", "hi", 2.0).select("i", "lo")) == [(1, 0.0), (1, 5.0)]


def test_covered_on(spark):
    d = lambda n: dt.date(2024, 1, n)
    p = spark.createDataFrame([(1, d(5)), (1, d(5)), (2, d(5)), (3, d(5))], "k int, day date")
    s = spark.createDataFrame([(1, d(1), None, True), (2, None, None, True), (3, d(1), d(5), False)], "k int, s date, e date, v boolean")
    assert rows(joins.covered_on(p, s, "k", "day", "s", "e", F.col("v")).select("k", "covered")) == [(1, True), (1, True), (2, None), (3, False)]


def test_wildcard(spark):
    f = spark.createDataFrame([(1, "x", 7), (2, "x", 8), (3, "y", 1)], "fact_id int, a string, b int")
    r = spark.createDataFrame([("x", None, "any"), ("x", 7, "seven")], "r_a string, r_b int, r_l string")
    assert rows(joins.wildcard_lookup(f, r, ["a"], ["b"], [F.col("r_l")]).select("fact_id", "r_l")) == [(1, "seven"), (2, "any"), (3, None)]


def test_blocked_pairs_once(spark):
    a = spark.createDataFrame([(1, "x", "p"), (2, None, "q")], "i int, e string, p string")
    b = spark.createDataFrame([(9, "x", "p"), (8, None, "q"), (7, None, None)], "i int, e string, p string")
    assert rows(joins.blocked_pairs(a, b, [[F.col("e")], [F.col("p")]], "i", "i")) == [(1, 9), (2, 8)]


def test_mode_ties_and_histogram(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", None), ("b", None)], "k string, v int")
    assert rows(aggregates.mode_of(df, ["k"], "v")) == [("a", 1, 1)]
    h = aggregates.histogram(df, "k", F.col("v").cast("string"), "h").collect()
    assert {r.k: [(x.label, x["count"], x.percent) for x in r.h] for r in h}["b"] == [("Unknown", 1, 100.0)]


def test_mass_is_conserved(spark):
    df = spark.createDataFrame([("w", 1.0, 10.0), ("w", 2.0, 10.0), ("z", 0.0, 4.0)], "w string, x double, m double")
    got = aggregates.allocate_mass(df, "w", "x", "m")
    assert quality.mass_conserved(got.where("w = 'w'"), "w", "m", "allocated").count() == 0
    assert got.where("w = 'z'").first().allocated is None


def test_count_once_ordering(spark):
    df = spark.createDataFrame([("c", "s1", 1), ("c", "s2", 1), ("c", "s1", 1), ("c", "s1", 2), ("c", "s1", None)], "c string, s string, m int")
    assert rows(aggregates.count_once(df, "c", "s", "m")) == [("c", 2, 3)]


def test_unpivot_and_unions(spark):
    df = spark.createDataFrame([(1, "a", None)], "i int, x string, y int")
    assert rows(reshape.unpivot(df, ["i"], ["x", "y"])) == [(1, "x", "a")]
    assert rows(reshape.unpivot_known(df, ["i"], ["x", "nope"])) == [(1, "x", "a")]
    tail = spark.createDataFrame([(1,), (5,)], "t int")
    assert rows(reshape.master_and_tail(spark.createDataFrame([(3,)], "t int"), tail, "t")) == [(3,), (5,)]
    assert rows(reshape.master_and_tail(tail.limit(0), tail, "t")) == [(1,), (5,)]


def test_incremental(spark):
    src = spark.createDataFrame([(1, 5), (2, 6), (3, 1)], "k int, t int")
    tgt = spark.createDataFrame([(1, 5), (2, 5)], "k int, t int")
    assert rows(incremental.newer_than(src, tgt, "t")) == [(2, 6)]
    assert rows(incremental.newer_than(src, tgt, "t", inclusive=True)) == [(1, 5), (2, 6)]
    assert incremental.newer_than(src, tgt.limit(0), "t").count() == 3
    assert rows(incremental.newer_than_per_key(src, tgt, "k", "t")) == [(2, 6), (3, 1)]
    assert rows(incremental.upsert(tgt, src.where("k > 1"), ["k"], F.col("k") == 2)) == [(1, 5), (3, 1)]
    assert rows(incremental.keep_stored(src, tgt.withColumnRenamed("t", "t"), ["k"], "t")) == [(1, 5), (2, 5), (3, 1)]


def test_history_and_snapshots_agree(spark):
    snaps = spark.createDataFrame([("a", 1, "x"), ("b", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("b", 3, None)], "k string, d int, v string")
    h = incremental.history(snaps, "k", "d", ["v"])
    assert rows(h) == sorted([("a", "x", 1, 3), ("a", "y", 3, None), ("b", None, 1, 2), ("b", None, 3, None)], key=str)
    cur = spark.createDataFrame([], "k string, v string, valid_from int, valid_to int")
    for day in (1, 2, 3):
        cur = incremental.apply_snapshot(cur, snaps.where(F.col("d") == day), "k", ["v"], F.lit(day))
    assert rows(cur) == rows(h)


def test_minted_ids_are_stable(spark):
    one = spark.createDataFrame([("g", "m2", 2), ("g", "m1", 2)], "g string, m string, t int")
    more = one.unionByName(spark.createDataFrame([("g", "m0", 3)], "g string, m string, t int"))
    assert rows(incremental.mint_ids(one, "g", "m", "t")) == rows(incremental.mint_ids(more, "g", "m", "t"))
    pinned = spark.createDataFrame([("g", "m9")], "g string, anchor string")
    assert incremental.mint_ids(one, "g", "m", "t", pinned).first().anchor == "m9"


def test_components_with_conflicts(spark):
    e = spark.createDataFrame([("a", "b", False), ("b", "c", False), ("a", "c", True), ("x", "y", True)], "a string, b string, bad boolean")
    got = {r.v: (r.component, r.n_vertices, r.has_conflict) for r in graph.components(e, F.col("bad")).collect()}
    assert got == {"a": ("a", 3, True), "b": ("a", 3, True), "c": ("a", 3, True), "x": ("x", 1, False), "y": ("y", 1, False)}
    assert graph.components(e.limit(0)).count() == 0


def test_quality_vocabulary(spark):
    df = spark.createDataFrame([(1, "CA", "a"), (1, "Ca", None), (None, None, "b")], "i int, s string, v string")
    assert quality.not_null(df, "i").count() == 1
    assert [r.n for r in quality.unique(df, ["i"]).collect()] == [2]
    assert quality.accepted_values(df, "v", ["a"]).count() == 1
    assert quality.accepted_range(df, "i", low=2).count() == 2
    assert quality.expression_is_true(df, "i = 1").count() == 1
    assert quality.relationships(df, "v", df.where("v = 'a'"), "v").count() == 1
    assert quality.tuple_exists(df, ["s"], df.where("s = 'CA'")).count() == 2
    assert quality.is_state(df, "s").count() == 1 and quality.is_uuid(df, "v").count() == 2
    assert quality.share_below(df, F.col("i").isNull(), 0.05).count() == 1
    assert quality.unique_sampled(df, ["i"], 1.0).count() == 1 and quality.unique_sampled(df, ["v"], 1.0).count() == 0
    gates = {r.gate: r.passed for r in quality.publish_gate(df, df.limit(0), "i", 0.9, 10, 0.9, ["v"]).collect()}
    assert gates == {"row_ratio": True, "cold_start": False, "key_overlap": True, "null_v": False}


def test_watermark_reaches_the_scan(spark, small):
    e = spark.read.parquet(f"{small}/events.parquet")
    plan = incremental.newer_than(e, e.where("event_id < 100"), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan


def test_components_of_all_orders(spark, small):
    orders = table(spark, small, "orders").select("o_custkey", F.to_date("o_orderdate").cast("string").alias("day"), "o_orderpriority").collect()
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    by = {}
    for r in orders:
        by.setdefault((r.day, r.o_orderpriority), set()).add(r.o_custkey)
    for a, *rest in (sorted(x) for x in by.values()):
        for b in rest:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    want = {x: top(x) for x in parent if any(len(c) > 1 and x in c for c in by.values())}
    got = {r.v: r.component for r in catalogue.queries()["connected_components"](spark, small).collect()}
    assert got == want and any(v % 3 for v in got)


def test_covered_on_against_brute_force(spark):
    import random

    rng = random.Random(5)
    day = lambda: None if rng.random() < 0.1 else dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(120))
    spans = [(rng.choice([1, 1, 1, 2, None]), day(), day(), rng.choice([True, False, None])) for _ in range(60)]
    points = [(rng.choice([1, 1, 2, 3, None]), day()) for _ in range(150)]
    got = joins.covered_on(spark.createDataFrame(points, "k int, d date"), spark.createDataFrame(spans, "k int, s date, e date, v boolean"), "k", "d", "s", "e", F.col("v")).collect()

    def want(k, d):
        hits = [v for sk, s, e, v in spans if k is not None and d is not None and sk == k and s is not None and s <= d and (e is None or e >= d) and v is not None]
        return None if not hits else any(hits)

    assert sorted(((r.k, r.d, r.covered) for r in got), key=str) == sorted(((k, d, want(k, d)) for k, d in points), key=str)


def test_empty_increment_is_not_run(spark):
    df = spark.range(3)
    assert incremental.run_if_any(df.where("id > 9"), lambda x: 1 / 0, "n bigint").columns == ["n"]
    assert incremental.run_if_any(df, lambda x: x.withColumnRenamed("id", "n"), "n bigint").count() == 3


def test_chance_pairs_are_bounded(spark):
    from quorum.operators import linkage

    big = spark.range(20_000).withColumnRenamed("id", "k")
    assert 500 < linkage.chance_pairs(big, big, "k", 1000).count() < 2000
    assert 2500 < linkage.chance_pairs(big.limit(100), big.limit(100), "k", 3000).count() <= 3000
