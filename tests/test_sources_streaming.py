"""Files, published tables, enrichment, metrics, linkage and streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quorum.functions import similarity
from quorum.functions.similarity import jaro_winkler
from quorum.operators import linkage, quality
from quorum.plans import analytic, metrics
from quorum.sources import enrich, files
from quorum.streaming import streams


def test_read_delimited_keeps_zeros(spark, tmp_path):
    (tmp_path / "a.tab").write_text('id\tzip\n1\t00501\n2\t"x\ty"\n')
    got = files.read_delimited(spark, str(tmp_path / "a.tab"), F.lit("now"))
    assert [(r.id, r.zip, r.loaded_at) for r in got.sort("id").collect()] == [("1", "00501", "now"), ("2", "x\ty", "now")]


def test_table_names():
    assert files.table_name_of("VM2--CA--2024-01-01-DEMOGRAPHIC.tab", "CA") == "l2_s3_ca_demographic"
    with pytest.raises(ValueError):
        files.table_name_of("readme.txt", "CA")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b', None, "CA"), (2, "", [1, 2], "CA"), (3, "x", None, "TX")], "i int, s string, l array<int>, st string")
    files.write_delimited(df, str(tmp_path / "out"), [("s", "string"), ("i", "bigint"), ("none", "date"), ("l", "string")], ("st", "CA"))
    got = spark.read.csv(str(tmp_path / "out"), header=True, quote='"', escape='"', nullValue=None, emptyValue="").sort("i").collect()
    assert [(r.i, r.none, r.l) for r in got] == [("1", None, None), ("2", None, "[1,2]")] and got[0].s == 'a "q", b'


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "CA"), (2, "TX")], "i int, st string")
    p = str(tmp_path / "t")
    assert [files.overwrite_partition(df, p, "st", s) for s in ("CA", "TX", "CA")] == ["loaded", "loaded", "skipped"]
    assert files.overwrite_partition(df.unionByName(df), p, "st", "CA") == "loaded"
    assert spark.read.parquet(p).count() == 3
    other = df.withColumn("i", F.col("i") + 7)  # as many rows, other values
    assert files.overwrite_partition(other, p, "st", "TX") == "loaded"
    assert {r.i for r in spark.read.parquet(p).where("st = 'TX'").collect()} == {9}


def test_logs_batches_and_records(spark, tmp_path):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "i int, s string")
    assert [files.append_log(df, log, ["i"]), files.append_log(df.withColumn("s", F.lit("z")), log, ["i"])] == [2, 0]
    assert {tuple(r) for r in spark.read.parquet(log).collect()} == {(1, "a"), (2, "b")}
    assert [(v, p.count()) for v, p in files.partitions_of(df, "s")] == [("a", 1), ("b", 2)]
    assert [len(b) for b in files.batches_of(df, 2)] == [2, 1] and list(files.batches_of(df.limit(0), 2)) == []
    for name in (str(tmp_path / "r.csv"), str(tmp_path / "r_parquet"), "linked_records"):
        files.write_records(df, name)
        assert {(int(r.i), r.s) for r in files.read_records(spark, name).collect()} == {(1, "a"), (2, "b")}
    spark.sql("DROP TABLE linked_records")
    out = str(tmp_path / "over")
    files.overwrite_table(df, out)
    files.overwrite_table(files.read_published(spark, out, "table").select("s"), out)
    assert files.read_published(spark, out, "table").columns == ["s"]


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "pub")
    a, b = spark.range(5), spark.range(7)
    assert files.publish({"a": a, "b": a}, root)["published"]
    gate = quality.publish_gate(spark.range(1), a, "id", 0.9, 1, 0.9, ["id"])
    assert files.publish({"a": spark.range(1)}, root, {"a": gate}) == {"published": False, "failed": {"a": ["row_ratio", "key_overlap"]}}
    assert files.read_published(spark, root, "a").count() == 5
    files.publish({"a": b, "b": b}, root)
    assert files.read_published(spark, root, "a").count() == files.read_published(spark, root, "b").count() == 7


def test_enrich_drops_misses(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    got = enrich.enrich(df, "k", "rid bigint, name string", lambda ks: {k: (k * 10, "n") for k in ks if k == 2})
    assert [tuple(r) for r in got.collect()] == [(2, 20, "n")]


DEFINITIONS = {
    "semantic_models": [{"name": "s", "defaults": {"agg_time_dimension": "day"}, "dimensions": [{"name": "won", "type": "categorical", "expr": "result = 'won'"}, {"name": "day", "type": "time"}], "measures": [{"name": "n", "agg": "sum", "expr": "1"}]}],
    "metrics": [
        {"name": "wins", "type": "simple", "type_params": {"measure": "n"}, "filter": "{{ Dimension('s__won') }} and {{ TimeDimension('s__day', 'day') }} >= '2024-01-01'"},
        {"name": "all_wins", "type": "cumulative", "type_params": {"measure": "n"}, "filter": "{{ Dimension('s__won') }}"},
    ],
}


def test_metrics(spark):
    d = lambda m, n: dt.date(2024, m, n)
    t = spark.createDataFrame([(d(1, 5), "won", "a"), (d(1, 9), "lost", "a"), (d(3, 1), "won", "a"), (dt.date(2023, 12, 1), "won", "b")], "day date, result string, g string")
    reg = metrics.registry_of(DEFINITIONS)
    assert {(str(r.period), r.wins) for r in metrics.query(reg["wins"], t).collect()} == {("2024-01-01", 1), ("2024-03-01", 1)}
    got = metrics.query(reg["all_wins"], t, [], "month", ("2023-12-01", "2024-04-01")).sort("period").collect()
    assert [r.all_wins for r in got] == [1, 2, 2, 3, 3]
    by = metrics.query(reg["all_wins"], t, ["g"], "month", ("2023-12-01", "2024-03-01")).where("g = 'a'").sort("period").collect()
    assert [r.all_wins for r in by] == [0, 1, 1, 2]


def test_linkage_finds_the_same_people(spark):
    firsts, lasts = ["ann", "bob", "carla", "dave", "eve", "frank", "gina", "hugo"], ["stone", "rivera", "okafor", "lindqvist", "marsh", "petrov", "quayle", "ng"]
    people = [(f"{f}{l}", f, l, "CA", str(i * 7 % 23)) for i, (f, l) in enumerate((f, l) for f in firsts for l in lasts)]
    typo = lambda s: s[:-1] + "x" if len(s) > 4 else s
    a = spark.createDataFrame([(f"a|{k}", f, l, s, z) for k, f, l, s, z in people], "id string, first string, last string, state string, zip string")
    b = spark.createDataFrame([(f"b|{k}", f, typo(l) if i % 4 == 0 else l, s, z) for i, (k, f, l, s, z) in enumerate(people)], "id string, first string, last string, state string, zip string")
    comps = [
        linkage.Comparison("last", ["last"], [F.col("l_last") == F.col("r_last"), F.col("jw") >= 0.88]),
        linkage.Comparison("first", ["first"], [F.col("l_first") == F.col("r_first")]),
        linkage.Comparison("zip", ["zip"], [F.col("l_zip") == F.col("r_zip")]),
    ]
    sides = lambda p: linkage.with_sides(p, a, b, "id", ["first", "last", "zip"]).withColumn("jw", jaro_winkler(F.col("l_last"), F.col("r_last")))
    pairs = a.select(F.col("id").alias("id_l"), "state").join(b.select(F.col("id").alias("id_r"), "state"), "state").select("id_l", "id_r")
    gammas = linkage.compare(sides(pairs), comps)
    model = linkage.estimate(gammas, linkage.compare(sides(linkage.chance_pairs(a, b, "id", 4000)), comps), comps)
    scored = linkage.score(gammas, model, comps)
    found = {(r.id_l[2:], r.id_r[2:]) for r in scored.where("match_probability > 0.8").collect()}
    assert found == {(k, k) for k, *_ in people}
    groups = linkage.clusters(scored, 0.8)
    assert groups.count() == 128 and groups.select("cluster_id").distinct().count() == 64


def test_stream_upsert_and_windows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, at timestamp, v string"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    for i, data in enumerate([[(1, t(1), "a"), (2, t(1), "b")], [(1, t(3), "c"), (1, t(2), "late")], [(1, t(2), "older"), (3, t(1), "d")]]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        streams.run_available(spark.readStream.schema(schema).parquet(src), streams.upsert_into(out, ["k"], ["at", "v"]), str(tmp_path / "cp"))
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [(1, "c"), (2, "b"), (3, "d")]
    stream = spark.readStream.schema(schema).parquet(src)
    q = streams.weekly(stream, "at", ["k"]).writeStream.format("memory").queryName("weeks").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(str(r.week_start), r.k, r.n_events) for r in spark.table("weeks").collect()} == {("2024-01-01 00:00:00", 1, 4), ("2024-01-01 00:00:00", 2, 1), ("2024-01-01 00:00:00", 3, 1)}
    s = streams.sessions(stream, "at", "k", "90 minutes").writeStream.format("memory").queryName("visits").outputMode("complete").trigger(availableNow=True).start()
    s.awaitTermination()
    assert {(r.k, r.n_events) for r in spark.table("visits").collect()} == {(1, 4), (2, 1), (3, 1)}


def test_linkage_candidates(spark, small):
    rows = [
        ("a|1", "a", "CA", "lindqvist", None, None, None), ("b|1", "b", "CA", "kindqvist", None, None, None), ("c|1", "c", "NV", "lindqvist", None, None, None), ("a|2", "a", "CA", "lindqvist", None, None, None),
        ("b|3", "b", "CA", "stone", None, "555", None), ("c|3", "c", "TX", None, None, "555", None), ("b|4", "b", "TX", "ng", None, None, "p"), ("d|4", "d", "TX", "wu", None, None, "p"), ("a|4", "a", "CA", "ho", None, None, "p"),
        ("c|5", "c", "CA", "marsh", "m@x", None, None), ("d|5", "d", "TX", "swamp", "m@x", None, None),
    ]
    e = spark.createDataFrame(rows, "unique_id string, source_name string, state string, last string, email string, phone string, position string")
    got = [tuple(r) for r in analytic.linkage_candidates(e, 0.92).collect()]
    assert sorted(got) == [("a|1", "b|1"), ("a|2", "b|1"), ("b|3", "c|3"), ("b|4", "d|4"), ("c|5", "d|5")]
    linked = analytic.record_linkage(spark, small).collect()
    assert {r.id_l.split("|")[0] for r in linked} >= {"ballotready", "ddhq"} and all(r.id_l.split("|")[0] < r.id_r.split("|")[0] for r in linked)


def test_near_keys_lose_no_pair():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcde") for _ in range(rng.randrange(1, 13))) for _ in range(400)} | {"ng", "li", "lee", "de la cruz", "garcia-lopez", "garcia-lopes"})
    keys = {w: set(similarity.near_keys_of(w, 0.88)) for w in words}
    near = [(a, b) for a in words for b in words if similarity.jaro_winkler_of(a, b) >= 0.88]
    assert len(near) > len(words) and not [p for p in near if keys[p[0]].isdisjoint(keys[p[1]])]
