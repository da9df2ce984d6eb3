"""Encoding, mixing and look-alikes."""

import random
import unicodedata

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quorum.llm import lookalikes, mixing, queries, tokens
from quorum.session import table

TEXTS = ["", None, "Hello  world's 123,456\n\n\tx", "naïve 東京 😀‍🏫 \x00", "<|endoftext|>", "a" * 5000, "ab" * 700, " " * 900, "=" * 3000 + " z", "Hello  world's 123,456\n\n\tx", "'s 'LL  don't", "퟿"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def documents(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").withColumn("ids", F.lit("clash"))


def test_encoding_equals_the_library(spark, reference):
    rng = random.Random(7)
    noise = ["".join(rng.choice("ab cé'1\n-東") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts = TEXTS + noise
    got = tokens.encode_corpus(documents(spark, texts), F.col("doc_id"), F.col("text")).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == [(i, reference(t)) for i, t in enumerate(texts)]


def test_long_words_equal_the_library(reference):
    rng = random.Random(3)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    work = tokens.Contractor(tokens.default_vocabulary())
    for word in [draw("abcdefghijklmnopqrstuvwxyz", 20_000), "ab" * 5000, draw("ab", 4000), draw("étation", 3000), "東京" * 900, "the" * 900 + "internationalization" * 99]:
        assert work.encode([word])[0].tolist() == reference(word)


def test_round_trip_and_repeated_ids(spark):
    df = documents(spark, TEXTS).unionAll(documents(spark, TEXTS))
    enc = tokens.encode_corpus(df, F.col("doc_id"), F.col("text"), batch_rows=5)
    assert enc.count() == 2 * len(TEXTS)
    back = {(r.doc_id, r.text) for r in tokens.decode_corpus(enc, batch_rows=3).collect()}
    assert back == {(i, t or "") for i, t in enumerate(TEXTS)}
    assert tokens.encode_corpus(df.limit(0), F.col("doc_id"), F.col("text")).count() == 0


def test_whole_table_equals_the_library(spark, small, reference):
    want = {r.doc_id: reference(r.text) for r in table(spark, small, "documents").collect()}
    assert {r.doc_id: r.ids for r in queries.p8_ids(spark, small).collect()} == want


def test_counts_equal_lengths(spark):
    df = documents(spark, TEXTS)
    n = {r.doc_id: r.n for r in tokens.count_tokens(df, F.col("text"), "n").collect()}
    assert n == {r.doc_id: len(r.ids) for r in tokens.encode_corpus(df, F.col("doc_id"), F.col("text")).collect()}


def sizes(spark, per_source):
    rows = [(f"{s}{i}", s, n) for s, ns in per_source.items() for i, n in enumerate(ns)]
    return spark.createDataFrame(rows, "doc_id string, source string, n_tokens int")


WEIGHTS = "source string, target_weight double, max_repeats int"


def test_rates_meet_shares_and_caps(spark):
    s = sizes(spark, {"a": [100] * 40, "b": [10] * 30, "c": [0, 0], None: [5]})
    w = spark.createDataFrame([("a", 2.0, 1), ("b", 2.0, 3), ("c", 1.0, 9), ("none", 5.0, 1), ("b2", None, 1), ("z", -1.0, 1)], WEIGHTS)
    r = {x.source: x for x in mixing.repetition_rates(s, w).collect()}
    assert set(r) == {"a", "b"} and r["b"].rate == 3.0 and r["a"].rate == pytest.approx(900 / 4000)
    assert r["a"].target_share == r["b"].target_share == 0.5
    big = {x.source: x.rate for x in mixing.repetition_rates(s, w, total_tokens=100_000).collect()}
    assert big == {"a": 1.0, "b": 3.0}


def test_mix_is_floor_plus_draw(spark):
    s = sizes(spark, {"a": [10] * 4000, "b": [10] * 100})
    rates = spark.createDataFrame([("a", 1.25, 2), ("b", 3.0, 3)], "source string, rate double, max_repeats int")
    made = mixing.mix(s.withColumn("copies", F.lit(1)), "doc_id", "source", rates, seed=3)
    n = {r.source: r["n"] for r in made.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert n["b"] == 300 and abs(n["a"] - 5000) < 120
    per = made.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.max("copy_no").alias("m"))
    assert per.where("n <> m").count() == 0 and {r.n for r in per.where("source = 'a'").select("n").distinct().collect()} == {1, 2}
    assert per.where("source = 'a'").count() == 4000
    again = mixing.mix(s.repartition(7), "doc_id", "source", rates, seed=3)
    assert again.select("doc_id", "copy_no").exceptAll(made.select("doc_id", "copy_no")).count() == 0


def test_shares_of_the_documents(spark, small):
    got = queries.p9_shares(spark, small).collect()
    assert got and all(r.most_repeats is None or r.most_repeats <= r.max_repeats for r in got)
    assert sum(r.actual_share or 0 for r in got) == pytest.approx(1.0)
    assert sum(r.target_share for r in got) == pytest.approx(1.0)


def test_shares_at_a_given_total(spark, small):
    s = sizes(spark, {"a": [100] * 4000, "b": [10] * 30, "c": [50] * 2000})
    w = spark.createDataFrame([("a", 2.0, 1), ("b", 1.0, 3), ("c", 1.0, 2)], WEIGHTS)
    got = {r.source: r for r in mixing.actual_shares(s, mixing.repetition_rates(s, w, total_tokens=400_000)).collect()}
    assert got["b"].mixed_tokens == 900 and got["b"].most_repeats == 3  # falls short of 100,000
    assert got["a"].mixed_tokens == pytest.approx(200_000, rel=0.05) and got["c"].mixed_tokens == pytest.approx(100_000, rel=0.05)
    assert sum(r.actual_share for r in got.values()) == pytest.approx(1.0)
    rows = queries.p9_shortfalls(spark, small).collect()
    assert any(r.rate == r.max_repeats and (r.actual_share or 0) < r.target_share for r in rows)


def test_empty_mix(spark):
    s = sizes(spark, {"a": [1]})
    w = spark.createDataFrame([("a", 1.0, 1)], WEIGHTS)
    assert mixing.repetition_rates(s.limit(0), w).count() == 0
    assert mixing.mix(s, "doc_id", "source", mixing.repetition_rates(s, w.limit(0))).count() == 0


@pytest.fixture(scope="module")
def reader(spark, small):
    return lookalikes.fit_reader(table(spark, small, "documents"), F.col("text"))


ALIKE = [
    ("Council vote", "Ｃｏｕｎｃｉｌ　ｖｏｔｅ"), ("office", "oﬃce"), ("café", "café"), ("a b", "a b"), ("a b", "a　b"), ("election", "elec​tion"), ("election", "e­lection﻿"),
    ("scope", "ѕсоре"), ("HOME", "НОМЕ"), ("a-b", "a‑b"), ("a-b", "a‐b"), ("x; y", "x; y"), ("K", "K"), ("ё", "ë"), ("line\nend", "line\r\nend"), ("bell", "b\x07ell"), ("ælf", "ӕlf"), ("ə", "ә"), ("noon", "ոooո"), ("a|b", "aǀb"), ("a:b", "a꞉b"), ("a·b", "a⋅b"), ("vote", "vοtе"), ("alarm", "αlαrm"), ("한", "한"),
]
DIFFERENT = [("Vote", "vote"), ("café", "cafe"), ("O", "0"), ("l", "1"), ("a b", "a  b"), ("rn", "m"), ("\U0001f469‍\U0001f3eb", "\U0001f469\U0001f3eb"), ("a-b", "a—b"), ("п", "n"), ("I", "l")]


@pytest.mark.parametrize("a, b", ALIKE)
def test_alike(reader, a, b):
    assert reader.canonical(a) == reader.canonical(b)


@pytest.mark.parametrize("a, b", DIFFERENT)
def test_different(reader, a, b):
    assert reader.canonical(a) != reader.canonical(b)


def test_canonical_form_is_stable_and_readable(reader, spark, small):
    texts = [r.text for r in table(spark, small, "documents").select("text").collect() if r.text]
    for t in texts:
        c = reader.canonical(t)
        assert reader.canonical(c) == c
    assert reader.canonical("Тhе сlеrk") == "The clerk"
    assert reader.canonical("Coвет oдoбpил пpoeкт") == "Совет одобрил проект"


def test_viterbi_takes_the_best_path(reader):
    from itertools import product

    for token in ("scope", "pace", "hope", "xoc"):
        looks = token.translate(lookalikes._LOOK_OF)
        best = max(product(*[lookalikes._READINGS.get(c, c) for c in looks]), key=lambda path: sum(reader._score(a, b) for a, b in zip(["", *path], path)))
        score = lambda path: sum(reader._score(a, b) for a, b in zip(["", *path], path))
        assert score(reader.read(looks, "")) == pytest.approx(score(best))


def test_pairs_against_brute_force(spark, reader):
    classes = lambda x: lookalikes.text_classes(lookalikes.canonical_texts(documents(spark, x), F.col("doc_id"), F.col("text"), reader))
    texts = ["scope", "sсоре", "scope", "Scope", None, "", "​", " ​ ", " ", "ｓｃｏｐｅ", "x" * 9000, "х" * 9000]
    got = {(r.id_1, r.id_2) for r in lookalikes.alike_pairs(classes(texts)).collect()}
    form = [unicodedata.normalize("NFC", reader.canonical(t)) if t else "" for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if texts[i] != texts[j] and form[i] == form[j] and form[i].strip()}
    assert got == want == {(0, 1), (0, 9), (1, 2), (1, 9), (2, 9), (10, 11)}
    assert lookalikes.alike_pairs(classes([])).count() == 0
    member = {r.doc_id: (r.form, r.text_no, r.n_texts, r.n_docs) for r in lookalikes.alike_members(classes(texts)).collect()}
    assert {(i, j) for i in member for j in member if i < j and member[i][0] == member[j][0] and member[i][1] != member[j][1]} == want
    assert member[0][2:] == (3, 4) and member[10][2:] == (2, 2)
