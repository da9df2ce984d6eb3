"""Matching entities across sources without keys.

Candidate pairs of different sources get a vector of similarities; two Gaussians with regularised covariances
separate matched from unmatched vectors without labels. Between the steps of expectation-maximisation,
transitivity is enforced: if a matches b and b matches c, then a matches c, or one of the two legs is wrong.
Vectors are rounded, so the mixture is fitted on the counts of at most some thousand patterns, whatever the
number of pairs; the constraints are joins of the pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.llm import names, variants
from quorum.session import cut

FEATURES = ["s_name", "s_given", "s_office", "s_seat", "s_contact"]
# Similarity of given names by level, and what an unknown part counts.
GIVEN = {3: 1.0, 2: 0.95, 1: 0.75, 0: 0.0}
UNKNOWN = 0.7
#: added to the variances; share by which covariances shrink to their diagonal
RIDGE, SHRINK = 0.02, 0.2
MATCHED = 0.5
#: steps end when no posterior moves by more than this, or, should they swing, after so many
STILL, MOST_PLAIN, MOST_CONSTRAINED = 1e-3, 200, 3
#: legs below this cannot break transitivity; a third side below VETO lowers a leg instead of being raised
LEG, VETO = 0.3, 0.05
COMPARED = ["body", "seat", *variants.GIVEN, "email", "phone"]


class Mixture:
    """Weights, means and covariances of two Gaussians: 1 matched, 0 unmatched."""

    def __init__(self, x: np.ndarray, n: np.ndarray, gamma: np.ndarray) -> None:
        self.weight, self.mean, self.cov = [], [], []
        for g in (1 - gamma, gamma):
            w = n * g
            total = max(w.sum(), 1e-9)
            m = (w[:, None] * x).sum(axis=0) / total
            d = x - m
            c = (w[:, None] * d).T @ d / total
            c = (1 - SHRINK) * c + SHRINK * np.diag(np.diag(c)) + RIDGE * np.eye(x.shape[1])
            self.weight.append(max(w.sum() / max(n.sum(), 1e-9), 1e-6))
            self.mean.append(m)
            self.cov.append(c)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        logs = []
        for w, m, c in zip(self.weight, self.mean, self.cov):
            d = x - m
            logs.append(np.log(w) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,ij->i", d @ np.linalg.inv(c), d))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))


def _classes(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: unique_id, cls; classes): rows alike in every compared part are one class."""
    common = cut(variants.placeholders(parts))
    own = parts.where(F.col("surname") != "")
    for c in ("email", "phone"):
        own = own.join(common.select(F.col("contact").alias(f"_{c}")), F.col(c) == F.col(f"_{c}"), "left").withColumn(c, F.when(F.col(f"_{c}").isNull(), F.col(c))).drop(f"_{c}")
    cols = ["source_name", "state", "place", "body", "seat", "surname", "surname_parts", *variants.GIVEN, "email", "phone"]
    member = cut(own.withColumn("cls", variants.digest(*cols)))
    return member.select("unique_id", "cls"), cut(member.groupBy("cls").agg(*[F.first(c).alias(c) for c in cols]))


def _compare(a: str, b: str, unknown: Column) -> Column:
    x, y = F.col(a), F.col(b)
    return F.when(unknown, UNKNOWN).when(x == y, 1.0).otherwise(0.0)


def _rest_of_vector() -> list[Column]:
    """The similarities besides the surname's, of columns a_... and b_..."""
    shared = (F.col("a_email") == F.col("b_email")) | (F.col("a_phone") == F.col("b_phone"))
    apart = (F.col("a_email") != F.col("b_email")) | (F.col("a_phone") != F.col("b_phone"))
    level, given = variants.given_level("a", "b"), F.lit(0.0)
    for k, v in GIVEN.items():
        given = F.when(level == k, v).otherwise(given)
    return [
        given.alias("s_given"),
        _compare("a_body", "b_body", (F.col("a_body") == "") | (F.col("b_body") == "")).alias("s_office"),
        _compare("a_seat", "b_seat", (F.col("a_seat") == "") | (F.col("b_seat") == "")).alias("s_seat"),
        F.when(F.coalesce(shared, F.lit(False)), 1.0).when(F.coalesce(apart, F.lit(False)), 0.0).otherwise(UNKNOWN).alias("s_contact"),
    ]


def candidate_pairs(cls: DataFrame, relations: DataFrame) -> DataFrame:
    """a_cls, b_cls, a_source, b_source and the similarities of all classes of different sources in one place with surnames within two edits."""
    keys = cls.select(F.concat_ws("|", "state", "place").alias("grp"), F.explode(variants.surname_keys("surname", "surname_parts")).alias("k"))
    near = cut(variants.near_and_equal(keys.select("grp", F.col("k.key").alias("name"))))
    cols = ["cls", "source_name", *COMPARED]

    def side(s: str) -> DataFrame:
        keyed = cls.withColumn("k", F.explode(variants.surname_keys("surname", "surname_parts")))
        return keyed.select(F.concat_ws("|", "state", "place").alias(f"{s}_grp"), F.col("k.key").alias(f"{s}_key"), F.col("k.full").alias(f"{s}_full"), *[F.col(c).alias(f"{s}_{c}") for c in cols])

    a, b = side("a"), side("b")
    once = (F.col("distance") > 0) | (F.col("a_cls") < F.col("b_cls"))  # equal names meet once
    fit = (F.col("a_source_name") != F.col("b_source_name")) & (F.col("a_full") | F.col("b_full")) & once
    met = near.join(a, (F.col("grp") == F.col("a_grp")) & (F.col("name_a") == F.col("a_key"))).join(b, (F.col("grp") == F.col("b_grp")) & (F.col("name_b") == F.col("b_key")) & fit)
    swap = F.col("a_cls") > F.col("b_cls")
    pick = lambda c: [F.when(swap, F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).alias(f"a_{c}"), F.when(swap, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(f"b_{c}")]
    edits = F.when(variants.transposed(F.col("a_key"), F.col("b_key")), 1).otherwise(F.col("distance"))
    scored = met.select(
        *pick("cls"), *pick("source_name"),
        F.round(1 - edits / F.greatest(F.length("a_key"), F.length("b_key"), F.lit(1)) - F.when(F.col("a_full") & F.col("b_full"), 0.0).otherwise(0.05), 2).alias("s_name"),
        *_rest_of_vector(),
    )
    best = F.max_by(F.struct(*FEATURES), F.col("s_name")).alias("f")
    pairs = cut(scored.groupBy("a_cls", "b_cls", "a_source_name", "b_source_name").agg(best).select("a_cls", "b_cls", "a_source_name", "b_source_name", "f.*"))
    rest = variants.related_rest(pairs.where("s_given = 0"), cls, relations).withColumn("_known", F.lit(GIVEN[2]))
    return pairs.join(rest, ["a_cls", "b_cls"], "left").withColumn("s_given", F.coalesce("_known", "s_given")).drop("_known")


def _wedges(legs: DataFrame) -> DataFrame:
    """mid, x < z, their sources and gammas: two legs that meet, with ends of different sources."""
    ends = legs.select(F.col("a_cls").alias("mid"), F.col("b_cls").alias("end"), F.col("b_source_name").alias("src"), "gamma").unionByName(legs.select(F.col("b_cls").alias("mid"), F.col("a_cls").alias("end"), F.col("a_source_name").alias("src"), "gamma"))
    l, r = ends.toDF("mid", "x", "x_src", "g1"), ends.toDF("mid2", "z", "z_src", "g2")
    return l.join(r, (F.col("mid") == F.col("mid2")) & (F.col("x") < F.col("z")) & (F.col("x_src") != F.col("z_src"))).drop("mid2")


def _implied(pairs: DataFrame, cls: DataFrame) -> DataFrame:
    """Pairs that transitivity implies but that were no candidates (surnames misspelled on both sides), with their similarities."""
    known = pairs.select(F.col("a_cls").alias("x"), F.col("b_cls").alias("z"))
    new = _wedges(pairs.where(F.col("gamma") > LEG)).join(known, ["x", "z"], "left_anti").select(F.col("x").alias("a_cls"), F.col("z").alias("b_cls")).distinct()
    a, b = (cls.select(*[F.col(c).alias(f"{s}_{c}") for c in ("cls", "source_name", "surname", *COMPARED)]) for s in "ab")
    edits = F.when(variants.transposed(F.col("a_surname"), F.col("b_surname")), 1).otherwise(F.levenshtein("a_surname", "b_surname"))
    near = F.round(1 - edits / F.greatest(F.length("a_surname"), F.length("b_surname"), F.lit(1)), 2)
    return new.join(a, "a_cls").join(b, "b_cls").select("a_cls", "b_cls", "a_source_name", "b_source_name", near.alias("s_name"), *_rest_of_vector())


def _transitive(pairs: DataFrame) -> DataFrame:
    """pairs (a_cls, b_cls, sources, gamma, ...) with gamma changed as little as makes every triangle consistent once."""
    wedges = _wedges(pairs.where(F.col("gamma") > LEG))
    third = pairs.select(F.col("a_cls").alias("x"), F.col("b_cls").alias("z"), F.col("gamma").alias("g3"))
    broken = cut(wedges.join(third, ["x", "z"]).where(F.col("g1") * F.col("g2") > F.col("g3") + 1e-6))
    raised = broken.where(F.col("g3") >= VETO).groupBy(F.col("x").alias("a_cls"), F.col("z").alias("b_cls")).agg(F.max(F.col("g1") * F.col("g2")).alias("up"))
    weak = F.when(F.col("g1") < F.col("g2"), F.col("x")).otherwise(F.col("z"))
    down = broken.where((F.col("g3") < VETO) & (F.col("g1") != F.col("g2"))).select(F.least("mid", weak).alias("a_cls"), F.greatest("mid", weak).alias("b_cls"), (F.col("g3") / F.greatest("g1", "g2")).alias("down")).groupBy("a_cls", "b_cls").agg(F.min("down").alias("down"))
    joined = pairs.join(raised, ["a_cls", "b_cls"], "left").join(down, ["a_cls", "b_cls"], "left")
    return joined.withColumn("gamma", F.least(F.greatest("gamma", "up"), F.col("down"))).drop("up", "down")


class _Patterns:
    """The distinct vectors, how many pairs have each, and their posteriors. Similarities are rounded, so their number is bounded by the levels."""

    def __init__(self, pairs: DataFrame) -> None:
        rows = pairs.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(FEATURES).reset_index(drop=True)
        self.rows, self.x, self.n = rows[FEATURES], rows[FEATURES].to_numpy(float), rows["n"].to_numpy(float)
        # constraint within the pair: a contradicting given name, office or seat cannot be a match
        self.free = (self.x[:, 1:4].min(axis=1, initial=1.0) > 0).astype(float)

    def step(self, gamma: np.ndarray) -> np.ndarray:
        return Mixture(self.x, self.n, gamma).posterior(self.x) * self.free

    def with_gamma(self, pairs: DataFrame, gamma: np.ndarray) -> DataFrame:
        table = pairs.sparkSession.createDataFrame(self.rows.assign(gamma=gamma))
        return pairs.join(F.broadcast(table), FEATURES)  # patterns, not pairs

    def averaged(self, held: DataFrame) -> np.ndarray:
        return held.groupBy(*FEATURES).agg(F.avg("gamma").alias("g")).toPandas().sort_values(FEATURES)["g"].to_numpy(float)


def match_across_sources(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: unique_id, cls; pairs: a_cls, b_cls, similarities, confidence).

    Rows alike in every compared part are one class, so copies are compared once. Null names give no pair;
    repeated unique_ids count once; an empty table gives empty results. confidence is the posterior of the
    last step under the constraints; pairs that transitivity implies take part in the constrained steps.
    """
    parts = cut(variants.snapped_places(cut(names.parts_of_records(records, names.learn_vocabulary(records)))))
    member, cls = _classes(parts)
    pairs = cut(candidate_pairs(cls, cut(names.rare_relations(records))))
    seen = _Patterns(pairs)
    if not len(seen.n):
        return member, pairs.select("a_cls", "b_cls", *FEATURES, F.lit(None).cast("double").alias("confidence"))
    gamma = (seen.x.min(axis=1) >= UNKNOWN).astype(float)  # start: nothing disagrees
    for _ in range(MOST_PLAIN):
        before, gamma = gamma, seen.step(gamma)
        if np.abs(gamma - before).max() < STILL:
            break
    implied = _implied(seen.with_gamma(pairs, gamma), cls)
    mixture, pairs = Mixture(seen.x, seen.n, gamma), cut(pairs.unionByName(implied))
    seen = _Patterns(pairs)
    gamma = mixture.posterior(seen.x) * seen.free
    for _ in range(MOST_CONSTRAINED):
        before, gamma = gamma, seen.step(seen.averaged(_transitive(seen.with_gamma(pairs, gamma))))
        if np.abs(gamma - before).max() < STILL:
            break
    held = _transitive(seen.with_gamma(pairs, gamma)).withColumnRenamed("gamma", "confidence")
    return member, cut(held).select("a_cls", "b_cls", *FEATURES, "confidence")


def found(member: DataFrame, pairs: DataFrame, threshold: float = MATCHED) -> DataFrame:
    """id_1 < id_2 and confidence of the records of matched classes."""
    sure = pairs.where(F.col("confidence") >= threshold)
    a, b = member.select(F.col("unique_id").alias("x"), F.col("cls").alias("a_cls")), member.select(F.col("unique_id").alias("y"), F.col("cls").alias("b_cls"))
    return sure.join(a, "a_cls").join(b, "b_cls").select(F.least("x", "y").alias("id_1"), F.greatest("x", "y").alias("id_2"), "confidence")


def members_of(member: DataFrame, pairs: DataFrame, threshold: float = MATCHED) -> DataFrame:
    """unique_id, cls, n_classes, confidence: one row per record, with its class and the matched classes of other sources; the best confidence, null without."""
    sure = pairs.where(F.col("confidence") >= threshold)
    ends = sure.select(F.col("a_cls").alias("cls"), "confidence").unionByName(sure.select(F.col("b_cls").alias("cls"), "confidence"))
    per = ends.groupBy("cls").agg(F.count(F.lit(1)).alias("n_classes"), F.max("confidence").alias("confidence"))
    return member.join(per, "cls", "left").select("unique_id", "cls", F.coalesce("n_classes", F.lit(0)).alias("n_classes"), "confidence")
