"""The pN_ queries of the problems tagged llm, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.llm import components, lookalikes, matching, mixing, tokens, variants
from quorum.session import cut, table

# ---- problem 1: matching entities across sources without keys


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return matching.found(*matching.match_across_sources(table(spark, d, "dummy_data_elected"))).select("id_1", "id_2")


def p1_confidence(spark: SparkSession, d: str) -> DataFrame:
    """The matched pairs with their posteriors."""
    return matching.found(*matching.match_across_sources(table(spark, d, "dummy_data_elected")))


def p1_members(spark: SparkSession, d: str) -> DataFrame:
    """One row per record, with its class and how many classes of other sources it matches."""
    return matching.members_of(*matching.match_across_sources(table(spark, d, "dummy_data_elected")))


# ---- problem 2: variant spellings of names typed by people


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.pairs_of(*variants.same_person(table(spark, d, "dummy_data")))


def p2_persons(spark: SparkSession, d: str) -> DataFrame:
    """One row per record with a surname, with its person."""
    return variants.persons_of(*variants.same_person(table(spark, d, "dummy_data")))


# ---- problem 4: consolidating pairwise matches into groups


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    lists = table(spark, d, "election_stage_input").select(F.col("unique_id").alias("id"), F.explode(F.from_json("matched_candidacy_stage_clusters", "array<string>")).alias("label"))
    members = lists.select("id", F.nullif(F.lower(F.btrim("label", F.lit(" \t\r\n"))), F.lit("")).alias("label"))
    return components.connected_groups(members).select(F.col("id").alias("unique_id"), "group_id")


P4_FOUND_SQL = r"""
WITH RECURSIVE m AS (SELECT DISTINCT unique_id u, lower(trim(l, E' \t\r\n')) l
  FROM (SELECT unique_id, unnest(from_json(matched_candidacy_stage_clusters, '["VARCHAR"]')) l FROM election_stage_input WHERE json_valid(matched_candidacy_stage_clusters))
  WHERE l IS NOT NULL AND trim(l, E' \t\r\n') <> ''),
hub AS (SELECT l, min(u) h FROM m GROUP BY l),
e AS (SELECT DISTINCT u a, h b FROM m JOIN hub USING (l) WHERE u <> h),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
walk AS (SELECT a v, a r FROM (SELECT a FROM both_ways UNION SELECT b FROM both_ways) UNION SELECT b, r FROM walk JOIN both_ways ON v = a WHERE b > r)
SELECT v AS unique_id, min(r) AS group_id FROM walk GROUP BY v
"""


# ---- problem 8: encoding of the whole corpus with a public tokenizer


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"), F.col("doc_id"), F.col("text"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    return tokens.decode_corpus(p8_ids(spark, d))


P8_DECODED_SQL = "SELECT doc_id, coalesce(text, '') AS text FROM documents"


# ---- problem 9: mixing sources to target weights


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return tokens.count_tokens(docs.select("doc_id", "source", "text"), F.col("text")).select("doc_id", "source", "n_tokens")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    rates = cut(mixing.repetition_rates(_sizes(spark, d), table(spark, d, "source_weights")))
    return mixing.mix(table(spark, d, "documents"), "doc_id", "source", rates).select("doc_id", "copy_no", "source", "text")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes = cut(_sizes(spark, d))
    rates = cut(mixing.repetition_rates(sizes, table(spark, d, "source_weights")))
    return mixing.actual_shares(sizes, rates)


def p9_shortfalls(spark: SparkSession, d: str) -> DataFrame:
    """The shares of a mix as large as the weighted sources are: small sources are used max_repeats times and fall short."""
    sizes, weights = cut(_sizes(spark, d)), table(spark, d, "source_weights")
    total = sizes.join(weights.where("target_weight > 0").select("source").distinct(), "source", "left_semi").agg(F.sum(F.col("n_tokens").cast("bigint"))).first()[0]
    return mixing.actual_shares(sizes, cut(mixing.repetition_rates(sizes, weights, total or 0)))


# ---- problem 10: visually identical text with different characters


def _canonical(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return lookalikes.canonical_texts(docs, F.col("doc_id"), F.col("text"), lookalikes.fit_reader(docs, F.col("text")))


def _text_classes(spark: SparkSession, d: str) -> DataFrame:
    return cut(lookalikes.text_classes(_canonical(spark, d)))  # the corpus is read in looks once


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.alike_pairs(_text_classes(spark, d))


def p10_members(spark: SparkSession, d: str) -> DataFrame:
    """One row per document that looks like a different text, with its class."""
    return lookalikes.alike_members(_text_classes(spark, d))


def p10_canonical(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d).select("doc_id", F.col("canonical").alias("text"))


def queries() -> dict:
    return {"p1_found": p1_found, "p1_confidence": p1_confidence, "p1_members": p1_members, "p2_found": p2_found, "p2_persons": p2_persons, "p4_found": p4_found, "p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_mix": p9_mix, "p9_shares": p9_shares, "p9_shortfalls": p9_shortfalls, "p10_found": p10_found, "p10_members": p10_members, "p10_canonical": p10_canonical}


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4_FOUND_SQL, "p8_decoded": P8_DECODED_SQL}
