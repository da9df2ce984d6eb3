"""Projection, predicates, joins and set operations: the relational vocabulary, one query each.

Where both dialects read the same text, one SQL text states the query; Spark reads it with the tables bound as
DataFrames. The others are DataFrame plans with the SQL beside them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.functions import text
from quorum.operators import incremental, joins, quality, reshape, windows
from quorum.session import table
from quorum.sources import enrich, files

SAME_TEXT: dict[str, str] = {
    "scan_project": """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS net, l_returnflag AS flag
        FROM {lineitem} WHERE l_shipdate < TIMESTAMP '1996-01-01 00:00:00'""",
    "lateral_alias": """SELECT o_orderkey, o_totalprice AS price, round(price * 0.07, 6) AS tax, round(price + tax, 6) AS gross FROM {orders}""",
    "case_bucket": """SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN 'small' WHEN o_totalprice < 100000 THEN 'medium' ELSE 'large' END AS size,
        CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS status_rank FROM {orders}""",
    "filter_range": """SELECT o_orderkey, o_custkey FROM {orders} WHERE o_totalprice BETWEEN 1000 AND 50000 AND o_orderstatus IN ('O', 'P')
        AND o_orderdate >= TIMESTAMP '1994-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'""",
    "semi_join_in": """SELECT c_custkey, c_name FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'P')""",
    "anti_join_not_in": """SELECT c_custkey, c_mktsegment FROM {customer} WHERE c_custkey NOT IN (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)""",
    "anti_join_not_exists": """SELECT c_custkey, c_name FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 200000)""",
    "scalar_subquery": """SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderdate > (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01 00:00:00') FROM {orders} WHERE o_orderstatus = 'F')""",
    "values_params_join": """SELECT o_orderkey, p.scale, round(o_totalprice * p.scale, 6) AS scaled FROM {orders}
        LEFT JOIN (VALUES ('F', 0.5D), ('O', 2.0D)) AS p(status, scale) ON p.status = o_orderstatus""".replace("0.5D", "CAST(0.5 AS DOUBLE)").replace("2.0D", "CAST(2.0 AS DOUBLE)"),
    "join_inner": """SELECT o_orderkey, c_mktsegment, n_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "join_left": """SELECT c_custkey, count(o_orderkey) AS n_orders, coalesce(round(sum(o_totalprice), 2), 0) AS spent FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey""",
    "join_using": """SELECT o_orderkey, n_lines, o_orderstatus FROM {orders} JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n_lines FROM {lineitem} GROUP BY l_orderkey) AS l USING (o_orderkey)""",
    "self_join": """SELECT a.s_suppkey AS supplier_1, b.s_suppkey AS supplier_2, a.s_nationkey AS nation FROM {supplier} AS a JOIN {supplier} AS b
        ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey WHERE abs(a.s_acctbal - b.s_acctbal) < 500""",
    "cross_scalar": """SELECT o_orderkey, round(o_totalprice / top, 6) AS share_of_top FROM {orders} CROSS JOIN (SELECT max(o_totalprice) AS top FROM {orders}) AS m""",
    "lateral_project": """SELECT p_partkey, x.per_unit, x.is_large FROM {part}, LATERAL (SELECT round(p_retailprice / p_size, 4) AS per_unit, p_size > 25 AS is_large) AS x""",
    "anti_join": """SELECT p_partkey, p_name FROM {part} LEFT JOIN (SELECT DISTINCT l_partkey FROM {lineitem} WHERE l_quantity > 45) AS l ON l_partkey = p_partkey WHERE l_partkey IS NULL""",
    "guarded_join": """SELECT c_custkey, coalesce(n.n_name, r.r_name, 'unknown') AS place FROM {customer} LEFT JOIN {nation} AS n ON n.n_nationkey = c_nationkey AND c_acctbal >= 0
        LEFT JOIN {region} AS r ON r.r_regionkey = c_nationkey % 5 AND c_acctbal < 0""",
    "distinct_rows": """SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_quantity AS INT) AS quantity FROM {lineitem}""",
    "union_all": """SELECT c_custkey AS key, c_name AS name, 'customer' AS kind FROM {customer} UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM {supplier}""",
    "union_distinct": """SELECT c_nationkey AS nation FROM {customer} UNION SELECT s_nationkey FROM {supplier}""",
    "set_difference": """(SELECT o_custkey AS custkey FROM {orders} WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F') EXCEPT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'P'""",
    "having": """SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS spent FROM {orders} GROUP BY o_custkey HAVING count(*) >= 12 AND max(o_totalprice) > 100000""",
    "grouping_sets": """SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS INT) AS all_statuses, CAST(grouping(o_orderpriority) AS INT) AS all_priorities, count(*) AS n
        FROM {orders} GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
    "rollup_totals": """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "explode_array": """SELECT unique_id, count(*) AS n_labels FROM (SELECT unique_id, label FROM {election_stage_input} CROSS JOIN LATERAL_EXPLODE) AS x WHERE label IS NOT NULL GROUP BY unique_id""",
}
ONLY_SPARK_TEXT = {"explode_array": ("CROSS JOIN LATERAL_EXPLODE", "LATERAL VIEW explode(from_json(matched_candidacy_stage_clusters, 'array<string>')) e AS label")}
ONLY_DUCK_TEXT = {"explode_array": ("CROSS JOIN LATERAL_EXPLODE", ", unnest(from_json(matched_candidacy_stage_clusters, '[\"VARCHAR\"]')) AS e(label)")}


def _from_text(sql: str):
    names = sorted(set(re.findall(r"\{(\w+)\}", sql)))
    return lambda spark, d: spark.sql(sql, **{n: table(spark, d, n) for n in names})


def latest_per_group(spark: SparkSession, d: str) -> DataFrame:
    """The latest file of each state and file type in the load log."""
    got = files.latest_files(table(spark, d, "load__l2_s3_to_databricks"), ["state_id"], "source_file_name", "loaded_at")
    return got.select("state_id", "file_type", "source_file_name", "loaded_at")


LATEST_PER_GROUP = r"""SELECT state_id, file_type, source_file_name, loaded_at FROM (
  SELECT *, CASE WHEN source_file_name LIKE '%VOTEHISTORY.tab' THEN 'vote_history' WHEN source_file_name LIKE '%DEMOGRAPHIC.tab' THEN 'demographic'
    WHEN source_file_name LIKE '%VOTEHISTORY_DataDictionary.csv' THEN 'vote_history_data_dictionary' WHEN source_file_name LIKE '%DEMOGRAPHIC_DataDictionary.csv' THEN 'demographic_data_dictionary'
    WHEN source_file_name LIKE 'VM2Uniform%.tab' THEN 'uniform' WHEN source_file_name LIKE 'VM2Uniform%DataDictionary.csv' THEN 'uniform_data_dictionary' END AS file_type
  FROM load__l2_s3_to_databricks) WHERE file_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY state_id, file_type ORDER BY loaded_at DESC, source_file_name) = 1"""


def _service(keys: list) -> dict:
    """A stand-in for a remote service that knows even keys."""
    return {k: (k * 10, f"entry {k}") for k in keys if k % 2 == 0}


def pandas_udf_struct(spark: SparkSession, d: str) -> DataFrame:
    return enrich.enrich(table(spark, d, "orders"), "o_custkey", "remote_id bigint, remote_name string", _service)


def to_json_struct(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("orderKey"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("state"))).alias("doc"))


def _updates(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = o.where("o_orderstatus <> 'P'")
    return target, o.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 6))


def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    target, updates = _updates(spark, d)
    return incremental.upsert(target, updates, ["o_orderkey"], deleted=F.col("o_orderstatus") == "F")


UPSERT_MERGE = """WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
u AS (SELECT o_orderkey, o_orderstatus, round(o_totalprice * 2, 6) AS o_totalprice FROM orders WHERE o_orderkey % 5 = 0)
SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u) UNION ALL SELECT * FROM u WHERE o_orderstatus <> 'F'"""


def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    target, _ = _updates(spark, d)
    return quality.publish_gate(table(spark, d, "orders"), target, "o_orderkey", 0.9, 100, 0.98, ["o_orderkey", "o_custkey"])


QUALITY_GATE = """WITH live AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
s AS (SELECT (SELECT count(*) FROM orders) AS n, (SELECT count(*) FROM live) AS o, (SELECT avg(CASE WHEN k IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) FROM (SELECT DISTINCT o_orderkey x FROM live) LEFT JOIN (SELECT DISTINCT o_orderkey k FROM orders) ON x = k) AS kept,
 (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS n1, (SELECT count(*) FROM orders WHERE o_custkey IS NULL) AS n2)
SELECT 'row_ratio' AS gate, n::DOUBLE / nullif(o, 0)::DOUBLE AS value, coalesce(n::DOUBLE / nullif(o, 0)::DOUBLE >= 0.9, true) AS passed FROM s
UNION ALL SELECT 'cold_start', n::DOUBLE, o > 0 OR n >= 100 FROM s UNION ALL SELECT 'key_overlap', kept, coalesce(kept >= 0.98, true) FROM s
UNION ALL SELECT 'null_o_orderkey', n1::DOUBLE, n1 = 0 FROM s UNION ALL SELECT 'null_o_custkey', n2::DOUBLE, n2 = 0 FROM s"""


def star_except(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").drop("p_retailprice", "p_type")


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def multi_col_avg(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(*[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in MEASURES])


MULTI_COL_AVG = f"SELECT l_returnflag, {', '.join(f'round(avg({c}), 6) AS avg_{c}' for c in MEASURES)} FROM lineitem GROUP BY 1"


def coalesce_precedence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dummy_data_elected").select("unique_id", F.coalesce("candidate_office", "office_type", F.lit("unknown")).alias("office"), F.coalesce("email", "phone").alias("contact")).distinct()


COALESCE_PRECEDENCE = "SELECT DISTINCT unique_id, coalesce(candidate_office, office_type, 'unknown') AS office, coalesce(email, phone) AS contact FROM dummy_data_elected"


def _providers(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Three providers' views of the customers, each with gaps."""
    c = table(spark, d, "customer")
    spent = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.round(F.max("o_totalprice"), 2).alias("top"))
    return {
        "br": c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment")),
        "ts": c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("custkey"), F.upper("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        "ddhq": spent.where("custkey % 5 <> 0"),
    }


def provider_merge(spark: SparkSession, d: str) -> DataFrame:
    return joins.merge_providers(_providers(spark, d), "custkey", {"name": ["ts", "br"], "segment": ["br", "ts"], "top": ["ddhq"]}).withColumn("sources", F.array_join("sources", "+"))


_PROVIDERS = """WITH br AS (SELECT c_custkey k, c_name name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END segment FROM customer WHERE c_custkey % 2 = 0),
ts AS (SELECT c_custkey k, upper(c_name) name, c_mktsegment segment FROM customer WHERE c_custkey % 3 = 0),
ddhq AS (SELECT o_custkey k, round(max(o_totalprice), 2) top FROM orders WHERE o_custkey % 5 <> 0 GROUP BY 1)"""
PROVIDER_MERGE = (
    _PROVIDERS
    + """ SELECT coalesce(br.k, ts.k, ddhq.k) AS custkey, coalesce(ts.name, br.name) AS name, coalesce(br.segment, ts.segment) AS segment, top,
concat_ws('+', CASE WHEN br.k IS NOT NULL THEN 'br' END, CASE WHEN ts.k IS NOT NULL THEN 'ts' END, CASE WHEN ddhq.k IS NOT NULL THEN 'ddhq' END) AS sources
FROM br FULL JOIN ts ON br.k = ts.k FULL JOIN ddhq ON coalesce(br.k, ts.k) = ddhq.k"""
)


def full_outer_merge(spark: SparkSession, d: str) -> DataFrame:
    merged = joins.merge_providers(_providers(spark, d), "custkey", {"top": ["ddhq"]})
    return merged.groupBy(F.size("sources").alias("n_sources"), F.col("top").isNull().alias("no_top")).agg(F.count(F.lit(1)).alias("n"))


FULL_OUTER_MERGE = (
    _PROVIDERS
    + """ SELECT (br.k IS NOT NULL)::INT + (ts.k IS NOT NULL)::INT + (ddhq.k IS NOT NULL)::INT AS n_sources, top IS NULL AS no_top, count(*) AS n
FROM br FULL JOIN ts ON br.k = ts.k FULL JOIN ddhq ON coalesce(br.k, ts.k) = ddhq.k GROUP BY 1, 2"""
)


def full_outer_fallback(spark: SparkSession, d: str) -> DataFrame:
    p = _providers(spark, d)
    a, b = p["br"].select("custkey", F.col("segment").alias("a")), p["ts"].select(F.col("custkey").alias("k"), F.col("segment").alias("b"))
    return a.join(b, F.col("custkey") == F.col("k"), "full").select(F.coalesce("custkey", "k").alias("custkey"), F.coalesce("a", "b").alias("segment"), F.when(F.col("a").isNotNull(), "a").otherwise("b").alias("origin"))


FULL_OUTER_FALLBACK = _PROVIDERS + " SELECT coalesce(br.k, ts.k) AS custkey, coalesce(br.segment, ts.segment) AS segment, CASE WHEN br.segment IS NOT NULL THEN 'a' ELSE 'b' END AS origin FROM br FULL JOIN ts ON br.k = ts.k"


def like_ilike_rlike(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents")
    any_of = F.col("text").ilike("%recount%") | F.col("text").ilike("%ballot%")
    return x.select("doc_id", F.col("text").like("%District%").alias("is_like"), any_of.alias("is_ilike"), F.col("text").rlike("[0-9]{4}-[0-9]{2}-[0-9]{2}").alias("has_date"))


LIKE_ILIKE_RLIKE = "SELECT doc_id, text LIKE '%District%' AS is_like, text ILIKE '%recount%' OR text ILIKE '%ballot%' AS is_ilike, regexp_matches(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS has_date FROM documents"


def null_safe_join(spark: SparkSession, d: str) -> DataFrame:
    """Documents per district and language, a null being a value: kinds of both tables that agree, and differ in state."""
    x = table(spark, d, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    y = table(spark, d, "documents").where(F.length("text") > 300).groupBy(F.col("lang").alias("lang2"), F.col("source").alias("source2")).agg(F.count(F.lit(1)).alias("n_long"))
    both = x.join(y, F.col("lang").eqNullSafe(F.col("lang2")) & F.col("source").eqNullSafe(F.col("source2")))
    return both.select("lang", "source", "n", "n_long", (~F.col("lang").eqNullSafe("en")).alias("not_en"))


NULL_SAFE_JOIN = """SELECT x.lang, x.source, x.n, y.n_long, x.lang IS DISTINCT FROM 'en' AS not_en FROM (SELECT lang, source, count(*) n FROM documents GROUP BY 1, 2) x
JOIN (SELECT lang, source, count(*) n_long FROM documents WHERE length(text) > 300 GROUP BY 1, 2) y ON x.lang IS NOT DISTINCT FROM y.lang AND x.source IS NOT DISTINCT FROM y.source"""


def point_in_time_join(spark: SparkSession, d: str) -> DataFrame:
    """Per user and anchor (first purchase), what happened strictly before it."""
    e = table(spark, d, "events").where(F.col("user_id").isNotNull())
    anchors = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("anchor"))
    aggs = [F.count(F.lit(1)).alias("n_before"), F.countDistinct("event_type").alias("n_types"), F.count_if(F.col("ts") >= F.col("__a") - F.expr("interval 7 days")).alias("n_last_week")]
    return joins.events_before(anchors, e, "user_id", "anchor", "ts", F.lit("2024-01-02").cast("timestamp"), aggs)


POINT_IN_TIME_JOIN = """WITH a AS (SELECT user_id, min(ts) anchor FROM events WHERE event_type = 'purchase' AND user_id IS NOT NULL GROUP BY 1),
g AS (SELECT a.user_id, count(*) n_before, count(DISTINCT event_type) n_types, count(*) FILTER (WHERE ts >= anchor - INTERVAL 7 DAY) n_last_week FROM a JOIN events e ON e.user_id = a.user_id AND ts < anchor AND ts >= TIMESTAMP '2024-01-02' GROUP BY 1)
SELECT a.user_id, a.anchor, n_before, n_types, n_last_week FROM a LEFT JOIN g USING (user_id)"""


def _terms(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "dummy_data_elected").where("term_start_date IS NOT NULL").select("unique_id", "source_name", "state", "term_start_date").distinct()
    return e.where("source_name = 'gp_api'"), e.where("source_name = 'ballotready'")


def asof_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The term of another source in the state that starts nearest, within 10 days."""
    a, b = _terms(spark, d)
    b = b.withColumnRenamed("term_start_date", "starts")
    return joins.best_right(joins.nearest_within(a, b, "unique_id", "unique_id", ["state"], "term_start_date", "starts", 10))


_NEAREST = """WITH a AS (SELECT DISTINCT unique_id left_id, state, term_start_date x FROM dummy_data_elected WHERE source_name = 'gp_api' AND term_start_date IS NOT NULL),
b AS (SELECT DISTINCT unique_id right_id, state, term_start_date y FROM dummy_data_elected WHERE source_name = 'ballotready' AND term_start_date IS NOT NULL),
best AS (SELECT left_id, right_id, abs(date_diff('day', x, y))::INT AS diff FROM a JOIN b USING (state) WHERE abs(date_diff('day', x, y)) <= 10
  QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY abs(date_diff('day', x, y)), right_id) = 1)"""
ASOF_NEAREST = _NEAREST + " SELECT left_id, right_id, diff FROM best"


def two_pass_assignment(spark: SparkSession, d: str) -> DataFrame:
    a, b = _terms(spark, d)
    b = b.withColumnRenamed("term_start_date", "starts")
    return joins.one_to_one(joins.nearest_within(a, b, "unique_id", "unique_id", ["state"], "term_start_date", "starts", 10))


TWO_PASS_ASSIGNMENT = _NEAREST + " SELECT left_id, right_id, diff FROM best QUALIFY row_number() OVER (PARTITION BY right_id ORDER BY diff, left_id) = 1"


def interval_join(spark: SparkSession, d: str) -> DataFrame:
    """Whether a key's term covers the day of an order, and null where none does."""
    points = table(spark, d, "orders").select("o_orderkey", F.pmod("o_custkey", F.lit(50)).alias("k"), F.to_date("o_orderdate").alias("day"))
    spans = table(spark, d, "supplier").select(F.pmod("s_suppkey", F.lit(50)).alias("k"), F.date_add(F.lit("1993-01-01").cast("date"), (F.pmod("s_suppkey", F.lit(900))).cast("int")).alias("s"), F.when(F.col("s_acctbal") > 2000, F.date_add(F.lit("1995-01-01").cast("date"), F.pmod("s_suppkey", F.lit(300)).cast("int"))).alias("e"), (F.col("s_acctbal") > 5000).alias("v"))
    return joins.covered_on(points, spans, "k", "day", "s", "e", F.col("v")).select("o_orderkey", "k", "day", "covered")


INTERVAL_JOIN = """WITH p AS (SELECT o_orderkey, o_custkey % 50 AS k, o_orderdate::DATE AS day FROM orders),
s AS (SELECT s_suppkey % 50 AS k, (DATE '1993-01-01' + (s_suppkey % 900)::INT) AS s, CASE WHEN s_acctbal > 2000 THEN (DATE '1995-01-01' + (s_suppkey % 300)::INT) END AS e, s_acctbal > 5000 AS v FROM supplier),
c AS (SELECT p.k, day, bool_or(v) AS covered FROM (SELECT DISTINCT k, day FROM p) p JOIN s ON s.k = p.k AND s.s <= day AND (s.e IS NULL OR s.e >= day) GROUP BY 1, 2)
SELECT o_orderkey, p.k, p.day, covered FROM p LEFT JOIN c ON c.k = p.k AND c.day = p.day"""


def range_join(spark: SparkSession, d: str) -> DataFrame:
    """Customers in the balance bands of their nation."""
    bands = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", (F.col("s_acctbal") - 400).alias("low"), (F.col("s_acctbal") + 400).alias("high"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    return joins.in_range(c, bands, ["nation"], "c_acctbal", "low", "high", 400.0).select("c_custkey", "s_suppkey", "nation")


RANGE_JOIN = "SELECT c_custkey, s_suppkey, c_nationkey AS nation FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_acctbal BETWEEN s_acctbal - 400 AND s_acctbal + 400"


def multi_key_anti(spark: SparkSession, d: str) -> DataFrame:
    """Candidacy records whose e-mail, phone and source id all are unknown among the elected."""
    left = table(spark, d, "dummy_data").select("unique_id", "email", "phone", "source_id").distinct()
    return joins.anti_on_any(left, table(spark, d, "dummy_data_elected"), ["email", "phone", "source_id"]).select("unique_id")


MULTI_KEY_ANTI = """SELECT unique_id FROM (SELECT DISTINCT unique_id, email, phone, source_id FROM dummy_data) a WHERE NOT EXISTS (SELECT 1 FROM dummy_data_elected b WHERE b.email = a.email)
AND NOT EXISTS (SELECT 1 FROM dummy_data_elected b WHERE b.phone = a.phone) AND NOT EXISTS (SELECT 1 FROM dummy_data_elected b WHERE b.source_id = a.source_id)"""


def carve_union(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    per = lambda df, f: df.groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year")).agg(F.round(f("o_totalprice"), 2).alias("amount"))
    return joins.carve_union(per(o.where("o_orderstatus = 'O'"), F.max).withColumn("origin", F.lit("new")), per(o, F.sum).withColumn("origin", F.lit("old")), ["custkey", "year"])


CARVE_UNION = """WITH a AS (SELECT o_custkey custkey, year(o_orderdate)::INT AS year, round(max(o_totalprice), 2) amount, 'new' origin FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2),
b AS (SELECT o_custkey custkey, year(o_orderdate)::INT AS year, round(sum(o_totalprice), 2) amount, 'old' origin FROM orders GROUP BY 1, 2)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.custkey = b.custkey AND a.year = b.year)"""

RULES = [("BUILDING", None, "a"), ("BUILDING", 3, "b"), ("MACHINERY", None, "c"), ("AUTOMOBILE", 7, "d")]


def wildcard_join(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame([(*r, i) for i, r in enumerate(RULES)], "r_c_mktsegment string, r_c_nationkey int, r_label string, r_no int")
    facts = table(spark, d, "customer").select(F.col("c_custkey").alias("fact_id"), "c_mktsegment", "c_nationkey")
    return joins.wildcard_lookup(facts, F.broadcast(rules), ["c_mktsegment"], ["c_nationkey"], [F.col("r_no")]).select("fact_id", F.col("r_label").alias("label"))  # rules is a constant list


WILDCARD_JOIN = """WITH r(seg, nat, label, no) AS (VALUES ('BUILDING', NULL, 'a', 0), ('BUILDING', 3, 'b', 1), ('MACHINERY', NULL, 'c', 2), ('AUTOMOBILE', 7, 'd', 3))
SELECT c_custkey AS fact_id, label FROM customer LEFT JOIN r ON seg = c_mktsegment AND (nat IS NULL OR nat = c_nationkey)
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY (nat IS NOT NULL)::INT DESC, no) = 1"""


def normalized_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Districts and zip rows by type, state and normalized name."""
    a = table(spark, d, "district").select("state", "district_type", text.district_name(F.col("district_name")).alias("name"), "id").distinct()
    b = table(spark, d, "zip_code_to_l2_district").select(F.col("state_postal_code").alias("state"), "district_type", text.district_name(F.concat(F.lower("district_name"), F.lit("  (EST.)"))).alias("name"), "zip_code").distinct()
    return a.join(b, ["state", "district_type", "name"]).select("id", "zip_code").distinct()


NORMALIZED_KEY_JOIN = r"""SELECT DISTINCT id, zip_code FROM (SELECT state, district_type, upper(regexp_replace(trim(regexp_replace(district_name, '\s+', ' ', 'g')), '\s*\(EST\.\)$', '')) n, id FROM district) a
JOIN (SELECT state_postal_code s, district_type t, upper(trim(regexp_replace(district_name, '\s+', ' ', 'g'))) m, zip_code FROM zip_code_to_l2_district) b ON state = s AND district_type = t AND n = m"""


def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    return reshape.union_by_name([c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), s.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))])


UNION_BY_NAME = "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier"


def union_master_tail(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "ts", "event_type")
    return reshape.master_and_tail(e.where("event_type = 'signup'"), e.where("event_type = 'error'"), "ts")


UNION_MASTER_TAIL = """SELECT event_id, ts, event_type FROM events WHERE event_type = 'signup' UNION ALL
SELECT event_id, ts, event_type FROM events WHERE event_type = 'error' AND ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events WHERE event_type = 'signup')"""


def er_blocking(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of any two sources that agree on one of three rules, once each."""
    e = table(spark, d, "dummy_data_elected").select("unique_id", "source_name", "state", "last_name", "first_name", "email", "phone").distinct()
    rules = [[F.col("state"), F.lower("last_name")], [F.lower("email")], [F.col("phone"), F.lower("first_name")]]
    source = lambda i: e.select(F.col("unique_id").alias(i), F.col("source_name").alias(f"source_{i}")).distinct()
    met = joins.blocked_pairs(e, e, rules, "unique_id", "unique_id").join(source("id_l"), "id_l").join(source("id_r"), "id_r")
    return met.where("source_id_l < source_id_r").select("id_l", "id_r").distinct()


ER_BLOCKING = """WITH a AS (SELECT DISTINCT * FROM dummy_data_elected), b AS (SELECT * FROM a)
SELECT a.unique_id AS id_l, b.unique_id AS id_r FROM a JOIN b ON a.state = b.state AND lower(a.last_name) = lower(b.last_name) WHERE a.source_name < b.source_name
UNION SELECT a.unique_id, b.unique_id FROM a JOIN b ON lower(a.email) = lower(b.email) WHERE a.source_name < b.source_name
UNION SELECT a.unique_id, b.unique_id FROM a JOIN b ON a.phone = b.phone AND lower(a.first_name) = lower(b.first_name) WHERE a.source_name < b.source_name"""


def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return windows.latest_by_struct(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


DEDUP_LATEST = "SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"

PLANS = {
    "latest_per_group": (latest_per_group, LATEST_PER_GROUP),
    "pandas_udf_struct": (pandas_udf_struct, "SELECT DISTINCT o_custkey, o_custkey * 10 AS remote_id, 'entry ' || o_custkey AS remote_name FROM orders WHERE o_custkey % 2 = 0"),
    "to_json_struct": (to_json_struct, """SELECT o_orderkey, '{"orderKey":' || o_orderkey || ',"state":{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}}' AS doc FROM orders"""),
    "upsert_merge": (upsert_merge, UPSERT_MERGE),
    "quality_gate": (quality_gate, QUALITY_GATE),
    "star_except": (star_except, "SELECT * EXCLUDE (p_retailprice, p_type) FROM part"),
    "multi_col_avg": (multi_col_avg, MULTI_COL_AVG),
    "coalesce_precedence": (coalesce_precedence, COALESCE_PRECEDENCE),
    "provider_merge": (provider_merge, PROVIDER_MERGE),
    "full_outer_merge": (full_outer_merge, FULL_OUTER_MERGE),
    "full_outer_fallback": (full_outer_fallback, FULL_OUTER_FALLBACK),
    "like_ilike_rlike": (like_ilike_rlike, LIKE_ILIKE_RLIKE),
    "null_safe_join": (null_safe_join, NULL_SAFE_JOIN),
    "point_in_time_join": (point_in_time_join, POINT_IN_TIME_JOIN),
    "asof_nearest": (asof_nearest, ASOF_NEAREST),
    "two_pass_assignment": (two_pass_assignment, TWO_PASS_ASSIGNMENT),
    "interval_join": (interval_join, INTERVAL_JOIN),
    "range_join": (range_join, RANGE_JOIN),
    "multi_key_anti": (multi_key_anti, MULTI_KEY_ANTI),
    "carve_union": (carve_union, CARVE_UNION),
    "wildcard_join": (wildcard_join, WILDCARD_JOIN),
    "normalized_key_join": (normalized_key_join, NORMALIZED_KEY_JOIN),
    "union_by_name": (union_by_name, UNION_BY_NAME),
    "union_master_tail": (union_master_tail, UNION_MASTER_TAIL),
    "er_blocking": (er_blocking, ER_BLOCKING),
    "dedup_latest": (dedup_latest, DEDUP_LATEST),
}


def queries() -> dict:
    texts = {k: s.replace(*ONLY_SPARK_TEXT[k]) if k in ONLY_SPARK_TEXT else s for k, s in SAME_TEXT.items()}
    return {k: _from_text(s) for k, s in texts.items()} | {k: q for k, (q, _) in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    texts = {k: s.replace(*ONLY_DUCK_TEXT[k]) if k in ONLY_DUCK_TEXT else s for k, s in SAME_TEXT.items()}
    return {k: re.sub(r"\{(\w+)\}", r"\1", s) for k, s in texts.items()} | {k: s for k, (_, s) in PLANS.items()}
