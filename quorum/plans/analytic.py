"""Aggregates, windows, reshaping, incremental patterns and the algorithms built from them: one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorum.functions import civic, ids, names, numbers, similarity, text
from quorum.operators import aggregates, graph, incremental, joins, linkage, quality, reshape, windows
from quorum.plans import metrics
from quorum.session import table


def _t(name: str):
    return lambda spark, d: table(spark, d, name)


events, orders, lineitem, customer, supplier, part, nation = map(_t, ("events", "orders", "lineitem", "customer", "supplier", "part", "nation"))


# ---- aggregates


def group_agg(spark: SparkSession, d: str) -> DataFrame:
    return lineitem(spark, d).groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_net"), F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("n"),
    )


def count_distinct_conditional(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d)
    return o.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct(F.when(F.col("o_orderstatus") == "P", F.col("o_custkey"))).alias("pending_customers"))


def conditional_agg(spark: SparkSession, d: str) -> DataFrame:
    """Milestones of a user."""
    e, is_ = events(spark, d), lambda t: F.col("event_type") == t
    return e.groupBy("user_id").agg(
        F.min(F.when(is_("signup"), F.col("ts"))).alias("first_signup"), F.max(F.when(is_("purchase"), F.col("ts"))).alias("last_purchase"), F.count_if(is_("error")).alias("n_errors"),
        F.round(F.sum(F.when(is_("purchase"), F.col("value")).otherwise(0.0)), 2).alias("spent"), F.max(F.get_json_object("props", "$.k").cast("int")).alias("top_k"),
    )


def bool_rollup(spark: SparkSession, d: str) -> DataFrame:
    big = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 150000)
    return orders(spark, d).groupBy("o_custkey").agg(F.bool_or(big).alias("any_big"), F.max(big).alias("max_big"), F.bool_and(big).alias("all_big"))


def max_by_fallback(spark: SparkSession, d: str) -> DataFrame:
    """The status of the dearest order, of any order if no price is known; ties by the key."""
    o = orders(spark, d)
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return o.groupBy("o_custkey").agg(F.coalesce(F.max_by("o_orderkey", F.when(price.isNotNull(), F.struct(price, F.col("o_orderkey")))), F.max("o_orderkey")).alias("pick"), F.min_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("first_status"))


def mode_deterministic(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.mode_of(lineitem(spark, d).withColumn("mode", F.pmod("l_partkey", F.lit(7))), ["l_suppkey"], "mode")


def collect_sorted_structs(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey")), asc=False), lambda x: x["o_orderkey"].cast("string")), ",").alias("keys"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))


def percentile_iqr_outliers(spark: SparkSession, d: str) -> DataFrame:
    got = aggregates.iqr_outliers(events(spark, d), "event_type", "value")
    return got.select("event_type", "n_rows", F.round("q1", 4).alias("q1"), F.round("q3", 4).alias("q3"), "n_outliers")


def rollup_all_label(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select("o_orderstatus", F.year("o_orderdate").alias("year"), "o_custkey")
    return aggregates.rollup_with_all(o, "o_orderstatus", "year", F.col("o_custkey"), ["P"])


def safe_ratio(spark: SparkSession, d: str) -> DataFrame:
    z = table(spark, d, "zip_code_to_l2_district").groupBy("zip_code").agg(F.sum("voters_in_zip_district").alias("a"), F.sum(F.when(F.col("voters_in_zip") > 3000, F.col("voters_in_zip")).otherwise(0)).alias("b"))
    return z.select("zip_code", F.round(numbers.safe_ratio(F.col("a"), F.col("b")), 8).alias("ratio"))


def bucket_histogram(spark: SparkSession, d: str) -> DataFrame:
    band = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "low").when(F.col("c_custkey") % 10 != 0, "high")
    got = aggregates.histogram(customer(spark, d), "c_mktsegment", band, "buckets")
    return got.select("c_mktsegment", "total", F.array_join(F.transform("buckets", lambda b: F.concat_ws(":", b["label"], b["count"].cast("string"), F.round(b["percent"]).cast("int").cast("string"))), ",").alias("buckets"))


def mass_allocation(spark: SparkSession, d: str) -> DataFrame:
    """Each nation's orders total, allocated to its suppliers by their balance."""
    total = orders(spark, d).join(customer(spark, d), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("o_totalprice").alias("magnitude"))
    s = supplier(spark, d).withColumn("weight", F.greatest("s_acctbal", F.lit(0.0))).join(total, F.col("s_nationkey") == F.col("c_nationkey"))
    return aggregates.allocate_mass(s, "s_nationkey", "weight", "magnitude").select("s_suppkey", "s_nationkey", F.round("share", 8).alias("share"), F.round("allocated", 2).alias("allocated"))


def majority_membership(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select("o_custkey", "o_orderstatus")
    return aggregates.majority(o, ["o_custkey"], "o_orderstatus").select("o_custkey", "o_orderstatus", F.round("share", 8).alias("share"))


def rss_margin(spark: SparkSession, d: str) -> DataFrame:
    """Estimates and margins with their codes, summed."""
    codes = F.when(F.col("p_size") == 1, -666666666).when(F.col("p_size") == 2, -888888888).otherwise(F.col("p_size") * 10)
    margins = F.when(F.col("p_size") == 3, -555555555).when(F.col("p_size") == 4, -222222222).otherwise(F.col("p_size"))
    return part(spark, d).select("p_partkey", civic.census_estimate_sum(codes, F.col("p_size")).alias("estimate"), F.round(civic.census_margin_rss(margins, F.col("p_size") + 1), 6).alias("margin"))


def wilson_interval(spark: SparkSession, d: str) -> DataFrame:
    g = orders(spark, d).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("k"))
    return g.select("o_custkey", *numbers.wilson(F.col("k"), F.col("n")))


def count_once(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select(F.col("o_orderpriority").alias("cohort"), "o_orderstatus", "o_custkey")
    return aggregates.count_once(o, "cohort", "o_orderstatus", "o_custkey")


ORDERS_MODEL = metrics.SemanticModel("orders", "o_orderdate", {"status": "o_orderstatus", "is_large": "o_totalprice > 100000"}, {"order_count": metrics.Measure(), "customers": metrics.Measure("o_custkey", "count_distinct")})
METRICS = {
    "large_orders": metrics.Metric("large_orders", ORDERS_MODEL, "order_count", "is_large"),
    "active_customers": metrics.Metric("active_customers", ORDERS_MODEL, "customers"),
    "cumulative_finished": metrics.Metric("cumulative_finished", ORDERS_MODEL, "order_count", "status = 'F'", cumulative=True),
}


def metric_simple(spark: SparkSession, d: str) -> DataFrame:
    return metrics.query(METRICS["large_orders"], orders(spark, d), ["status"], "month")


def metric_cumulative(spark: SparkSession, d: str) -> DataFrame:
    return metrics.query(METRICS["cumulative_finished"], orders(spark, d), [], "month", ("1992-01-01", "1999-01-01"))


# ---- windows


def ranked_pick(spark: SparkSession, d: str) -> DataFrame:
    """One record per official's source id: elected before tried wordings, known e-mails first."""
    e = table(spark, d, "dummy_data").select("unique_id", "state", "official_office_name", "email", "election_date").distinct()
    order = [F.when(F.col("email").isNotNull(), 0).otherwise(1), F.col("election_date").desc_nulls_last(), F.col("unique_id")]
    return windows.latest_per_key(e, ["state", "official_office_name"], order).select("state", "official_office_name", "unique_id")


def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select("o_orderpriority", "o_orderkey", "o_totalprice")
    return windows.top_k(o, ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 5)


def window_totals(spark: SparkSession, d: str) -> DataFrame:
    s = supplier(spark, d).select("s_suppkey", "s_nationkey", "s_acctbal")
    got = windows.with_totals(s, ["s_nationkey"], total=F.sum("s_acctbal"), n=F.count(F.lit(1)), n_debt=F.count_if(F.col("s_acctbal") < 0), top=F.max("s_acctbal"))
    return got.select("s_suppkey", "s_nationkey", F.round("total", 2).alias("total"), "n", "n_debt", "top")


def first_value_ignore_nulls(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "dummy_data_elected").select("state", "official_office_name", "unique_id", "email", "phone").distinct()
    return windows.first_known(e, ["state", "official_office_name"], [F.col("unique_id")], ["email", "phone"]).select("unique_id", "email", "phone")


def sessionize_gap(spark: SparkSession, d: str) -> DataFrame:
    """Visits (views more than 30 s after the last) and views per user and week."""
    v = windows.sessions_by_gap(events(spark, d).where("event_type IN ('view', 'click')"), "user_id", "ts", 1800)
    return v.groupBy("user_id", F.to_date(F.date_trunc("week", "ts")).alias("week")).agg(F.count_if("is_new").alias("visits"), F.count(F.lit(1)).alias("views"))


def window_collect_union(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "dummy_data_elected").select("unique_id", "state", "candidate_office", "source_name").distinct()
    by = ["state", "candidate_office"]
    sources = e.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set("source_name")), ",").alias("sources"))  # few sources a group; rows are not gathered
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]
    return e.alias("e").join(sources.alias("s"), same[0] & same[1]).select("unique_id", "sources")


def sibling_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Districts whose spelling has no statistics take the id of the one that has."""
    known = table(spark, d, "districtstats").select(F.col("district_id").alias("k")).where("total_constituents > 20000").distinct()
    x = table(spark, d, "district").select("id", "state", "district_type", "district_name").distinct().join(known, F.col("id") == F.col("k"), "left")
    short = text.district_name(F.regexp_replace("district_name", "[0-9 ]+$", ""))
    return windows.sibling_resolution(x, [F.col("state"), F.col("district_type"), short], "id", F.col("k").isNotNull()).select("id", "resolved_id").distinct()


def trailing_window_flags(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    last = e.agg(F.max("ts").alias("now"))
    got = e.groupBy("user_id").agg(F.max("ts").alias("seen")).crossJoin(F.broadcast(last))
    return got.select("user_id", *[(F.col("seen") > F.col("now") - F.expr(f"interval {n} days")).alias(f"active_{n}d") for n in (1, 7, 30)])


def tumbling_week(spark: SparkSession, d: str) -> DataFrame:
    monday = F.window("ts", "7 days", startTime="4 days")
    return events(spark, d).groupBy(monday, "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("week_start"), "event_type", "n")


# ---- reshaping


def unpivot(spark: SparkSession, d: str) -> DataFrame:
    return reshape.unpivot(table(spark, d, "dummy_data_elected").distinct(), ["unique_id"], ["party", "email", "phone", "district_raw"])


def stack_reshape(spark: SparkSession, d: str) -> DataFrame:
    return lineitem(spark, d).select("l_orderkey", "l_linenumber", F.stack(F.lit(2), F.lit("discount"), F.col("l_discount"), F.lit("tax"), F.col("l_tax")).alias("kind", "rate")).groupBy("kind").agg(F.round(F.sum("rate"), 2).alias("total"), F.count("rate").alias("n"))


def unpivot_dynamic(spark: SparkSession, d: str) -> DataFrame:
    wanted = ["office_type", "office_level", "candidate_office", "not_there"]
    return reshape.unpivot_known(table(spark, d, "election_stage_input").select("unique_id", "office_type", "office_level", "candidate_office").distinct(), ["unique_id"], wanted, "field", "label")


def pivot_conditional(spark: SparkSession, d: str) -> DataFrame:
    got = reshape.pivot(orders(spark, d), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    return got.select("o_orderpriority", *[F.round(f"o_orderstatus_{s}", 2).alias(f"total_{s.lower()}") for s in "FOP"])


# ---- incremental patterns


def incremental_watermark(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).select("event_id", "ts", "user_id")
    return incremental.newer_than(e, e.where("event_id < 6000"), "ts")


def incremental_per_key(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).select("event_id", "ts", "user_id")
    return incremental.newer_than_per_key(e, e.where("event_id < 6000 AND user_id % 7 <> 0"), "user_id", "ts")


def affected_key_recompute(spark: SparkSession, d: str) -> DataFrame:
    z = table(spark, d, "zip_code_to_l2_district")
    changed = z.where("loaded_at >= timestamp'2026-01-04' AND voters_in_zip > 2000")
    return incremental.affected(z, changed, ["zip_code"]).groupBy("zip_code").agg(F.count(F.lit(1)).alias("n"), F.sum("voters_in_zip_district").alias("voters"), F.max("loaded_at").alias("last_load"))


def version_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    o = orders(spark, d).select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return incremental.latest_versions(o, "o_custkey", ["o_orderstatus", "o_orderpriority"], "o_orderkey").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "is_latest")


def scd2_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The history of constituents per district over the loads."""
    s = table(spark, d, "districtstats").where("district_id IS NOT NULL").select("district_id", F.to_date("updated_at").alias("day"), F.floor(F.col("total_constituents") / 1000).alias("thousands"))
    one = s.groupBy("district_id", "day").agg(F.max("thousands").alias("thousands"))
    return incremental.history(one, "district_id", "day", ["thousands"])


def mint_canonical_id(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "dummy_data_elected").select("unique_id", F.concat_ws("|", "state", F.lower("last_name"), F.lower("first_name")).alias("person"), F.coalesce("term_start_date", F.lit("9999-12-31").cast("date")).alias("seen")).distinct()
    return incremental.mint_ids(e, "person", "unique_id", "seen")


# ---- expressions


def salted_ids(spark: SparkSession, d: str) -> DataFrame:
    return orders(spark, d).select("o_orderkey", ids.salted_uuid("o_orderkey", "o_orderstatus").alias("id"))


def election_ids(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "election_stage_input")
    made = ids.election_id("official_office_name", "candidate_office", "office_level", "office_type", "state", F.lit(None), F.col("district_identifier"), "seat_name", "election_date", F.col("is_special"), F.lit(None))
    return e.select("unique_id", made.alias("election_id")).distinct()


def slugs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "election_stage_input").select("unique_id", "official_office_name", "state").distinct()
    return e.select("unique_id", text.slugify("official_office_name", "state").alias("slug")).distinct()


def text_normalization(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "dummy_data")
    return e.select(
        "unique_id", text.party(F.col("party")).alias("party"), text.digits_only(F.col("phone")).alias("digits"), text.without_suffix(F.col("last_name")).alias("last"),
        text.letters_only(F.col("first_name")).alias("letters"), F.array_join(text.name_tokens(F.col("first_name")), "+").alias("tokens"), text.to_boolean(F.when(F.col("partisan_type") == "partisan", " Yes ").otherwise("n")).alias("partisan"),
        text.code_of(F.col("state"), F.col("office_type")).alias("code"),
    ).distinct()


def office_match_keys(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "election_stage_input").select("official_office_name").distinct()
    got = e.select("official_office_name", *civic.office_match_keys(F.col("official_office_name")))
    return got.withColumn("locality_key", F.array_join("locality_key", " "))


def district_parts(spark: SparkSession, d: str) -> DataFrame:
    names_ = table(spark, d, "dummy_data").select(F.regexp_replace("official_office_name", r" \(?(District|Ward|Area) ", " - $1 ").alias("name")).distinct()
    return names_.select("name", civic.district_raw(F.col("name")).alias("raw"), civic.district_geographic(F.col("name")).alias("geographic"), civic.district_number(F.col("name")).alias("number"))


def election_days(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1990, 2040).select(F.col("id").alias("year"), civic.november_election_day(F.col("id").cast("int")).alias("day"))


def stage_depths(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "election_stage_input").select("election_stage").distinct()
    return e.select("election_stage", civic.stage_type(F.col("election_stage")).alias("stage"), civic.stage_depth(civic.stage_type(F.col("election_stage"))).alias("depth"))


#: column, field of the document, kind
EVENT_PROPERTIES = [("k", "k", "bigint"), ("k_flag", "k", "boolean"), ("absent", "absent", "date")]


def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", *text.json_columns(F.col("props"), EVENT_PROPERTIES))


def office_types(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "dummy_data").select("unique_id", "candidate_office", "official_office_name").distinct()
    return e.select("unique_id", "official_office_name", civic.office_type(F.col("candidate_office")).alias("office_type"), civic.office_level(F.col("official_office_name")).alias("office_level")).distinct()


EVENT_FAMILIES = {"signup": "account", "purchase": "conversion", "error": "fault", "view": "engagement", "click": "engagement"}


def event_families(spark: SparkSession, d: str) -> DataFrame:
    """Events per user and family; what recurs is told from what happens once."""
    e = events(spark, d).withColumn("family", text.first_keyword(F.col("event_type"), EVENT_FAMILIES, "other"))
    return e.groupBy("user_id", "family").agg(F.count(F.lit(1)).alias("n"), (F.countDistinct(F.to_date("ts")) > 1).alias("is_recurrent"))


def freshness_lag(spark: SparkSession, d: str) -> DataFrame:
    return quality.freshness(table(spark, d, "load__l2_s3_to_databricks"), "state_id", "loaded_at")


def tri_state_gate(spark: SparkSession, d: str) -> DataFrame:
    """false before an effective date, else the flag, null where it is unknown."""
    o = orders(spark, d)
    flag = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 100000)
    return o.select("o_orderkey", civic.not_before(flag, F.lit("1995-06-01").cast("date"), F.to_date("o_orderdate"), F.lit(None).cast("date")).alias("eligible"), civic.all_false(F.col("o_orderstatus") == "P", flag).alias("clean"))


def multi_format_dates(spark: SparkSession, d: str) -> DataFrame:
    p = part(spark, d)
    raw = F.when(F.col("p_partkey") % 4 == 0, F.concat_ws("/", F.lit("7"), (F.col("p_partkey") % 28 + 1).cast("string"), F.lit("2024"))).when(F.col("p_partkey") % 4 == 1, F.lit("2024-02-30")).when(F.col("p_partkey") % 4 == 2, F.lit("2023-05-17")).otherwise(F.lit("12/31/1899"))
    return p.select("p_partkey", numbers.parse_date(raw, ["M/d/yyyy"], "1990-01-01", "2040-12-31").alias("day"))


def deidentified(spark: SparkSession, d: str) -> DataFrame:
    """Voters under an allow-list of columns, with a household hash in place of the address."""
    v = table(spark, d, "voter")
    return v.select(ids.household_hash("state", "residence_addresses_city", "residence_addresses_zip", "lastname").alias("household"), "state", "active", F.year("birthdate").alias("birth_year")).groupBy("household", "state").agg(F.count(F.lit(1)).alias("members"), F.min("birth_year").alias("oldest"))


def human_names(spark: SparkSession, d: str) -> DataFrame:
    names.register(spark)
    e = table(spark, d, "dummy_data").select(F.concat_ws(" ", "first_name", "last_name").alias("full")).distinct()
    return spark.sql("SELECT full, parse_human_name(full) AS p FROM {e}", e=e).select("full", "p.*")


# ---- algorithms


def connected_components(spark: SparkSession, d: str) -> DataFrame:
    """Customers linked by orders of one day and priority."""
    o = orders(spark, d).select(F.col("o_custkey").alias("c"), F.concat_ws("|", F.to_date("o_orderdate").cast("string"), "o_orderpriority").alias("k"))
    hub = o.groupBy("k").agg(F.min("c").alias("b"))
    edges = o.join(hub, "k").where("c <> b").select(F.col("c").alias("a"), "b").distinct()
    return graph.components(edges).select("v", "component", "n_vertices")


def near_surnames(e: DataFrame, least: float) -> DataFrame:
    """state, x, y: the distinct surnames of a state with a Jaro-Winkler similarity of at least ``least``, both ways and each with itself."""
    from quorum.session import cut, spread

    cores = e.sparkSession.sparkContext.defaultParallelism
    last = cut(e.select("state", "last").where("state IS NOT NULL AND last IS NOT NULL").distinct())
    keyed = cut(spread(last).withColumn("k", F.explode(similarity.near_keys(F.col("last"), least))).repartition(2 * cores, "state", "k"))
    met = keyed.withColumnRenamed("last", "x").hint("merge").join(keyed.withColumnRenamed("last", "y"), ["state", "k"]).where("x < y")
    long, short = F.greatest(F.length("x"), F.length("y")), F.least(F.length("x"), F.length("y"))
    lead = F.when(F.substring("x", 1, similarity.PREFIX) == F.substring("y", 1, similarity.PREFIX), similarity.PREFIX).otherwise(similarity.PREFIX - 1) * F.lit(similarity.WEIGHT)
    enough = lambda m: (m / long + m / short + 1) / 3 * (1 - lead) + lead >= least - 1e-9
    pairs = cut(met.where(enough(short)).select("state", "x", "y").distinct())
    near = cut(spread(pairs).where(enough(similarity.common_letters(F.col("x"), F.col("y")))).where(similarity.jaro_winkler(F.col("x"), F.col("y")) >= least))
    return near.unionAll(near.select("state", F.col("y").alias("x"), F.col("x").alias("y"))).unionAll(last.select("state", F.col("last").alias("x"), F.col("last").alias("y")))


def linkage_candidates(e: DataFrame, least: float) -> DataFrame:
    """id_l, id_r of different sources with near surnames in a state, or with an e-mail, a phone or a position of a state in common."""
    l = e.select("state", F.col("last").alias("x"), F.col("unique_id").alias("id_l"))
    r = e.select("state", F.col("last").alias("y"), F.col("unique_id").alias("id_r"))
    by_name = l.join(near_surnames(e, least), ["state", "x"]).join(r, ["state", "y"]).select("id_l", "id_r")
    by_key = joins.blocked_pairs(e, e, [[F.col("email")], [F.col("phone")], [F.col("state"), F.col("position")]], "unique_id", "unique_id")
    source = lambda i: e.select(F.col("unique_id").alias(i), F.col("source_name").alias(f"source_{i}")).distinct()
    return by_name.unionAll(by_key).distinct().join(source("id_l"), "id_l").join(source("id_r"), "id_r").where("source_id_l < source_id_r").select("id_l", "id_r")


def record_linkage(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of any two sources with match probabilities of a Fellegi-Sunter model, post-filtered."""
    from quorum.session import cut, spread

    e = cut(spread(cut(table(spark, d, "dummy_data_elected").select("unique_id", "source_name", "state", F.lower("last_name").alias("last"), text.letters_only(F.col("first_name")).alias("first"), F.split(F.lower("official_office_name"), "[^a-z]+").alias("office"), F.lower("email").alias("email"), "phone", F.col("ballotready_position_id").alias("position")).distinct())))
    cols = ["source_name", "last", "first", "office", "email"]
    jw = lambda x, y: similarity.jaro_winkler_at_least(x, y, 0.92)
    comparisons = [
        linkage.Comparison("last", ["last"], [F.col("l_last") == F.col("r_last"), F.col("jw_last") >= 0.92]),
        linkage.Comparison("first", ["first"], [F.col("l_first") == F.col("r_first"), F.col("jw_first") >= 0.92]),
        linkage.Comparison("office", ["office"], [F.size(F.array_intersect("l_office", "r_office")) >= 4, F.arrays_overlap("l_office", "r_office")]),
        linkage.Comparison("email", ["email"], [F.col("l_email") == F.col("r_email")]),
    ]
    sides = lambda p: linkage.with_sides(p, e, e, "unique_id", cols).where("l_source_name <> r_source_name").withColumns({"jw_last": jw(F.col("l_last"), F.col("r_last")), "jw_first": jw(F.col("l_first"), F.col("r_first"))})
    gammas = cut(linkage.compare(sides(linkage_candidates(e, 0.92)), comparisons))
    # of four sources of one size a quarter of all pairs are within a source
    chance = linkage.compare(sides(linkage.chance_pairs(e, e, "unique_id", linkage.CHANCE_PAIRS * 4 // 3)), comparisons)
    scored = linkage.score(gammas, linkage.estimate(gammas, chance, comparisons), comparisons)
    return scored.where((F.col("match_probability") >= 0.01) & (F.col("gamma_last") != 0) & (F.col("gamma_office") > 0)).select("id_l", "id_r", F.round("match_probability", 6).alias("match_probability"))


def linkage_clusters(spark: SparkSession, d: str) -> DataFrame:
    """record, cluster_id: the records that pairs of a probability of 0.8 or more link, directly or through others."""
    return linkage.clusters(record_linkage(spark, d), 0.8)


def term_frequencies(spark: SparkSession, d: str) -> DataFrame:
    """How rare a surname is: what raises the weight of an agreement on it."""
    e = table(spark, d, "dummy_data_elected").select("unique_id", "source_name", F.lower("last_name").alias("last")).distinct()
    tf = linkage.frequency_adjustment(e.where("source_name = 'ballotready'"), e.where("source_name <> 'ballotready'"), "last")
    return tf.select(F.col("value").alias("last"), F.round("tf", 12).alias("tf"))


def similarity_scores(spark: SparkSession, d: str) -> DataFrame:
    p = part(spark, d).select(F.col("p_brand").alias("brand"), "p_name")
    x = p.groupBy("brand").agg(F.min("p_name").alias("a"), F.max("p_name").alias("b"))
    return x.select("brand", "a", "b", F.round(similarity.jaro_winkler(F.col("a"), F.col("b")), 6).alias("jw"))


def interval_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Projected counts with bounds in rate space that enclose the point."""
    g = lineitem(spark, d).groupBy("l_suppkey").agg(F.sum(F.col("l_discount") * F.col("l_quantity")).alias("projected"), F.sum("l_quantity").alias("size"))
    q = F.when(F.col("l_suppkey") % 4 != 0, F.lit(-0.1)), F.when(F.col("l_suppkey") % 4 != 0, F.lit(0.12))
    return g.select("l_suppkey", *numbers.projection_interval(F.round("projected", 4), F.col("size"), *q, F.col("l_suppkey") % 2 == 0))


def waterfall_scoring(spark: SparkSession, d: str) -> DataFrame:
    """Weight of evidence by segment, rare ones as 'Other'; the first model that has a value wins."""
    c = customer(spark, d)
    o = orders(spark, d).groupBy("o_custkey").agg(F.max((F.col("o_totalprice") > 250000).cast("int")).alias("y"))
    x = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    seg = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"), F.col("c_mktsegment")).otherwise("Other")
    woe = x.where("y IS NOT NULL").groupBy(seg.alias("seg")).agg(F.round(F.log((F.sum("y") + 0.5) / (F.count_if(F.col("y") == 0) + 0.5)), 6).alias("woe"))
    by_balance = F.when(F.col("c_acctbal") > 9000, F.lit(1.0))
    got = x.withColumn("seg", seg).join(F.broadcast(woe), "seg", "left")  # four rows
    return got.select("c_custkey", F.coalesce(by_balance, F.when(F.col("y").isNotNull(), F.col("woe")), F.lit(0.0)).alias("score"), F.when(by_balance.isNotNull(), "balance").when(F.col("y").isNotNull() & F.col("woe").isNotNull(), "segment").otherwise("default").alias("model"))


def state_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Each user's last signal on or before a date, unless an error came after it by then."""
    day = F.lit("2024-01-15").cast("timestamp")
    e = events(spark, d).where(F.col("ts") <= day)
    got = e.groupBy("user_id").agg(F.max_by("event_type", F.when(F.col("event_type") != "error", F.struct("ts", "event_id"))).alias("signal"), F.max(F.when(F.col("event_type") != "error", F.col("ts"))).alias("at"), F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("failed"))
    return got.select("user_id", F.when(F.col("failed").isNull() | (F.col("failed") < F.col("at")), F.col("signal")).alias("state"))


def scalar_if_unambiguous(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "dummy_data_elected").groupBy("state", F.lower("last_name").alias("last"))
    return e.agg(aggregates.single_value(F.col("party")).alias("party"), aggregates.single_value(F.col("office_type")).alias("office"), F.count(F.lit(1)).alias("n"))


def fail_closed_resolution(spark: SparkSession, d: str) -> DataFrame:
    """The priority of a customer's year, only with two orders or more and no contradiction."""
    g = orders(spark, d).groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"), aggregates.single_value(F.col("o_orderpriority")).alias("p"))
    return g.where("n >= 2 AND p IS NOT NULL").select("o_custkey", "year", F.col("p").alias("priority"))


def share_projection(spark: SparkSession, d: str) -> DataFrame:
    """Voters of a district in proportion to its part of the zip code, largest first pick."""
    z = table(spark, d, "zip_code_to_l2_district").where("voters_in_zip_district BETWEEN 1 AND voters_in_zip AND zip_code IS NOT NULL")
    last = windows.latest_per_key(z, ["zip_code", "state_postal_code", "district_type"], [F.col("loaded_at").desc(), F.col("voters_in_zip_district").desc(), F.col("district_name")])
    return last.select("zip_code", "state_postal_code", "district_type", "district_name", F.round(10000 * F.col("voters_in_zip_district") / F.col("voters_in_zip"), 4).alias("projected"))


def geo_slugs(spark: SparkSession, d: str) -> DataFrame:
    """Slugs of places under their parents; a slug that two places share gets the place's id."""
    x = table(spark, d, "district").select("id", "state", "district_type", "district_name").distinct()
    slug = x.withColumn("slug", text.slugify("state", "district_type", F.regexp_replace("district_name", " [0-9]+$", "")))
    n = F.count(F.lit(1)).over(Window.partitionBy("slug"))
    return slug.withColumn("n", n).select("id", F.when(F.col("n") > 1, F.concat_ws("-", "slug", "id")).otherwise(F.col("slug")).alias("slug"))


def canonical_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """Records' canonical ids: the anchor source's record of a cluster, else the least record; clusters with two anchors have none."""
    e = table(spark, d, "dummy_data_elected").select("unique_id", "source_name", F.concat_ws("|", "state", F.lower("last_name"), F.lower("official_office_name")).alias("cluster")).distinct()
    c = e.groupBy("cluster").agg(F.countDistinct(F.when(F.col("source_name") == "ballotready", F.col("unique_id"))).alias("n"), F.min(F.when(F.col("source_name") == "ballotready", F.col("unique_id"))).alias("anchor"), F.min("unique_id").alias("least"))
    ok = c.where("n <= 1").select("cluster", F.coalesce("anchor", "least").alias("canonical_id"))
    return e.join(ok, "cluster").select("unique_id", "canonical_id")


PLANS = [
    group_agg, count_distinct_conditional, conditional_agg, bool_rollup, max_by_fallback, mode_deterministic, collect_sorted_structs, percentile_iqr_outliers, rollup_all_label, safe_ratio, bucket_histogram,
    mass_allocation, majority_membership, rss_margin, wilson_interval, count_once, metric_simple, metric_cumulative, ranked_pick, topk_per_group, window_totals, first_value_ignore_nulls, sessionize_gap,
    window_collect_union, sibling_resolution, trailing_window_flags, tumbling_week, unpivot, stack_reshape, unpivot_dynamic, pivot_conditional, incremental_watermark, incremental_per_key, affected_key_recompute,
    version_fingerprint, scd2_snapshot, mint_canonical_id, salted_ids, election_ids, slugs, text_normalization, office_match_keys, district_parts, election_days, stage_depths, json_fields, office_types, event_families, freshness_lag, tri_state_gate, multi_format_dates,
    deidentified, human_names, connected_components, record_linkage, linkage_clusters, term_frequencies, similarity_scores, interval_bounds, waterfall_scoring, state_as_of, scalar_if_unambiguous, fail_closed_resolution, share_projection, geo_slugs, canonical_crosswalk,
]


def queries() -> dict:
    return {f.__name__: f for f in PLANS}


def oracle_sql() -> dict[str, str]:
    from quorum.plans.analytic_sql import SQL

    return SQL
