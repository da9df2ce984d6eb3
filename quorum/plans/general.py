"""The pN_ queries of the general problems, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.operators import profile
from quorum.operators import references as ref
from quorum.operators import skew
from quorum.session import table

DAY = "yyyy-MM-dd"


# ---- problem 3: column-level data quality profile

MOST = 1_000_000
PROFILED = {
    "zip_code_to_l2_district": ("loaded_at", [
        profile.Profiled("zip_code", pattern=r"^[0-9]{5}$"), profile.Profiled("state_postal_code", pattern=r"^[A-Z]{2}$"), profile.Profiled("district_type"), profile.Profiled("district_name"),
        profile.Profiled("voters_in_zip_district", True, low=1, high=MOST), profile.Profiled("voters_in_zip", True, low=1, high=MOST),
    ]),
    "districtstats": ("updated_at", [
        profile.Profiled("district_id", pattern=r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"),
        profile.Profiled("total_constituents", True, low=1, high=MOST), profile.Profiled("total_constituents_with_cell_phone", True, low=1, high=MOST),
    ]),
}


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    """The profile of both tables: base aggregates, those of the load before, and the classifier's figures."""
    parts = [profile.profile_loads(table(spark, d, t), F.date_format(at, DAY), cols).withColumn("table_name", F.lit(t)) for t, (at, cols) in PROFILED.items()]
    return parts[0].unionByName(parts[1])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The findings, which thresholds on the exact profile define; the classifier's decisions are in p3_profile."""
    parts = [
        profile.findings(profile.exact_profile(table(spark, d, t), F.date_format(at, DAY), cols)).select(F.lit(t).alias("table_name"), "load_day", "column_name", "finding")
        for t, (at, cols) in PROFILED.items()
    ]
    return parts[0].unionByName(parts[1])


def p3_exact(spark: SparkSession, d: str) -> DataFrame:
    """The exact part of the profile: every column of every load."""
    parts = [profile.exact_profile(table(spark, d, t), F.date_format(at, DAY), cols).withColumn("table_name", F.lit(t)) for t, (at, cols) in PROFILED.items()]
    return parts[0].unionByName(parts[1]).select("table_name", "load_day", "column_name", "n_rows", "n_nulls", "n_distinct", "median", "n_off_range", "n_off_pattern", "b_n_rows", "b_n_nulls", "b_n_distinct", "b_median")


def _p3_base_sql() -> str:
    longs = []
    for t, (at, cols) in PROFILED.items():
        for c in cols:
            bad = f"count(*) FILTER (WHERE NOT regexp_matches({c.name}, '{c.pattern}'))" if c.pattern else "0"
            off = f"count(*) FILTER (WHERE {c.name} < {c.low} OR {c.name} > {c.high})" if c.number else "0"
            med = f"quantile_disc({c.name}, 0.5)" if c.number else "NULL::BIGINT"
            longs.append(f"SELECT '{t}' table_name, strftime({at}, '%Y-%m-%d') load_day, '{c.name}' column_name, count(*) n, count(*) - count({c.name}) nn, count(DISTINCT {c.name}) nd, {med} med, {off} off_range, {bad} off_pattern FROM {t} WHERE {at} IS NOT NULL GROUP BY 2")
    return "WITH s AS (" + "\nUNION ALL ".join(longs) + """),
b AS (SELECT *, lag(n) OVER w bn, lag(nn) OVER w bnn, lag(nd) OVER w bnd, lag(med) OVER w bmed FROM s WINDOW w AS (PARTITION BY table_name, column_name ORDER BY load_day))
"""


def _p3_exact_sql() -> str:
    return _p3_base_sql() + "SELECT table_name, load_day, column_name, n AS n_rows, nn AS n_nulls, nd AS n_distinct, med AS median, off_range AS n_off_range, off_pattern AS n_off_pattern, bn AS b_n_rows, bnn AS b_n_nulls, bnd AS b_n_distinct, bmed AS b_median FROM b"


def _p3_sql() -> str:
    return _p3_base_sql() + """SELECT table_name, load_day, column_name, 'nulls' AS finding FROM b WHERE 10 * abs(nn * bn - bnn * n) > n * bn
UNION ALL SELECT table_name, load_day, column_name, 'distinct' FROM b WHERE nd > 2 * bnd OR 2 * nd < bnd
UNION ALL SELECT table_name, load_day, column_name, 'shift' FROM b WHERE med > 2 * bmed OR 2 * med < bmed
UNION ALL SELECT table_name, load_day, column_name, 'range' FROM b WHERE off_range > 0
UNION ALL SELECT table_name, load_day, column_name, 'pattern' FROM b WHERE off_pattern > 0"""


# ---- problem 6: references to records that do not exist


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    dv, stats = table(spark, d, "districtvoter"), table(spark, d, "districtstats")
    gone = (
        table(spark, d, "l2_expired_voters")
        .select(ref.plain_id(F.col("lalvoterid")).alias("_lal"), F.col("loaded_at").alias("_gone"))
        .where(F.col("_lal").isNotNull())
        .groupBy("_lal")
        .agg(F.min("_gone").alias("_gone"))
    )
    v = table(spark, d, "voter").select(ref.plain_id(F.col("id")).alias("_id"), ref.plain_id(F.col("lalvoterid")).alias("_lal"), F.col("created_at").alias("_created"))
    voters = ref.parent_lifespans(v.join(gone, "_lal", "left"), F.col("_id"), F.col("_created"), F.col("_gone"))
    districts = ref.parent_lifespans(table(spark, d, "district"), ref.plain_id(F.col("id")), F.col("created_at"))
    v_id, d_id = ref.plain_id(F.col("voter_id")), ref.plain_id(F.col("district_id"))
    say = lambda df, t, f: df.withColumn("table_name", F.lit(t)).withColumn("ref_field", F.lit(f))
    both = {"voter_id": v_id, "district_id": d_id}
    return (
        say(ref.orphan_references(dv, v_id, F.col("created_at"), voters, both), "districtvoter", "voter_id")
        .unionByName(say(ref.orphan_references(dv, d_id, F.col("created_at"), districts, both), "districtvoter", "district_id"))
        .unionByName(say(ref.orphan_references(stats, d_id, F.col("updated_at"), districts, {"voter_id": F.lit(""), "district_id": d_id}), "districtstats", "district_id"))
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select(
        "table_name", "ref_field", F.coalesce("voter_id", F.lit("")).alias("voter_id"), F.coalesce("district_id", F.lit("")).alias("district_id"),
        F.coalesce(F.date_format("_at", DAY), F.lit("")).alias("ref_day"), "reason",
    ).distinct()


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    return ref.orphan_counts(_orphans(spark, d), ["table_name", "ref_field"]).withColumn("month", F.coalesce("month", F.lit("")))


_ORPHANS_SQL = r"""
WITH gone AS (SELECT nullif(lower(trim(lalvoterid, E'{} \t\r\n')), '') lal, min(loaded_at) g FROM l2_expired_voters GROUP BY 1),
voters AS (SELECT nullif(lower(trim(id, E'{} \t\r\n')), '') k, min(created_at) born, min(g) died
  FROM voter LEFT JOIN gone ON nullif(lower(trim(lalvoterid, E'{} \t\r\n')), '') = lal GROUP BY 1),
districts AS (SELECT nullif(lower(trim(id, E'{} \t\r\n')), '') k, min(created_at) born FROM district GROUP BY 1),
dv AS (SELECT nullif(lower(trim(voter_id, E'{} \t\r\n')), '') v, nullif(lower(trim(district_id, E'{} \t\r\n')), '') d, created_at t FROM districtvoter),
ds AS (SELECT nullif(lower(trim(district_id, E'{} \t\r\n')), '') d, updated_at t FROM districtstats),
orphans AS (
  SELECT 'districtvoter' table_name, 'voter_id' ref_field, v voter_id, d district_id, t, v fk,
    CASE WHEN k IS NULL THEN 'missing' WHEN died <= t THEN 'deleted' WHEN born > t THEN 'late' END reason
  FROM dv LEFT JOIN voters ON v = k WHERE v IS NOT NULL
  UNION ALL
  SELECT 'districtvoter', 'district_id', v, d, t, d, CASE WHEN k IS NULL THEN 'missing' WHEN born > t THEN 'late' END
  FROM dv LEFT JOIN districts ON d = k WHERE d IS NOT NULL
  UNION ALL
  SELECT 'districtstats', 'district_id', '', d, t, d, CASE WHEN k IS NULL THEN 'missing' WHEN born > t THEN 'late' END
  FROM ds LEFT JOIN districts ON d = k WHERE d IS NOT NULL)
"""
P6_FOUND_SQL = (
    _ORPHANS_SQL
    + """SELECT DISTINCT table_name, ref_field, coalesce(voter_id, '') AS voter_id, coalesce(district_id, '') AS district_id,
  coalesce(strftime(t, '%Y-%m-%d'), '') AS ref_day, reason FROM orphans WHERE reason IS NOT NULL"""
)
P6_COUNTS_SQL = (
    _ORPHANS_SQL
    + """SELECT table_name, ref_field, coalesce(strftime(t, '%Y-%m'), '') AS month, reason, count(*) AS n_rows, count(DISTINCT fk) AS n_keys
FROM orphans WHERE reason IS NOT NULL GROUP BY 1, 2, 3, 4"""
)


# ---- problem 7: a few keys holding most records


def p7_by_key(spark: SparkSession, d: str) -> DataFrame:
    """Rows, distinct voters and latest change of every district_id and every state of districtvoter."""
    dv = table(spark, d, "districtvoter")
    latest, voter = F.coalesce("updated_at", "created_at"), ref.plain_id(F.col("voter_id"))
    by = lambda kind, key: skew.balanced_by_key(dv, key, voter, latest).select(F.lit(kind).alias("key_kind"), "key", "n_rows", F.col("n_distinct").alias("n_voters"), "latest")
    return by("district_id", ref.plain_id(F.col("district_id"))).unionByName(by("state", F.nullif(F.upper(F.trim("state")), F.lit(""))))


P7_BY_KEY_SQL = r"""
WITH dv AS (SELECT nullif(lower(trim(voter_id, E'{} \t\r\n')), '') v, nullif(lower(trim(district_id, E'{} \t\r\n')), '') d, nullif(upper(trim(state)), '') s,
  coalesce(updated_at, created_at) t FROM districtvoter)
SELECT 'district_id' AS key_kind, d AS key, count(*) AS n_rows, count(DISTINCT v) AS n_voters, max(t) AS latest FROM dv GROUP BY d
UNION ALL SELECT 'state', s, count(*), count(DISTINCT v), max(t) FROM dv GROUP BY s
"""


def queries() -> dict:
    return {"p3_found": p3_found, "p3_profile": p3_profile, "p3_exact": p3_exact, "p6_found": p6_found, "p6_counts": p6_counts, "p7_by_key": p7_by_key}


def oracle_sql() -> dict[str, str]:
    return {"p3_found": _p3_sql(), "p3_exact": _p3_exact_sql(), "p6_found": P6_FOUND_SQL, "p6_counts": P6_COUNTS_SQL, "p7_by_key": P7_BY_KEY_SQL}
