"""Published relations: what the operators are composed to, one query each.

Spark and DuckDB read one text; where they name a function differently the texts part at that word. Every
text reads whole tables once a source, keeps joins on equal keys, and breaks ties by an id.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quorum.session import table

#: words that the two dialects spell differently: placeholder, Spark, DuckDB
WORDS = [("@DATE_TEXT", "date_format", "strftime"), ("@YMD", "'yyyy-MM-dd'", "'%Y-%m-%d'")]

# a record's merge key: who runs for what in which stage
_KEY = "concat_ws('|', state, lower(trim(last_name)), lower(trim(first_name)), lower(trim(official_office_name)), election_stage)"


def _side(source: str) -> str:
    """One record per merge key of a source, the least unique_id."""
    return f"""SELECT k, min(unique_id) AS id, max(party) AS party, max(email) AS email, max(phone) AS phone, max(election_date) AS day FROM keyed WHERE source_name = '{source}' AND election_date >= DATE '2020-01-01' GROUP BY k"""


_MERGE = f"""keyed AS (SELECT *, {_KEY} AS k FROM {{dummy_data}}),
br AS ({_side('ballotready')}), ts AS ({_side('techspeed')}), dd AS ({_side('ddhq')}), gp AS ({_side('gp_api')}),
m1 AS (SELECT coalesce(br.k, ts.k) AS k, br.id AS br_id, ts.id AS ts_id, coalesce(br.party, ts.party) AS party, coalesce(br.email, ts.email) AS email, coalesce(br.phone, ts.phone) AS phone, coalesce(br.day, ts.day) AS day FROM br FULL OUTER JOIN ts ON br.k = ts.k),
m2 AS (SELECT coalesce(m1.k, dd.k) AS k, br_id, ts_id, dd.id AS dd_id, coalesce(m1.party, dd.party) AS party, coalesce(m1.email, dd.email) AS email, coalesce(m1.phone, dd.phone) AS phone, coalesce(dd.day, m1.day) AS day FROM m1 FULL OUTER JOIN dd ON m1.k = dd.k),
m3 AS (SELECT coalesce(m2.k, gp.k) AS k, br_id, ts_id, dd_id, gp.id AS gp_id, coalesce(gp.party, m2.party) AS party, coalesce(gp.email, m2.email) AS email, coalesce(gp.phone, m2.phone) AS phone, coalesce(m2.day, gp.day) AS day FROM m2 FULL OUTER JOIN gp ON m2.k = gp.k)"""

TEXTS: dict[str, str] = {
    # four sources merged on a key with precedence by column and provenance; older records come as the archive has them
    "stage_merge": f"""WITH {_MERGE}
SELECT k, coalesce(br_id, ts_id, dd_id, gp_id) AS record_id, party, email, phone, @DATE_TEXT(day, @YMD) AS day,
  concat_ws('+', CASE WHEN br_id IS NOT NULL THEN 'ballotready' END, CASE WHEN ts_id IS NOT NULL THEN 'techspeed' END, CASE WHEN dd_id IS NOT NULL THEN 'ddhq' END, CASE WHEN gp_id IS NOT NULL THEN 'gp_api' END) AS sources, false AS from_archive FROM m3
UNION ALL SELECT k, min(unique_id), max(party), max(email), max(phone), @DATE_TEXT(max(election_date), @YMD), min(source_name), true
  FROM keyed WHERE (election_date < DATE '2020-01-01' OR election_date IS NULL) AND NOT EXISTS (SELECT 1 FROM m3 WHERE m3.k = keyed.k) GROUP BY k""",
    # stages rolled up to a candidacy: how far it got, by depth before date, and what is known of it on a day
    "candidacy_rollup": """WITH s AS (SELECT DISTINCT concat_ws('|', state, lower(trim(last_name)), lower(trim(first_name)), lower(trim(official_office_name))) AS candidacy, unique_id, election_date,
  CASE election_stage WHEN 'primary' THEN 1 WHEN 'primary runoff' THEN 2 WHEN 'general' THEN 3 WHEN 'runoff' THEN 4 ELSE 0 END AS depth FROM {dummy_data}),
r AS (SELECT *, row_number() OVER (PARTITION BY candidacy ORDER BY depth DESC, election_date DESC NULLS LAST, unique_id) AS place, max(CASE WHEN election_date > DATE '2026-01-01' THEN depth END) OVER (PARTITION BY candidacy) AS pending, count(*) OVER (PARTITION BY candidacy) AS n_stages FROM s)
SELECT candidacy, unique_id AS last_stage_id, depth, @DATE_TEXT(election_date, @YMD) AS last_day, n_stages,
  CASE WHEN pending IN (2, 4) THEN 'pending runoff' WHEN pending = 3 THEN 'pending general' WHEN pending IS NOT NULL THEN 'pending' WHEN depth = 4 THEN 'decided in runoff' WHEN depth = 3 THEN 'decided' WHEN depth > 0 THEN 'ended before' ELSE 'unknown' END AS result
FROM r WHERE place = 1""",
    # scores given from outside win over those at hand, with what they came from
    "candidacy_scored": """WITH base AS (SELECT unique_id, max(ddhq_votes) AS votes, max(party) AS party FROM {dummy_data_elected} GROUP BY unique_id),
given AS (SELECT unique_id, CAST(count(*) AS DOUBLE) / 4 AS score FROM {dummy_data_elected} WHERE email IS NOT NULL AND phone IS NOT NULL GROUP BY unique_id)
SELECT base.unique_id, party, round(coalesce(given.score, least(CAST(votes AS DOUBLE) / 10000, 1), 0), 6) AS score, CASE WHEN given.score IS NOT NULL THEN 'given' WHEN votes IS NOT NULL THEN 'votes' ELSE 'none' END AS score_source
FROM base LEFT JOIN given ON base.unique_id = given.unique_id""",
    # an incumbent holds the office on the election's day; an office nobody is known to hold then is vacant
    "incumbency_on_day": """WITH c AS (SELECT unique_id, min(state) AS state, min(lower(trim(official_office_name))) AS office, min(lower(trim(last_name))) AS last, min(election_date) AS day FROM {dummy_data} WHERE election_date IS NOT NULL GROUP BY unique_id),
t AS (SELECT DISTINCT state, lower(trim(official_office_name)) AS office, lower(trim(last_name)) AS last, term_start_date AS s, coalesce(term_end_date, DATE '9999-12-31') AS e FROM {dummy_data_elected} WHERE term_start_date IS NOT NULL)
SELECT c.unique_id, count(t.s) AS holders, CASE WHEN count(t.s) = 0 THEN NULL ELSE bool_or(t.last = c.last) END AS is_incumbent, count(t.s) = 0 AS is_vacant
FROM c LEFT JOIN t ON c.state = t.state AND c.office = t.office AND c.day >= t.s AND c.day <= t.e GROUP BY c.unique_id""",
    # everyone served, counted once, once a district type, once a district and once a row: each count is at most the next
    "people_served": """WITH v AS (SELECT lower(trim(voter_id)) AS voter, lower(trim(district_id)) AS district, dv.state FROM {districtvoter} AS dv WHERE voter_id IS NOT NULL AND district_id IS NOT NULL AND dv.state IS NOT NULL),
d AS (SELECT lower(trim(id)) AS district, coalesce(max(district_type), 'unknown') AS kind FROM {district} WHERE id IS NOT NULL GROUP BY 1),
p AS (SELECT v.state, d.kind, v.district, v.voter, count(*) AS n FROM v JOIN d ON v.district = d.district GROUP BY v.state, d.kind, v.district, v.voter),
by_kind AS (SELECT state, kind, voter, count(*) AS districts, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY state, kind, voter),
by_voter AS (SELECT state, voter, count(*) AS kinds, CAST(sum(districts) AS BIGINT) AS districts, CAST(sum(n) AS BIGINT) AS n FROM by_kind GROUP BY state, voter)
SELECT state, kind AS office_type, count(*) AS once, count(*) AS per_type, CAST(sum(districts) AS BIGINT) AS per_district, CAST(sum(n) AS BIGINT) AS per_row FROM by_kind GROUP BY state, kind
UNION ALL SELECT state, 'all', count(*), CAST(sum(kinds) AS BIGINT), CAST(sum(districts) AS BIGINT), CAST(sum(n) AS BIGINT) FROM by_voter GROUP BY state""",
    # columns averaged over the loads, turned to rows, and ranked within the district
    "district_top_issues": """WITH a AS (SELECT c_nationkey AS district, avg(l_discount) AS discount, avg(l_tax) AS tax, avg(CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END) AS returned, avg(l_quantity / 100) AS quantity
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey GROUP BY c_nationkey),
u AS (SELECT district, 'discount' AS issue, round(discount, 6) AS score FROM a UNION ALL SELECT district, 'tax', round(tax, 6) FROM a UNION ALL SELECT district, 'returned', round(returned, 6) FROM a UNION ALL SELECT district, 'quantity', round(quantity, 6) FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY score DESC, issue) AS place FROM u WHERE score IS NOT NULL)
SELECT district, issue, score, place FROM r WHERE place <= 3""",
    # one position per zip code and type: the latest load, the ratio guarded, the most complete and largest first
    "zip_to_position": """WITH z AS (SELECT *, row_number() OVER (PARTITION BY zip_code, state_postal_code, district_type, district_name ORDER BY loaded_at DESC, voters_in_zip_district DESC NULLS LAST, voters_in_zip DESC NULLS LAST) AS newest FROM {zip_code_to_l2_district} WHERE zip_code IS NOT NULL),
x AS (SELECT zip_code, district_type, state_postal_code, district_name, CAST(voters_in_zip_district AS DOUBLE) / nullif(voters_in_zip, 0) AS share,
  (CASE WHEN state_postal_code IS NULL THEN 0 ELSE 1 END) + (CASE WHEN district_name IS NULL THEN 0 ELSE 1 END) + (CASE WHEN voters_in_zip_district IS NULL THEN 0 ELSE 1 END) AS known FROM z WHERE newest = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY zip_code, district_type ORDER BY known DESC, share DESC NULLS LAST, district_name NULLS LAST, state_postal_code NULLS LAST) AS place, count(*) OVER (PARTITION BY zip_code, district_type) AS n_positions FROM x)
SELECT zip_code, district_type, state_postal_code, district_name, round(share, 9) AS share, n_positions FROM r WHERE place = 1""",
    # statewide totals are exact, all others are rolled up from their parts
    "district_totals": """WITH latest AS (SELECT district_id, total_constituents, row_number() OVER (PARTITION BY district_id ORDER BY updated_at DESC, total_constituents DESC NULLS LAST) AS newest FROM {districtstats} WHERE district_id IS NOT NULL),
d AS (SELECT id, max(state) AS state, max(district_type) AS kind FROM {district} GROUP BY id),
exact AS (SELECT state, count(DISTINCT id) AS n FROM {voter} WHERE state IS NOT NULL GROUP BY state)
SELECT d.state, d.kind, CAST(sum(total_constituents) AS BIGINT) AS constituents, count(*) AS n_districts, 'rolled up' AS made FROM latest JOIN d ON latest.district_id = d.id WHERE newest = 1 AND kind <> 'State' GROUP BY d.state, d.kind
UNION ALL SELECT state, 'State', n, 1, 'exact' FROM exact""",
    # milestones and how lately a user was active
    "user_base": """WITH e AS (SELECT user_id, min(CASE WHEN event_type = 'signup' THEN ts END) AS first_signup, min(CASE WHEN event_type = 'purchase' THEN ts END) AS first_purchase, max(ts) AS last_seen, count(*) AS n_events, count(DISTINCT event_type) AS n_types FROM {events} GROUP BY user_id),
n AS (SELECT max(ts) AS now_ts FROM {events})
SELECT user_id, first_signup, first_purchase, last_seen, n_events, n_types, first_purchase < first_signup AS bought_before, last_seen > now_ts - INTERVAL '7' DAY AS active_7d, last_seen > now_ts - INTERVAL '30' DAY AS active_30d, last_seen > now_ts - INTERVAL '90' DAY AS active_90d FROM e CROSS JOIN n""",
    # funnel flags of a contact, the first touch of any kind, and what was won
    "prospects": """WITH o AS (SELECT o_custkey, min(o_orderdate) AS first_order, count(*) AS n_orders, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS won FROM {orders} GROUP BY o_custkey),
e AS (SELECT user_id, min(ts) AS first_event, bool_or(event_type = 'signup') AS signed_up, bool_or(event_type = 'purchase') AS purchased FROM {events} GROUP BY user_id),
t AS (SELECT c_custkey, c_mktsegment, coalesce(n_orders, 0) AS n_orders, coalesce(won, 0.0) AS won, coalesce(signed_up, false) AS signed_up, coalesce(purchased, false) AS purchased,
  least(coalesce(first_order, TIMESTAMP '9999-12-31 00:00:00'), coalesce(first_event, TIMESTAMP '9999-12-31 00:00:00')) AS touch FROM {customer} LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN e ON user_id = c_custkey)
SELECT c_custkey, c_mktsegment, n_orders, won, signed_up, purchased, CASE WHEN touch < TIMESTAMP '9999-12-31 00:00:00' THEN touch END AS first_touch, CASE WHEN won > 0 THEN 'won' WHEN n_orders > 0 THEN 'engaged' WHEN signed_up OR purchased THEN 'lead' ELSE 'contact' END AS funnel FROM t""",
    # a person of one id a source at most; attributes come from one representative record, flags from all
    "people": """WITH r AS (SELECT DISTINCT concat_ws('|', state, lower(trim(last_name)), lower(trim(first_name))) AS person, unique_id, source_name, party, email, official_office_name, term_start_date, term_end_date FROM {dummy_data_elected} WHERE last_name IS NOT NULL AND first_name IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY CASE source_name WHEN 'gp_api' THEN 1 WHEN 'ballotready' THEN 2 WHEN 'techspeed' THEN 3 ELSE 4 END, CASE WHEN email IS NULL THEN 1 ELSE 0 END, unique_id, party NULLS LAST, email NULLS LAST) AS place FROM r)
SELECT person, CASE WHEN count(DISTINCT CASE WHEN source_name = 'ballotready' THEN unique_id END) = 1 THEN max(CASE WHEN source_name = 'ballotready' THEN unique_id END) END AS ballotready_id,
  CASE WHEN count(DISTINCT CASE WHEN source_name = 'gp_api' THEN unique_id END) = 1 THEN max(CASE WHEN source_name = 'gp_api' THEN unique_id END) END AS gp_api_id,
  max(CASE WHEN place = 1 THEN unique_id END) AS representative_id, max(CASE WHEN place = 1 THEN party END) AS party, max(CASE WHEN place = 1 THEN email END) AS email, count(DISTINCT source_name) AS n_sources, count(DISTINCT official_office_name) > 1 AS several_offices, bool_or(term_end_date IS NULL) AS has_open_term FROM p GROUP BY person""",
    # officials and their terms from two merges; a term nobody has a record for is left out by the inner join
    "office_holders": """WITH t AS (SELECT DISTINCT unique_id, source_name, state, official_office_name, term_start_date AS s, term_end_date AS e FROM {dummy_data_elected} WHERE term_start_date IS NOT NULL),
people AS (SELECT unique_id, min(last_name) AS last_name, min(first_name) AS first_name FROM {dummy_data_elected} WHERE last_name IS NOT NULL GROUP BY unique_id),
w AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY s, e NULLS LAST, official_office_name NULLS LAST, state NULLS LAST) AS term_no, lead(s) OVER (PARTITION BY unique_id ORDER BY s, e NULLS LAST, official_office_name NULLS LAST, state NULLS LAST) AS next_s FROM t)
SELECT w.unique_id, term_no, last_name, first_name, @DATE_TEXT(s, @YMD) AS started, @DATE_TEXT(least(coalesce(e, DATE '9999-12-31'), coalesce(next_s, DATE '9999-12-31')), @YMD) AS ended, e IS NULL AND next_s IS NULL AS is_current FROM w JOIN people ON w.unique_id = people.unique_id""",
    # records of two tables under one schema; names' aliases beside them; a value that most records have tells nothing and is a wildcard
    "prematch": """WITH u AS (SELECT DISTINCT 'stage' AS kind, unique_id, source_name, state, lower(trim(first_name)) AS first, lower(trim(last_name)) AS last, party, office_level FROM {dummy_data}
  UNION ALL SELECT DISTINCT 'elected', unique_id, source_name, state, lower(trim(first_name)), lower(trim(last_name)), party, office_level FROM {dummy_data_elected}),
n AS (SELECT kind, count(*) AS n_all FROM u GROUP BY kind),
c AS (SELECT u.kind, office_level, count(*) AS n_level, max(n_all) AS n_all FROM u JOIN n ON u.kind = n.kind WHERE office_level IS NOT NULL GROUP BY u.kind, office_level)
SELECT u.kind, unique_id, source_name, state, nullif(first, '') AS first, nullif(last, '') AS last, party, CASE WHEN 2 * n_level > n_all THEN NULL ELSE u.office_level END AS office_level
FROM u LEFT JOIN c ON u.kind = c.kind AND u.office_level = c.office_level""",
    # the subscription that covers a day; open ones count in good standing only
    "subscribed_on_day": """WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate AS started, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '90' DAY END AS ended, o_orderstatus <> 'P' AS good FROM {orders})
SELECT o_custkey, count(*) AS n_covering, max(o_orderkey) AS latest_order FROM s WHERE started <= TIMESTAMP '1997-06-01 00:00:00' AND (ended > TIMESTAMP '1997-06-01 00:00:00' OR (ended IS NULL AND good)) GROUP BY o_custkey""",
    # a feed of a rolling window of event time under the receiver's names, without what it must not get
    "crm_feed": """SELECT o_orderkey AS "External ID", o_custkey AS "Contact ID", @DATE_TEXT(o_orderdate, @YMD) AS "Order Day", round(o_totalprice, 2) AS "Amount" FROM {orders} AS o
WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL '365' DAY FROM {orders}) AND NOT EXISTS (SELECT 1 FROM {lineitem} AS l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""",
    # names of places under their parents, two hops up; a name that two places share gets the place's id
    "place_hierarchy": """WITH p AS (SELECT s_suppkey, concat_ws('/', lower(replace(r_name, ' ', '-')), lower(replace(n_name, ' ', '-')), CAST(s_suppkey % 7 AS STRING)) AS slug FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey),
n AS (SELECT slug, count(*) AS n FROM p GROUP BY slug)
SELECT s_suppkey, CASE WHEN n > 1 THEN concat_ws('-', p.slug, CAST(s_suppkey AS STRING)) ELSE p.slug END AS slug, n AS n_alike FROM p JOIN n ON p.slug = n.slug""",
    # a fixed number of rows drawn by a hash of the key, the same ones every time
    "sample_rows": """SELECT o_orderkey, o_custkey, o_orderstatus FROM {orders} ORDER BY md5(concat('draw', CAST(o_orderkey AS STRING))), o_orderkey LIMIT 500""",
    # voters for agents: a hashed key, an allow-list of columns, one row an id
    "agent_voters": """SELECT md5(concat_ws('|', 'agent', lower(trim(id)))) AS voter_key, min(upper(trim(state))) AS state, max(active) AS active, max(year(birthdate)) AS birth_year, count(*) AS n_records FROM {voter} WHERE id IS NOT NULL GROUP BY md5(concat_ws('|', 'agent', lower(trim(id))))""",
    # the stage of an election from its flags and its name, and the natural key of a source without ids
    "stage_keys": """WITH e AS (SELECT DISTINCT unique_id, state, candidate_office, official_office_name, district_identifier, election_date, election_stage, is_special FROM {election_stage_input}),
f AS (SELECT *, lower(election_stage) LIKE 'primary%' AS is_primary, lower(election_stage) LIKE '%runoff%' AS is_runoff, coalesce(is_special, false) AS special FROM e)
SELECT unique_id, concat_ws(' ', CASE WHEN is_primary THEN 'Primary' ELSE 'General' END, CASE WHEN special THEN 'Special' END, CASE WHEN is_runoff THEN 'Runoff' END) AS stage,
  md5(concat_ws('-', concat('techspeed', 'salt_string'), concat(coalesce(state, ''), 'salt_string'), concat(coalesce(candidate_office, ''), 'salt_string'), concat(coalesce(official_office_name, ''), 'salt_string'),
  concat(coalesce(district_identifier, ''), 'salt_string'), concat('', 'salt_string'), concat(coalesce(@DATE_TEXT(election_date, @YMD), ''), 'salt_string'), concat(coalesce(election_stage, ''), 'salt_string'))) AS stage_key FROM f""",
}


def _spoken(text: str, which: int) -> str:
    for w in WORDS:
        text = text.replace(w[0], w[which])
    return text


def _from_text(sql: str):
    names = sorted(set(re.findall(r"\{(\w+)\}", sql)))

    def run(spark: SparkSession, d: str) -> DataFrame:
        return spark.sql(sql, **{n: table(spark, d, n) for n in names})

    return run


def queries() -> dict:
    return {k: _from_text(re.sub(r'"([^"]+)"', r"`\1`", _spoken(s, 1))) for k, s in TEXTS.items()}


def oracle_sql() -> dict[str, str]:
    return {k: re.sub(r"\{(\w+)\}", r"\1", _spoken(s, 2)) for k, s in TEXTS.items()}
