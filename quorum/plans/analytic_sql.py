"""The SQL that states the results of the analytic queries."""

from quorum.functions import civic

_IN = "','".join

_TOKENS = r"""list_filter(list_transform(list_transform(string_split(regexp_replace(regexp_replace(lower(x), 'r-\s+', 'r-', 'g'), 'no\.\s+(\d+)', 'no. \1 r-\1', 'g'), ' '),
  lambda t: regexp_replace(t, '[!-/:-@\[-`{-~]+$', '')), lambda t: coalesce(map_extract(MAP {ROMAN}, t)[1], t)), lambda t: length(t) > 1 AND NOT regexp_matches(t, '^[0-9]+$') AND t NOT IN ('STOP'))"""
_TOKENS = _TOKENS.replace("ROMAN", ", ".join(f"'r-{r}': 'r-{i + 1}'" for i, r in enumerate(civic.ROMAN))).replace("STOP", _IN(civic.OFFICE_STOP_WORDS))

def _case(column: str, table: list[tuple[str, list[str], list[str]]], other: str) -> str:
    arms = []
    for name, whole, like in table:
        fits = [f"lower({column}) = '{w}'" for w in whole] + [f"lower({column}) LIKE '{p}'" for p in like]
        arms.append(f"WHEN {' OR '.join(fits)} THEN '{name}'")
    return f"CASE {' '.join(arms)} ELSE '{other}' END"


SQL: dict[str, str] = {
    "office_types": f"SELECT DISTINCT unique_id, official_office_name, {_case('candidate_office', civic.OFFICE_TYPES, 'Other')} AS office_type, {_case('official_office_name', civic.OFFICE_LEVELS, 'Local')} AS office_level FROM dummy_data",
    "term_frequencies": """WITH e AS (SELECT DISTINCT unique_id, source_name, lower(last_name) AS last FROM dummy_data_elected), x AS (SELECT last, count(*) AS n FROM e WHERE last IS NOT NULL AND source_name IS NOT NULL GROUP BY 1)
        SELECT last, round(n / sum(n) OVER (), 12) AS tf FROM x""",
    "group_agg": """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_net, round(avg(l_discount), 6) AS avg_disc,
        min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) AS n FROM lineitem GROUP BY 1, 2""",
    "count_distinct_conditional": "SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS pending_customers FROM orders GROUP BY 1",
    "conditional_agg": """SELECT user_id, min(CASE WHEN event_type = 'signup' THEN ts END) AS first_signup, max(CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase, count(*) FILTER (WHERE event_type = 'error') AS n_errors,
        round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS spent, max((props ->> '$.k')::INT) AS top_k FROM events GROUP BY 1""",
    "bool_rollup": "WITH x AS (SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 150000 END AS b FROM orders) SELECT o_custkey, bool_or(b) AS any_big, max(b) AS max_big, bool_and(b) AS all_big FROM x GROUP BY 1",
    "max_by_fallback": """SELECT o_custkey, coalesce(first(o_orderkey ORDER BY o_totalprice DESC, o_orderkey DESC) FILTER (WHERE o_orderstatus <> 'P'), max(o_orderkey)) AS pick, first(o_orderstatus ORDER BY o_orderdate, o_orderkey) AS first_status FROM orders GROUP BY 1""",
    "mode_deterministic": "SELECT l_suppkey, mode_value, mode_count FROM (SELECT l_suppkey, l_partkey % 7 AS mode_value, count(*) AS mode_count FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY mode_count DESC, mode_value) = 1",
    "collect_sorted_structs": "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate DESC, o_orderkey DESC) AS keys, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
    "percentile_iqr_outliers": """WITH q AS (SELECT event_type, count(value) AS n_rows, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
        SELECT q.event_type, n_rows, round(q1, 4) AS q1, round(q3, 4) AS q3, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers FROM events JOIN q USING (event_type) GROUP BY ALL""",
    "rollup_all_label": """SELECT o_orderstatus, year(o_orderdate)::INT AS year, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1, 2
        UNION ALL SELECT 'all', year(o_orderdate)::INT, count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus <> 'P' GROUP BY 2""",
    "safe_ratio": "SELECT zip_code, round(sum(voters_in_zip_district)::DOUBLE / nullif(sum(CASE WHEN voters_in_zip > 3000 THEN voters_in_zip ELSE 0 END)::DOUBLE, 0), 8) AS ratio FROM zip_code_to_l2_district GROUP BY 1",
    "bucket_histogram": """WITH n AS (SELECT c_mktsegment, coalesce(CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' WHEN c_custkey % 10 <> 0 THEN 'high' END, 'Unknown') AS label, count(*) AS c FROM customer GROUP BY 1, 2),
        t AS (SELECT *, sum(c) OVER (PARTITION BY c_mktsegment)::BIGINT AS total FROM n)
        SELECT c_mktsegment, max(total) AS total, string_agg(label || ':' || c || ':' || round(round(c / total * 100, 2))::INT, ',' ORDER BY label DESC) AS buckets FROM t GROUP BY 1""",
    "mass_allocation": """WITH m AS (SELECT c_nationkey, sum(o_totalprice) AS magnitude FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
        s AS (SELECT s_suppkey, s_nationkey, magnitude, greatest(s_acctbal, 0) / nullif(sum(greatest(s_acctbal, 0)) OVER (PARTITION BY s_nationkey), 0) AS share FROM supplier JOIN m ON s_nationkey = c_nationkey)
        SELECT s_suppkey, s_nationkey, round(share, 8) AS share, round(share * magnitude, 2) AS allocated FROM s""",
    "majority_membership": """SELECT o_custkey, o_orderstatus, round(share, 8) AS share FROM (SELECT o_custkey, o_orderstatus, count(*) / sum(count(*)) OVER (PARTITION BY o_custkey) AS share FROM orders GROUP BY 1, 2) WHERE share > 0.5""",
    "rss_margin": """SELECT p_partkey, CASE WHEN p_size NOT IN (1, 2) THEN (p_size * 10 + p_size)::BIGINT END AS estimate,
        round(CASE WHEN p_size = 4 THEN NULL WHEN p_size = 3 THEN sqrt(pow(4, 2)) ELSE sqrt(pow(p_size, 2) + pow(p_size + 1, 2)) END, 6) AS margin FROM part""",
    "wilson_interval": """WITH g AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS k FROM orders GROUP BY 1)
        SELECT o_custkey, round(100 * (k / n), 1) AS point_pct, round(100 * (k / n + z2 / (2 * n) - z * sqrt((k / n * (1 - k / n) + z2 / (4 * n)) / n)) / (1 + z2 / n), 1) AS lo_pct,
        round(100 * (k / n + z2 / (2 * n) + z * sqrt((k / n * (1 - k / n) + z2 / (4 * n)) / n)) / (1 + z2 / n), 1) AS hi_pct FROM g, (SELECT 1.96::DOUBLE AS z, 3.8416::DOUBLE AS z2)""",
    "count_once": """WITH m AS (SELECT o_orderpriority AS cohort, o_custkey, count(DISTINCT o_orderstatus) AS s FROM orders GROUP BY 1, 2) SELECT cohort, count(*) AS once, sum(s)::BIGINT AS per_seat FROM m GROUP BY 1""",
    "metric_simple": "SELECT date_trunc('month', o_orderdate)::DATE AS period, o_orderstatus AS status, count(*) AS large_orders FROM orders WHERE o_totalprice > 100000 GROUP BY 1, 2",
    "metric_cumulative": """WITH p AS (SELECT unnest(generate_series(DATE '1992-01-01', DATE '1999-01-01', INTERVAL 1 MONTH))::DATE AS period),
        n AS (SELECT date_trunc('month', o_orderdate)::DATE AS period, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
        SELECT period, sum(coalesce(n, 0)) OVER (ORDER BY period)::BIGINT AS cumulative_finished FROM p LEFT JOIN n USING (period)""",
    "ranked_pick": """SELECT state, official_office_name, unique_id FROM (SELECT DISTINCT unique_id, state, official_office_name, email, election_date FROM dummy_data)
        QUALIFY row_number() OVER (PARTITION BY state, official_office_name ORDER BY email IS NULL, election_date DESC NULLS LAST, unique_id) = 1""",
    "topk_per_group": "SELECT o_orderpriority, o_orderkey, o_totalprice, row_number() OVER w AS rnk FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) QUALIFY row_number() OVER w <= 5",
    "window_totals": "SELECT s_suppkey, s_nationkey, round(sum(s_acctbal) OVER w, 2) AS total, count(*) OVER w AS n, count(*) FILTER (WHERE s_acctbal < 0) OVER w AS n_debt, max(s_acctbal) OVER w AS top FROM supplier WINDOW w AS (PARTITION BY s_nationkey)",
    "first_value_ignore_nulls": """SELECT unique_id, first_value(email IGNORE NULLS) OVER w AS email, first_value(phone IGNORE NULLS) OVER w AS phone FROM (SELECT DISTINCT state, official_office_name, unique_id, email, phone FROM dummy_data_elected)
        WINDOW w AS (PARTITION BY state, official_office_name ORDER BY unique_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "sessionize_gap": """WITH v AS (SELECT user_id, ts, coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1800 SECOND, true) AS is_new FROM events WHERE event_type IN ('view', 'click'))
        SELECT user_id, date_trunc('week', ts)::DATE AS week, count(*) FILTER (WHERE is_new) AS visits, count(*) AS views FROM v GROUP BY 1, 2""",
    "window_collect_union": """WITH e AS (SELECT DISTINCT unique_id, state, candidate_office, source_name FROM dummy_data_elected),
        s AS (SELECT state, candidate_office, string_agg(DISTINCT source_name, ',' ORDER BY source_name) AS sources FROM e GROUP BY 1, 2)
        SELECT unique_id, sources FROM e JOIN s ON e.state IS NOT DISTINCT FROM s.state AND e.candidate_office IS NOT DISTINCT FROM s.candidate_office""",
    "sibling_resolution": r"""WITH k AS (SELECT DISTINCT district_id AS k FROM districtstats WHERE total_constituents > 20000),
        x AS (SELECT DISTINCT id, state, district_type, upper(trim(regexp_replace(regexp_replace(district_name, '[0-9 ]+$', ''), '\s+', ' ', 'g'))) AS short, k FROM district LEFT JOIN k ON id = k)
        SELECT DISTINCT id, CASE WHEN k IS NOT NULL THEN id WHEN count(k) OVER w = 1 THEN max(k) OVER w ELSE id END AS resolved_id FROM x WINDOW w AS (PARTITION BY state, district_type, short)""",
    "trailing_window_flags": """WITH m AS (SELECT max(ts) AS now FROM events), s AS (SELECT user_id, max(ts) AS seen FROM events GROUP BY 1)
        SELECT user_id, seen > now - INTERVAL 1 DAY AS active_1d, seen > now - INTERVAL 7 DAY AS active_7d, seen > now - INTERVAL 30 DAY AS active_30d FROM s CROSS JOIN m""",
    "tumbling_week": "SELECT date_trunc('week', ts)::TIMESTAMP AS week_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "unpivot": "SELECT unique_id, name, value FROM (SELECT unique_id, party, email, phone, district_raw FROM (SELECT DISTINCT * FROM dummy_data_elected)) UNPIVOT (value FOR name IN (party, email, phone, district_raw))",
    "stack_reshape": "SELECT 'discount' AS kind, round(sum(l_discount), 2) AS total, count(l_discount) AS n FROM lineitem UNION ALL SELECT 'tax', round(sum(l_tax), 2), count(l_tax) FROM lineitem",
    "unpivot_dynamic": "SELECT unique_id, field, label FROM (SELECT DISTINCT unique_id, office_type, office_level, candidate_office FROM election_stage_input) UNPIVOT (label FOR field IN (candidate_office, office_level, office_type))",
    "pivot_conditional": "SELECT o_orderpriority, " + ", ".join(f"round(coalesce(sum(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END), 0), 2) AS total_{s.lower()}" for s in "FOP") + " FROM orders GROUP BY 1",
    "incremental_watermark": "SELECT event_id, ts, user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id < 6000)",
    "incremental_per_key": "WITH l AS (SELECT user_id AS u, max(ts) AS m FROM events WHERE event_id < 6000 AND user_id % 7 <> 0 GROUP BY 1) SELECT event_id, ts, user_id FROM events LEFT JOIN l ON u = user_id WHERE m IS NULL OR ts > m",
    "affected_key_recompute": """SELECT zip_code, count(*) AS n, sum(voters_in_zip_district)::BIGINT AS voters, max(loaded_at) AS last_load FROM zip_code_to_l2_district
        WHERE zip_code IN (SELECT zip_code FROM zip_code_to_l2_district WHERE loaded_at >= TIMESTAMP '2026-01-04' AND voters_in_zip > 2000 AND zip_code IS NOT NULL) GROUP BY 1""",
    "version_fingerprint": """SELECT o_custkey, max(o_orderkey) AS o_orderkey, o_orderstatus, o_orderpriority, max(o_orderkey) = max(max(o_orderkey)) OVER (PARTITION BY o_custkey) AS is_latest FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority""",
    "scd2_snapshot": """WITH s AS (SELECT district_id, updated_at::DATE AS day, max(floor(total_constituents / 1000))::BIGINT AS thousands FROM districtstats WHERE district_id IS NOT NULL GROUP BY 1, 2),
        d AS (SELECT day, lead(day) OVER (ORDER BY day) AS nx, lag(day) OVER (ORDER BY day) AS pv FROM (SELECT DISTINCT day FROM s)),
        r AS (SELECT s.*, nx, CASE WHEN lag(s.thousands) OVER w IS NOT DISTINCT FROM s.thousands AND lag(s.day) OVER w = pv THEN 0 ELSE 1 END AS n FROM s JOIN d USING (day) WINDOW w AS (PARTITION BY district_id ORDER BY s.day)),
        g AS (SELECT *, sum(n) OVER (PARTITION BY district_id ORDER BY day) AS run FROM r)
        SELECT district_id, thousands, min(day) AS valid_from, last(nx ORDER BY day) AS valid_to FROM g GROUP BY district_id, run, thousands""",
    "mint_canonical_id": """WITH e AS (SELECT DISTINCT unique_id, concat_ws('|', state, lower(last_name), lower(first_name)) AS person, coalesce(term_start_date, DATE '9999-12-31') AS seen FROM dummy_data_elected),
        f AS (SELECT person, first(unique_id ORDER BY seen, unique_id) AS anchor, md5(first(unique_id ORDER BY seen, unique_id) || 'canonical') AS h FROM e GROUP BY 1)
        SELECT person, anchor, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS canonical_id FROM f""",
    "salted_ids": """WITH x AS (SELECT o_orderkey, md5(o_orderkey || 'salt_string-' || o_orderstatus || 'salt_string') AS h FROM orders) SELECT o_orderkey, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS id FROM x""",
    "election_ids": """WITH x AS (SELECT unique_id, md5(array_to_string(list_transform([official_office_name, candidate_office, office_level, office_type, state, '', district_identifier, seat_name,
        coalesce(year(election_date)::VARCHAR, '') || CASE WHEN is_special THEN '_special' ELSE '' END, ''], lambda v: coalesce(v, '') || 'salt_string'), '-')) AS h FROM election_stage_input)
        SELECT DISTINCT unique_id, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS election_id FROM x""",
    "slugs": r"""SELECT DISTINCT unique_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(concat_ws('-', official_office_name, state))), '[^a-z0-9\s/-]', '', 'g'), '\s+', '-', 'g'), '-{2,}', '-', 'g'), '/{2,}', '-', 'g'), '-/') AS slug FROM election_stage_input""",
    "text_normalization": r"""SELECT DISTINCT unique_id, CASE WHEN trim(coalesce(party, '')) = '' THEN NULL WHEN party ILIKE '%independent%' THEN 'Independent' WHEN party ILIKE '%nonpartisan%' THEN 'Nonpartisan' WHEN party ILIKE '%democrat%' THEN 'Democrat'
        WHEN party ILIKE '%republican%' THEN 'Republican' WHEN party ILIKE '%libertarian%' THEN 'Libertarian' WHEN party ILIKE '%green%' THEN 'Green' ELSE 'Other' END AS party,
        nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS digits, trim(regexp_replace(regexp_replace(last_name, ' (jr\.?|sr\.?|ii+|iv|v|i ii)$', '', 'i'), ' (jr\.?|sr\.?|ii+|iv|v|i ii)$', '', 'i')) AS last,
        regexp_replace(lower(first_name), '[^a-z]', '', 'g') AS letters, array_to_string(list_filter(string_split(regexp_replace(lower(first_name), '[^a-z ]', ' ', 'g'), ' '), lambda t: length(t) >= 2), '+') AS tokens,
        coalesce(partisan_type = 'partisan', false) AS partisan, CASE WHEN trim(coalesce(state, '')) <> '' AND trim(coalesce(office_type, '')) <> '' THEN lower(trim(state)) || '__' || regexp_replace(lower(trim(office_type)), '\s+', '-', 'g') END AS code FROM dummy_data""",
    "office_match_keys": "SELECT x AS official_office_name, array_to_string(list_sort(" + _TOKENS + r"""), ' ') AS locality_key,
        CASE WHEN regexp_matches(lower(x), 'school|education') THEN 'school' WHEN regexp_matches(lower(x), 'council|councillor|councilor|alderman|selectman|commission|trustee') OR (regexp_matches(lower(x), '\b(village|town|township|borough)\b') AND regexp_matches(lower(x), '\bboard\b')) THEN 'council'
        WHEN lower(x) LIKE '%mayor%' THEN 'mayor' WHEN lower(x) LIKE '%clerk%' THEN 'clerk' WHEN lower(x) LIKE '%treasurer%' THEN 'treasurer' WHEN lower(x) LIKE '%supervisor%' THEN 'supervisor' WHEN lower(x) LIKE '%judge%' THEN 'judge' ELSE 'other' END AS office_category,
        coalesce(nullif(regexp_extract(lower(x), '(WORDS) *#? *([0-9]+)', 2), ''), CASE WHEN regexp_matches(lower(x), 'at.?large') THEN 'atlarge' END, nullif(regexp_extract(lower(x), '([0-9]+) *$', 1), '')) AS seat_designator
        FROM (SELECT DISTINCT official_office_name AS x FROM election_stage_input)""".replace("WORDS", civic.SEAT_WORDS),
    "district_parts": r"""WITH n AS (SELECT DISTINCT regexp_replace(official_office_name, ' \(?(District|Ward|Area) ', ' - \1 ', 'g') AS name FROM dummy_data)
        SELECT name, regexp_extract(name, '- (?:ALLWORDS) (.+)$', 1) AS raw, trim(regexp_replace(regexp_extract(name, '- (?:GEOWORDS) (.+)$', 1), ', *(Place|Position|Seat|Post|Section|Group) +.*$', '')) AS geographic,
        coalesce(TRY_CAST(nullif(regexp_extract(name, '- (?:ALLWORDS) ([0-9]+)', 1), '') AS INT), TRY_CAST(nullif(regexp_extract(name, '([0-9]+)(?:st|nd|rd|th) Congressional', 1), '') AS INT)) AS number FROM n""".replace("ALLWORDS", civic.DISTRICT_WORDS).replace("GEOWORDS", civic.GEOGRAPHIC_WORDS),
    "election_days": "SELECT y::BIGINT AS year, (make_date(y, 11, 1) + ((8 - isodow(make_date(y, 11, 1))) % 7 + 1)::INT)::DATE AS day FROM (SELECT unnest(range(1990, 2040)) AS y)",
    "stage_depths": """SELECT election_stage, stage, CASE WHEN stage IN ('general runoff', 'general special runoff') THEN 4 WHEN stage IN ('general', 'general special') THEN 3 WHEN stage IN ('primary runoff', 'primary special runoff') THEN 2 WHEN stage IN ('primary', 'primary special') THEN 1 ELSE 0 END AS depth
        FROM (SELECT DISTINCT election_stage, CASE WHEN election_stage = 'runoff' THEN 'general runoff' ELSE lower(election_stage) END AS stage FROM election_stage_input)""",
    "json_fields": "SELECT event_id, TRY_CAST(nullif(props ->> '$.k', '') AS BIGINT) AS k, CASE WHEN props ->> '$.k' = '1' THEN true WHEN props ->> '$.k' = '0' THEN false END AS k_flag, NULL::DATE AS absent FROM events",
    "event_families": """SELECT user_id, CASE event_type WHEN 'signup' THEN 'account' WHEN 'purchase' THEN 'conversion' WHEN 'error' THEN 'fault' WHEN 'view' THEN 'engagement' WHEN 'click' THEN 'engagement' ELSE 'other' END AS family,
        count(*) AS n, count(DISTINCT ts::DATE) > 1 AS is_recurrent FROM events GROUP BY 1, 2""",
    "freshness_lag": "SELECT state_id, max(loaded_at) AS last_at, floor((epoch((SELECT max(loaded_at) FROM load__l2_s3_to_databricks)) - epoch(max(loaded_at))) / 3600)::BIGINT AS lag_hours FROM load__l2_s3_to_databricks GROUP BY 1",
    "tri_state_gate": """SELECT o_orderkey, CASE WHEN o_orderdate::DATE < DATE '1995-06-01' THEN false WHEN o_orderstatus <> 'P' THEN o_totalprice > 100000 END AS eligible, o_orderstatus <> 'P' AND o_totalprice <= 100000 AS clean FROM orders""",
    "multi_format_dates": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN make_date(2024, 7, (p_partkey % 28 + 1)::INT) WHEN 2 THEN DATE '2023-05-17' END AS day FROM part",
    "deidentified": """WITH x AS (SELECT sha256(concat_ws('|', coalesce(state, ''), coalesce(residence_addresses_city, ''), coalesce(residence_addresses_zip, ''), coalesce(lastname, ''))) AS household, state, year(birthdate)::INT AS y FROM voter)
        SELECT household, state, count(*) AS members, min(y) AS oldest FROM x GROUP BY 1, 2""",
    "connected_components": """WITH RECURSIVE o AS (SELECT o_custkey AS c, concat_ws('|', o_orderdate::DATE::VARCHAR, o_orderpriority) AS k FROM orders), h AS (SELECT k, min(c) AS b FROM o GROUP BY 1),
        e AS (SELECT DISTINCT c AS a, b FROM o JOIN h USING (k) WHERE c <> b), w AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
        l(v, component) USING KEY (v) AS (SELECT a, min(least(a, b)) FROM w GROUP BY a
          UNION SELECT w.a, min(l.component) FROM l JOIN w ON w.b = l.v JOIN recurring.l AS u ON u.v = w.a WHERE l.component < u.component GROUP BY w.a)
        SELECT v, component, count(*) OVER (PARTITION BY component) AS n_vertices FROM l""",
    "connected_components_all": """WITH RECURSIVE o AS (SELECT o_custkey AS c, concat_ws('|', o_orderdate::DATE::VARCHAR, o_orderpriority) AS k FROM orders), h AS (SELECT k, min(c) AS b FROM o GROUP BY 1),
        e AS (SELECT DISTINCT c AS a, b FROM o JOIN h USING (k) WHERE c <> b), w AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
        walk AS (SELECT DISTINCT a AS v, a AS r FROM w UNION SELECT b, min(r) FROM walk JOIN w ON v = a WHERE r < b GROUP BY b),
        l AS (SELECT v, min(r) AS component FROM walk GROUP BY 1) SELECT v, component, count(*) OVER (PARTITION BY component) AS n_vertices FROM l""",
    "similarity_scores": "SELECT p_brand AS brand, min(p_name) AS a, max(p_name) AS b, round(jaro_winkler_similarity(min(p_name), max(p_name)), 6) AS jw FROM part GROUP BY 1",
    "interval_bounds": """WITH g AS (SELECT l_suppkey, round(sum(l_discount * l_quantity), 4) AS projected, sum(l_quantity) AS size FROM lineitem GROUP BY 1),
        r AS (SELECT *, CASE WHEN size > 0 THEN least(greatest(projected / size, 0), 1) END AS rate, greatest(round(projected), 3.0) AS point FROM g),
        w AS (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN sqrt(1 - rate) ELSE sqrt(rate * (1 - rate)) END AS w FROM r)
        SELECT l_suppkey, point, CASE WHEN l_suppkey % 4 <> 0 THEN least(greatest(round(least(greatest(rate - 0.1 * w, 0), 1) * size), 3.0), point) END AS lower, CASE WHEN l_suppkey % 4 <> 0 THEN greatest(greatest(round(least(greatest(rate + 0.12 * w, 0), 1) * size), 3.0), point) END AS upper FROM w""",
    "waterfall_scoring": """WITH o AS (SELECT o_custkey, max((o_totalprice > 250000)::INT) AS y FROM orders GROUP BY 1),
        x AS (SELECT *, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN c_mktsegment ELSE 'Other' END AS seg FROM customer LEFT JOIN o ON c_custkey = o_custkey),
        w AS (SELECT seg, round(ln((sum(y) + 0.5) / (count(*) FILTER (WHERE y = 0) + 0.5)), 6) AS woe FROM x WHERE y IS NOT NULL GROUP BY 1)
        SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN 1.0 WHEN y IS NOT NULL THEN coalesce(woe, 0) ELSE 0 END::DOUBLE AS score, CASE WHEN c_acctbal > 9000 THEN 'balance' WHEN y IS NOT NULL AND woe IS NOT NULL THEN 'segment' ELSE 'default' END AS model FROM x LEFT JOIN w USING (seg)""",
    "state_as_of": """WITH e AS (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-15'),
        g AS (SELECT user_id, last(event_type ORDER BY ts, event_id) FILTER (WHERE event_type <> 'error') AS signal, max(ts) FILTER (WHERE event_type <> 'error') AS a, max(ts) FILTER (WHERE event_type = 'error') AS f FROM e GROUP BY 1)
        SELECT user_id, CASE WHEN f IS NULL OR f < a THEN signal END AS state FROM g""",
    "scalar_if_unambiguous": """SELECT state, lower(last_name) AS last, CASE WHEN count(DISTINCT party) = 1 THEN max(party) END AS party, CASE WHEN count(DISTINCT office_type) = 1 THEN max(office_type) END AS office, count(*) AS n FROM dummy_data_elected GROUP BY 1, 2""",
    "fail_closed_resolution": "SELECT o_custkey, year(o_orderdate)::INT AS year, max(o_orderpriority) AS priority FROM orders GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT o_orderpriority) = 1",
    "share_projection": """SELECT zip_code, state_postal_code, district_type, district_name, round(10000 * voters_in_zip_district / voters_in_zip, 4) AS projected FROM zip_code_to_l2_district WHERE voters_in_zip_district BETWEEN 1 AND voters_in_zip AND zip_code IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY zip_code, state_postal_code, district_type ORDER BY loaded_at DESC, voters_in_zip_district DESC, district_name) = 1""",
    "geo_slugs": r"""WITH x AS (SELECT DISTINCT id, state, district_type, district_name FROM district), s AS (SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(concat_ws('-', state, district_type, regexp_replace(district_name, ' [0-9]+$', '')))), '[^a-z0-9\s/-]', '', 'g'), '\s+', '-', 'g'), '-{2,}', '-', 'g'), '/{2,}', '-', 'g'), '-/') AS slug FROM x)
        SELECT id, CASE WHEN count(*) OVER (PARTITION BY slug) > 1 THEN concat_ws('-', slug, id) ELSE slug END AS slug FROM s""",
    "canonical_crosswalk": """WITH e AS (SELECT DISTINCT unique_id, source_name, concat_ws('|', state, lower(last_name), lower(official_office_name)) AS cluster FROM dummy_data_elected),
        c AS (SELECT cluster, count(DISTINCT CASE WHEN source_name = 'ballotready' THEN unique_id END) AS n, min(CASE WHEN source_name = 'ballotready' THEN unique_id END) AS anchor, min(unique_id) AS least FROM e GROUP BY 1)
        SELECT unique_id, coalesce(anchor, least) AS canonical_id FROM e JOIN c USING (cluster) WHERE n <= 1""",
}
