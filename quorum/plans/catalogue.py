"""All queries of the core, with the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorum.plans import analytic, drift, general, relational, relations

FLAGSHIP = "sessionize_gap"
PARTS = [general, drift, relational, analytic, relations]
#: days are compared as texts, as clients differ in how they read them
DAYS = {"interval_join": ["day"], "metric_simple": ["period"], "metric_cumulative": ["period"], "scd2_snapshot": ["valid_from", "valid_to"], "election_days": ["day"], "multi_format_dates": ["day"], "sessionize_gap": ["week"]}


def _days_as_text(query, days: list[str]):
    return lambda spark, d: query(spark, d).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in days})


def queries() -> dict:
    own = {k: q for p in PARTS for k, q in p.queries().items()}
    return own | {k: _days_as_text(own[k], days) for k, days in DAYS.items()}


def oracle_sql() -> dict[str, str]:
    own = {k: q for p in PARTS for k, q in p.oracle_sql().items()}
    return own | {k: "SELECT * REPLACE (" + ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in days) + f") FROM ({own[k]})" for k, days in DAYS.items()}
