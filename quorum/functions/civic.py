"""Offices, districts, stages, census values and election days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing about an office's locality.
OFFICE_STOP_WORDS = """
city of the county board council school district mayor alderperson trustee at large zone ward seat position commission precinct town village member councilmember supervisor supervisors commissioner judge
branch education unified public elementary consolidated central special independent office clerk treasurer coroner sheriff magistrate property value administrator emergency services director justice peace
representative house representatives legislature legislative metro president attorney executive municipal assessor auditor recorder register surveyor constable marshal comptroller controller prosecutor
councilor councilman councilwoman alderman alderwoman selectman selectperson freeholder and for no odd unexpired township twp borough regional community area local high authority committee members schools
trustees councillor post place group division at-large atlarge
""".split()
# Keywords of office categories, the first that matches decides.
OFFICE_CATEGORIES = [
    ("school", r"school|education"),
    ("council", r"council|councillor|councilor|alderman|selectman|commission|trustee"),
    ("mayor", r"mayor"), ("clerk", r"clerk"), ("treasurer", r"treasurer"), ("supervisor", r"supervisor"), ("judge", r"judge"),
]
# Office types, by what a candidate's office is called in full, or is like; the first that fits decides.
OFFICE_TYPES = [
    ("Alderman", ["alderman", "alderperson"], []),
    ("Attorney", [], ["%attorney%"]),
    ("City Council", ["city commission", "city commissioner", "city council", "town chair", "township council"], []),
    ("Clerk/Treasurer", ["clerk", "treasurer", "city clerk", "township clerk", "clerk/treasurer", "county court clerk"], ["county clerk%", "county treasurer%"]),
    ("Congressional", ["congressional", "u.s. representative", "u.s. senator"], []),
    ("County Supervisor", ["county commissioner", "county council", "county trustee", "county legislature"], ["county executive%", "county legislat%", "board of supervisor%"]),
    ("Judge", ["circuit court", "district court", "probate court", "supreme court"], ["%judge%", "%magistrate%", "%justice of the peace%", "%appellate court%", "%supreme court%"]),
    ("Mayor", ["mayor", "village president", "township mayor"], []),
    ("President", ["president"], []),
    ("School Board", ["board of education", "school board"], []),
    ("Sheriff", ["constable", "county constable", "sheriff"], ["county sheriff%"]),
    ("State House", ["house of delegates", "house of representatives", "state assembly", "state house", "state representative"], []),
    ("State Senate", ["state senate", "state senator"], []),
    ("Statewide/Governor", ["governor", "lieutenant governor"], []),
    ("Town Council", ["town council", "town trustee", "township supervisor", "village board", "village council", "village trustee"], []),
]
# Office levels by what a race's name is like; the first that fits decides.
OFFICE_LEVELS = [("County", [], ["%county%"]), ("State", [], ["%state senate%", "%state house%", "%state assembly%", "%state circuit court%", "%court of appeals%"])]
# Words before a seat's number, words before a district's name.
SEAT_WORDS = "ward|seat|post|place|group|division|precinct|zone|district"
DISTRICT_WORDS = "District|Ward|Place|Branch|Subdistrict|Zone|Precinct|Position|Area|Region|Circuit|Division|Post|Section|Subdivision|Seat"
GEOGRAPHIC_WORDS = "District|Ward|Place|Branch|Subdistrict|Zone|Precinct|Area|Region|Circuit|Division|Subdivision"
# Census codes that stand for no value, and for no error.
NO_ESTIMATE = [-999999999, -888888888, -666666666]
NO_MARGIN = [-999999999, -888888888, -333333333, -222222222]
CONTROLLED = -555555555
# Geographies kept of the census files.
GEO_SUMMARY_LEVELS = ["150", "040", "050", "160", "010", "950", "960", "970"]
# Depth of election stages.
STAGE_DEPTH = {"primary": 1, "primary runoff": 2, "general": 3, "general runoff": 4}
ROMAN = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x"]


def office_tokens(c: Column) -> Column:
    """Distinctive words of an office's name: without stop words, numbers and single letters; r-iv becomes r-4."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), r"r-\s+", "r-"), r"no\.\s+(\d+)", "no. $1 r-$1")
    words = F.transform(F.split(s, " "), lambda t: F.regexp_replace(t, r"\p{Punct}+$", ""))
    roman = F.create_map(*[F.lit(x) for i, r in enumerate(ROMAN) for x in (f"r-{r}", f"r-{i + 1}")])
    arabic = F.transform(words, lambda t: F.coalesce(F.try_element_at(roman, t), t))
    return F.filter(arabic, lambda t: (F.length(t) > 1) & ~t.rlike("^[0-9]+$") & ~t.isin(OFFICE_STOP_WORDS))


def office_category(c: Column) -> Column:
    s = F.lower(c)
    local_board = s.rlike(r"\b(village|town|township|borough)\b") & s.rlike(r"\bboard\b")
    out = F.when(s.rlike(OFFICE_CATEGORIES[0][1]), OFFICE_CATEGORIES[0][0]).when(s.rlike(OFFICE_CATEGORIES[1][1]) | local_board, "council")
    for name, pattern in OFFICE_CATEGORIES[2:]:
        out = out.when(s.rlike(pattern), name)
    return out.otherwise("other")


def _first_like(c: Column, table: list[tuple[str, list[str], list[str]]], other: str) -> Column:
    s, out = F.lower(c), F.lit(other)
    for name, whole, like in reversed(table):
        fits = s.isin(whole)
        for pattern in like:
            fits = fits | s.like(pattern)
        out = F.when(fits, name).otherwise(out)
    return out


def office_type(c: Column) -> Column:
    """A candidate's office in one of the office types, 'Other' for what fits none and for null."""
    return _first_like(c, OFFICE_TYPES, "Other")


def office_level(c: Column) -> Column:
    """County, State or Local, by a race's name."""
    return _first_like(c, OFFICE_LEVELS, "Local")


def seat_designator(c: Column) -> Column:
    """The number after a seat word, else 'atlarge', else a number at the end, else null."""
    s = F.lower(c)
    numbered, trailing = F.regexp_extract(s, rf"({SEAT_WORDS}) *#? *([0-9]+)", 2), F.regexp_extract(s, "([0-9]+) *$", 1)
    return F.coalesce(F.nullif(numbered, F.lit("")), F.when(s.rlike("at.?large"), "atlarge"), F.nullif(trailing, F.lit("")))


def office_match_keys(c: Column) -> list[Column]:
    return [F.array_sort(office_tokens(c)).alias("locality_key"), office_category(c).alias("office_category"), seat_designator(c).alias("seat_designator")]


def district_raw(c: Column) -> Column:
    return F.coalesce(F.regexp_extract(c, rf"- (?:{DISTRICT_WORDS}) (.+)$", 1), F.lit(""))


def district_geographic(c: Column) -> Column:
    """The district's name without the seat in it."""
    named = F.regexp_extract(c, rf"- (?:{GEOGRAPHIC_WORDS}) (.+)$", 1)
    return F.coalesce(F.trim(F.regexp_replace(named, r", *(Place|Position|Seat|Post|Section|Group) +.*$", "")), F.lit(""))


def district_number(c: Column) -> Column:
    by_word, by_rank = F.regexp_extract(c, rf"- (?:{DISTRICT_WORDS}) ([0-9]+)", 1), F.regexp_extract(c, "([0-9]+)(?:st|nd|rd|th) Congressional", 1)
    return F.coalesce(by_word.try_cast("int"), by_rank.try_cast("int"))


def stage_type(c: Column) -> Column:
    """A stage in lower case; a runoff that does not say of what follows a general election."""
    return F.when(c == "runoff", "general runoff").otherwise(F.lower(c))


def stage_depth(c: Column) -> Column:
    """How far a stage is through the cycle: 1 primary to 4 general runoff, special ones alike, 0 for anything else."""
    plain, out = F.regexp_replace(c, "^(primary|general) special", "$1"), F.lit(0)
    for name, depth in STAGE_DEPTH.items():
        out = F.when(plain == name, depth).otherwise(out)
    return out


def census_estimate(c: Column) -> Column:
    n = c.cast("bigint")
    return F.when(~n.isin(NO_ESTIMATE), n)


def census_margin(c: Column) -> Column:
    n = c.cast("bigint")
    return F.when(n == CONTROLLED, 0.0).when(~n.isin(NO_MARGIN), c.cast("double"))


def census_estimate_sum(*cols: Column) -> Column:
    """The sum of the estimates; null if one has none."""
    out = F.lit(0).cast("bigint")
    for c in cols:
        out = out + census_estimate(c)
    return out


def census_margin_rss(*cols: Column) -> Column:
    """The margin of a sum: root of the summed squares; null if one is missing."""
    out = F.lit(0.0)
    for c in cols:
        out = out + F.pow(census_margin(c), 2)
    return F.sqrt(out)


def census_kept_geography(geo_id: Column) -> Column:
    return (F.substring(geo_id, 4, 6) == "0000US") & F.left(geo_id, F.lit(3)).isin(GEO_SUMMARY_LEVELS)


def november_election_day(year: Column) -> Column:
    """The Tuesday after the first Monday of November."""
    return F.date_add(F.next_day(F.date_sub(F.make_date(year, F.lit(11), F.lit(1)), 1), "Mon"), 1)


def not_before(flag: Column, effective: Column, *dates: Column) -> Column:
    """flag, but false if there is an effective date and every date is missing or earlier."""
    all_early = effective.isNotNull()
    for d in dates:
        all_early = all_early & F.coalesce(d < effective, F.lit(True))
    return F.when(all_early, False).otherwise(flag)


def all_false(*flags: Column) -> Column:
    """Whether every flag is known to be false; an unknown flag fails."""
    out = F.lit(True)
    for f in flags:
        out = out & F.coalesce(~f, F.lit(False))
    return out
