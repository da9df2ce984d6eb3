"""Text normalization and classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for true and false.
TRUE_WORDS = ["true", "yes", "1", "y"]
FALSE_WORDS = ["false", "no", "0", "n"]
# Parties by keyword, the first that occurs decides.
PARTIES = ["Independent", "Nonpartisan", "Democrat", "Republican", "Libertarian", "Green"]
# Fixed value: generational suffixes at the end of a name.
NAME_SUFFIX = r"(?i) (jr\.?|sr\.?|ii+|iv|v|i ii)$"
# Forms of stage suffixes and of place estimates in district names.
STAGE_SUFFIX = r"__(primary|general|runoff)$"
ESTIMATE_SUFFIX = r"\s*\(EST\.\)$"


def slugify(*parts: Column | str) -> Column:
    """Lower case, hyphens between words and parts, nothing but a-z, 0-9, '-' and '/'; null parts drop out."""
    s = F.lower(F.trim(F.concat_ws("-", *parts)))
    for pattern, by in ((r"[^a-z0-9\s\-/]", ""), (r"\s+", "-"), (r"-{2,}", "-"), (r"/{2,}", "-")):
        s = F.regexp_replace(s, pattern, by)
    return F.btrim(s, F.lit("-/"))


def to_boolean(c: Column, true_words: list[str] = TRUE_WORDS, false_words: list[str] = FALSE_WORDS) -> Column:
    """true, false, or null for anything else; case and surrounding blanks do not matter."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(true_words), True).when(word.isin(false_words), False)


def digits_only(c: Column) -> Column:
    """The digits of a phone number; null if there are none."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def first_keyword(c: Column, rules: dict[str, str], otherwise: str | None) -> Column:
    """The label of the first rule (keyword -> label) whose keyword occurs in any case; null for blank texts."""
    out = F.when(F.length(F.trim(F.coalesce(c, F.lit("")))) == 0, F.lit(None).cast("string"))
    for word, label in rules.items():
        out = out.when(c.ilike(f"%{word}%"), label)
    return out.otherwise(otherwise)


def party(c: Column) -> Column:
    return first_keyword(c, {p.lower(): p for p in PARTIES}, "Other")


def without_suffix(c: Column) -> Column:
    """A name without generational suffixes at its end, two at most."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, NAME_SUFFIX, ""), NAME_SUFFIX, ""))


def letters_only(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def name_tokens(c: Column) -> Column:
    """Words of two letters or more."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z ]", " "), " "), lambda t: F.length(t) >= 2)


def district_name(c: Column) -> Column:
    """Single blanks, upper case, without the mark of an estimate."""
    return F.upper(F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), ESTIMATE_SUFFIX, ""))


def without_state_prefix(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(F.trim(c)), "^[a-z]{2} ", ""), F.lit(""))


def without_stage_suffix(c: Column) -> Column:
    return F.regexp_replace(c, STAGE_SUFFIX, "")


def code_of(*parts: Column) -> Column:
    """Parts lower-cased and joined by '__'; null if any is null or blank."""
    blank = F.lit(False)
    for p in parts:
        blank = blank | (F.trim(F.coalesce(p, F.lit(""))) == "")
    return F.when(~blank, F.concat_ws("__", *[F.regexp_replace(F.lower(F.trim(p)), r"\s+", "-") for p in parts]))


def json_columns(doc: Column, registry: list[tuple[str, str, str]]) -> list[Column]:
    """The typed columns that a registry of (column, field, kind) names."""
    return [json_field(doc, field, kind).alias(name) for name, field, kind in registry]


def json_field(doc: Column, field: str, kind: str) -> Column:
    """A typed field of a JSON text that never raises: '' and malformed values are null.

    kind: string (as it is), boolean, or a SQL type; int_via_float takes whole numbers written with a point.
    """
    raw = F.get_json_object(doc, f"$.{field}")
    if kind == "string":
        return raw
    if kind == "boolean":
        return to_boolean(raw)
    full = F.nullif(raw, F.lit(""))
    return full.try_cast("double").try_cast("int") if kind == "int_via_float" else full.try_cast(kind)
