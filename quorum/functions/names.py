"""Parts of a person's full name, as a vectorized function of SQL and DataFrames."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Words around and inside names.
TITLES = {"dr", "mr", "mrs", "ms", "miss", "rev", "hon", "prof", "sir", "judge"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "v", "phd", "md", "esq", "dds"}
PARTICLES = {"de", "la", "del", "der", "den", "di", "da", "du", "le", "van", "von", "st", "saint", "bin", "al", "mc", "mac", "dos", "das"}
PARTS = ["title", "first", "middle", "last", "suffix", "nickname"]
SCHEMA = StructType([StructField(p, StringType()) for p in PARTS])


def parse(full: str | None) -> tuple[str | None, ...] | None:
    """(title, first, middle, last, suffix, nickname); missing parts are null, a null or blank name is null."""
    if full is None or not full.strip():
        return None
    nick = re.search(r'"([^"]*)"|\(([^)]*)\)', full)
    nickname = next((g for g in nick.groups() if g), None) if nick else None
    rest = re.sub(r'"[^"]*"|\([^)]*\)', " ", full)
    bare = lambda w: w.lower().rstrip(".,")
    if "," in rest and bare(rest.split(",", 1)[1].strip()) not in SUFFIXES:  # last, first
        last, first = rest.split(",", 1)
        rest = f"{first} {last}"
        forced = len(last.split())
    else:
        rest, forced = rest.replace(",", " "), 0
    words, titles, suffixes = rest.split(), [], []
    while len(words) > 1 and bare(words[0]) in TITLES:
        titles.append(words.pop(0))
    while len(words) > 1 and bare(words[-1]) in SUFFIXES:
        suffixes.insert(0, words.pop())
    cut = len(words) - forced if forced else len(words) - 1
    while not forced and cut > 1 and bare(words[cut - 1]) in PARTICLES:
        cut -= 1
    first, middle, last = (words[:1], words[1:cut], words[max(cut, 1) :]) if len(words) > 1 else (words, [], [])
    text = lambda ws: " ".join(ws) or None
    return text(titles), text(first), text(middle), text(last), text(suffixes), nickname


@F.pandas_udf(SCHEMA)
def parse_human_name(names: pd.Series) -> pd.DataFrame:
    none = (None,) * 6
    return pd.DataFrame([parse(n) or none for n in names], columns=PARTS)


def register(spark: SparkSession) -> None:
    """Makes parse_human_name callable from SQL."""
    spark.udf.register("parse_human_name", parse_human_name)
