"""Column lists chosen by policy, by name or by what tables have."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def in_families(df: DataFrame, classification: dict[str, str], families: list[str]) -> list[str]:
    """The table's columns whose family is allowed, in the table's order. A column without a family is not: the list fails closed."""
    return [c for c in df.columns if classification.get(c) in families]


def excluding(df: DataFrame, classification: dict[str, str], families: list[str]) -> list[str]:
    """The table's classified columns whose family is not denied; unclassified ones are left out too."""
    return [c for c in df.columns if c in classification and classification[c] not in families]


def matching(df: DataFrame, pattern: str) -> list[str]:
    """The table's columns whose whole name matches."""
    return [c for c in df.columns if re.fullmatch(pattern, c)]


def compare_schemas(tables: dict[str, DataFrame]) -> list[tuple[str, str, list[str]]]:
    """(column, problem, tables) for every column that some tables lack ('missing') or have in another type ('type <its types>')."""
    kinds: dict[str, dict[str, str]] = {}
    for name, df in tables.items():
        for c, kind in df.dtypes:
            kinds.setdefault(c, {})[name] = kind
    out = []
    for c in sorted(kinds):
        if lacking := sorted(set(tables) - set(kinds[c])):
            out.append((c, "missing", lacking))
        if len(types := sorted(set(kinds[c].values()))) > 1:
            out.append((c, "type " + ", ".join(types), sorted(kinds[c])))
    return out
