"""String similarities that Spark lacks."""

from __future__ import annotations

from itertools import combinations
from math import ceil

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

PREFIX, WEIGHT, BOOST = 4, 0.1, 0.7


def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro's similarity, raised for a common prefix of up to PREFIX letters if it is above BOOST."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [c for c, t in zip(b, taken) if t]
    half = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - half) / m) / 3
    if jaro <= BOOST:
        return jaro
    same = 0
    for x, y in zip(a[:PREFIX], b[:PREFIX]):
        if x != y:
            break
        same += 1
    return jaro + same * WEIGHT * (1 - jaro)


@F.pandas_udf(DoubleType())
def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(None)
        else:
            if (x, y) not in known:
                known[x, y] = jaro_winkler_of(x, y)
            out.append(known[x, y])
    return pd.Series(out, dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    """Null if a side is null. Costs a pass through Python: compare within blocks, on distinct texts."""
    return _jaro_winkler(a, b)


def jaro_winkler_at_least(a: Column, b: Column, least: float) -> Column:
    """jaro_winkler where it can be ``least`` or more by the letters in common, 0 elsewhere; null if a side is null.

    What falls short is told by built-in functions, and costs Python no more than a null.
    """
    long, short = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    lead = F.when(F.substring(a, 1, PREFIX) == F.substring(b, 1, PREFIX), PREFIX).otherwise(PREFIX - 1) * F.lit(WEIGHT)
    reach = lambda m: (m / long + m / short + 1) / 3 * (1 - lead) + lead >= least - 1e-9
    may = (long > 0) & reach(short) & reach(common_letters(a, b)) & (a != b)
    return F.when(a == b, 1.0).when(a.isNotNull() & b.isNotNull(), F.coalesce(_jaro_winkler(F.when(may, a), F.when(may, b)), F.lit(0.0)))


#: letters from rare to frequent; any fixed order is right, this one makes small blocks
RARE_FIRST = "qjzxvkwybpgfmucdlhrsnioate"
KEY = 3


def near_keys_of(s: str, least: float) -> list[str]:
    """Texts with jaro_winkler_of >= least (above BOOST) share one of these keys: the first PREFIX letters, or letters in common.

    Texts that share fewer letters at their beginning have a Jaro similarity of at least j, so the m letters in
    common are at least 3j - 2 of the longer one. Of two sets with m elements in common, ordered alike, the
    first n - m + KEY of each (of n) have KEY of these in common.
    """
    j = min((least - n * WEIGHT) / (1 - n * WEIGHT) for n in range(PREFIX))
    seen: dict[str, int] = {}
    letters = []
    for c in s:
        seen[c] = seen.get(c, 0) + 1
        letters.append((-seen[c], RARE_FIRST.find(c), c))
    letters.sort()
    m = max(ceil((3 * j - 2) * len(s) - 1e-9), KEY)
    parts = ["".join(f"{c}{-k}" for k, _, c in x) for x in combinations(letters[: len(s) - m + KEY], KEY)] if len(s) >= KEY else []
    parts += ["".join(f"{c}{-k}" for k, _, c in x) for n in range(1, KEY) for x in combinations(letters, n)] if len(s) * (3 * j - 2) < KEY - 1 + 1e-9 else []
    return sorted({*parts, "=" + s, *(["^" + s[:PREFIX]] if len(s) >= PREFIX else [])})


def near_keys(x: Column, least: float) -> Column:
    """An array of keys of which texts with jaro_winkler >= least share one; null for null. Apply to distinct texts."""

    @F.pandas_udf(ArrayType(StringType()))
    def keys(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else near_keys_of(t, least))

    return keys(x)


def common_letters(x: Column, y: Column) -> Column:
    """How many letters x and y have in common, each as often as both have it: no less than Jaro's matches."""
    distinct = F.array_distinct(F.split(x, ""))
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c))
    return F.aggregate(distinct, F.lit(0), lambda n, c: n + F.least(count(x, c), count(y, c)))
