"""Radius joins of names by metric-space partitioning.

The names of a group are assigned to the nearest of sampled pivots. By the triangle inequality every name
within radius r of a name whose nearest pivot is p has a distance to p of at most its own nearest distance
plus 2r, so names are replicated to those cells and an exact join inside each cell finds every pair. The
metric is Levenshtein's. In a cell of one block all meet; in a larger one those meet that become equal when
up to r letters are left out of each, as all pairs within r do, so that the cost of a cell grows with its
names and not with their square. Names too long for that meet in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.operators.graph import cut_and_sum
from quorum.session import cut

#: a group of n names has the root of n / CELL pivots; names in a block
CELL, BLOCK = 256, 1024
#: letters up to which a name's forms with letters left out are made in large cells
KEYED = 32


def _unit(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


def radius_join(names: DataFrame, radius: int) -> DataFrame:
    """grp, name_a < name_b, distance of all pairs of different names of one group within ``radius`` edits.

    ``names`` has grp and name; repeats and null names or groups do not count. Each pair comes once. Names of
    any length are compared whole.
    """
    n = cut(names.where(F.col("grp").isNotNull() & F.col("name").isNotNull()).select("grp", "name").distinct())
    sizes, n_large = cut_and_sum(n.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("name").alias("h"), F.col("name").alias("name"))).getField("name").alias("least")), (F.col("n") > CELL).cast("int"))
    small = n.join(sizes.where(F.col("n") <= CELL).select("grp", F.col("least").alias("pivot")), "grp").select("grp", "name", "pivot", F.levenshtein("name", "pivot").alias("d"), F.lit(True).alias("is_home"))
    if not n_large:  # every group is one cell and one block
        return _distances(_in_blocks(cut(small).withColumns({"hb": F.lit(1), "vb": F.lit(1)}), radius))
    want = F.ceil(F.sqrt(F.col("n") / CELL))
    sampled = n.join(sizes.where(F.col("n") > CELL), "grp").where((_unit("name") < want / F.col("n")) | (F.col("name") == F.col("least"))).select("grp", F.col("name").alias("pivot"))
    near = n.join(sampled, "grp").withColumn("d", F.levenshtein("name", "pivot"))
    per_name = near.groupBy("grp", "name").agg(F.min(F.struct("d", "pivot")).alias("home"), F.collect_list(F.struct("pivot", "d")).alias("all"))
    cells = per_name.select("grp", "name", F.col("home.pivot").alias("nearest"), F.explode(F.filter("all", lambda x: x["d"] <= F.col("home.d") + 2 * radius)).alias("c")).select("grp", "name", F.col("c.pivot").alias("pivot"), F.col("c.d").alias("d"), (F.col("c.pivot") == F.col("nearest")).alias("is_home"))
    placed = cut(cells.unionByName(small))
    blocks = placed.groupBy("grp", "pivot").agg(F.ceil(F.count_if("is_home") / BLOCK).cast("int").alias("hb"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("vb")).where("hb > 0")
    blocks, n_large = cut_and_sum(blocks, (F.col("vb") > 1).cast("int"))
    sized = placed.join(blocks, ["grp", "pivot"])
    if not n_large:
        return _distances(_in_blocks(sized, radius))
    large, long = F.col("vb") > 1, F.length("name") > KEYED
    return _distances(_in_blocks(sized.where(~large | long), radius).unionByName(_by_keys(sized.where(large & (F.length("name") <= KEYED + radius)), radius)))


def _distances(pairs: DataFrame) -> DataFrame:
    return pairs.select("grp", F.least("x", "y").alias("name_a"), F.greatest("x", "y").alias("name_b"), F.levenshtein("x", "y").alias("distance")).distinct()


def _close(radius: int) -> Column:
    """Names x and y within the radius. The triangle inequality once more: their distances to the pivot differ by the radius at most."""
    return (F.abs(F.col("dx") - F.col("dy")) <= radius) & (F.abs(F.length("x") - F.length("y")) <= radius) & (F.col("x") != F.col("y")) & (~F.col("y_home") | (F.col("x") < F.col("y"))) & (F.levenshtein("x", "y", radius) >= 0)


def _in_blocks(sized: DataFrame, radius: int) -> DataFrame:
    """grp, x, y of the homes x and names y of a cell, which meet in blocks so that no task holds more than a block pair."""
    block = lambda k: F.pmod(F.xxhash64("name"), F.col(k)).cast("int")
    spread = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    homes = sized.where("is_home").select("grp", "pivot", F.col("name").alias("x"), F.col("d").alias("dx"), block("hb").alias("h"), spread("vb").alias("v"))
    visitors = sized.select("grp", "pivot", F.col("name").alias("y"), F.col("d").alias("dy"), F.col("is_home").alias("y_home"), block("vb").alias("v"), spread("hb").alias("h"))
    return homes.join(visitors, ["grp", "pivot", "h", "v"]).where(_close(radius)).select("grp", "x", "y")


def without_letters(name: Column, most: int) -> Column:
    """The name and its forms with up to ``most`` letters left out."""
    out = last = F.array(name)
    for _ in range(most):
        less = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
        last = F.array_distinct(F.flatten(F.transform(last, less)))
        out = F.array_distinct(F.concat(out, last))
    return out


def _by_keys(sized: DataFrame, radius: int) -> DataFrame:
    """grp, x, y of the homes x and names y of a cell that have a form with letters left out in common."""
    keyed = sized.select("grp", "pivot", "name", "d", "is_home", F.explode(without_letters(F.col("name"), radius)).alias("k")).withColumn("k", F.xxhash64("grp", "pivot", "k"))
    homes = keyed.where("is_home").select("k", "grp", "pivot", F.col("name").alias("x"), F.col("d").alias("dx"))
    visitors = keyed.select("k", F.col("grp").alias("y_grp"), F.col("pivot").alias("y_pivot"), F.col("name").alias("y"), F.col("d").alias("dy"), F.col("is_home").alias("y_home"))
    same_cell = (F.col("grp") == F.col("y_grp")) & (F.col("pivot") == F.col("y_pivot"))
    return homes.join(visitors, "k").where(same_cell & _close(radius)).select("grp", "x", "y")


def snap_to_frequent(words: DataFrame, radius: int = 2, times: int = 4) -> DataFrame:
    """grp, name, snapped: each word and the word of its group it is a misspelling of, or itself.

    ``words`` has grp, name and n. A word is a misspelling of the nearest, then most frequent, word within
    ``radius`` edits that is at least ``times`` as frequent.
    """
    w = cut(words.groupBy("grp", "name").agg(F.sum("n").alias("n")))
    near = cut(radius_join(w.where("name <> ''"), radius))
    both = near.unionByName(near.select("grp", F.col("name_b").alias("name_a"), F.col("name_a").alias("name_b"), "distance"))
    a, b = w.select("grp", F.col("name").alias("name_a"), F.col("n").alias("n_a")), w.select("grp", F.col("name").alias("name_b"), F.col("n").alias("n_b"))
    best = both.join(a, ["grp", "name_a"]).join(b, ["grp", "name_b"]).where(F.col("n_b") >= times * F.col("n_a")).groupBy("grp", F.col("name_a").alias("name")).agg(F.min(F.struct("distance", (-F.col("n_b")).alias("m"), "name_b")).getField("name_b").alias("to"))
    return w.join(best, ["grp", "name"], "left").select("grp", "name", F.coalesce("to", "name").alias("snapped"))
