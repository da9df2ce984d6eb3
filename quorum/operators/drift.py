"""Schemas that drift between files: a catalogue of column lifespans.

Every file's header and value kinds are exploded into catalogue rows (producer, file number, column, kind).
lag over the file numbers of a column cuts its life into islands; starts and endings of islands are the
changes. A start and an ending at one file are one renaming if the two columns hold the same values. Chains
of renamings give an alias table, from which the casts of the consistent table are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorum.operators.graph import cut_and_sum
from quorum.operators.sizes import broadcast_if_small
from quorum.session import cut

BLANKS = " \t\r\n "
SAME_VALUES = 0.9
# Patterns of the kinds of value.
KINDS = {"integer": r"^-?(0|[1-9]\d*)$", "point": r"^-?(0|[1-9]\d*)\.\d+$", "iso date": r"^\d{4}-\d{2}-\d{2}$", "us date": r"^\d{2}/\d{2}/\d{4}$", "flag": r"^[YN]$", "bool": r"^(true|false)$"}


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def split_line(line: Column, is_tab: Column) -> Column:
    """The fields of a delimited line; double quotes around a field are removed and doubled ones undone."""

    def by(sep: str) -> Column:
        # a separator before every field, so that each match has at least one character
        quoted = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(rf'{sep}(\s*"[^"]*+(?:""[^"]*+)*+"[^{sep}]*|[^{sep}]*)'), F.lit(1))
        return F.when(F.instr(line, '"') > 0, quoted).otherwise(F.split(line, sep, -1))

    def plain(x: Column) -> Column:
        t = _trim(x)
        return F.when(t.rlike('^"[\\s\\S]*"$') & (F.length(t) > 1), F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))).otherwise(t)

    return F.transform(F.when(is_tab, by("\t")).otherwise(by(",")), lambda x: _trim(plain(x)))


def numbered_files(log: DataFrame) -> DataFrame:
    """One row per file name: file_id, file, producer (table name), seq (its place by the date in its name).

    ``log`` has id, loaded_at, source_file_name, table_name, table_path. A file loaded twice counts once, by
    its first load. A null table_name is taken from the other files whose names differ in the date alone
    (same state and type), else from the table_path. Files without a date in their name come first.
    """
    once = log.where(F.col("source_file_name").isNotNull()).groupBy(F.col("source_file_name").alias("file")).agg(F.min(F.struct("loaded_at", "id")).getField("id").alias("file_id"), F.max("table_name").alias("t"), F.max("table_path").alias("p"))
    day, sort = F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2})", 1), F.regexp_replace("file", r"\d{4}-\d{2}-\d{2}", "")
    alike = Window.partitionBy("sort")
    named = once.withColumns({"day": day, "sort": sort}).withColumn("producer", F.coalesce("t", F.max("t").over(alike), F.substring_index("p", ".", -1), F.lit("")))
    return named.select("file_id", "file", "producer", F.row_number().over(Window.partitionBy("producer").orderBy("day", "file")).alias("seq"))


def file_lines(lines: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headers: producer, seq, file, file_id, names), (records: producer, seq, file, file_id, line_no, names, fields).

    ``lines`` has file_load_id, line_no, raw_line; line 0 is the header. Null and blank lines and lines of
    files not in ``files`` are left out. A name that occurs twice in a header stands for its first column.
    """
    split = lines.select("file_load_id", "line_no", F.regexp_replace("raw_line", "^﻿", "").alias("raw_line")).where(F.length(_trim(F.regexp_replace("raw_line", '[",]', " "))) > 0)
    # every line is parsed once
    known = split.join(broadcast_if_small(files), F.col("file_load_id") == F.col("file_id")).select("producer", "seq", "file", "file_id", "line_no", split_line(F.col("raw_line"), F.lower("file").endswith(".tab")).alias("fields"))
    known = cut(known)
    names = F.transform("fields", lambda x: _trim(F.regexp_replace(x, "[﻿\"]", "")))
    headers = known.where("line_no = 0").select("producer", "seq", "file", "file_id", names.alias("names")).dropDuplicates(["file_id"])
    records = known.where("line_no > 0").join(broadcast_if_small(headers.select("file_id", "names")), "file_id").select("producer", "seq", "file", "file_id", "line_no", "names", "fields")
    return headers, records


def cells(records: DataFrame) -> DataFrame:
    """producer, seq, key (the record's first field), name, value ('' for blank and absent fields)."""
    each = F.explode(F.transform(F.array_distinct("names"), lambda n: F.struct(n.alias("name"), F.coalesce(F.get("fields", F.array_position("names", n).cast("int") - 1), F.lit("")).alias("value"))))
    return records.select("producer", "seq", F.get("fields", F.lit(0)).alias("key"), each.alias("c")).select("producer", "seq", "key", "c.name", "c.value")


def catalogue(headers: DataFrame, cell: DataFrame) -> DataFrame:
    """producer, seq, name, kind of every column of every file; kind is null for wholly blank columns."""
    filled = F.col("value") != ""
    hits = {k: F.count_if(filled & F.col("value").rlike(p)) for k, p in KINDS.items()}
    n = cell.groupBy("producer", "seq", "name").agg(F.count_if(filled).alias("n"), *[c.alias(k) for k, c in hits.items()])
    kind = F.when(F.col("n") == 0, None).when(F.col("integer") == F.col("n"), "integer").when((F.col("integer") + F.col("point")) == F.col("n"), "decimal")
    for k in ("iso date", "us date", "flag", "bool"):
        kind = kind.when(F.col(k) == F.col("n"), k)
    kinds = n.select("producer", "seq", "name", kind.otherwise("text").alias("kind"))
    return headers.select("producer", "seq", F.explode(F.array_distinct("names")).alias("name")).join(kinds, ["producer", "seq", "name"], "left")


def lifespans(cat: DataFrame) -> DataFrame:
    """Islands of a column's presence: producer, name, first, last (file numbers), final (the producer's last file)."""
    w = Window.partitionBy("producer", "name").orderBy("seq")
    born = F.when(F.col("seq") - F.lag("seq").over(w) == 1, 0).otherwise(1)
    island = F.sum("born").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ends = cat.groupBy("producer").agg(F.max("seq").alias("final"))
    return cat.withColumn("born", born).withColumn("island", island).groupBy("producer", "name", "island").agg(F.min("seq").alias("first"), F.max("seq").alias("last")).join(ends, "producer").drop("island")


def best_first(pairs: DataFrame) -> DataFrame:
    """pairs (producer, at, old, new, n) with one partner per column, best first: greatest n, then least old and new.

    In a round those pairs stay that are the best of both their columns; a round leaves out what they exclude.
    That gives what taking the best of all, again and again, gives.
    """
    kept = []
    while True:
        top = lambda side: F.row_number().over(Window.partitionBy("producer", "at", side).orderBy(F.col("n").desc(), "old", "new"))
        ranked = cut(pairs.withColumns({"by_old": top("old"), "by_new": top("new")}))
        best = ranked.where("by_old = 1 AND by_new = 1").select("producer", "at", "old", "new", "n")
        kept.append(best)
        left = ranked.where("by_old > 1 OR by_new > 1").select("producer", "at", "old", "new", "n")
        pairs, n = cut_and_sum(left.join(best.select("producer", "at", "old"), ["producer", "at", "old"], "left_anti").join(best.select("producer", "at", "new"), ["producer", "at", "new"], "left_anti").select("producer", "at", "old", "new", "n"), F.lit(1))
        if not n:
            break
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return out


def renamings(spans: DataFrame, cell: DataFrame) -> DataFrame:
    """producer, seq (the later file), old, new: an ending and a start at one file that hold the same values.

    Records are paired by their first field; of records with one key in a file the greatest value counts.
    """
    ended = spans.where("last < final").select("producer", (F.col("last") + 1).alias("at"), F.col("name").alias("old"))
    begun = spans.where("first > 1").select("producer", F.col("first").alias("at"), F.col("name").alias("new"))
    both = ended.select("producer", "at").intersect(begun.select("producer", "at"))

    def side(events: DataFrame, name: str, back: int) -> DataFrame:
        some = broadcast_if_small(events.join(both, ["producer", "at"], "left_semi"))
        return cell.withColumn("at", F.col("seq") + back).withColumnRenamed("name", name).join(some, ["producer", "at", name]).groupBy("producer", "at", "key", name).agg(F.max("value").alias("value"))

    old, new = cut(side(ended, "old", 1)), cut(side(begun, "new", 0))
    shared = old.select("producer", "at", "key").distinct().join(new.select("producer", "at", "key").distinct(), ["producer", "at", "key"]).groupBy("producer", "at").agg(F.count(F.lit(1)).alias("records"))
    same = old.join(new, ["producer", "at", "key", "value"]).groupBy("producer", "at", "old", "new").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") != "").alias("filled"))
    close = same.join(shared, ["producer", "at"]).where((F.col("filled") > 0) & (F.col("n") >= SAME_VALUES * F.col("records"))).select("producer", "at", "old", "new", "n")
    return best_first(close).select("producer", F.col("at").alias("seq"), "old", "new")


def changes(cat: DataFrame, spans: DataFrame, renamed: DataFrame) -> DataFrame:
    """producer, seq (the later file), change, old, new, of every change between a file and the one before."""
    r = renamed.select("producer", "seq", F.lit("renamed").alias("change"), "old", "new")
    ended = spans.where("last < final").select("producer", (F.col("last") + 1).alias("seq"), F.col("name").alias("old"))
    begun = spans.where("first > 1").select("producer", F.col("first").alias("seq"), F.col("name").alias("new"))
    removed = ended.join(renamed, ["producer", "seq", "old"], "left_anti").select("producer", "seq", F.lit("removed").alias("change"), "old", F.lit("").alias("new"))
    added = begun.join(renamed, ["producer", "seq", "new"], "left_anti").select("producer", "seq", F.lit("added").alias("change"), F.lit("").alias("old"), "new")
    w = Window.partitionBy("producer", "name").orderBy("seq")
    stayed = cat.withColumns({"before": F.lag("seq").over(w), "was": F.lag("kind").over(w)}).where((F.col("before") == F.col("seq") - 1) & (F.col("was") != F.col("kind")))
    kinds = cat.select("producer", "seq", "name", "kind")
    moved = (
        renamed.join(kinds.select("producer", (F.col("seq") + 1).alias("seq"), F.col("name").alias("old"), F.col("kind").alias("was")), ["producer", "seq", "old"])
        .join(kinds.withColumnRenamed("name", "new"), ["producer", "seq", "new"])
        .where(F.col("was") != F.col("kind"))
    )
    retyped = stayed.select("producer", "seq", F.lit("retyped").alias("change"), F.col("name").alias("old"), F.col("name").alias("new")).unionByName(moved.select("producer", "seq", F.lit("retyped").alias("change"), "old", "new"))
    return r.unionByName(removed).unionByName(added).unionByName(retyped)


def aliases(cat: DataFrame, spans: DataFrame, renamed: DataFrame) -> DataFrame:
    """producer, name, first, last, final_name, cast: what each life of a column is called and cast to in the consistent table.

    final_name is the last name of the chain of renamings; cast is integer, decimal, date, flag, bool or text,
    the narrowest that holds all kinds of the columns of that final name.
    """
    life = spans.select("producer", "name", "first", "last")
    step = (
        life.join(renamed.select("producer", F.col("old").alias("name"), (F.col("seq") - 1).alias("last"), F.col("new").alias("n_name"), F.col("seq").alias("n_first")), ["producer", "name", "last"], "left")
        .select("producer", "name", "first", "last", F.coalesce("n_name", "name").alias("to_name"), F.coalesce("n_first", "first").alias("to_first"))
    )
    step = cut(step)
    while True:  # chains of pointers, doubled until none moves; one row per life of a column
        on = step.select("producer", F.col("name").alias("to_name"), F.col("first").alias("to_first"), F.col("to_name").alias("x_name"), F.col("to_first").alias("x_first"))
        longer = step.join(on, ["producer", "to_name", "to_first"], "left").select("producer", "name", "first", "last", F.coalesce("x_name", "to_name").alias("x"), F.coalesce("x_first", "to_first").alias("y"), "to_name", "to_first")
        longer = cut(longer)
        moved = not longer.where("x <> to_name OR y <> to_first").isEmpty()
        step = longer.select("producer", "name", "first", "last", F.col("x").alias("to_name"), F.col("y").alias("to_first"))
        if not moved:
            break
    kinds = cat.alias("c").join(step.alias("s"), (F.col("c.producer") == F.col("s.producer")) & (F.col("c.name") == F.col("s.name")) & F.col("c.seq").between(F.col("s.first"), F.col("s.last"))).where("kind IS NOT NULL")
    seen = F.array_sort(F.collect_set("c.kind"))
    has = lambda *ks: F.size(F.array_except(seen, F.array(*map(F.lit, ks)))) == 0
    cast = F.when(has("integer"), "integer").when(has("integer", "decimal"), "decimal").when(has("iso date", "us date"), "date").when(has("flag"), "flag").when(has("bool"), "bool").otherwise("text")
    casts = kinds.groupBy(F.col("s.producer").alias("producer"), F.col("s.to_name").alias("final_name")).agg(cast.alias("cast"))
    return step.withColumnRenamed("to_name", "final_name").join(casts, ["producer", "final_name"], "left").select("producer", "name", "first", "last", "final_name", F.coalesce("cast", F.lit("text")).alias("cast"))


def consistent_records(headers: DataFrame, records: DataFrame, alias: DataFrame) -> DataFrame:
    """producer, file, line_no, values (map of final name to text in the cast's form): one row per record of every file.

    Dates become yyyy-mm-dd, blank values null. Where one file has two columns of one final name, the second
    and later ones get '#2', ... in order of their old names.
    """
    h = headers.select("producer", "seq", "file_id", F.explode(F.array_distinct("names")).alias("name"))
    named = h.alias("h").join(alias.alias("a"), (F.col("h.producer") == F.col("a.producer")) & (F.col("h.name") == F.col("a.name")) & F.col("h.seq").between(F.col("a.first"), F.col("a.last")))
    place = F.row_number().over(Window.partitionBy("file_id", "final_name").orderBy("h.name"))
    rows = named.select("file_id", F.col("h.name").alias("name"), "final_name", "cast", place.alias("k"))
    unique = F.when(F.col("k") > 1, F.concat_ws("#", "final_name", "k")).otherwise(F.col("final_name"))
    per_file = rows.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct(unique.alias("final"), "name", "cast"))).alias("plan"))

    def value(p: Column) -> Column:
        raw = F.get("fields", F.array_position("names", p["name"]).cast("int") - 1)
        us = F.date_format(F.try_to_date(raw, "MM/dd/yyyy"), "yyyy-MM-dd")
        return F.nullif(F.when((p["cast"] == "date") & raw.rlike(KINDS["us date"]), us).otherwise(raw), F.lit(""))

    made = F.map_from_entries(F.transform("plan", lambda p: F.struct(p["final"], value(p))))
    return records.join(broadcast_if_small(per_file), "file_id").select("producer", "file", "line_no", made.alias("values"))
