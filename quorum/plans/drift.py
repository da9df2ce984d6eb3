"""The p5_ queries: schemas that drift between files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum.operators import drift
from quorum.session import cut, table


def _read(spark: SparkSession, d: str):
    files = cut(drift.numbered_files(table(spark, d, "load__l2_s3_to_databricks")))
    headers, records = drift.file_lines(table(spark, d, "l2_raw_lines"), files)
    headers = cut(headers)
    cell = drift.cells(records)
    cat = cut(drift.catalogue(headers, cell))
    spans = cut(drift.lifespans(cat))
    renamed = cut(drift.renamings(spans, cell))
    return files, headers, records, cat, spans, renamed


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    files, _, _, cat, spans, renamed = _read(spark, d)
    found = drift.changes(cat, spans, renamed).join(files.select("producer", "seq", "file"), ["producer", "seq"])
    return found.select(F.col("producer").alias("table_name"), F.col("file").alias("source_file_name"), "change", F.col("old").alias("old_column"), F.col("new").alias("new_column"))


def p5_consistent(spark: SparkSession, d: str) -> DataFrame:
    """Every record of every file under the final names and casts of its table."""
    _, headers, records, cat, spans, renamed = _read(spark, d)
    rows = drift.consistent_records(headers, records, cut(drift.aliases(cat, spans, renamed)))
    return rows.select(F.col("producer").alias("table_name"), F.col("file").alias("source_file_name"), "line_no", "values")


def p5_aliases(spark: SparkSession, d: str) -> DataFrame:
    """The alias table: each life of a column, its final name and its cast."""
    _, _, _, cat, spans, renamed = _read(spark, d)
    return drift.aliases(cat, spans, renamed).select(F.col("producer").alias("table_name"), F.col("name").alias("column_name"), "first", "last", "final_name", "cast")


P5_FOUND_SQL = r"""
WITH f0 AS (SELECT source_file_name AS file, first(id ORDER BY loaded_at, id) AS file_id, max(table_name) AS t, max(table_path) AS p FROM load__l2_s3_to_databricks WHERE source_file_name IS NOT NULL GROUP BY 1),
f1 AS (SELECT *, regexp_extract(file, '(\d{4}-\d{2}-\d{2})', 1) AS day, regexp_replace(file, '\d{4}-\d{2}-\d{2}', '', 'g') AS sort FROM f0),
f2 AS (SELECT file, file_id, day, coalesce(t, max(t) OVER (PARTITION BY sort), regexp_extract(p, '([^.]*)$', 1)) AS producer FROM f1),
f AS (SELECT file, file_id, producer, row_number() OVER (PARTITION BY producer ORDER BY day, file) AS seq FROM f2),
l0 AS (SELECT producer, seq, line_no, regexp_replace(raw_line, '^\x{FEFF}', '') AS x, file LIKE '%.tab' AS tab FROM l2_raw_lines JOIN f ON file_load_id = file_id WHERE trim(replace(replace(raw_line, '"', ' '), ',', ' '), E' \t\r\n') <> ''),
l1 AS (SELECT producer, seq, line_no, CASE WHEN tab AND contains(x, '"') THEN regexp_extract_all(chr(9) || x, '\t("[^"]*(?:""[^"]*)*"[^\t]*|[^\t]*)', 1) WHEN tab THEN string_split(x, chr(9))
  WHEN contains(x, '"') THEN regexp_extract_all(',' || x, ',(\s*"[^"]*(?:""[^"]*)*"[^,]*|[^,]*)', 1) ELSE string_split(x, ',') END AS raw FROM l0),
l AS (SELECT producer, seq, line_no, list_transform(raw, lambda v: trim(CASE WHEN regexp_matches(trim(v), '^"[\s\S]*"$') AND length(trim(v)) > 1 THEN replace(substring(trim(v), 2, length(trim(v)) - 2), '""', '"') ELSE v END, E' \t\r\n')) AS fields FROM l1),
h AS (SELECT producer, seq, list_transform(fields, lambda v: trim(replace(replace(v, '"', ''), chr(65279), ''))) AS names FROM l WHERE line_no = 0),
c AS (SELECT producer, seq, unnest(list_distinct(names)) AS name FROM h),
cell AS (SELECT l.producer, l.seq, l.fields[1] AS k, c.name, coalesce(l.fields[list_position(h.names, c.name)], '') AS v FROM l JOIN h USING (producer, seq) JOIN c USING (producer, seq) WHERE line_no > 0),
kind AS (SELECT producer, seq, name, CASE WHEN bool_and(regexp_matches(v, '^-?(0|[1-9]\d*)$')) THEN 'integer' WHEN bool_and(regexp_matches(v, '^-?(0|[1-9]\d*)(\.\d+)?$')) THEN 'decimal'
  WHEN bool_and(regexp_matches(v, '^\d{4}-\d{2}-\d{2}$')) THEN 'iso' WHEN bool_and(regexp_matches(v, '^\d{2}/\d{2}/\d{4}$')) THEN 'us' WHEN bool_and(v IN ('Y', 'N')) THEN 'flag' WHEN bool_and(v IN ('true', 'false')) THEN 'bool' ELSE 'text' END AS kind FROM cell WHERE v <> '' GROUP BY ALL),
old AS (SELECT producer, seq + 1 AS seq, name AS old FROM c WHERE (producer, seq + 1) IN (SELECT (producer, seq) FROM h) AND (producer, seq + 1, name) NOT IN (SELECT (producer, seq, name) FROM c)),
new AS (SELECT producer, seq, name AS new FROM c WHERE seq > 1 AND (producer, seq - 1, name) NOT IN (SELECT (producer, seq, name) FROM c)),
vals AS (SELECT producer, seq, k, name, max(v) AS v FROM cell GROUP BY ALL),
cand AS (SELECT old.producer, old.seq, old, new, count(*) FILTER (WHERE a.v = b.v) AS n FROM old JOIN new USING (producer, seq) JOIN vals a ON a.producer = old.producer AND a.seq = old.seq - 1 AND a.name = old
  JOIN vals b ON b.producer = old.producer AND b.seq = old.seq AND b.name = new AND b.k = a.k GROUP BY ALL HAVING count(*) FILTER (WHERE a.v = b.v) >= 0.9 * count(*) AND count(*) FILTER (WHERE a.v = b.v AND a.v <> '') > 0),
ren AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY producer, seq, old ORDER BY n DESC, new) = 1 AND row_number() OVER (PARTITION BY producer, seq, new ORDER BY n DESC, old) = 1),
found AS (SELECT producer, seq, 'renamed' AS change, old, new FROM ren
  UNION ALL SELECT producer, seq, 'removed', old, '' FROM old WHERE (producer, seq, old) NOT IN (SELECT (producer, seq, old) FROM ren) UNION ALL SELECT producer, seq, 'added', '', new FROM new WHERE (producer, seq, new) NOT IN (SELECT (producer, seq, new) FROM ren)
  UNION ALL SELECT a.producer, b.seq, 'retyped', a.name, b.name FROM kind a JOIN kind b ON a.producer = b.producer AND b.seq = a.seq + 1 AND a.kind <> b.kind
    AND (a.name = b.name OR (b.producer, b.seq, a.name, b.name) IN (SELECT (producer, seq, old, new) FROM ren)))
SELECT producer AS table_name, file AS source_file_name, change, old AS old_column, new AS new_column FROM found JOIN f USING (producer, seq)
"""


def queries() -> dict:
    return {"p5_found": p5_found, "p5_consistent": p5_consistent, "p5_aliases": p5_aliases}


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_FOUND_SQL}
