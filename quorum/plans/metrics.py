"""A small semantic layer: entities' measures and dimensions, simple and cumulative metrics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    expr: str = "1"
    agg: str = "sum"  # sum, count, count_distinct, min, max, avg


@dataclass(frozen=True)
class SemanticModel:
    """A table with a time dimension, named dimensions (SQL) and measures."""

    name: str
    time: str
    dimensions: dict[str, str] = field(default_factory=dict)
    measures: dict[str, Measure] = field(default_factory=dict)


@dataclass(frozen=True)
class Metric:
    name: str
    model: SemanticModel
    measure: str
    filter: str | None = None  # SQL over the dimensions and the table
    cumulative: bool = False


AGGREGATES = {"sum": F.sum, "count": F.count, "count_distinct": F.countDistinct, "min": F.min, "max": F.max, "avg": F.avg}


def registry_of(definitions: dict) -> dict[str, Metric]:
    """Metrics from a parsed definition: {"semantic_models": [...], "metrics": [...]}.

    Filters may name dimensions as {{ Dimension('entity__name') }} and {{ TimeDimension('entity__time', 'grain') }}.
    """
    import re

    models = {}
    for m in definitions["semantic_models"]:
        dims = {d["name"]: d.get("expr", d["name"]) for d in m.get("dimensions", []) if d.get("type") != "time"}
        measures = {x["name"]: Measure(str(x.get("expr", "1")), x.get("agg", "sum")) for x in m["measures"]}
        models |= {x: SemanticModel(m["name"], m["defaults"]["agg_time_dimension"], dims, measures) for x in measures}
    plain = lambda t: re.sub(r"\{\{\s*(?:Time)?Dimension\('(?:\w+?__)?(\w+)'(?:,\s*'\w+')?\)\s*\}\}", r"\1", t) if t else None
    return {m["name"]: Metric(m["name"], models[m["type_params"]["measure"]], m["type_params"]["measure"], plain(m.get("filter")), m["type"] == "cumulative") for m in definitions["metrics"]}


def read_definitions(path: str) -> dict[str, Metric]:
    """The metrics of a YAML or JSON file, or of all such files in a folder."""
    import json
    import pathlib

    at = pathlib.Path(path)
    both: dict[str, list] = {"semantic_models": [], "metrics": []}
    for f in sorted(at.iterdir()) if at.is_dir() else [at]:
        if f.suffix == ".json":
            part = json.loads(f.read_text())
        elif f.suffix in (".yml", ".yaml"):
            import yaml  # only where such files are read

            part = yaml.safe_load(f.read_text()) or {}
        else:
            continue
        for k in both:
            both[k] += part.get(k) or []
    return registry_of(both)


def time_spine(spark: SparkSession, first: str, last: str, grain: str = "day") -> DataFrame:
    return spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}', interval 1 {grain})) AS period")


def query(metric: Metric, table: DataFrame, by: list[str] | None = None, grain: str = "month", spine: tuple[str, str] | None = None) -> DataFrame:
    """period, the ``by`` dimensions and the metric's value.

    A cumulative metric accumulates all time before; with a ``spine`` (first, last day) it has a value for every
    period and group, else for the periods with rows.
    """
    by, m = by or [], metric.model.measures[metric.measure]
    rows = table.withColumns({d: F.expr(e) for d, e in metric.model.dimensions.items()})
    if metric.filter:
        rows = rows.where(F.expr(metric.filter))
    period = F.to_date(F.date_trunc(grain, metric.model.time)).alias("period")
    value = rows.groupBy(period, *by).agg(AGGREGATES[m.agg](F.expr(m.expr)).alias(metric.name))
    if not metric.cumulative:
        return value
    if m.agg not in ("sum", "count"):
        raise ValueError("only sums and counts accumulate")
    if spine:
        periods = time_spine(table.sparkSession, *spine, grain).select(F.to_date(F.date_trunc(grain, "period")).alias("period")).distinct()
        grid = value.select(*by).distinct().crossJoin(F.broadcast(periods)) if by else periods  # the spine is a short list
        value = grid.join(value, ["period", *by], "left").withColumn(metric.name, F.coalesce(metric.name, F.lit(0)))
    run = Window.partitionBy(*by).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return value.withColumn(metric.name, F.sum(metric.name).over(run))
