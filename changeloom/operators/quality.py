"""Data-quality checks: each returns the failing rows (or values), and
``dq_report`` folds a list of checks into one report DataFrame.

Failure counts follow the declarative-test conventions: ``not_null`` counts
NULL rows; ``unique`` counts values that occur more than once;
``accepted_values`` counts distinct values outside the list (NULL passes);
row assertions count rows.  Every check is an aggregation with partial
(map-side) combine, so a hot value costs one row per task in the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.joins import orphans


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n")))


def non_positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) <= 0))


@dataclass
class Check:
    """One test: ``kind`` in not_null / unique / accepted_values /
    non_positive / orphans; ``model`` names the tested DataFrame."""
    kind: str
    model: str
    column: str
    values: list[str] = field(default_factory=list)
    parent: str | None = None          # orphans: parent model (same column)
    name: str | None = None            # report name (defaults to kind)


def _failures(models: dict[str, DataFrame], c: Check) -> DataFrame:
    df = models[c.model]
    if c.kind == "not_null":
        return df.agg(F.count(F.when(F.col(c.column).isNull(), 1)).alias("failures"))
    if c.kind == "unique":
        return unique(df, c.column).agg(F.count(F.lit(1)).alias("failures"))
    if c.kind == "accepted_values":
        return accepted_values(df, c.column, c.values).agg(F.count(F.lit(1)).alias("failures"))
    if c.kind == "non_positive":
        return non_positive(df, c.column).agg(F.count(F.lit(1)).alias("failures"))
    if c.kind == "orphans":
        return orphans(df, models[c.parent], c.column).agg(F.count(F.lit(1)).alias("failures"))
    raise ValueError(f"unknown check kind {c.kind}")


def dq_report(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """``(check, model, column, failures, passed)``, one row per check.

    The not-null and accepted-values checks of one model share a single
    aggregation (conditional counts, plus an exact distinct count of the
    failing values — one distinct aggregate per pass, so no row expansion);
    unique, row-assertion and orphan checks are one aggregation each.
    """
    def single(c: Check) -> DataFrame:
        return _failures(models, c).select(
            F.lit(c.name or c.kind).alias("check"), F.lit(c.model).alias("model"),
            F.lit(c.column).alias("column"), F.col("failures").cast("bigint"))

    parts = []
    fused: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ("not_null", "accepted_values"):
            fused.setdefault(c.model, []).append(c)
        else:
            parts.append(single(c))
    for model, cs in fused.items():
        in_pass, aggs, distinct_used = [], [], False
        for c in cs:
            col = F.col(c.column)
            if c.kind == "not_null":
                expr = F.count(F.when(col.isNull(), 1))
            elif not distinct_used:
                expr = F.count_distinct(F.when(col.isNotNull() & ~col.isin(*c.values), col))
                distinct_used = True
            else:
                parts.append(single(c))
                continue
            aggs.append(expr.alias(f"_{len(in_pass)}"))
            in_pass.append(c)
        rows = F.explode(F.array(*[F.struct(F.lit(c.name or c.kind).alias("check"),
                                            F.lit(model).alias("model"),
                                            F.lit(c.column).alias("column"),
                                            F.col(f"_{i}").cast("bigint").alias("failures"))
                                   for i, c in enumerate(in_pass)]))
        parts.insert(0, models[model].agg(*aggs).select(rows.alias("r")).select("r.*"))
    report = reduce(lambda a, b: a.unionByName(b), parts)
    return report.withColumn("passed", F.col("failures") == 0)
