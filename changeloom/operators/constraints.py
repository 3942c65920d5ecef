"""Constraints of the source tables, checked on the change log.

A constraint is a row (table, column, kind, argument) of
``schemas.SOURCE_CONSTRAINTS``.  The kinds:

* ``not_null``, ``check`` (a list of values) and ``max_length`` hold for every
  row image, as each was a row of the source table;
* ``primary_key``: a key is inserted (``c``) once;
* ``unique``: no two keys have the value in their latest image.  (Deletes carry
  no image, so a deleted row counts until its key is used again.)

One pass per table: an image becomes one row per constraint it breaks, and per
key or value that must be unique.  Those are counted in two phases, first per
value (map-side combine: a value shared by a third of all rows is one row a
task), then per constraint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.latest import latest_by_key
from changeloom.schemas import EXPECTED_COLUMNS, SOURCE_CONSTRAINTS

COUNTED = ("primary_key", "unique")


def _broken(kind: str, v: Column, argument) -> Column:
    if kind == "not_null":
        return v.isNull()
    if kind == "check":
        return v.isNotNull() & ~v.isin(*argument)
    if kind == "max_length":
        return F.char_length(v) > argument
    raise ValueError(f"unknown constraint kind {kind}")


def _images(raw: DataFrame, table: str) -> DataFrame:
    schema = "struct<" + ",".join(f"`{c}`:string" for c, _ in EXPECTED_COLUMNS[table]) + ">"
    return (raw.where((F.col("source_table") == table) & F.col("after").isNotNull())
            .select("op", F.col("ts_ms").alias("cdc_ts_ms"), "cdc_id", F.from_json("after", schema).alias("j")))


def _marks(images: DataFrame, rules: list[tuple[int, str, str, object]], key: str) -> DataFrame:
    """(rule, value): one row per broken rule (value null) or counted value."""
    latest = [r for r in rules if r[2] == "unique"]
    inserts, breaks, faults = [], [], []
    for number, column, kind, argument in rules:
        v = F.col(f"j.{column}")
        if kind == "primary_key":
            inserts.append(F.when((F.col("op") == "c") & v.isNotNull(),
                                  F.struct(F.lit(number).alias("rule"), v.alias("value"))))
        elif kind != "unique":
            broken = F.coalesce(_broken(kind, v, argument), F.lit(False))
            faults.append(broken)
            breaks.append(F.when(broken, F.struct(F.lit(number).alias("rule"), F.lit(None).cast("string").alias("value"))))
    # Most images break nothing: they give their inserted keys only.
    marks = F.array(*inserts, *breaks)
    if inserts and faults:
        marks = F.when(reduce(Column.__or__, faults), marks).otherwise(F.array(*inserts))
    out = images.select(F.explode(marks).alias("m")).where("m IS NOT NULL").select("m.*")
    if latest:
        now = latest_by_key(images.withColumn("_key", F.col(f"j.{key}")), ["_key"])
        values = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"j.{c}").alias("value")) for n, c, _, _ in latest])
        out = out.unionByName(now.select(F.explode(values).alias("m")).select("m.*").where("value IS NOT NULL"))
    return out


def source_constraints(raw: DataFrame, constraints: list[tuple] | None = None) -> DataFrame:
    """(source_table, column_name, kind, violations), one row per constraint:
    images that break it, or values that occur more than once."""
    declared = list(enumerate(constraints or SOURCE_CONSTRAINTS))
    parts = []
    for table in dict.fromkeys(c[0] for _, c in declared):
        rules = [(n, c[1], c[2], c[3]) for n, c in declared if c[0] == table]
        parts.append(_marks(_images(raw, table), rules, EXPECTED_COLUMNS[table][0][0]))
    counted = [n for n, c in declared if c[2] in COUNTED]
    found = (reduce(DataFrame.unionByName, parts).groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("rule").agg(F.sum(F.when(F.col("rule").isin(*counted), (F.col("n") > 1).cast("bigint"))
                                        .otherwise(F.col("n"))).alias("violations")))
    names = raw.sparkSession.createDataFrame([(n, c[0], c[1], c[2]) for n, c in declared],
                                             "rule int, source_table string, column_name string, kind string")
    return (names.join(found, "rule", "left")
            .select("source_table", "column_name", "kind", F.coalesce("violations", F.lit(0)).alias("violations")))
