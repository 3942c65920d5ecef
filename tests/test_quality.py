"""Checks on injected bad rows and the 38-check suite shape."""

from pyspark.sql import functions as F

from changeloom.operators import quality
from changeloom.operators.joins import orphans
from changeloom.plans.checks import project_checks


def test_checks_on_injected_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", "active"), (1, "b", "bogus"), (None, "c", None), (3, None, "odd")],
        "k bigint, s string, st string")
    assert quality.not_null(df, "s").count() == 1
    assert [r.k for r in quality.unique(df, "k").collect()] == [1]
    assert sorted(r.st for r in quality.accepted_values(df, "st", ["active"]).collect()) == ["bogus", "odd"]
    parent = spark.createDataFrame([(1,)], "k bigint")
    assert orphans(df, parent, "k").count() == 2                    # NULL key is an orphan
    assert orphans(df, parent, "k", ignore_null=True).count() == 1  # FK semantics
    neg = spark.createDataFrame([(1.0,), (0.0,), (-2.0,), (None,)], "m double")
    assert quality.non_positive(neg, "m").count() == 2


def test_report(spark):
    m = spark.createDataFrame([(1, "x"), (1, None)], "id bigint, v string")
    p = spark.createDataFrame([(2,)], "id bigint")
    checks = [quality.Check("not_null", "m", "v"), quality.Check("unique", "m", "id"),
              quality.Check("accepted_values", "m", "v", ["y"]),
              quality.Check("orphans", "m", "id", parent="p", name="no_orphans")]
    r = {row.check: row for row in quality.dq_report({"m": m, "p": p}, checks).collect()}
    assert r["not_null"].failures == 1 and not r["not_null"].passed
    assert r["unique"].failures == 1
    assert r["accepted_values"].failures == 1
    assert r["no_orphans"].failures == 2


def test_suite_has_38_checks():
    assert len(project_checks()) == 38
