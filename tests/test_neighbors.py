"""Next / previous row in range parts equals the plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from changeloom.operators import monitor
from changeloom.operators.neighbors import in_parts, with_neighbor


def _data(spark):
    # key 0 is hot (most rows); keys 1..20 are small; one NULL key group; the
    # order column has ties, which the second one breaks, and nulls.
    return (spark.range(0, 5000)
            .select(F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(
                        F.when(F.col("id") % 3 == 0, F.col("id") % 20 + 1).otherwise(F.lit(0)))
                    .cast("bigint").alias("k"),
                    F.when(F.col("id") % 97 != 0, (F.col("id") * 7919) % 1007).alias("t"),
                    F.col("id").alias("tie"),
                    F.when(F.col("id") % 11 != 0, F.col("id") * 3).alias("v")))


@pytest.mark.parametrize("parts", [1, 2, 7, 64, None])
def test_next_and_prev_match_window(spark, parts):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("t", "tie")
    expect = df.select("k", "t", "tie", F.lead("v").over(w).alias("next_v"),
                       F.lag("v").over(w).alias("prev_v"))
    got_n = with_neighbor(df, ["k"], ["t", "tie"], ["v"], "next", parts=parts)
    got_p = with_neighbor(df, ["k"], ["t", "tie"], ["v"], "prev", parts=parts)
    got = got_n.join(got_p.select("tie", "prev_v"), "tie").select("k", "t", "tie", "next_v", "prev_v")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expect.collect()), key=repr)


def test_one_key_in_one_hour_is_spread_evenly(spark):
    """Every row in one key and one hour: no task above twice the median."""
    df = spark.range(0, 40_000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 3_600_000).alias("t"),
                                       F.col("id").alias("tie"), F.col("id").alias("v"))
    cut = in_parts(df, ["k"], ["t", "tie"])
    parts = sorted(r["count"] for r in cut.groupBy("_part").count().collect())
    assert len(parts) == 16 * 8 and sum(parts) == 40_000 and parts[-1] <= 3 * parts[len(parts) // 2]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = sorted(r["count"] for r in cut.repartition("k", "_part").groupBy(F.spark_partition_id()).count().collect())
        assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[len(tasks) // 2]
        got = with_neighbor(df, ["k"], ["t", "tie"], ["v"])
        assert got.where("next_v IS NULL").count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # parts ascend along the order
    ends = cut.groupBy("_part").agg(F.min(F.struct("t", "tie")).alias("a"), F.max(F.struct("t", "tie")).alias("b")).orderBy("_part").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:]))


def test_empty_one_row_and_two_keys(spark):
    schema = "a string, b int, t int, v string"
    empty = spark.createDataFrame([], schema)
    assert with_neighbor(empty, ["a", "b"], ["t"], ["v"]).collect() == []
    one = spark.createDataFrame([("x", None, 1, "p")], schema)
    assert [r.next_v for r in with_neighbor(one, ["a", "b"], ["t"], ["v"]).collect()] == [None]
    rows = [(a, b, t, f"{a}{b}{t}") for a in ("x", "y", None) for b in (1, None) for t in range(40)]
    got = with_neighbor(spark.createDataFrame(rows, schema), ["a", "b"], ["t"], ["v", "t"], parts=30).collect()
    want = {(a, b, t): (f"{a}{b}{t + 1}" if t < 39 else None, t + 1 if t < 39 else None) for a, b, t, _ in rows}
    assert {(r.a, r.b, r.t): (r.next_v, r.next_t) for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("parts", [1, 50])
def test_late_events_match_running_maximum(spark, parts):
    df = (spark.range(0, 3000).select(
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.when(F.col("id") % 4 == 0, F.col("id") % 30).otherwise(0)).alias("k"),
        F.expr("timestamp_ntz '2024-01-01' + make_interval(0,0,0,0,0,0, (id * 37) % 900)").alias("cdc_consumed_at"),
        ((F.col("id") * 7919) % 1009).alias("cdc_ts_ms"), F.col("id").alias("cdc_id")))
    w = (Window.partitionBy("k").orderBy("cdc_consumed_at", "cdc_ts_ms", "cdc_id")
         .rowsBetween(Window.unboundedPreceding, -1))
    expect = df.withColumn("newer_ts_ms", F.max("cdc_ts_ms").over(w)).where("newer_ts_ms > cdc_ts_ms")
    got = monitor.late_events(df, "k", parts=parts)
    assert sorted(map(tuple, got.select(*expect.columns).collect()), key=repr) == sorted(map(tuple, expect.collect()), key=repr)
