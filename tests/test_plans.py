"""Physical-plan properties the scale design relies on."""

import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeloom.operators import quality
from changeloom.plans import marts, metrics, staging
from changeloom.sources.changelog import change_log
from changeloom.sources.files import read_raw, write_raw

from sf_folders import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _landed(spark):
    path = tempfile.mkdtemp(prefix="cl-plan-") + "/raw"
    write_raw(change_log(spark, SF001), path)
    return read_raw(spark, path)


def test_latest_cuts_before_shuffle(spark):
    raw = _landed(spark)
    df = marts.dim_users(staging.stg_users(raw))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # partial top-1 runs map-side, before the exchange
    assert "WindowGroupLimit" in plan
    explain = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Partial" in explain and "Final" in explain


def test_staging_prunes_partitions_and_pushes_ops(spark):
    raw = _landed(spark)
    df = staging.stg_payments_base(raw)
    explain = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(source_table" in explain and "payments" in explain
    assert "PushedFilters: [In(op, [c,r,u])]" in explain or "In(op" in explain
    # only the needed raw columns are read (no before / topic / partition)
    read_schema = [ln for ln in explain.splitlines() if "ReadSchema" in ln][0]
    assert "before" not in read_schema and "topic" not in read_schema


def test_fused_checks_single_distinct_no_expand(spark):
    raw = _landed(spark)
    m = {"stg_payments": staging.stg_payments_base(raw)}
    checks = [quality.Check("not_null", "stg_payments", "cdc_id"),
              quality.Check("not_null", "stg_payments", "amount"),
              quality.Check("accepted_values", "stg_payments", "status", ["success", "failed"])]
    report = quality.dq_report(m, checks)
    assert report.count() == 3
    assert "Expand" not in _plan(report)


def test_staging_over_a_landed_log_prunes(spark):
    """The filter on the source table passes the replay dedup."""
    from changeloom.streaming.landing import read_landed
    base = tempfile.mkdtemp(prefix="cl-landed-") + "/raw"
    raw = change_log(spark, SF001).withColumn("batch_id", F.lit(0).cast("bigint"))
    raw.write.partitionBy("batch_id", "source_table").parquet(base)
    users = staging.stg_users(read_landed(spark, base))
    plan = users._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.splitlines() if "PartitionFilters" in x]
    assert filters and all("source_table" in x.split("PartitionFilters")[1].split("]")[0] for x in filters)


def test_raw_files_are_sorted_by_time(spark):
    raw = _landed(spark)
    files = (raw.select("source_table", "ts_ms", F.input_file_name().alias("f"),
                        F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i")))
    previous = F.lag("ts_ms").over(Window.partitionBy("f", "b").orderBy("i"))
    assert files.withColumn("p", previous).where("p > ts_ms").count() == 0


def test_payment_facts_move_payments_twice(spark):
    """Top-1, counts, latest subscription and one join: four exchanges."""
    raw = _landed(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fct = marts.fct_payments(staging.stg_payments_base(raw), staging.stg_subscriptions(raw))
        plan = fct._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert len(moved) <= 4, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_revenue_keeps_payments_outside_the_calendar(spark):
    rows = [("2025-01-05 00:00:00", 10, True), ("2031-02-01 00:00:00", 5, True), (None, 7, False)]
    fct = spark.createDataFrame(rows, "t string, recognised_revenue int, is_successful boolean").select(
        F.col("t").cast("timestamp_ntz").alias("created_at"),
        F.col("recognised_revenue").cast("decimal(10,2)").alias("recognised_revenue"), "is_successful")
    got = {r.year_month: float(r.revenue) for r in metrics.revenue_by_month(fct).collect()}
    assert got == {"2025-01": 10.0, "2031-02": 5.0, None: 7.0}


def test_building_a_plan_runs_no_job(spark):
    from changeloom.operators import monitor, scd2
    raw = _landed(spark)
    sc = spark.sparkContext
    sc.setJobGroup("plan-building", "plans only")
    try:
        subs, plans, users = staging.stg_subscriptions(raw), staging.stg_plans(raw), staging.stg_users(raw)
        marts.fct_subscriptions(subs, plans)
        metrics.revenue_by_month(marts.fct_payments(staging.stg_payments_base(raw), subs))
        history = scd2.build_scd2(users, "user_id", tracked=["email", "plan_id"])
        scd2.apply_scd2(history, users, "user_id", tracked=["email", "plan_id"], log=users)
        monitor.silence_gaps(raw)
        monitor.late_events(users, "user_id")
        assert not sc.statusTracker().getJobIdsForGroup("plan-building")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
