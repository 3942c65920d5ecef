"""Pipeline run, versioned SCD2 publishing and snapshot bootstrap."""

import tempfile

from pyspark.sql import functions as F

from changeloom.operators import scd2
from changeloom.plans import staging
from changeloom.plans.pipeline import run_pipeline
from changeloom.sources.changelog import change_log, snapshot_events
from changeloom.sources.files import publish_versioned, read_raw, read_versioned, write_raw

from sf_folders import SF001


def test_run_pipeline(spark):
    out = tempfile.mkdtemp(prefix="cl-pipe-")
    write_raw(change_log(spark, SF001), f"{out}/raw")
    log = {(r.stage, r.model): r for r in run_pipeline(spark, read_raw(spark, f"{out}/raw"),
                                                        out, landed=True).collect()}
    assert all(r.status == "success" for r in log.values())
    assert log[("marts", "dim_dates")].rows == 2557
    assert log[("tests", "dq_report")].rows == 38
    report = spark.read.parquet(f"{out}/tests/dq_report")
    assert [k for k in log if k[0] == "staging"]
    assert report.count() == 38 and report.where("NOT passed").count() == 0


def test_versioned_scd2_updates(spark):
    base = tempfile.mkdtemp(prefix="cl-ver-") + "/users_snapshot"
    ev = staging.stg_users(change_log(spark, SF001, ["users"]))
    cut = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    assert read_versioned(spark, base) is None
    publish_versioned(scd2.build_scd2(ev.where(F.col("cdc_consumed_at") < cut), "user_id"), base)
    cur = read_versioned(spark, base)
    p2 = publish_versioned(scd2.apply_scd2(cur, ev.where(F.col("cdc_consumed_at") >= cut),
                                           "user_id"), base)
    assert p2.endswith("v=2")
    latest = read_versioned(spark, base)
    assert latest.count() == ev.count()
    assert latest.where("is_current").count() == ev.select("user_id").distinct().count()


def test_snapshot_events_round_trip(spark):
    base = spark.createDataFrame([(1, "a@x.com", 1704067200000000), (2, "b@x.com", 5)],
                                 "user_id bigint, email string, created_at bigint")
    raw = snapshot_events(base, "users", "user_id", F.lit(1000))
    rows = raw.collect()
    assert {r.op for r in rows} == {"r"} and {r.ts_ms for r in rows} == {1000}
    stg = staging.stg_users(raw).orderBy("user_id").collect()
    assert [s.email for s in stg] == ["a@x.com", "b@x.com"]


def test_a_failing_model_stops_the_run_and_says_why(spark):
    out = tempfile.mkdtemp(prefix="cl-pipe-")
    bad = change_log(spark, SF001).withColumn("after", F.when(
        F.col("source_table") == "plans", F.lit('{"plan_id":"x","name":"n","price":"1","billing_cycle":"annual","created_at":1}'))
        .otherwise(F.col("after")))
    log = run_pipeline(spark, bad, out).collect()
    assert log[-1].model == "dim_plans" and log[-1].rows is None and "CAST_INVALID_INPUT" in log[-1].status
    assert spark.read.parquet(f"{out}/raw").count() == bad.count()


def test_images_are_parsed_once_for_marts_and_tests(spark, monkeypatch):
    from changeloom.plans import marts, pipeline
    out, names, write_once = tempfile.mkdtemp(prefix="cl-pipe-"), [], pipeline.write_once
    monkeypatch.setattr(pipeline, "write_once", lambda df, name: names.append(name) or write_once(df, name))
    raw = change_log(spark, SF001)
    log = run_pipeline(spark, raw, out).collect()
    assert all(r.status == "success" for r in log)
    assert sorted(names) == ["stg_payments", "stg_plans", "stg_subscriptions", "stg_users"]
    want = marts.fct_payments(staging.stg_payments_base(raw), staging.stg_subscriptions(raw))
    got = spark.read.parquet(f"{out}/marts/fct_payments")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
