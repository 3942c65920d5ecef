"""One pipeline run: raw layer, staging, marts, snapshots, tests, and a run log.

Order matters: staging reads the landed raw layer, snapshots read staging,
tests read the built marts.  Each stage writes its tables under ``out``; the run
log records per model the rows written, the seconds taken and the outcome.  A
failing stage stops the run and is logged with the error's first line.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from changeloom.operators import quality, scd2
from changeloom.plans import checks, marts, staging
from changeloom.session import stage as write_once
from changeloom.sources.files import publish_table, publish_view, read_raw, write_raw

RUN_LOG_SCHEMA = "stage string, model string, rows bigint, seconds double, status string"


def run_pipeline(spark: SparkSession, raw: DataFrame, out: str, landed: bool = False) -> DataFrame:
    """Run all stages over ``raw``.  It is written to ``out``/raw first, and every
    model reads that; ``landed`` says that it is such a table already."""
    if not landed:
        write_raw(raw, f"{out}/raw")
        raw = read_raw(spark, f"{out}/raw")
    log: list[tuple] = []
    built: dict[str, DataFrame] = {}
    written: dict[str, DataFrame] = {}

    def step(stage: str, name: str, action) -> bool:
        """Run ``action() -> (rows, status)`` and log it, also when it fails."""
        began = time.time()
        try:
            rows, status = action()
        except Exception as exc:  # noqa: BLE001 - logged as the failed step
            first_line = (str(exc).strip().splitlines() or [""])[0][:300]
            rows, status = None, f"failed: {type(exc).__name__}: {first_line}"
        log.append((stage, name, rows, time.time() - began, status))
        return status == "success"

    def view(name, fn):
        def action():
            built[name] = publish_view(fn(raw), name)
            return built[name].count(), "success"
        return action

    def typed(name):
        """The rows of a staging view, typed and written when the first mart asks for
        them: marts, snapshots and tests then parse no image again."""
        if name not in written:
            payments = name == "stg_payments"       # the retry flag is derived on reading
            written[name] = write_once(staging.stg_payments_base(raw) if payments else built[name], name)
            built[name] = staging.flag_retry(written[name]) if payments else written[name]
        return written[name]

    def table(stage, name, fn):
        def action():
            path = f"{out}/{stage}/{name}"
            publish_table(fn(), path)
            built[name] = spark.read.parquet(path)
            return built[name].count(), "success"
        return action

    def tests():
        publish_table(quality.dq_report(built, checks.project_checks()), f"{out}/tests/dq_report")
        report = spark.read.parquet(f"{out}/tests/dq_report")
        failed, passed = report.where("NOT passed").count(), report.where("passed").count()
        return passed, "success" if failed == 0 else f"failed: {failed} checks"

    steps = [("staging", n, view(n, fn)) for n, fn in staging.STAGING_MODELS.items()]
    steps += [("marts", n, table("marts", n, fn)) for n, fn in {
        "dim_users": lambda: marts.dim_users(typed("stg_users")),
        "dim_plans": lambda: marts.dim_plans(typed("stg_plans")),
        "dim_dates": lambda: marts.dim_dates(spark),
        "fct_subscriptions": lambda: marts.fct_subscriptions(typed("stg_subscriptions"), typed("stg_plans")),
        "fct_payments": lambda: marts.fct_payments(typed("stg_payments"), typed("stg_subscriptions")),
    }.items()]
    steps += [("snapshots", n, table("snapshots", n, fn)) for n, fn in {
        "users_snapshot": lambda: scd2.build_scd2(typed("stg_users"), "user_id"),
        "plans_snapshot": lambda: scd2.build_scd2(typed("stg_plans"), "plan_id"),
    }.items()]
    steps.append(("tests", "dq_report", tests))
    for stage, name, action in steps:
        if not step(stage, name, action):
            break
    return spark.createDataFrame(log, RUN_LOG_SCHEMA)
