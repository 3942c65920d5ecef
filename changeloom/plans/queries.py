"""Registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame computed over the whole base tables of ``sf_dir``.

Queries are lazy but for those that write: staged rows that a query reads several
times and the plans are written first, the report query writes its marts, the
stream and pipeline queries run and read their output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeloom.operators import monitor, quality, scd2
from changeloom.operators.joins import orphans
from changeloom.operators.parse import parse_change_events
from changeloom.plans import checks, marts, metrics, staging
from changeloom.session import remove_path, scratch_path, stage
from changeloom.sources.changelog import change_messages
from changeloom.sources.changelog import BASE_MICROS, DAY_MS, change_log
from changeloom.sources.faults import drift_events, fault_events
from changeloom.sources.files import read_raw

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_log(spark, sf_dir)


def faulty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log with the faulty events of ``sources.faults``."""
    return raw(spark, sf_dir).unionByName(fault_events(spark, sf_dir))


def drifted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).unionByName(drift_events(spark, sf_dir))


def _stg(name: str) -> Query:
    return lambda spark, d: staging.STAGING_MODELS[name](raw(spark, d))


def _plans(r: DataFrame) -> DataFrame:
    """The staged plans, written once.  Their size is then known to the planner: a
    small catalogue is broadcast and no subscription moves to its plan, a
    large one is joined by key."""
    return stage(staging.stg_plans(r), "plans")


def _payments(r: DataFrame) -> DataFrame:
    """The staged payments, written once: the facts read them for the latest event,
    the events per subscription and those without one."""
    return stage(staging.stg_payments_base(r), "payments")


def _subscription_facts(spark: SparkSession, d: str, keep=None) -> DataFrame:
    r = raw(spark, d)
    return marts.subscription_facts(staging.stg_subscriptions(r), _plans(r), keep)


def _latest_subs(spark: SparkSession, d: str) -> DataFrame:
    return metrics.latest_subscriptions(_subscription_facts(spark, d, ["cdc_id"]))


def _fct_payments(spark: SparkSession, d: str, log: Query = raw) -> DataFrame:
    r = log(spark, d)
    return marts.fct_payments(_payments(r), staging.stg_subscriptions(r))


def revenue_by_day(spark: SparkSession, d: str, log: Query = raw) -> DataFrame:
    """Every calendar day with its payments and revenue (zero-filled), and the
    payment days outside the calendar, which have no calendar columns."""
    from pyspark.sql import functions as F
    pay = (_fct_payments(spark, d, log)
           .groupBy(F.to_date("created_at").alias("date_day"))
           .agg(F.count(F.lit(1)).alias("payments"),
                F.sum("recognised_revenue").alias("revenue")))
    cal = marts.dim_dates(spark)
    return (cal.join(pay, "date_day", "full")
            .select(*cal.columns,
                    F.coalesce(F.col("payments"), F.lit(0)).alias("payments"),
                    F.coalesce(F.col("revenue"), F.lit(0)).cast("decimal(18,2)").alias("revenue")))


# Batches of the incremental metrics: rows dealt by id hash, so that they come
# in no order.
METRIC_BATCHES = 3


def _taken_in(sums, rows: DataFrame):
    from pyspark.sql import functions as F
    rows = stage(rows, "metric-rows")
    for b in range(METRIC_BATCHES):
        sums.apply(rows.where(F.pmod(F.xxhash64("cdc_id"), F.lit(METRIC_BATCHES)) == b), b)
    return sums.read()


def revenue_by_day_incremental(spark: SparkSession, d: str) -> DataFrame:
    """``revenue_by_day`` kept by retraction from payments in mixed order."""
    from pyspark.sql import functions as F
    from changeloom.operators.retraction import RetractedSums
    pay = staging.stg_payments_base(raw(spark, d)).select(
        "payment_id", "cdc_ts_ms", "cdc_id", F.to_date("created_at").alias("date_day"),
        F.when(F.col("status") == "success", F.col("amount")).otherwise(0).alias("revenue"))
    sums = RetractedSums(spark, scratch_path(spark, "revenue"), ["payment_id"], ["date_day"], {"revenue": "decimal(18,2)"})
    by_day, cal = _taken_in(sums, pay), marts.dim_dates(spark)
    return (cal.join(by_day, "date_day", "full")
            .select(*cal.columns, F.coalesce("rows", F.lit(0)).alias("payments"),
                    F.coalesce("revenue", F.lit(0)).cast("decimal(18,2)").alias("revenue")))


def mrr_incremental(spark: SparkSession, d: str) -> DataFrame:
    """``mrr_by_plan``: active subscriptions per plan kept by retraction; the
    price is the plan's latest when the metric is read."""
    from pyspark.sql import functions as F
    from changeloom.operators.retraction import RetractedSums
    r = raw(spark, d)
    subs = staging.stg_subscriptions(r).select("subscription_id", "cdc_ts_ms", "cdc_id", "plan_id", "status")
    sums = RetractedSums(spark, scratch_path(spark, "mrr"), ["subscription_id"], ["plan_id"], {},
                         F.col("status") == "active")
    active = _taken_in(sums, subs).withColumnRenamed("rows", "active_subscriptions")
    price = marts.plan_mrr(staging.stg_plans(r)).withColumnRenamed("plan_id", "_plan")
    return (active.join(price, F.col("plan_id").eqNullSafe(F.col("_plan")), "left")
            .select("plan_id", "active_subscriptions",
                    (F.col("mrr") * F.col("active_subscriptions")).cast("decimal(18,2)").alias("mrr")))


# History: incremental runs split the log at this consumption time; hard
# deletes are applied at this run time.
SCD2_CUT = "2024-02-15 00:00:00"
SCD2_RUN_AT = "2031-01-01 00:00:00"
USER_TRACKED = ["email", "plan_id"]


def users_scd2(spark: SparkSession, d: str) -> DataFrame:
    return scd2.build_scd2(staging.stg_users(raw(spark, d)), "user_id")


def plans_scd2(spark: SparkSession, d: str) -> DataFrame:
    return scd2.build_scd2(staging.stg_plans(raw(spark, d)), "plan_id")


def scd2_incremental_tracked(spark: SparkSession, d: str) -> DataFrame:
    """The change-only history, built and then extended like ``scd2_incremental``."""
    from pyspark.sql import functions as F
    ev = staging.stg_users(raw(spark, d))
    cut = F.lit(SCD2_CUT).cast("timestamp_ntz")
    first = scd2.build_scd2(ev.where(F.col("cdc_consumed_at") < cut), "user_id", tracked=USER_TRACKED)
    return scd2.apply_scd2(first, ev.where(F.col("cdc_consumed_at") >= cut), "user_id",
                           tracked=USER_TRACKED, log=ev)


def users_scd2_changes_only(spark: SparkSession, d: str) -> DataFrame:
    return scd2.build_scd2(staging.stg_users(raw(spark, d)), "user_id", tracked=USER_TRACKED)


def scd2_incremental(spark: SparkSession, d: str) -> DataFrame:
    """History built from the events consumed before ``SCD2_CUT``, then the
    later events applied incrementally (late events included)."""
    from pyspark.sql import functions as F
    ev = staging.stg_users(raw(spark, d))
    cut = F.lit(SCD2_CUT).cast("timestamp_ntz")
    first = scd2.build_scd2(ev.where(F.col("cdc_consumed_at") < cut), "user_id")
    return scd2.apply_scd2(first, ev.where(F.col("cdc_consumed_at") >= cut), "user_id")


def current_user_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the live users table: customers minus the deleted ones (the
    delete rule of the change log)."""
    from pyspark.sql import functions as F
    from changeloom.sources.tables import read_table
    c = read_table(spark, d, "customer", ["c_custkey"])
    return c.where(F.col("c_custkey") % 37 != 0).select(F.col("c_custkey").alias("user_id"))


def scd2_hard_deletes(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import functions as F
    return scd2.invalidate_hard_deletes(users_scd2(spark, d), current_user_keys(spark, d),
                                        "user_id", F.lit(SCD2_RUN_AT))


def models(spark: SparkSession, d: str, persist: set[str] | None = None,
           log: Query = raw) -> dict[str, DataFrame]:
    """Every staging model and mart over the change log of ``d``.

    With ``persist`` the log is landed and the marts it names are written once
    as Parquet below the checkpoint folder, as the tests of a table run against the built table;
    each check then reads its columns only.  Staging stays lazy (views), each
    staging model then scanned once per fused check pass.
    """
    r = log(spark, d)
    if persist:
        # Checks scan the staging models many times: land the log once.
        path = scratch_path(spark, "log")
        r.write.partitionBy("source_table").parquet(path)
        r = read_raw(spark, path)
    stg = {name: fn(r) for name, fn in staging.STAGING_MODELS.items()}
    payments = staging.stg_payments_base(r)
    if persist:
        # Read several times by the marts and checks: their events are parsed once.
        payments = _payments(r)
        stg |= {"stg_plans": _plans(r), "stg_payments": staging.flag_retry(payments),
                "stg_subscriptions": stage(stg["stg_subscriptions"], "subscriptions")}
    m = dict(stg)
    m["dim_users"] = marts.dim_users(stg["stg_users"])
    m["dim_plans"] = marts.dim_plans(stg["stg_plans"])
    m["dim_dates"] = marts.dim_dates(spark)
    m["fct_subscriptions"] = marts.fct_subscriptions(stg["stg_subscriptions"], stg["stg_plans"])
    m["fct_payments"] = marts.fct_payments(payments, stg["stg_subscriptions"])
    m.update({k: stage(m[k], k) for k in sorted(persist or ())})
    return m


# Foreign keys checked on the marts: (name, child, column, parent, parent column).
FOREIGN_KEYS = [
    ("users.plan_id", "dim_users", "plan_id", "dim_plans", "plan_id"),
    ("subscriptions.user_id", "fct_subscriptions", "user_id", "dim_users", "user_id"),
    ("subscriptions.plan_id", "fct_subscriptions", "plan_id", "dim_plans", "plan_id"),
    ("payments.subscription_id", "fct_payments", "subscription_id", "fct_subscriptions",
     "subscription_id"),
    ("events.user_id", "stg_events", "user_id", "dim_users", "user_id"),
]


def dq_report(spark: SparkSession, d: str, log: Query = raw) -> DataFrame:
    return quality.dq_report(models(spark, d, set(marts.MARTS), log), checks.project_checks())


def fk_violations(spark: SparkSession, d: str, log: Query = raw) -> DataFrame:
    """Rows per foreign key whose parent is missing.  Children are counted per
    key before they look for it, and a parent is the set of its staged keys, so
    what is shuffled are keys and no mart is built."""
    from functools import reduce
    from pyspark.sql import functions as F
    from changeloom.operators.latest import DEFAULT_ORDER, latest_by_key
    r = log(spark, d)
    stg = {name: fn(r) for name, fn in staging.STAGING_MODELS.items() if name != "stg_payments"}
    # Child of two keys and parent of one, or both: written once, keys and order only.
    stg["stg_users"] = stage(stg["stg_users"].select("user_id", "plan_id", *DEFAULT_ORDER), "users")
    stg["stg_subscriptions"] = stage(stg["stg_subscriptions"].select("subscription_id", "user_id", "plan_id"), "subscriptions")
    children = {"dim_users": latest_by_key(stg["stg_users"], ["user_id"]), "fct_subscriptions": stg["stg_subscriptions"],
                "fct_payments": latest_by_key(staging.stg_payments_base(r), ["payment_id"]), "stg_events": stg["stg_events"]}
    parents = {"dim_users": stg["stg_users"], "dim_plans": stg["stg_plans"], "fct_subscriptions": stg["stg_subscriptions"]}

    def violations(name, child, col, parent, pcol):
        counted = children[child].where(F.col(col).isNotNull()).groupBy(F.col(col).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        keys = parents[parent].select(F.col(pcol).alias("_k")).distinct()
        return (counted.join(keys, F.col("k") == F.col("_k"), "left_anti")
                .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit(name).alias("fk"), "violations"))

    return reduce(DataFrame.unionByName, [violations(*fk) for fk in FOREIGN_KEYS])


def orphan_payments(spark: SparkSession, d: str, log: Query = raw) -> DataFrame:
    r = log(spark, d)
    subs = stage(staging.stg_subscriptions(r), "subscriptions")
    return orphans(marts.fct_payments(_payments(r), subs), marts.fct_subscriptions(subs, staging.stg_plans(r)),
                   "subscription_id").drop("_pk")


def non_positive_mrr(spark: SparkSession, d: str, log: Query = raw) -> DataFrame:
    r = log(spark, d)
    return quality.non_positive(marts.fct_subscriptions(staging.stg_subscriptions(r), _plans(r)), "mrr")


def source_constraints(spark: SparkSession, d: str, log: Query = raw) -> DataFrame:
    """Every declared constraint of the source tables with its violations."""
    from changeloom.operators.constraints import source_constraints as check
    return check(log(spark, d))


def lifecycle_violations(spark: SparkSession, d: str) -> DataFrame:
    """Subscription events out of order, in the log with such events."""
    from changeloom.operators.lifecycle import lifecycle_violations as check, subscription_events
    from changeloom.sources.faults import lifecycle_events
    return check(subscription_events(raw(spark, d).unionByName(lifecycle_events(spark, d))), "subscription_id")


# Recent drift is judged on the events of the last users' changes.
DRIFT_SINCE_MS = BASE_MICROS // 1000 + 120 * DAY_MS


def _faulty(query) -> Query:
    return lambda spark, d: query(spark, d, faulty_log)


FAULTY = {f"{q.__name__}_faulty": _faulty(q)
          for q in (dq_report, fk_violations, orphan_payments, non_positive_mrr, revenue_by_day, source_constraints)}


def _parsed(spark: SparkSession, d: str):
    from pyspark.sql import functions as F
    return parse_change_events(change_messages(spark, d), consumed_at=F.col("timestamp"))


# Monitoring: batches are the 30-minute schedule windows.
BATCH_MICROS = 1_800_000_000


def batch_stats(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import functions as F
    from changeloom.functions import micros_to_ts, ts_to_micros
    start = micros_to_ts(F.floor(ts_to_micros(F.col("consumed_at")) / BATCH_MICROS)
                         * BATCH_MICROS).alias("batch_start")
    return monitor.batch_stats(raw(spark, d), start)


def stream_landing(spark: SparkSession, d: str) -> DataFrame:
    """Land the change messages through Structured Streaming.

    The messages are written as parquet files under the shared checkpoint
    folder, consumed with ``availableNow`` in about ``STREAM_BATCHES``
    micro-batches by the landing stream, and the landed log is read back with
    replays removed.
    """
    from pyspark.sql import functions as F
    from changeloom.streaming.landing import read_change_stream, read_landed, start_landing
    base = scratch_path(spark, "stream_landing")
    files = _write_messages(spark, d, f"{base}/in")
    stream = read_change_stream(spark, "parquet", {"maxFilesPerTrigger": str(-(-files // STREAM_BATCHES))},
                                f"{base}/in")
    q = start_landing(stream, f"{base}/raw", f"{base}/checkpoint",
                      rejects_path=f"{base}/rejects", consumed_at=F.col("timestamp"))
    q.awaitTermination()
    q.stop()
    if q.exception():
        raise q.exception()
    remove_path(spark, f"{base}/in")        # all landed: the dedup needs the room
    return read_landed(spark, f"{base}/raw").drop("batch_id")


def stream_landing_bounded(spark: SparkSession, d: str) -> DataFrame:
    """The same landing from a source whose micro-batches are bounded by records."""
    from pyspark.sql import functions as F
    from changeloom.streaming.landing import read_landed, start_landing
    from changeloom.streaming.messages import read_bounded_messages
    base = scratch_path(spark, "stream_bounded")
    _write_messages(spark, d, f"{base}/in")
    bound = -(-spark.read.parquet(f"{base}/in").count() // STREAM_BATCHES)
    q = start_landing(read_bounded_messages(spark, f"{base}/in", max(1, bound)), f"{base}/raw", f"{base}/checkpoint",
                      trigger={"processingTime": "0 seconds"}, consumed_at=F.col("timestamp"))
    q.processAllAvailable()
    q.stop()
    if q.exception():
        raise q.exception()
    remove_path(spark, f"{base}/in")        # all landed: the dedup needs the room
    return read_landed(spark, f"{base}/raw").drop("batch_id")


STREAM_BATCHES = 4
HELD_BATCHES = "spark.sql.streaming.maxBatchesToRetainInMemory"


# Records of a message file, and bytes of its row groups: a reader holds one group.
FILE_RECORDS = 250_000
GROUP_BYTES = 16 << 20


def _write_messages(spark: SparkSession, d: str, path: str) -> int:
    """The change messages as files of at most ``FILE_RECORDS``, each written where
    its rows are made: no text is shuffled; the number of files."""
    (change_messages(spark, d).write.mode("overwrite").option("compression", "zstd")
     .option("maxRecordsPerFile", FILE_RECORDS).option("parquet.block.size", GROUP_BYTES).parquet(path))
    return len(spark.read.parquet(path).inputFiles())


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Replays removed by the stream itself: the messages arrive in files that
    mix old and new event times, and every position comes out once."""
    from pyspark.sql import functions as F
    from changeloom.streaming.landing import read_change_stream
    base = scratch_path(spark, "stream_dedup")
    files = _write_messages(spark, d, f"{base}/in")
    stream = read_change_stream(spark, "parquet", {"maxFilesPerTrigger": str(-(-files // STREAM_BATCHES))},
                                f"{base}/in")
    # Nothing else of a message is worked out or passes through the state.
    narrow, _ = parse_change_events(stream, consumed_at=F.col("timestamp"),
                                    columns=[*monitor.POSITION, "source_table", "ts_ms", "consumed_at", "cdc_id"])
    # Every batch touches most states: the executors read them from the checkpoint
    # and do not hold them all between the batches.
    held = spark.conf.get(HELD_BATCHES)
    spark.conf.set(HELD_BATCHES, "0")
    try:
        q = (monitor.dedup_offsets(narrow).select(*monitor.POSITION, "source_table", "ts_ms")
             .writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    finally:
        spark.conf.set(HELD_BATCHES, held)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    remove_path(spark, f"{base}/in")
    return spark.read.parquet(f"{base}/out")


# The fixed time and bound of the silence query.
SILENCE_NOW = "2024-06-01 00:00:00"
SILENCE_MINUTES = 30


def current_silence(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import functions as F
    from changeloom.schemas import EXPECTED_COLUMNS
    return monitor.current_silence(raw(spark, d), F.lit(SILENCE_NOW).cast("timestamp_ntz"),
                                   SILENCE_MINUTES, list(EXPECTED_COLUMNS))


def current_silence_live(spark: SparkSession, d: str) -> DataFrame:
    """``current_silence`` from the last-seen table that a landing keeps: the log
    is merged into it in two batches, and the query reads that table only."""
    from pyspark.sql import functions as F
    from changeloom.schemas import EXPECTED_COLUMNS
    from changeloom.streaming.landing import record_seen
    path, log = scratch_path(spark, "last_seen"), raw(spark, d)
    late = F.col("consumed_at") >= F.lit(SCD2_CUT).cast("timestamp_ntz")
    record_seen(log.where(~late), path)
    seen = record_seen(log.where(late), path).read()
    return monitor.silent_tables(seen, F.lit(SILENCE_NOW).cast("timestamp_ntz"), SILENCE_MINUTES, list(EXPECTED_COLUMNS))


def snapshot_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """Re-snapshot of the live users table (after a drop and re-create):
    the current state of every live user as an ``r`` event at run time."""
    from pyspark.sql import functions as F
    from changeloom.functions import ts_to_micros
    from changeloom.sources.changelog import snapshot_events
    state = marts.dim_users(staging.stg_users(raw(spark, d)))
    live = state.join(current_user_keys(spark, d), "user_id", "left_semi")
    base = live.select("user_id", "email", "name", "plan_id",
                       ts_to_micros(F.col("created_at")).alias("created_at"))
    run_ms = F.lit(SNAPSHOT_RUN_MS)
    return snapshot_events(base, "users", "user_id", run_ms)


SNAPSHOT_RUN_MS = 1924992000000      # 2031-01-01 00:00:00 UTC


def dim_users_incremental(spark: SparkSession, d: str) -> DataFrame:
    """dim_users kept by upserts: built from the events consumed before
    ``SCD2_CUT``, then the later events merged in (late ones included)."""
    from pyspark.sql import functions as F
    from changeloom.operators.latest import latest_by_key, merge_latest
    ev = staging.stg_users(raw(spark, d))
    cut = F.lit(SCD2_CUT).cast("timestamp_ntz")
    first = latest_by_key(ev.where(F.col("cdc_consumed_at") < cut), ["user_id"])
    merged = merge_latest(first, ev.where(F.col("cdc_consumed_at") >= cut), ["user_id"])
    return merged.select(*marts.DIM_USER_COLUMNS)


def _users_in_two(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The users' events, written once, before and from ``SCD2_CUT`` on."""
    from pyspark.sql import functions as F
    ev = stage(staging.stg_users(raw(spark, d)), "users-events")
    cut = F.lit(SCD2_CUT).cast("timestamp_ntz")
    return ev.where(F.col("cdc_consumed_at") < cut), ev.where(F.col("cdc_consumed_at") >= cut)


def dim_users_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """dim_users in a bucketed table: created from the events before
    ``SCD2_CUT``, the later ones upserted, touched buckets rewritten only."""
    from changeloom.operators.latest import latest_by_key
    from changeloom.sources.bucketed import BucketedTable, upsert_latest
    first, later = _users_in_two(spark, d)
    table = BucketedTable.create(latest_by_key(first, ["user_id"]), scratch_path(spark, "dim_users"), ["user_id"])
    return upsert_latest(table, later).read().select(*marts.DIM_USER_COLUMNS)


def users_scd2_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The users' history in a bucketed table, built and then extended."""
    from changeloom.sources.bucketed import BucketedTable
    first, later = _users_in_two(spark, d)
    table = BucketedTable.create(scd2.build_scd2(first, "user_id"), scratch_path(spark, "users_scd2"), ["user_id"])
    return table.update(later, lambda h, new: scd2.apply_scd2(h, new, "user_id")).read()


def pipeline_run(spark: SparkSession, d: str) -> DataFrame:
    """One scheduled run (staging -> marts -> snapshots -> tests) over the
    change log, written under the shared checkpoint folder; returns the run
    log without its wall-clock seconds."""
    from changeloom.plans.pipeline import run_pipeline
    return run_pipeline(spark, raw(spark, d), scratch_path(spark, "pipeline")).drop("seconds")


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "raw_change_log": raw,
    }
    for name in staging.STAGING_MODELS:
        q[name] = _stg(name)
    q.update({
        "dim_users": lambda s, d: marts.dim_users(staging.stg_users(raw(s, d))),
        "dim_plans": lambda s, d: marts.dim_plans(staging.stg_plans(raw(s, d))),
        "fct_subscriptions": lambda s, d: marts.fct_subscriptions(
            staging.stg_subscriptions(raw(s, d)), _plans(raw(s, d))),
        "fct_payments": _fct_payments,
        "revenue_by_day": revenue_by_day,
        "mrr_by_plan": lambda s, d: metrics.mrr_by_plan(_latest_subs(s, d)),
        "churn_rate": lambda s, d: metrics.churn_rate(_latest_subs(s, d)),
        "avg_duration": lambda s, d: metrics.avg_duration(_latest_subs(s, d)),
        "revenue_by_month": lambda s, d: metrics.revenue_by_month(
            _fct_payments(s, d)),
        "payment_failure_rate": lambda s, d: metrics.payment_failure_rate(_fct_payments(s, d)),
        "payment_retry_rate": lambda s, d: metrics.payment_retry_rate(_fct_payments(s, d)),
        "revenue_by_day_incremental": revenue_by_day_incremental,
        "mrr_incremental": mrr_incremental,
        "users_scd2": users_scd2,
        "plans_scd2": plans_scd2,
        "users_scd2_changes_only": users_scd2_changes_only,
        "scd2_incremental": scd2_incremental,
        "scd2_incremental_tracked": scd2_incremental_tracked,
        "scd2_hard_deletes": scd2_hard_deletes,
        "dq_report": dq_report,
        "fk_violations": fk_violations,
        "orphan_payments": orphan_payments,
        "non_positive_mrr": non_positive_mrr,
        "parse_events": lambda s, d: _parsed(s, d)[0],
        "parse_rejects": lambda s, d: _parsed(s, d)[1].drop("value"),
        "replay_dedup": lambda s, d: monitor.dedup_offsets(_parsed(s, d)[0]),
        "late_events": lambda s, d: monitor.late_events(staging.stg_users(raw(s, d)), "user_id"),
        "schema_drift": lambda s, d: monitor.schema_drift(raw(s, d), monitor.expected_columns(s)),
        **FAULTY,
        "revenue_by_month_faulty": lambda s, d: metrics.revenue_by_month(_fct_payments(s, d, faulty_log)),
        "schema_drift_recent": lambda s, d: monitor.schema_drift(
            drifted_log(s, d), monitor.expected_columns(s), DRIFT_SINCE_MS),
        "source_constraints": source_constraints,
        "lifecycle_violations": lifecycle_violations,
        "column_renames": lambda s, d: monitor.column_renames(drifted_log(s, d), DRIFT_SINCE_MS),
        "type_drift_faulty": lambda s, d: monitor.type_drift(drifted_log(s, d)),
        "type_drift": lambda s, d: monitor.type_drift(raw(s, d)),
        "silence_gaps": lambda s, d: monitor.silence_gaps(raw(s, d)),
        "batch_stats": batch_stats,
        "current_silence": current_silence,
        "stream_landing": stream_landing,
        "stream_dedup": stream_dedup,
        "stream_landing_bounded": stream_landing_bounded,
        "current_silence_live": current_silence_live,
        "snapshot_bootstrap": snapshot_bootstrap,
        "dim_users_incremental": dim_users_incremental,
        "dim_users_bucketed": dim_users_bucketed,
        "users_scd2_bucketed": users_scd2_bucketed,
        "pipeline_run": pipeline_run,
    })
    return q
