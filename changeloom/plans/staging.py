"""Staging models: one typed row per change event of one source table.

Each model scans the raw log for its source table (partition pruning on a
landed log partitioned by ``source_table``), keeps the staged ops (pushed to
the scan), parses ``after`` once into an all-string struct (Catalyst prunes
fields nobody reads) and casts strictly — a value that does not cast fails
the job, as in the source database.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import micros_to_ts
from changeloom.schemas import EVENT_OPS, EVENT_PROPERTY_COLUMNS, ID_TYPE, STAGED_OPS



def cdc_columns() -> list[Column]:
    return [F.col("cdc_id"), F.col("op").alias("cdc_op"), F.col("ts_ms").alias("cdc_ts_ms"),
            F.col("consumed_at").alias("cdc_consumed_at")]


def scan_raw(raw: DataFrame, table: str) -> DataFrame:
    """Raw change events of one source table."""
    return raw.where(F.col("source_table") == F.lit(table))


def _extract(raw: DataFrame, table: str, ops: list[str], fields: list[str]) -> DataFrame:
    schema = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"
    src = scan_raw(raw, table).where(F.col("op").isin(*ops))
    return src.select(*cdc_columns(), F.from_json("after", schema).alias("j"))


def _ts(field: str) -> Column:
    return micros_to_ts(F.col(f"j.{field}").cast("bigint"))


def _id(field: str) -> Column:
    return F.col(f"j.{field}").cast(ID_TYPE).alias(field)


def _clean(field: str) -> Column:
    return F.lower(F.trim(F.col(f"j.{field}"))).alias(field)


def stg_users(raw: DataFrame) -> DataFrame:
    j = _extract(raw, "users", STAGED_OPS, ["user_id", "email", "name", "plan_id", "created_at"])
    return j.select("cdc_id", "cdc_op", "cdc_ts_ms", "cdc_consumed_at", _id("user_id"), F.col("j.email").alias("email"),
                    F.col("j.name").alias("name"), _id("plan_id"),
                    _ts("created_at").alias("created_at"))


def stg_plans(raw: DataFrame) -> DataFrame:
    j = _extract(raw, "plans", STAGED_OPS,
                 ["plan_id", "name", "price", "billing_cycle", "created_at"])
    return j.select("cdc_id", "cdc_op", "cdc_ts_ms", "cdc_consumed_at",
                    _id("plan_id"), F.col("j.name").alias("name"),
                    F.col("j.price").cast("decimal(10,2)").alias("price"),
                    F.col("j.billing_cycle").alias("billing_cycle"),
                    _ts("created_at").alias("created_at"))


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    j = _extract(raw, "subscriptions", STAGED_OPS,
                 ["subscription_id", "user_id", "plan_id", "status", "started_at", "ended_at"])
    return j.select("cdc_id", "cdc_op", "cdc_ts_ms", "cdc_consumed_at",
                    _id("subscription_id"), _id("user_id"), _id("plan_id"),
                    _clean("status"), _ts("started_at").alias("started_at"),
                    F.when(F.col("j.ended_at").isNotNull(), _ts("ended_at")).alias("ended_at"))


def stg_payments_base(raw: DataFrame) -> DataFrame:
    """Payment events without the retry flag (the flag needs a shuffle)."""
    j = _extract(raw, "payments", STAGED_OPS,
                 ["payment_id", "subscription_id", "amount", "status", "created_at"])
    return j.select("cdc_id", "cdc_op", "cdc_ts_ms", "cdc_consumed_at",
                    _id("payment_id"), _id("subscription_id"),
                    F.col("j.amount").cast("decimal(10,2)").alias("amount"),
                    _clean("status"), _ts("created_at").alias("created_at"))


def retry_counts(payments: DataFrame, key: str = "subscription_id") -> DataFrame:
    """Events per ``key`` (partial aggregation before the shuffle, so a hot
    key costs one row per map task)."""
    return payments.groupBy(key).agg(F.count(F.lit(1)).alias("_events"))


def flag_retry(payments: DataFrame, key: str = "subscription_id") -> DataFrame:
    """``is_retry``: more than one event shares ``key`` (NULL keys are one
    group), i.e. ``count(*) over (partition by key) > 1``.

    Expressed as pre-aggregated counts joined back on a null-safe key rather
    than a window: the window would put every event of a hot key into one
    task, the join is split by adaptive skew handling.
    """
    counts = retry_counts(payments, key).withColumnRenamed(key, "_k")
    joined = payments.join(counts, payments[key].eqNullSafe(counts["_k"]), "left")
    return joined.withColumn("is_retry", F.col("_events") > 1).drop("_k", "_events")


def stg_payments(raw: DataFrame) -> DataFrame:
    return flag_retry(stg_payments_base(raw))


def stg_events(raw: DataFrame) -> DataFrame:
    j = _extract(raw, "events", EVENT_OPS,
                 ["event_id", "user_id", "event_type", "properties", "created_at"])
    props_schema = "struct<" + ",".join(f"`{c}`:string" for c, _ in EVENT_PROPERTY_COLUMNS) + ">"
    p = F.from_json(F.col("j.properties"), props_schema)
    return j.select("cdc_id", "cdc_op", "cdc_ts_ms", "cdc_consumed_at",
                    _id("event_id"), _id("user_id"),
                    F.col("j.event_type").alias("event_type"),
                    _ts("created_at").alias("created_at"),
                    F.col("j.properties").alias("properties"),
                    *[p[c].cast(t).alias(c) for c, t in EVENT_PROPERTY_COLUMNS])


STAGING_MODELS = {
    "stg_users": stg_users,
    "stg_plans": stg_plans,
    "stg_subscriptions": stg_subscriptions,
    "stg_payments": stg_payments,
    "stg_events": stg_events,
}
