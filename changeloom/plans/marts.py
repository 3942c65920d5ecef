"""Marts: latest-state dimensions, calendar, subscription and payment facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import flag
from changeloom.operators.latest import latest_by_key
from changeloom.plans.staging import retry_counts

DIM_USER_COLUMNS = ["user_id", "email", "name", "plan_id", "created_at",
                    "cdc_op", "cdc_ts_ms", "cdc_consumed_at"]
DIM_PLAN_COLUMNS = ["plan_id", "name", "price", "billing_cycle", "created_at",
                    "cdc_op", "cdc_ts_ms", "cdc_consumed_at"]
FCT_SUBSCRIPTION_COLUMNS = ["subscription_id", "user_id", "plan_id", "status", "started_at",
                            "ended_at", "mrr", "is_churned", "duration_days",
                            "cdc_op", "cdc_ts_ms", "cdc_consumed_at"]
FCT_PAYMENT_COLUMNS = ["payment_id", "subscription_id", "user_id", "plan_id", "amount",
                       "status", "created_at", "is_retry", "is_successful", "is_failed",
                       "is_refunded", "recognised_revenue", "cdc_op", "cdc_ts_ms",
                       "cdc_consumed_at"]


def dim_users(stg_users: DataFrame) -> DataFrame:
    """Latest event per user (newest ``cdc_ts_ms``, ties by ``cdc_id``)."""
    return latest_by_key(stg_users, ["user_id"]).select(*DIM_USER_COLUMNS)


def dim_plans(stg_plans: DataFrame) -> DataFrame:
    return latest_by_key(stg_plans, ["plan_id"]).select(*DIM_PLAN_COLUMNS)


def dim_dates(spark: SparkSession, start: str = "2024-01-01", end: str = "2030-12-31"
              ) -> DataFrame:
    """Calendar: one row per day from ``start`` to ``end`` inclusive.

    Names are blank-padded to 9 characters (the width of the longest English
    month / day name), weeks are ISO weeks, ``day_of_week`` is 0 for Sunday.
    """
    d = F.col("date_day")
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                             F.expr("interval 1 day"))).alias("date_day"))
    dow = F.dayofweek(d) - 1
    return days.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        dow.alias("day_of_week"),
        F.rpad(F.date_format(d, "EEEE"), 9, " ").alias("day_name"),
        flag(dow.isin(0, 6)).alias("is_weekend"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


def latest_plans(stg_plans: DataFrame) -> DataFrame:
    return latest_by_key(stg_plans, ["plan_id"]).select("plan_id", "price", "billing_cycle")


def monthly(price, billing_cycle):
    """Monthly revenue of a plan: a twelfth of an annual price, to the cent."""
    return (F.when(billing_cycle == "annual", F.round(price / 12, 2)).otherwise(price)).cast("decimal(10,2)")


def plan_mrr(stg_plans: DataFrame) -> DataFrame:
    """(plan_id, mrr) of the latest plans."""
    return latest_plans(stg_plans).select("plan_id", monthly(F.col("price"), F.col("billing_cycle")).alias("mrr"))


def subscription_facts(stg_subscriptions: DataFrame, stg_plans: DataFrame,
                       keep: list[str] | None = None) -> DataFrame:
    """fct_subscriptions plus the extra columns in ``keep`` (e.g. cdc_id).

    No hint on the plans: adaptive execution broadcasts them when they turn out
    small, and splits a hot plan when they do not."""
    plans = latest_plans(stg_plans)
    s = stg_subscriptions.alias("s")
    joined = s.join(plans.alias("p"), F.col("s.plan_id") == F.col("p.plan_id"), "left")
    mrr = monthly(F.col("p.price"), F.col("p.billing_cycle"))
    duration = F.when(F.col("s.ended_at").isNotNull(),
                      F.extract(F.lit("DAY"), F.col("s.ended_at") - F.col("s.started_at"))
                      .cast("int"))
    return joined.select(
        F.col("s.subscription_id"), F.col("s.user_id"), F.col("s.plan_id"),
        F.col("s.status"), F.col("s.started_at"), F.col("s.ended_at"),
        mrr.alias("mrr"),
        flag(F.col("s.status") == "cancelled").alias("is_churned"),
        duration.alias("duration_days"),
        F.col("s.cdc_op"), F.col("s.cdc_ts_ms"), F.col("s.cdc_consumed_at"),
        *[F.col(f"s.{c}") for c in (keep or [])])


def fct_subscriptions(stg_subscriptions: DataFrame, stg_plans: DataFrame) -> DataFrame:
    """One row per subscription event with MRR, churn flag and duration."""
    return subscription_facts(stg_subscriptions, stg_plans).select(*FCT_SUBSCRIPTION_COLUMNS)


def fct_payments(stg_payments_base: DataFrame, stg_subscriptions: DataFrame) -> DataFrame:
    """One row per payment: its latest event, the owning subscription's
    latest user / plan, retry flag and revenue flags.

    Plan: payments are cut to one row per payment_id (partial top-1 before
    the shuffle), then joined on subscription_id to the per-subscription
    event counts (the retry flag, pre-aggregated) with the latest subscription
    state.  The two right sides, one row per subscription, are joined first on
    the partitioning they already have, so payments move once for the top-1 and
    once for one join; a hot subscription is split by adaptive skew handling.
    Payments without a subscription are one group of their own: their number is
    a one-row aggregate.
    """
    pay = latest_by_key(stg_payments_base, ["payment_id"]).alias("p")
    counts = retry_counts(stg_payments_base.where(F.col("subscription_id").isNotNull()))
    subs = latest_by_key(stg_subscriptions, ["subscription_id"]) \
        .select("subscription_id", "user_id", "plan_id")
    owners = counts.join(subs, "subscription_id", "left").alias("s")
    unowned = stg_payments_base.where(F.col("subscription_id").isNull()).agg(
        F.count(F.lit(1)).alias("_unowned"))
    joined = (pay.join(owners, F.col("p.subscription_id") == F.col("s.subscription_id"), "left")
              .join(F.broadcast(unowned)))
    status = F.col("p.status")
    return joined.select(
        F.col("p.payment_id"), F.col("p.subscription_id"), F.col("s.user_id"),
        F.col("s.plan_id"), F.col("p.amount"), status.alias("status"),
        F.col("p.created_at"),
        (F.coalesce(F.col("s._events"), F.col("_unowned")) > 1).alias("is_retry"),
        flag(status == "success").alias("is_successful"),
        flag(status == "failed").alias("is_failed"),
        flag(status == "refunded").alias("is_refunded"),
        F.when(status == "success", F.col("p.amount"))
         .otherwise(F.lit(0).cast("decimal(10,2)")).alias("recognised_revenue"),
        F.col("p.cdc_op"), F.col("p.cdc_ts_ms"), F.col("p.cdc_consumed_at"),
    )


MARTS = ["dim_users", "dim_plans", "dim_dates", "fct_subscriptions", "fct_payments"]
