"""Business metrics over the facts (MRR, churn, revenue, failure, retry,
duration).  Subscription metrics use the latest state per subscription;
rates are exact decimals (round half up)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.latest import latest_by_key

RATE_SCALE = 6


def ratio(num: Column, den: Column, scale: int = RATE_SCALE) -> Column:
    """``num / den`` as decimal(18, scale), rounded half up; NULL when den = 0."""
    unit = 10 ** scale
    scaled = F.floor((num.cast("decimal(38,0)") * (2 * unit) + den) / (den * 2))
    return F.when(den != 0, (scaled.cast("decimal(38,0)") / unit)
                  .cast(f"decimal(18,{scale})"))


def latest_subscriptions(subscription_facts: DataFrame) -> DataFrame:
    """Current state per subscription (input must carry ``cdc_id``)."""
    return latest_by_key(subscription_facts, ["subscription_id"])


def mrr_by_plan(latest_subs: DataFrame) -> DataFrame:
    active = latest_subs.where(F.col("status") == "active")
    return active.groupBy("plan_id").agg(
        F.count(F.lit(1)).alias("active_subscriptions"),
        F.sum("mrr").cast("decimal(18,2)").alias("mrr"))


def churn_rate(latest_subs: DataFrame) -> DataFrame:
    agg = latest_subs.agg(F.count(F.lit(1)).alias("subscriptions"),
                          F.count(F.when(F.col("is_churned"), 1)).alias("churned"))
    return agg.select("subscriptions", "churned",
                      ratio(F.col("churned"), F.col("subscriptions")).alias("churn_rate"))


def avg_duration(latest_subs: DataFrame) -> DataFrame:
    closed = latest_subs.where(F.col("duration_days").isNotNull())
    agg = closed.agg(F.count(F.lit(1)).alias("closed_subscriptions"),
                     F.sum("duration_days").cast("bigint").alias("total_duration_days"))
    return agg.select("closed_subscriptions", "total_duration_days",
                      ratio(F.col("total_duration_days"), F.col("closed_subscriptions"))
                      .alias("avg_duration_days"))


def revenue_by_month(fct_payments: DataFrame) -> DataFrame:
    """Revenue per month of payment.  The month comes from the payment itself,
    so none is lost outside the calendar; payments without a time are the row
    with a NULL month."""
    p = fct_payments.select(F.date_format("created_at", "yyyy-MM").alias("year_month"),
                            "recognised_revenue", "is_successful")
    return (p.groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("payments"),
                 F.count(F.when(F.col("is_successful"), 1)).alias("successful_payments"),
                 F.sum("recognised_revenue").cast("decimal(18,2)").alias("revenue")))


def payment_failure_rate(fct_payments: DataFrame) -> DataFrame:
    agg = fct_payments.agg(F.count(F.lit(1)).alias("payments"),
                           F.count(F.when(F.col("is_failed"), 1)).alias("failed"))
    return agg.select("payments", "failed",
                      ratio(F.col("failed"), F.col("payments")).alias("failure_rate"))


def payment_retry_rate(fct_payments: DataFrame) -> DataFrame:
    agg = fct_payments.agg(F.count(F.lit(1)).alias("payments"),
                           F.count(F.when(F.col("is_retry"), 1)).alias("retries"))
    return agg.select("payments", "retries",
                      ratio(F.col("retries"), F.col("payments")).alias("retry_rate"))
