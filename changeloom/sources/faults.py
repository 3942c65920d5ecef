"""Faulty change events, derived from the base tables.

A clean log proves little about checks: they must also report what is wrong.
These events break, by fixed rules, what the checks, finders and drift
monitors look for; the oracle queries apply the same rules.

``fault_events`` (typed correctly, so that staging accepts them):

* users: for ``custkey % 41 = 0`` a second user ``-custkey`` with the same
  email (none when ``custkey % 82 = 0``) on the missing plan 99;
* plans: plan 7, free of charge, with an unknown billing cycle;
* subscriptions: for ``orderkey % 53 = 0`` a subscription ``-orderkey`` of an
  unknown user with an unknown status, on plan 7 (on the missing plan 98 when
  ``orderkey % 106 = 0``);
* payments: for line 1 of ``orderkey % 59 = 0`` a payment ``-orderkey`` of an
  unknown subscription with an unknown status, without an amount when
  ``orderkey % 118 = 0``; when ``orderkey % 177 = 0`` it is a success ten years
  later, outside the calendar;
* events: for ``event_id % 61 = 0`` an event ``-event_id - 1`` of an unknown
  user without a type.

``lifecycle_events`` (subscriptions out of order, with images): for ``orderkey %
61 = 0`` a change ten days before the creation; for ``orderkey % 67 = 0`` a second
creation after 20 days; for ``orderkey % 71 = 0`` a delete after 500 days and a
change after 510.

``drift_events``: for ``custkey % 47 = 0`` a users event 120 days after the
creation whose ``email`` is called ``mail``, with a new ``phone`` and values that
are not of the declared types.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.schemas import RAW_COLUMNS
from changeloom.sources.changelog import (BASE_MICROS, DAY_MS, DAY_US, MINUTE_US, _finish, _json,
                                          _shifted_micros, plan_events)
from changeloom.sources.tables import read_table

FREE_PLAN = (7, "Free", "0.00", "weekly")
NO_USER = 1_000_000_000
NO_SUBSCRIPTION = 1_000_000_000_000
TEN_YEARS_US = 3_650 * DAY_US


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    k = F.col("c_custkey")
    created = F.lit(BASE_MICROS) + k * F.lit(MINUTE_US)
    return c.select(k.alias("k"), "c_name", created.alias("created_at"),
                    F.floor(created / 1000).cast("bigint").alias("c_ms"),
                    F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                             F.lit("@example.com")).alias("email"))


def _keyed(df: DataFrame, table: str, key: str, *image) -> DataFrame:
    """Events ``c`` of a frame with entity_key and ts_ms."""
    return _finish(df.select(
        "entity_key", F.lit("c").alias("op"), "ts_ms",
        F.concat_ws("|", F.col("entity_key"), F.lit("c"), F.col("ts_ms")).alias("natural_key"),
        _json(F.col("entity_key").alias(key), *image).alias("after")), table)


def fault_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _users(spark, sf_dir).where("k % 41 = 0")
    users = _keyed(u.withColumns({"entity_key": -F.col("k"), "ts_ms": F.col("c_ms")}), "users", "user_id",
                   F.when(F.col("k") % 82 != 0, F.col("email")).alias("email"), F.col("c_name").alias("name"),
                   F.lit(99).alias("plan_id"), F.col("created_at"))

    o = (read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
         .where("o_orderkey % 53 = 0").withColumn("started_at", _shifted_micros("o_orderdate")))
    subscriptions = _keyed(
        o.withColumns({"entity_key": -F.col("o_orderkey"),
                       "ts_ms": F.floor(F.col("started_at") / 1000).cast("bigint")}),
        "subscriptions", "subscription_id", (F.col("o_custkey") + NO_USER).alias("user_id"),
        F.when(F.col("o_orderkey") % 106 == 0, F.lit(98)).otherwise(F.lit(7)).alias("plan_id"),
        F.lit("bogus").alias("status"), F.col("started_at"), F.lit(None).cast("bigint").alias("ended_at"))

    k = F.col("l_orderkey")
    li = (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"])
          .where("l_orderkey % 59 = 0 AND l_linenumber = 1")
          .withColumn("created_at", _shifted_micros("l_shipdate")
                      + F.when(k % 177 == 0, F.lit(TEN_YEARS_US)).otherwise(F.lit(0))))
    payments = _keyed(
        li.withColumns({"entity_key": -k, "ts_ms": F.floor(F.col("created_at") / 1000).cast("bigint")}),
        "payments", "payment_id", (k + NO_SUBSCRIPTION).alias("subscription_id"),
        F.when(k % 118 != 0, F.col("l_extendedprice").cast("decimal(10,2)").cast("string")).alias("amount"),
        F.when(k % 177 == 0, F.lit("success")).otherwise(F.lit("unknown")).alias("status"), F.col("created_at"))

    from changeloom.functions import ts_to_micros
    e = (read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id"]).where("event_id % 61 = 0")
         .withColumn("created_at", ts_to_micros(F.col("ts"))))
    none = F.lit(None).cast("string")
    events = _keyed(
        e.withColumns({"entity_key": -F.col("event_id") - 1,
                       "ts_ms": F.floor(F.col("created_at") / 1000).cast("bigint")}),
        "events", "event_id", (F.col("user_id") + NO_USER).alias("user_id"), none.alias("event_type"),
        none.alias("properties"), F.col("created_at"))
    plans = plan_events(spark, sf_dir, [FREE_PLAN])
    return reduce(DataFrame.unionByName,
                  [x.select(*RAW_COLUMNS) for x in (users, plans, subscriptions, payments, events)])


def drift_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _users(spark, sf_dir).where("k % 47 = 0")
    drifted = _finish(u.select(
        F.col("k").alias("entity_key"), F.lit("u").alias("op"), (F.col("c_ms") + 120 * DAY_MS).alias("ts_ms"),
        F.concat_ws("|", F.col("k"), F.lit("drift")).alias("natural_key"),
        _json(F.concat(F.lit("u"), F.col("k")).alias("user_id"), F.col("email").alias("mail"),
              F.col("c_name").alias("name"), F.lit(1).alias("plan_id"), F.lit("soon").alias("created_at"),
              F.lit("555").alias("phone")).alias("after")), "users")
    return drifted.select(*RAW_COLUMNS)


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = (read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
         .withColumn("started_at", _shifted_micros("o_orderdate")))
    start_ms = F.floor(F.col("started_at") / 1000).cast("bigint")

    def event(op: str, days: int, divisor: int):
        return F.struct(F.lit(op).alias("op"), (start_ms + days * DAY_MS).alias("ts_ms"), (k % divisor == 0).alias("keep"))

    events = F.array(event("u", -10, 61), event("c", 20, 67), event("d", 500, 71), event("u", 510, 71))
    ev = o.select(k.alias("entity_key"), "o_custkey", "started_at", F.explode(F.filter(events, lambda e: e["keep"])).alias("e"))
    return _finish_with_image(ev.select("entity_key", "o_custkey", "started_at", "e.op", "e.ts_ms")).select(*RAW_COLUMNS)


def _finish_with_image(ev: DataFrame) -> DataFrame:
    image = _json(F.col("entity_key").alias("subscription_id"), F.col("o_custkey").alias("user_id"),
                  F.lit(1).alias("plan_id"), F.lit("active").alias("status"), F.col("started_at"),
                  F.lit(None).cast("bigint").alias("ended_at"))
    key = F.concat_ws("|", F.col("entity_key"), F.lit("lifecycle"), F.col("op"), F.col("ts_ms"))
    done = _finish(ev.select("entity_key", "op", "ts_ms", key.alias("natural_key"), F.lit("").alias("after"),
                             image.alias("image")), "subscriptions")
    return done.withColumn("after", F.col("image")).drop("image")
