"""Change log derived from the base tables.

The base tables play the OLTP side: every row turns into the change events a
log-based capture would have emitted for it.  All rules are deterministic
column expressions, so the log is rebuilt identically on any cluster and by
any SQL engine (the oracle queries use the same rules).

Rules (ids are entity keys, times epoch micro/milliseconds):

* users <- customer: ``c`` for every customer (created 2024-01-01 plus
  ``c_custkey`` minutes, plan ``custkey % 6 + 1``); ``u`` with a new plan
  ``(custkey + 1) % 6 + 1`` after 30 days when ``custkey % 10 = 0`` (consumed
  45 days late when ``custkey % 30 = 0``); ``u`` renaming the user after 60
  days when ``custkey % 15 = 0``; ``d`` after 90 days when ``custkey % 37 = 0``.
* plans: the six catalogue plans created on 2024-01-01, then a yearly price
  review (+5 % per year since 2024, rounded half up to the cent) on January 1st
  of every later year in which orders exist.
* subscriptions <- orders (order dates shifted by ``DATE_SHIFT_DAYS``): ``c``
  active on the order date (written ``" Active "`` when ``orderkey % 7 = 0``);
  status F -> ``u`` cancelled after ``orderkey % 90`` days and ``orderkey % 24 + 1``
  hours, P -> ``u`` paused after 15 days, O with ``orderkey % 11 = 0`` -> ``u``
  expired after 365 days; ``r`` snapshot re-read of the final state after 400
  days when ``orderkey % 50 = 0``.
* payments <- lineitem: one ``c`` per line, id ``orderkey * 10 + linenumber``
  (not unique: repeated ids are repeated events), status N/A/R ->
  success/failed/refunded (upper-cased with a trailing blank on line 7).
* events <- events: one ``c`` per event, type mapped to the product's event
  names, properties derived from ``props.k``; odd event ids carry the
  properties string-encoded, as a JSON column often arrives.

``offset_value`` is a 60-bit hash of the event's natural key, ``partition``
the entity key modulo 3, ``cdc_id`` the 60-bit hash of
(topic, partition, offset_value), and ``consumed_at`` is ``ts_ms`` plus
``offset_value % 5000`` ms (plus the late-arrival delay).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import hash60, micros_to_ts, millis_to_ts, ts_to_micros
from changeloom.schemas import PLANS, RAW_COLUMNS
from changeloom.sources.tables import read_table

# Fixed values of the derivation (shared with the oracle SQL).
TOPIC_PREFIX = "shop.public."
BASE_MICROS = 1704067200000000           # 2024-01-01 00:00:00 UTC
DAY_MS = 86_400_000
DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000
DATE_SHIFT_DAYS = 10_592                 # moves 1995-2001 order dates into 2024-2030
LATE_DELAY_MS = 45 * DAY_MS
EVENT_TYPE_MAP = [("view", "page_view"), ("click", "button_click"),
                  ("signup", "login"), ("purchase", "checkout_started"),
                  ("error", "support_ticket_opened")]
DEVICES = ["desktop", "mobile", "tablet"]
PLAN_NAMES = ["starter", "growth", "pro"]

_JSON_OPTS = {"ignoreNullFields": "false"}


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), _JSON_OPTS)


def _object(*fields: tuple[str, Column]) -> Column:
    """The text of ``_json`` for fields given as JSON text (NULL: ``null``), joined
    without a JSON writer."""
    parts = [F.lit("{")]
    for i, (name, text) in enumerate(fields):
        parts += [F.lit(f'{"," if i else ""}"{name}":'), F.coalesce(text.cast("string"), F.lit("null"))]
    return F.concat(*parts, F.lit("}"))


def _plain(text: Column) -> Column:
    """A string without characters to escape as JSON text."""
    return F.concat(F.lit('"'), text, F.lit('"'))


def _escaped(text: Column) -> Column:
    """Any string as JSON text."""
    whole = F.to_json(F.struct(text.alias("v")), _JSON_OPTS)
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def _shifted_micros(c: str) -> Column:
    return ts_to_micros(F.col(c)) + F.lit(DATE_SHIFT_DAYS * DAY_US)


def _finish(df: DataFrame, table: str) -> DataFrame:
    """Add topic / partition / offset / ids / consumed_at to an event frame.

    ``df`` has: entity_key, natural_key (string), op, ts_ms, after, del_key
    and optionally late_ms (extra arrival delay).
    """
    topic = F.lit(TOPIC_PREFIX + table)
    offset = hash60(F.lit(table), F.col("natural_key"))
    part = (F.col("entity_key") % 3).cast("int")
    late = F.col("late_ms") if "late_ms" in df.columns else F.lit(0)
    delay = F.col("offset_value") % 5000 + late
    return (df
            .withColumn("topic", topic)
            .withColumn("partition", part)
            .withColumn("offset_value", offset)
            .withColumn("source_table", F.lit(table))
            .withColumn("before", F.lit(None).cast("string"))
            .withColumn("cdc_id", hash60(F.col("topic"), F.col("partition"),
                                         F.col("offset_value")))
            .withColumn("consumed_at", millis_to_ts(F.col("ts_ms") + delay))
            .withColumn("after", F.when(F.col("op") == "d", F.lit(None))
                        .otherwise(F.col("after")))
            .drop("late_ms"))


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    k = F.col("c_custkey")
    created = F.lit(BASE_MICROS) + k * F.lit(MINUTE_US)
    c_ms = F.floor(created / 1000).cast("bigint")
    email = F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                     F.lit("@example.com"))
    plan0 = (k % 6 + 1).cast("int")
    plan1 = ((k + 1) % 6 + 1).cast("int")
    versions = F.array(
        F.struct(F.lit("c").alias("op"), c_ms.alias("ts_ms"), F.col("c_name").alias("name"),
                 plan0.alias("plan_id"), F.lit(True).alias("keep"), F.lit(0).alias("late_ms")),
        F.struct(F.lit("u").alias("op"), (c_ms + 30 * DAY_MS).alias("ts_ms"),
                 F.col("c_name").alias("name"), plan1.alias("plan_id"),
                 (k % 10 == 0).alias("keep"),
                 F.when(k % 30 == 0, F.lit(LATE_DELAY_MS)).otherwise(F.lit(0)).alias("late_ms")),
        F.struct(F.lit("u").alias("op"), (c_ms + 60 * DAY_MS).alias("ts_ms"),
                 F.upper(F.col("c_name")).alias("name"),
                 F.when(k % 10 == 0, plan1).otherwise(plan0).alias("plan_id"),
                 (k % 15 == 0).alias("keep"), F.lit(0).alias("late_ms")),
        F.struct(F.lit("d").alias("op"), (c_ms + 90 * DAY_MS).alias("ts_ms"),
                 F.col("c_name").alias("name"), plan0.alias("plan_id"),
                 (k % 37 == 0).alias("keep"), F.lit(0).alias("late_ms")),
    )
    ev = (c.select(k.alias("entity_key"), email.alias("email"), created.alias("created_at"),
                   F.explode(F.filter(versions, lambda v: v["keep"])).alias("v"))
          .select("entity_key", "email", "created_at", "v.*"))
    ev = ev.select(
        "entity_key", "op", "ts_ms", "late_ms",
        F.concat_ws("|", F.col("entity_key"), F.col("op"), F.col("ts_ms")).alias("natural_key"),
        _json(F.col("entity_key").alias("user_id"), F.col("email"), F.col("name"),
              F.col("plan_id"), F.col("created_at")).alias("after"),
        F.concat(F.lit('"user_id":'), F.col("entity_key")).alias("del_key"),
    )
    return _finish(ev, "users")


def plan_events(spark: SparkSession, sf_dir: str, plans: list[tuple] = PLANS) -> DataFrame:
    """Catalogue plans plus one yearly price review per year with orders."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate"])
    base_ms = BASE_MICROS // 1000
    years = (o.select(F.year(micros_to_ts(_shifted_micros("o_orderdate")))
                      .alias("year"))
             .distinct()
             .where(F.col("year") > 2024))
    catalogue = F.array(*[
        F.struct(F.lit(pid).alias("plan_id"), F.lit(name).alias("name"),
                 F.lit(int(price.replace(".", ""))).cast("bigint").alias("base_cents"),
                 F.lit(cycle).alias("billing_cycle"))
        for pid, name, price, cycle in plans])
    # Base events: one 'c' per catalogue plan (year 2024 stands for creation).
    creation = spark.range(1).select(F.lit(2024).alias("year"))
    ev = (creation.unionByName(years)
          .select("year", F.explode(catalogue).alias("p"))
          .select("year", "p.*"))
    n = F.col("year") - 2024
    cents = F.floor((F.col("base_cents") * (100 + 5 * n) + 50) / 100).cast("bigint")
    price = F.concat(F.floor(cents / 100).cast("string"), F.lit("."),
                     F.lpad((cents % 100).cast("string"), 2, "0"))
    year_start_ms = ts_to_micros(F.make_timestamp_ntz(
        F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))) / 1000
    ev = ev.select(
        F.col("plan_id").cast("bigint").alias("entity_key"),
        F.when(F.col("year") == 2024, F.lit("c")).otherwise(F.lit("u")).alias("op"),
        F.when(F.col("year") == 2024, F.lit(base_ms))
         .otherwise(year_start_ms.cast("bigint")).alias("ts_ms"),
        F.col("plan_id"), F.col("name"), price.alias("price"), F.col("billing_cycle"),
    )
    return _finish(ev.select(
        "entity_key", "op", "ts_ms",
        F.concat_ws("|", F.col("entity_key"), F.col("op"), F.col("ts_ms")).alias("natural_key"),
        _json(F.col("plan_id"), F.col("name"), F.col("price"), F.col("billing_cycle"),
              F.lit(BASE_MICROS).alias("created_at")).alias("after"),
        F.concat(F.lit('"plan_id":'), F.col("entity_key")).alias("del_key"),
    ), "plans")


def subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    k = F.col("o_orderkey")
    start = _shifted_micros("o_orderdate")
    start_ms = F.floor(start / 1000).cast("bigint")
    status = F.col("o_orderstatus")
    end_cancel = start + (k % 90) * F.lit(DAY_US) + (k % 24 + 1) * F.lit(HOUR_US)
    end_expire = start + F.lit(365 * DAY_US)
    final_status = (F.when(status == "F", F.lit("cancelled"))
                    .when(status == "P", F.lit("paused"))
                    .when(k % 11 == 0, F.lit("expired"))
                    .otherwise(F.lit("active")))
    final_end = (F.when(status == "F", end_cancel)
                 .when((status == "O") & (k % 11 == 0), end_expire))
    final_ms = (F.when(status == "F", F.floor(end_cancel / 1000))
                .when(status == "P", start_ms + 15 * DAY_MS)
                .when(k % 11 == 0, F.floor(end_expire / 1000))).cast("bigint")
    null_long = F.lit(None).cast("bigint")
    versions = F.array(
        F.struct(F.lit("c").alias("op"), start_ms.alias("ts_ms"),
                 F.when(k % 7 == 0, F.lit(" Active ")).otherwise(F.lit("active")).alias("status"),
                 null_long.alias("ended_at"), F.lit(True).alias("keep")),
        F.struct(F.lit("u").alias("op"), final_ms.alias("ts_ms"), final_status.alias("status"),
                 final_end.alias("ended_at"), final_ms.isNotNull().alias("keep")),
        F.struct(F.lit("r").alias("op"), (start_ms + 400 * DAY_MS).alias("ts_ms"),
                 final_status.alias("status"), final_end.alias("ended_at"),
                 (k % 50 == 0).alias("keep")),
    )
    ev = (o.select(k.alias("entity_key"), F.col("o_custkey").alias("user_id"),
                   (k % 6 + 1).cast("int").alias("plan_id"), start.alias("started_at"),
                   F.explode(F.filter(versions, lambda v: v["keep"])).alias("v"))
          .select("entity_key", "user_id", "plan_id", "started_at", "v.*"))
    return _finish(ev.select(
        "entity_key", "op", "ts_ms",
        F.concat_ws("|", F.col("entity_key"), F.col("op"), F.col("ts_ms")).alias("natural_key"),
        _object(("subscription_id", F.col("entity_key")), ("user_id", F.col("user_id")),
                ("plan_id", F.col("plan_id")), ("status", _plain(F.col("status"))),
                ("started_at", F.col("started_at")), ("ended_at", F.col("ended_at"))).alias("after"),
        F.concat(F.lit('"subscription_id":'), F.col("entity_key")).alias("del_key"),
    ), "subscriptions")


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     "l_extendedprice", "l_returnflag", "l_shipdate"])
    created = _shifted_micros("l_shipdate")
    amount = F.col("l_extendedprice").cast("decimal(10,2)").cast("string")
    base = (F.when(F.col("l_returnflag") == "N", F.lit("success"))
            .when(F.col("l_returnflag") == "A", F.lit("failed"))
            .when(F.col("l_returnflag") == "R", F.lit("refunded")))
    status = F.when(F.col("l_linenumber") == 7, F.concat(F.upper(base), F.lit(" "))) \
        .otherwise(base)
    pid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    ev = li.select(
        pid.alias("entity_key"), F.lit("c").alias("op"),
        F.floor(created / 1000).cast("bigint").alias("ts_ms"),
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    created, amount, "l_returnflag").alias("natural_key"),
        _object(("payment_id", pid), ("subscription_id", F.col("l_orderkey")),
                ("amount", _plain(amount)), ("status", _plain(status)),
                ("created_at", created)).alias("after"),
        F.concat(F.lit('"payment_id":'), pid).alias("del_key"),
    )
    return _finish(ev, "payments")


def _event_properties() -> Column:
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    etype = F.col("event_type")
    # Keys in alphabetical order: a JSON object re-serialised from a variant
    # lists its keys sorted, so both encodings then carry the same text.
    props = _object(
        ("button", F.when(etype == "button_click", _plain(F.concat(F.lit("btn_"), k % 5)))),
        ("device", _plain(F.element_at(F.array(*[F.lit(d) for d in DEVICES]), (k % 3 + 1).cast("int")))),
        ("duration_seconds", k),
        ("method", F.when(etype == "login", F.when(k % 2 == 0, F.lit('"password"'))
                          .otherwise(F.lit('"sso"')))),
        ("page", _plain(F.concat(F.lit("/page/"), k % 10))),
        ("plan", F.when(etype == "checkout_started",
                        _plain(F.element_at(F.array(*[F.lit(p) for p in PLAN_NAMES]),
                                            (k % 3 + 1).cast("int"))))),
        ("referrer", F.when(k % 2 == 0, F.lit('"search"')).otherwise(F.lit('"direct"'))),
    )
    return props


def event_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    mapping = F.create_map(*[F.lit(x) for pair in EVENT_TYPE_MAP for x in pair])
    known = mapping[F.col("event_type")]
    e = e.select("*", F.when(known.isNotNull(), _plain(known)).otherwise(_escaped(F.col("event_type"))).alias("type_text"))
    e = e.withColumn("event_type", F.coalesce(known, F.col("event_type")))
    created = ts_to_micros(F.col("ts"))
    props = _event_properties()
    # An object, or the same object's text as a JSON string (only quotes need an escape).
    prop_value = F.when(F.col("event_id") % 2 == 0, props) \
        .otherwise(_plain(F.replace(props, F.lit('"'), F.lit('\\"'))))
    ev = e.select(
        F.col("event_id").alias("entity_key"), F.lit("c").alias("op"),
        F.floor(created / 1000).cast("bigint").alias("ts_ms"),
        F.col("event_id").cast("string").alias("natural_key"),
        _object(("event_id", F.col("event_id")), ("user_id", F.col("user_id")),
                ("event_type", F.col("type_text")), ("properties", prop_value),
                ("created_at", created)).alias("after"),
        F.concat(F.lit('"event_id":'), F.col("event_id")).alias("del_key"),
    )
    return _finish(ev, "events")


BUILDERS = {
    "users": user_events,
    "plans": plan_events,
    "subscriptions": subscription_events,
    "payments": payment_events,
    "events": event_events,
}


def _events(spark: SparkSession, sf_dir: str, tables: list[str] | None) -> DataFrame:
    frames = [BUILDERS[t](spark, sf_dir) for t in (tables or list(BUILDERS))]
    return reduce(lambda a, b: a.unionByName(b), frames)


def change_log(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> DataFrame:
    """The raw change log (``RAW_SCHEMA``) for the given source tables.

    Restricting ``tables`` is the lazy equivalent of partition pruning on a
    landed log partitioned by ``source_table``.
    """
    return _events(spark, sf_dir, tables).select(*RAW_COLUMNS)


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages ``(topic, partition, offset, value, timestamp)``.

    Encoding rotates with ``offset % 3``: flat (``op``, ``table``, ``ts_ms`` at
    the end), prefixed (``__op``, ``__table``, ``__ts_ms``) and wrapped in a
    schema envelope.  Deletes carry only the key and ``__deleted``.  Every
    event with ``offset % 10 = 0`` is delivered twice (a replay after a
    failed commit), and every events-table event with ``event_id % 101 = 0`` is
    followed by a truncated, unparseable message at ``offset + 1``.
    """
    ev = _events(spark, sf_dir, None)
    body = F.when(F.col("op") == "d", F.concat(F.lit("{"), F.col("del_key"),
                                                F.lit(',"__deleted":"true"}'))) \
        .otherwise(F.col("after"))
    inner = F.substring(body, F.lit(1), F.length(body) - 1)
    meta_plain = F.concat(F.lit(',"op":"'), F.col("op"), F.lit('","table":"'),
                          F.col("source_table"), F.lit('","ts_ms":'), F.col("ts_ms"), F.lit("}"))
    meta_prefixed = F.concat(F.lit(',"__op":"'), F.col("op"), F.lit('","__table":"'),
                             F.col("source_table"), F.lit('","__ts_ms":'), F.col("ts_ms"),
                             F.lit("}"))
    flat = F.concat(inner, meta_plain)
    enc = F.col("offset_value") % 3
    value = (F.when(enc == 0, flat)
             .when(enc == 1, F.concat(inner, meta_prefixed))
             .otherwise(F.concat(F.lit('{"schema":{"type":"struct","name":"'), F.col("topic"),
                                 F.lit('.Value"},"payload":'), flat, F.lit("}"))))
    msgs = ev.select(F.col("topic"), F.col("partition"), F.col("offset_value").alias("offset"),
                     value.alias("value"), F.col("consumed_at").alias("timestamp"),
                     F.col("entity_key"), F.col("source_table"))
    copies = F.when(F.col("offset") % 10 == 0, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    broken = (msgs.where((F.col("source_table") == "events") & (F.col("entity_key") % 101 == 0))
              .select("topic", "partition", (F.col("offset") + 1).alias("offset"),
                      F.substring(F.col("value"), F.lit(1), F.length("value") - 1).alias("value"),
                      "timestamp"))
    good = msgs.select("topic", "partition", "offset", "value", "timestamp",
                       F.explode(copies).alias("copy")).drop("copy")
    return good.unionByName(broken)


def snapshot_events(base: DataFrame, table: str, key: str, ts_ms: Column) -> DataFrame:
    """Snapshot bootstrap: every row of a base table as an ``op='r'`` event.

    ``base`` holds the table's row-image columns (timestamps as epoch
    micros); the event time ``ts_ms`` is the snapshot time, which also
    stamps ``consumed_at``.  One narrow projection, no shuffle.
    """
    cols = [F.col(c) for c in base.columns]
    ev = base.select(
        F.col(key).cast("bigint").alias("entity_key"), F.lit("r").alias("op"),
        ts_ms.cast("bigint").alias("ts_ms"),
        _json(*cols).alias("after"))
    topic = F.lit(TOPIC_PREFIX + table)
    return (ev.select(
        topic.alias("topic"), (F.col("entity_key") % 3).cast("int").alias("partition"),
        hash60(F.lit(table), F.concat_ws("|", F.col("entity_key"), F.col("op"), F.col("ts_ms")))
        .alias("offset_value"),
        "op", F.lit(table).alias("source_table"), F.lit(None).cast("string").alias("before"),
        "after", "ts_ms", millis_to_ts(F.col("ts_ms")).alias("consumed_at"))
        .withColumn("cdc_id", hash60("topic", "partition", "offset_value"))
        .select(*RAW_COLUMNS))
