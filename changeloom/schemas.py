"""Relation schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (they must equal the source system's domain values).
# Plans in id order: (plan_id, name, price, billing_cycle).
PLANS = [
    (1, "starter", "9.99", "monthly"),
    (2, "growth", "29.99", "monthly"),
    (3, "pro", "79.99", "monthly"),
    (4, "starter", "99.99", "annual"),
    (5, "growth", "299.99", "annual"),
    (6, "pro", "799.99", "annual"),
]
SUBSCRIPTION_STATUSES = ["active", "cancelled", "paused", "expired"]
PAYMENT_STATUSES = ["success", "failed", "refunded", "pending"]
BILLING_CYCLES = ["monthly", "annual"]
STAGED_OPS = ["c", "u", "r"]          # ops kept by the four entity models
EVENT_OPS = ["c", "r"]                # events are insert-only
# Connector metadata fields have a plain and a prefixed spelling.
META_PREFIX = "__"
DELETED_MARKER = "__deleted"
# Row-image columns per source table with their declared types.
EXPECTED_COLUMNS = {
    "users": [("user_id", "int"), ("email", "string"), ("name", "string"),
              ("plan_id", "int"), ("created_at", "bigint")],
    "plans": [("plan_id", "int"), ("name", "string"), ("price", "decimal(10,2)"),
              ("billing_cycle", "string"), ("created_at", "bigint")],
    "subscriptions": [("subscription_id", "int"), ("user_id", "int"),
                      ("plan_id", "int"), ("status", "string"),
                      ("started_at", "bigint"), ("ended_at", "bigint")],
    "payments": [("payment_id", "int"), ("subscription_id", "int"),
                 ("amount", "decimal(10,2)"), ("status", "string"),
                 ("created_at", "bigint")],
    "events": [("event_id", "int"), ("user_id", "int"), ("event_type", "string"),
               ("properties", "string"), ("created_at", "bigint")],
}
# Constraints of the source tables: (table, column, kind, argument).
SOURCE_CONSTRAINTS = [
    ("plans", "plan_id", "primary_key", None), ("plans", "plan_id", "not_null", None),
    ("plans", "name", "not_null", None), ("plans", "name", "max_length", 50),
    ("plans", "price", "not_null", None),
    ("plans", "billing_cycle", "not_null", None), ("plans", "billing_cycle", "max_length", 20),
    ("plans", "billing_cycle", "check", BILLING_CYCLES), ("plans", "created_at", "not_null", None),
    ("users", "user_id", "primary_key", None), ("users", "user_id", "not_null", None),
    ("users", "email", "not_null", None), ("users", "email", "max_length", 255), ("users", "email", "unique", None),
    ("users", "name", "not_null", None), ("users", "name", "max_length", 100), ("users", "created_at", "not_null", None),
    ("subscriptions", "subscription_id", "primary_key", None), ("subscriptions", "subscription_id", "not_null", None),
    ("subscriptions", "user_id", "not_null", None), ("subscriptions", "plan_id", "not_null", None),
    ("subscriptions", "status", "not_null", None), ("subscriptions", "status", "max_length", 20),
    ("subscriptions", "status", "check", SUBSCRIPTION_STATUSES), ("subscriptions", "started_at", "not_null", None),
    ("payments", "payment_id", "primary_key", None), ("payments", "payment_id", "not_null", None),
    ("payments", "subscription_id", "not_null", None), ("payments", "amount", "not_null", None),
    ("payments", "status", "not_null", None), ("payments", "status", "max_length", 20),
    ("payments", "status", "check", PAYMENT_STATUSES), ("payments", "created_at", "not_null", None),
    ("events", "event_id", "primary_key", None), ("events", "event_id", "not_null", None),
    ("events", "user_id", "not_null", None), ("events", "event_type", "not_null", None),
    ("events", "event_type", "max_length", 50), ("events", "created_at", "not_null", None),
]
# Property keys flattened by the events model.
EVENT_PROPERTY_COLUMNS = [
    ("page", "string"), ("referrer", "string"), ("button", "string"),
    ("feature", "string"), ("plan", "string"), ("device", "string"),
    ("method", "string"), ("duration_seconds", "int"),
]
# ---------------------------------------------------------------------------

# Identifiers are widened to bigint: at cluster scale the order / line keys
# that feed subscription and payment ids exceed the int range.
ID_TYPE = "bigint"

MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("value", T.StringType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

RAW_SCHEMA = T.StructType([
    T.StructField("cdc_id", T.LongType(), False),
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset_value", T.LongType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("before", T.StringType(), True),
    T.StructField("after", T.StringType(), True),
    T.StructField("ts_ms", T.LongType(), False),
    T.StructField("consumed_at", T.TimestampNTZType(), False),
])
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]


def expected_columns_rows() -> list[tuple[str, str, str]]:
    """(source_table, column, declared type) rows of ``EXPECTED_COLUMNS``."""
    return [(t, c, ty) for t, cols in EXPECTED_COLUMNS.items() for c, ty in cols]
