"""DuckDB reference SQL for the registered queries.

The change log is re-derived here directly from the base tables with the
rules of ``changeloom.sources.changelog`` — without the JSON round trip the
Spark side goes through — so an equal result shows parsing and extraction
are lossless.  Only ``raw_change_log`` / ``parse_events`` rebuild the JSON
text of ``after``.
"""

from __future__ import annotations

from changeloom.plans.checks import project_checks
from changeloom.plans.queries import DRIFT_SINCE_MS, FOREIGN_KEYS, SILENCE_MINUTES, SILENCE_NOW
from changeloom.plans.staging import STAGING_MODELS
from changeloom.sources.faults import NO_SUBSCRIPTION, NO_USER, TEN_YEARS_US
from changeloom.schemas import EXPECTED_COLUMNS, PLANS, SOURCE_CONSTRAINTS
from changeloom.sources.changelog import (BASE_MICROS, DATE_SHIFT_DAYS, DAY_MS, DAY_US,
                                          DEVICES, EVENT_TYPE_MAP, HOUR_US, LATE_DELAY_MS,
                                          MINUTE_US, PLAN_NAMES, TOPIC_PREFIX)

SHIFT_US = DATE_SHIFT_DAYS * DAY_US
BASE_MS = BASE_MICROS // 1000


def h60(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


def _finish(table: str, src: str) -> str:
    """Common raw columns over a CTE with k, op, ts_ms, natural_key, after, late_ms."""
    return f"""
    SELECT *,
      {h60("'" + TOPIC_PREFIX + table + "' || '|' || partition || '|' || offset_value")} AS cdc_id,
      make_timestamp((ts_ms + offset_value % 5000 + late_ms) * 1000) AS consumed_at
    FROM (SELECT *, '{TOPIC_PREFIX}{table}' AS topic, (k % 3)::INTEGER AS partition,
                 {h60("'" + table + "|' || natural_key")} AS offset_value,
                 '{table}' AS source_table, NULL::VARCHAR AS before
          FROM {src})"""


_plan_rows = ", ".join(
    f"({pid}, '{name}', {int(price.replace('.', ''))}, '{cycle}')" for pid, name, price, cycle in PLANS)
_event_map = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_TYPE_MAP)
_devices = ", ".join(f"'{d}'" for d in DEVICES)
_plan_names = ", ".join(f"'{p}'" for p in PLAN_NAMES)

CTES = f"""
u_base AS (
  SELECT c_custkey AS k, c_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         {BASE_MICROS} + c_custkey * {MINUTE_US} AS created_at,
         ({BASE_MICROS} + c_custkey * {MINUTE_US}) // 1000 AS c_ms,
         c_custkey % 6 + 1 AS plan0, (c_custkey + 1) % 6 + 1 AS plan1
  FROM customer),
u_ev AS (
  SELECT k, 'c' AS op, c_ms AS ts_ms, c_name AS name, plan0 AS plan_id, 0 AS late_ms, email, created_at FROM u_base
  UNION ALL SELECT k, 'u', c_ms + {30 * DAY_MS}, c_name, plan1,
         CASE WHEN k % 30 = 0 THEN {LATE_DELAY_MS} ELSE 0 END, email, created_at FROM u_base WHERE k % 10 = 0
  UNION ALL SELECT k, 'u', c_ms + {60 * DAY_MS}, upper(c_name), CASE WHEN k % 10 = 0 THEN plan1 ELSE plan0 END,
         0, email, created_at FROM u_base WHERE k % 15 = 0
  UNION ALL SELECT k, 'd', c_ms + {90 * DAY_MS}, c_name, plan0, 0, email, created_at FROM u_base WHERE k % 37 = 0),
u_raw AS ({_finish("users", """(SELECT *, concat_ws('|', k, op, ts_ms) AS natural_key,
    CASE WHEN op = 'd' THEN NULL ELSE json_object('user_id', k, 'email', email, 'name', name,
      'plan_id', plan_id, 'created_at', created_at)::VARCHAR END AS after FROM u_ev)""")}),
p_cat AS (SELECT * FROM (VALUES {_plan_rows}) t(plan_id, name, base_cents, billing_cycle)),
p_years AS (
  SELECT 2024 AS year UNION ALL
  SELECT DISTINCT year(make_timestamp(epoch_us(o_orderdate) + {SHIFT_US})) AS year FROM orders
  WHERE year(make_timestamp(epoch_us(o_orderdate) + {SHIFT_US})) > 2024),
p_ev AS (
  SELECT plan_id AS k, plan_id, name, billing_cycle, year,
         CASE WHEN year = 2024 THEN 'c' ELSE 'u' END AS op,
         CASE WHEN year = 2024 THEN {BASE_MS} ELSE epoch_ms(make_timestamp(year, 1, 1, 0, 0, 0)) END AS ts_ms,
         (base_cents * (100 + 5 * (year - 2024)) + 50) // 100 AS cents, 0 AS late_ms
  FROM p_years, p_cat),
p_raw AS ({_finish("plans", f"""(SELECT *, concat_ws('|', k, op, ts_ms) AS natural_key,
    (cents // 100)::VARCHAR || '.' || lpad((cents % 100)::VARCHAR, 2, '0') AS price_text,
    json_object('plan_id', plan_id, 'name', name,
      'price', (cents // 100)::VARCHAR || '.' || lpad((cents % 100)::VARCHAR, 2, '0'),
      'billing_cycle', billing_cycle, 'created_at', {BASE_MICROS})::VARCHAR AS after FROM p_ev)""")}),
s_base AS (
  SELECT o_orderkey AS k, o_custkey AS user_id, o_orderkey % 6 + 1 AS plan_id, o_orderstatus AS st,
         epoch_us(o_orderdate) + {SHIFT_US} AS started_at,
         (epoch_us(o_orderdate) + {SHIFT_US}) // 1000 AS start_ms,
         epoch_us(o_orderdate) + {SHIFT_US} + (o_orderkey % 90) * {DAY_US} + (o_orderkey % 24 + 1) * {HOUR_US} AS end_cancel,
         epoch_us(o_orderdate) + {SHIFT_US} + {365 * DAY_US} AS end_expire
  FROM orders),
s_fin AS (
  SELECT *,
    CASE WHEN st = 'F' THEN 'cancelled' WHEN st = 'P' THEN 'paused'
         WHEN k % 11 = 0 THEN 'expired' ELSE 'active' END AS final_status,
    CASE WHEN st = 'F' THEN end_cancel WHEN st = 'O' AND k % 11 = 0 THEN end_expire END AS final_end,
    CASE WHEN st = 'F' THEN end_cancel // 1000 WHEN st = 'P' THEN start_ms + {15 * DAY_MS}
         WHEN k % 11 = 0 THEN end_expire // 1000 END AS final_ms
  FROM s_base),
s_ev AS (
  SELECT k, user_id, plan_id, started_at, 'c' AS op, start_ms AS ts_ms,
         CASE WHEN k % 7 = 0 THEN ' Active ' ELSE 'active' END AS status, NULL::BIGINT AS ended_at FROM s_fin
  UNION ALL SELECT k, user_id, plan_id, started_at, 'u', final_ms, final_status, final_end FROM s_fin
    WHERE final_ms IS NOT NULL
  UNION ALL SELECT k, user_id, plan_id, started_at, 'r', start_ms + {400 * DAY_MS}, final_status, final_end
    FROM s_fin WHERE k % 50 = 0),
s_raw AS ({_finish("subscriptions", """(SELECT *, 0 AS late_ms, concat_ws('|', k, op, ts_ms) AS natural_key,
    json_object('subscription_id', k, 'user_id', user_id, 'plan_id', plan_id, 'status', status,
      'started_at', started_at, 'ended_at', ended_at)::VARCHAR AS after FROM s_ev)""")}),
pay_base AS (
  SELECT l_orderkey * 10 + l_linenumber AS k, l_orderkey AS subscription_id,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
         epoch_us(l_shipdate) + {SHIFT_US} AS created_at,
         CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS amount_text,
         CASE l_returnflag WHEN 'N' THEN 'success' WHEN 'A' THEN 'failed' WHEN 'R' THEN 'refunded' END AS st0
  FROM lineitem),
pay_raw AS ({_finish("payments", """(SELECT *, 'c' AS op, created_at // 1000 AS ts_ms, 0 AS late_ms,
    CASE WHEN l_linenumber = 7 THEN upper(st0) || ' ' ELSE st0 END AS status_text,
    concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, created_at, amount_text, l_returnflag)
      AS natural_key,
    json_object('payment_id', k, 'subscription_id', subscription_id, 'amount', amount_text,
      'status', CASE WHEN l_linenumber = 7 THEN upper(st0) || ' ' ELSE st0 END,
      'created_at', created_at)::VARCHAR AS after FROM pay_base)""")}),
e_base AS (
  SELECT event_id AS k, event_id, user_id, CASE event_type {_event_map} ELSE event_type END AS event_type,
         epoch_us(ts) AS created_at, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pk
  FROM events),
e_props AS (
  SELECT *,
    CASE WHEN event_type = 'button_click' THEN 'btn_' || (pk % 5) END AS button,
    [{_devices}][pk % 3 + 1] AS device,
    pk AS duration_seconds,
    CASE WHEN event_type = 'login' THEN CASE WHEN pk % 2 = 0 THEN 'password' ELSE 'sso' END END AS method,
    '/page/' || (pk % 10) AS page,
    CASE WHEN event_type = 'checkout_started' THEN [{_plan_names}][pk % 3 + 1] END AS plan,
    CASE WHEN pk % 2 = 0 THEN 'search' ELSE 'direct' END AS referrer
  FROM e_base),
e_raw AS ({_finish("events", """(SELECT *, 'c' AS op, created_at // 1000 AS ts_ms, 0 AS late_ms,
    event_id::VARCHAR AS natural_key,
    json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type,
      'properties', CASE WHEN event_id % 2 = 0 THEN props_json ELSE to_json(props_json::VARCHAR) END,
      'created_at', created_at)::VARCHAR AS after
    FROM (SELECT *, json_object('button', button, 'device', device, 'duration_seconds', duration_seconds,
      'method', method, 'page', page, 'plan', plan, 'referrer', referrer) AS props_json FROM e_props))""")}),
raw_log AS (
  SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at FROM u_raw
  UNION ALL SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at FROM p_raw
  UNION ALL SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at FROM s_raw
  UNION ALL SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at FROM pay_raw
  UNION ALL SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at FROM e_raw),
stg_users AS (
  SELECT cdc_id, op AS cdc_op, ts_ms AS cdc_ts_ms, consumed_at AS cdc_consumed_at,
         k AS user_id, email, name, plan_id::BIGINT AS plan_id, make_timestamp(created_at) AS created_at
  FROM u_raw WHERE op IN ('c', 'u', 'r')),
stg_plans AS (
  SELECT cdc_id, op AS cdc_op, ts_ms AS cdc_ts_ms, consumed_at AS cdc_consumed_at,
         plan_id::BIGINT AS plan_id, name, CAST(price_text AS DECIMAL(10,2)) AS price, billing_cycle,
         make_timestamp({BASE_MICROS}) AS created_at
  FROM p_raw WHERE op IN ('c', 'u', 'r')),
stg_subscriptions AS (
  SELECT cdc_id, op AS cdc_op, ts_ms AS cdc_ts_ms, consumed_at AS cdc_consumed_at,
         k AS subscription_id, user_id, plan_id::BIGINT AS plan_id, lower(trim(status)) AS status,
         make_timestamp(started_at) AS started_at,
         CASE WHEN ended_at IS NOT NULL THEN make_timestamp(ended_at) END AS ended_at
  FROM s_raw WHERE op IN ('c', 'u', 'r')),
stg_payments_base AS (
  SELECT cdc_id, op AS cdc_op, ts_ms AS cdc_ts_ms, consumed_at AS cdc_consumed_at,
         k AS payment_id, subscription_id, CAST(amount_text AS DECIMAL(10,2)) AS amount,
         lower(trim(status_text)) AS status, make_timestamp(created_at) AS created_at
  FROM pay_raw WHERE op IN ('c', 'u', 'r')),
stg_payments AS (
  SELECT *, count(*) OVER (PARTITION BY subscription_id) > 1 AS is_retry FROM stg_payments_base),
stg_events AS (
  SELECT cdc_id, op AS cdc_op, ts_ms AS cdc_ts_ms, consumed_at AS cdc_consumed_at,
         event_id, user_id, event_type, make_timestamp(created_at) AS created_at,
         props_json::VARCHAR AS properties, page, referrer, button, NULL::VARCHAR AS feature, plan,
         device, method, duration_seconds::INTEGER AS duration_seconds
  FROM e_raw WHERE op IN ('c', 'r')),
dim_users AS (
  SELECT DISTINCT ON (user_id) user_id, email, name, plan_id, created_at, cdc_op, cdc_ts_ms, cdc_consumed_at
  FROM stg_users ORDER BY user_id, cdc_ts_ms DESC, cdc_id DESC),
dim_plans AS (
  SELECT DISTINCT ON (plan_id) plan_id, name, price, billing_cycle, created_at, cdc_op, cdc_ts_ms, cdc_consumed_at
  FROM stg_plans ORDER BY plan_id, cdc_ts_ms DESC, cdc_id DESC),
latest_plans AS (
  SELECT DISTINCT ON (plan_id) plan_id, price, billing_cycle FROM stg_plans
  ORDER BY plan_id, cdc_ts_ms DESC, cdc_id DESC),
fct_subscriptions_x AS (
  SELECT s.subscription_id, s.user_id, s.plan_id, s.status, s.started_at, s.ended_at,
    CAST(CASE WHEN p.billing_cycle = 'annual'
         THEN ((2 * CAST(p.price * 100 AS BIGINT) + 12) // 24)::DECIMAL(18,0) * 0.01
         ELSE p.price END AS DECIMAL(10,2)) AS mrr,
    CASE WHEN s.status = 'cancelled' THEN true ELSE false END AS is_churned,
    CASE WHEN s.ended_at IS NOT NULL
         THEN ((epoch_us(s.ended_at) - epoch_us(s.started_at)) // {DAY_US})::INTEGER END AS duration_days,
    s.cdc_op, s.cdc_ts_ms, s.cdc_consumed_at, s.cdc_id
  FROM stg_subscriptions s LEFT JOIN latest_plans p ON s.plan_id = p.plan_id),
fct_subscriptions AS (SELECT * EXCLUDE (cdc_id) FROM fct_subscriptions_x),
latest_subs AS (
  SELECT DISTINCT ON (subscription_id) * FROM fct_subscriptions_x
  ORDER BY subscription_id, cdc_ts_ms DESC, cdc_id DESC),
fct_payments AS (
  SELECT p.payment_id, p.subscription_id, s.user_id, s.plan_id, p.amount, p.status, p.created_at,
    p.is_retry,
    CASE WHEN p.status = 'success' THEN true ELSE false END AS is_successful,
    CASE WHEN p.status = 'failed' THEN true ELSE false END AS is_failed,
    CASE WHEN p.status = 'refunded' THEN true ELSE false END AS is_refunded,
    CASE WHEN p.status = 'success' THEN p.amount ELSE CAST(0 AS DECIMAL(10,2)) END AS recognised_revenue,
    p.cdc_op, p.cdc_ts_ms, p.cdc_consumed_at
  FROM (SELECT DISTINCT ON (payment_id) * FROM stg_payments
        ORDER BY payment_id, cdc_ts_ms DESC, cdc_id DESC) p
  LEFT JOIN (SELECT DISTINCT ON (subscription_id) subscription_id, user_id, plan_id FROM stg_subscriptions
             ORDER BY subscription_id, cdc_ts_ms DESC, cdc_id DESC) s
    ON p.subscription_id = s.subscription_id),
dim_dates AS (
  SELECT d::DATE AS date_day,
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
    year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
    rpad(monthname(d), 9, ' ') AS month_name,
    weekofyear(d)::INTEGER AS week_of_year, dayofweek(d)::INTEGER AS day_of_week,
    rpad(dayname(d), 9, ' ') AS day_name,
    CASE WHEN dayofweek(d) IN (0, 6) THEN true ELSE false END AS is_weekend,
    strftime(d, '%Y-%m') AS year_month
  FROM generate_series(DATE '2024-01-01', DATE '2030-12-31', INTERVAL 1 DAY) t(d))
"""


def ratio_sql(num: str, den: str, scale: int = 6) -> str:
    unit = 10 ** scale
    return (f"CASE WHEN {den} <> 0 THEN CAST((({num}) * {2 * unit} + ({den})) // (2 * ({den})) "
            f"AS DECIMAL(38,0)) / {unit}::DECIMAL(38,0) END")


def ratio_dec(num: str, den: str, scale: int = 6) -> str:
    return f"CAST({ratio_sql(num, den, scale)} AS DECIMAL(18,{scale}))"


BODIES = {
    "raw_change_log": "SELECT * FROM raw_log",
    "stg_users": "SELECT * FROM stg_users",
    "stg_plans": "SELECT * FROM stg_plans",
    "stg_subscriptions": "SELECT * FROM stg_subscriptions",
    "stg_payments": "SELECT * FROM stg_payments",
    "stg_events": "SELECT * FROM stg_events",
    "dim_users": """SELECT DISTINCT ON (user_id) user_id, email, name, plan_id, created_at, cdc_op,
        cdc_ts_ms, cdc_consumed_at FROM stg_users ORDER BY user_id, cdc_ts_ms DESC, cdc_id DESC""",
    "dim_plans": """SELECT DISTINCT ON (plan_id) plan_id, name, price, billing_cycle, created_at, cdc_op,
        cdc_ts_ms, cdc_consumed_at FROM stg_plans ORDER BY plan_id, cdc_ts_ms DESC, cdc_id DESC""",
    "revenue_by_day": """SELECT d.* REPLACE (coalesce(d.date_day, p.day) AS date_day),
        coalesce(p.payments, 0) AS payments, CAST(coalesce(p.revenue, 0) AS DECIMAL(18,2)) AS revenue
        FROM dim_dates d FULL JOIN (SELECT CAST(created_at AS DATE) AS day, count(*) AS payments,
          sum(recognised_revenue) AS revenue FROM fct_payments GROUP BY 1) p ON d.date_day = p.day""",
    "fct_subscriptions": """SELECT * EXCLUDE (cdc_id) FROM fct_subscriptions_x""",
    "fct_payments": "SELECT * FROM fct_payments",
    "mrr_by_plan": """SELECT plan_id, count(*) AS active_subscriptions, CAST(sum(mrr) AS DECIMAL(18,2)) AS mrr
        FROM latest_subs WHERE status = 'active' GROUP BY plan_id""",
    "churn_rate": f"""SELECT subscriptions, churned, {ratio_dec('churned', 'subscriptions')} AS churn_rate
        FROM (SELECT count(*) AS subscriptions, count(*) FILTER (WHERE is_churned) AS churned FROM latest_subs)""",
    "avg_duration": f"""SELECT closed_subscriptions, total_duration_days,
        {ratio_dec('total_duration_days', 'closed_subscriptions')} AS avg_duration_days
        FROM (SELECT count(*) AS closed_subscriptions, CAST(sum(duration_days) AS BIGINT) AS total_duration_days
              FROM latest_subs WHERE duration_days IS NOT NULL)""",
    "revenue_by_month": """SELECT strftime(created_at, '%Y-%m') AS year_month, count(*) AS payments,
        count(*) FILTER (WHERE is_successful) AS successful_payments,
        CAST(sum(recognised_revenue) AS DECIMAL(18,2)) AS revenue
        FROM fct_payments GROUP BY 1""",
    "payment_failure_rate": f"""SELECT payments, failed, {ratio_dec('failed', 'payments')} AS failure_rate
        FROM (SELECT count(*) AS payments, count(*) FILTER (WHERE is_failed) AS failed FROM fct_payments)""",
    "payment_retry_rate": f"""SELECT payments, retries, {ratio_dec('retries', 'payments')} AS retry_rate
        FROM (SELECT count(*) AS payments, count(*) FILTER (WHERE is_retry) AS retries FROM fct_payments)""",
}


def _scd2_sql(src: str, key: str) -> str:
    return f"""SELECT *, valid_to IS NULL AS is_current,
        md5(concat_ws('|', {key}, epoch_us(valid_from), cdc_id)) AS scd_id
      FROM (SELECT *, cdc_consumed_at AS updated_at, cdc_consumed_at AS valid_from,
              lead(cdc_consumed_at) OVER (PARTITION BY {key} ORDER BY cdc_consumed_at, cdc_ts_ms, cdc_id)
                AS valid_to
            FROM {src})"""


_USERS_CHANGES = """(SELECT * EXCLUDE (pe, pp, rn) FROM (
      SELECT *, lag(email) OVER w AS pe, lag(plan_id) OVER w AS pp, row_number() OVER w AS rn
      FROM stg_users WINDOW w AS (PARTITION BY user_id ORDER BY cdc_consumed_at, cdc_ts_ms, cdc_id))
    WHERE rn = 1 OR pe IS DISTINCT FROM email OR pp IS DISTINCT FROM plan_id)"""

BODIES.update({
    "users_scd2": _scd2_sql("stg_users", "user_id"),
    "plans_scd2": _scd2_sql("stg_plans", "plan_id"),
    "users_scd2_changes_only": _scd2_sql(_USERS_CHANGES, "user_id"),
    "scd2_incremental": _scd2_sql("stg_users", "user_id"),
    "users_scd2_bucketed": _scd2_sql("stg_users", "user_id"),
    "scd2_incremental_tracked": _scd2_sql(_USERS_CHANGES, "user_id"),
    "scd2_hard_deletes": f"""SELECT * REPLACE (
        CASE WHEN is_current AND user_id % 37 = 0 THEN TIMESTAMP '2031-01-01 00:00:00' ELSE valid_to END
          AS valid_to,
        is_current AND NOT (user_id % 37 = 0) AS is_current)
      FROM ({_scd2_sql("stg_users", "user_id")})""",
})


def _check_sql(c) -> str:
    name = c.name or c.kind
    m, col = c.model, c.column
    if c.kind == "not_null":
        fail = f"(SELECT count(*) FROM {m} WHERE {col} IS NULL)"
    elif c.kind == "unique":
        fail = f"(SELECT count(*) FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1))"
    elif c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.values)
        fail = f"(SELECT count(*) FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}) GROUP BY {col}))"
    elif c.kind == "non_positive":
        fail = f"(SELECT count(*) FROM {m} WHERE {col} IS NOT NULL AND {col} <= 0)"
    else:
        fail = (f"(SELECT count(*) FROM {m} x WHERE NOT EXISTS (SELECT 1 FROM {c.parent} y "
                f"WHERE y.{col} = x.{col}))")
    return (f"SELECT '{name}' AS \"check\", '{m}' AS model, '{col}' AS \"column\", "
            f"CAST({fail} AS BIGINT) AS failures")


def _dq_sql() -> str:
    rows = "\n  UNION ALL ".join(_check_sql(c) for c in project_checks())
    return f"SELECT *, failures = 0 AS passed FROM (\n  {rows})"


def _fk_sql() -> str:
    rows = "\n  UNION ALL ".join(
        f"SELECT '{n}' AS fk, (SELECT count(*) FROM {ch} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {p} y WHERE y.{pc} = x.{c})) AS violations"
        for n, ch, c, p, pc in FOREIGN_KEYS)
    return rows


_expected_rows = ", ".join(f"('{t}', '{c}')" for t, cols in EXPECTED_COLUMNS.items() for c, _ in cols)


def _type_drift_sql() -> str:
    parts = []
    for t, cols in EXPECTED_COLUMNS.items():
        for c, ty in cols:
            v = f"json_extract_string(after, '$.{c}')"
            parts.append(
                f"SELECT '{t}' AS source_table, '{c}' AS column_name, '{ty}' AS declared_type, "
                f"count({v}) AS \"values\", count(*) FILTER (WHERE {v} IS NOT NULL AND "
                f"TRY_CAST({v} AS {ty.upper()}) IS NULL) AS bad_values FROM raw_log WHERE source_table = '{t}'")
    return "\n  UNION ALL ".join(parts)


BODIES.update({
    "dq_report": _dq_sql(),
    "fk_violations": _fk_sql(),
    "orphan_payments": """SELECT p.* FROM fct_payments p
        WHERE NOT EXISTS (SELECT 1 FROM fct_subscriptions_x s WHERE s.subscription_id = p.subscription_id)""",
    "non_positive_mrr": "SELECT * EXCLUDE (cdc_id) FROM fct_subscriptions_x WHERE mrr IS NOT NULL AND mrr <= 0",
    "parse_events": "SELECT * FROM raw_log UNION ALL SELECT * FROM raw_log WHERE offset_value % 10 = 0",
    "parse_rejects": f"""SELECT topic, partition, offset_value + 1 AS offset_value,
        'not a JSON object' AS reason FROM e_raw WHERE event_id % 101 = 0""",
    "replay_dedup": "SELECT * FROM raw_log",
    "stream_dedup": "SELECT topic, partition, offset_value, source_table, ts_ms FROM raw_log",
    "stream_landing": "SELECT * FROM raw_log",
    "stream_landing_bounded": "SELECT * FROM raw_log",
    "dim_users_incremental": "SELECT * FROM dim_users",
    "dim_users_bucketed": "SELECT * FROM dim_users",
    "snapshot_bootstrap": """SELECT
        ('0x' || substr(md5('shop.public.users|' || partition || '|' || offset_value), 1, 15))::BIGINT AS cdc_id,
        topic, partition, offset_value, 'r' AS op, 'users' AS source_table, NULL::VARCHAR AS before,
        json_object('user_id', user_id, 'email', email, 'name', name, 'plan_id', plan_id,
                    'created_at', epoch_us(created_at))::VARCHAR AS after,
        1924992000000 AS ts_ms, make_timestamp(1924992000000 * 1000) AS consumed_at
      FROM (SELECT *, 'shop.public.users' AS topic, (user_id % 3)::INTEGER AS partition,
              ('0x' || substr(md5('users|' || user_id || '|r|1924992000000'), 1, 15))::BIGINT AS offset_value
            FROM dim_users WHERE user_id % 37 <> 0)""",
    "late_events": """SELECT * FROM (SELECT *, max(cdc_ts_ms) OVER (PARTITION BY user_id
          ORDER BY cdc_consumed_at, cdc_ts_ms, cdc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          AS newer_ts_ms FROM stg_users) WHERE newer_ts_ms > cdc_ts_ms""",
    "schema_drift": f"""SELECT source_table, column_name,
          CASE WHEN a.events IS NULL THEN 'missing' WHEN e.declared THEN 'expected' ELSE 'new' END AS status,
          coalesce(a.events, 0) AS events, a.first_ts_ms, a.last_ts_ms
        FROM (SELECT source_table, column_name, count(*) AS events, min(ts_ms) AS first_ts_ms,
                     max(ts_ms) AS last_ts_ms
              FROM (SELECT source_table, ts_ms, unnest(json_keys(after)) AS column_name
                    FROM raw_log WHERE after IS NOT NULL) WHERE column_name <> '__deleted' GROUP BY ALL) a
        FULL JOIN (SELECT *, true AS declared FROM (VALUES {_expected_rows}) t(source_table, column_name)
                   WHERE source_table IN (SELECT DISTINCT source_table FROM raw_log)) e
        USING (source_table, column_name)""",
    "type_drift": _type_drift_sql(),
    "silence_gaps": """SELECT source_table, consumed_at AS gap_start, nxt AS gap_end,
          (epoch_us(nxt) - epoch_us(consumed_at)) // 60000000 AS minutes_silent
        FROM (SELECT source_table, consumed_at,
                lead(consumed_at) OVER (PARTITION BY source_table ORDER BY consumed_at) AS nxt FROM raw_log)
        WHERE nxt IS NOT NULL AND epoch_us(nxt) - epoch_us(consumed_at) >= 1800000000""",
    "current_silence": f"""SELECT source_table, last_event,
          (epoch_us(TIMESTAMP '{SILENCE_NOW}') - epoch_us(last_event)) // 60000000 AS minutes_silent
        FROM (SELECT DISTINCT source_table FROM (VALUES {_expected_rows}) t(source_table, c))
        FULL JOIN (SELECT source_table, max(consumed_at) AS last_event FROM raw_log GROUP BY 1) USING (source_table)
        WHERE last_event IS NULL
           OR (epoch_us(TIMESTAMP '{SILENCE_NOW}') - epoch_us(last_event)) // 60000000 >= {SILENCE_MINUTES}""",
    "batch_stats": """SELECT batch_start, source_table, count(*) AS events,
                        grouping(source_table) = 1 AS is_total
        FROM (SELECT make_timestamp((epoch_us(consumed_at) // 1800000000) * 1800000000) AS batch_start,
                     source_table FROM raw_log)
        GROUP BY ROLLUP (batch_start, source_table) HAVING grouping(batch_start) = 0""",
})


def _run_sql() -> str:
    """Rows of every model of a pipeline run; the report is clean on this log."""
    counts = [("staging", m, f"(SELECT count(*) FROM {m})") for m in STAGING_MODELS]
    counts += [("marts", m, f"(SELECT count(*) FROM {m})") for m in ("dim_users", "dim_plans", "dim_dates")]
    counts += [("marts", "fct_subscriptions", "(SELECT count(*) FROM fct_subscriptions_x)"),
               ("marts", "fct_payments", "(SELECT count(*) FROM fct_payments)"),
               ("snapshots", "users_snapshot", "(SELECT count(*) FROM stg_users)"),
               ("snapshots", "plans_snapshot", "(SELECT count(*) FROM stg_plans)"),
               ("tests", "dq_report", f"(SELECT count(*) FROM ({_dq_sql()}) WHERE passed)")]
    rows = "\n  UNION ALL ".join(f"SELECT '{s}' AS stage, '{m}' AS model, {n} AS rows" for s, m, n in counts)
    return (f"SELECT *, CASE WHEN stage = 'tests' AND rows < {len(project_checks())} THEN 'failed: ' || "
            f"({len(project_checks())} - rows) || ' checks' ELSE 'success' END AS status FROM (\n  {rows})")


BODIES["pipeline_run"] = _run_sql()
BODIES["revenue_by_day_incremental"] = BODIES["revenue_by_day"]
BODIES["mrr_incremental"] = BODIES["mrr_by_plan"]
BODIES["current_silence_live"] = BODIES["current_silence"]


def _constraints_sql() -> str:
    def violations(table, column, kind, arg):
        v = f"json_extract_string(after, '$.{column}')"
        images = f"FROM raw_log WHERE source_table = '{table}' AND after IS NOT NULL"
        if kind == "not_null":
            return f"(SELECT count(*) {images} AND {v} IS NULL)"
        if kind == "max_length":
            return f"(SELECT count(*) {images} AND length({v}) > {arg})"
        if kind == "check":
            return f"(SELECT count(*) {images} AND {v} NOT IN ({', '.join(repr(a) for a in arg)}))"
        if kind == "primary_key":
            return (f"(SELECT count(*) FROM (SELECT {v} {images} AND op = 'c' AND {v} IS NOT NULL GROUP BY 1 "
                    f"HAVING count(*) > 1))")
        key = f"json_extract_string(after, '$.{EXPECTED_COLUMNS[table][0][0]}')"
        return (f"(SELECT count(*) FROM (SELECT v FROM (SELECT DISTINCT ON (k) k, v FROM (SELECT {key} AS k, {v} AS v, "
                f"ts_ms, cdc_id {images}) ORDER BY k, ts_ms DESC, cdc_id DESC) WHERE v IS NOT NULL GROUP BY v "
                f"HAVING count(*) > 1))")
    return "\n  UNION ALL ".join(
        f"SELECT '{t}' AS source_table, '{c}' AS column_name, '{k}' AS kind, CAST({violations(t, c, k, a)} AS BIGINT) AS violations"
        for t, c, k, a in SOURCE_CONSTRAINTS)


BODIES["source_constraints"] = _constraints_sql()

# Subscriptions out of order (sources.faults.lifecycle_events), and the state
# before every event by a plain window.
_LIFECYCLE = f"""life_raw AS ({_finish("subscriptions", f"""(SELECT *, 0 AS late_ms,
    concat_ws('|', k, 'lifecycle', op, ts_ms) AS natural_key, '' AS after FROM (
      SELECT k, 'u' AS op, start_ms - {10 * DAY_MS} AS ts_ms FROM s_base WHERE k % 61 = 0
      UNION ALL SELECT k, 'c', start_ms + {20 * DAY_MS} FROM s_base WHERE k % 67 = 0
      UNION ALL SELECT k, 'd', start_ms + {500 * DAY_MS} FROM s_base WHERE k % 71 = 0
      UNION ALL SELECT k, 'u', start_ms + {510 * DAY_MS} FROM s_base WHERE k % 71 = 0))""")}),
life AS (
  SELECT k AS subscription_id, op AS cdc_op, ts_ms AS cdc_ts_ms, cdc_id FROM s_raw
  UNION ALL SELECT k, op, ts_ms, cdc_id FROM life_raw),
life_state AS (
  SELECT *, last_value(CASE WHEN cdc_op IN ('c', 'r', 'd') THEN cdc_op END IGNORE NULLS) OVER (
    PARTITION BY subscription_id ORDER BY cdc_ts_ms, cdc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state
  FROM life)"""
_LIFECYCLE_BODY = """SELECT * FROM (SELECT *, CASE WHEN cdc_op IN ('u', 'd') AND state IS NULL THEN 'before_create'
    WHEN cdc_op IN ('u', 'd') AND state = 'd' THEN 'after_delete'
    WHEN cdc_op = 'c' AND state IN ('c', 'r') THEN 'second_create' END AS violation FROM life_state)
  WHERE violation IS NOT NULL"""
_RENAMES_BODY = f"""SELECT * FROM (
  SELECT o.source_table, o.column_name AS old_column, n.column_name AS new_column,
         len(n.vals)::BIGINT AS new_values, len(list_intersect(o.vals, n.vals))::BIGINT AS shared_values
  FROM cols o JOIN cols n ON n.source_table = o.source_table AND NOT o.present AND n.fresh)
  WHERE new_values > 0 AND shared_values >= 0.5 * new_values"""
_RENAMES = f"""cols AS (
  SELECT source_table, c AS column_name, bool_or(ts_ms >= {DRIFT_SINCE_MS}) AS present,
         bool_and(ts_ms >= {DRIFT_SINCE_MS}) AS fresh,
         coalesce(list(DISTINCT v) FILTER (WHERE v IS NOT NULL), []) AS vals
  FROM (SELECT source_table, ts_ms, c, json_extract_string(after, '$.' || c) AS v
        FROM (SELECT source_table, ts_ms, after, unnest(json_keys(after)) AS c FROM drifted_log WHERE after IS NOT NULL))
  GROUP BY ALL)"""


# The rules of sources.faults, added to the CTEs of the derivation.
_FAULT_ROWS = [
    ("FROM u_base WHERE k % 37 = 0)", f"""
  UNION ALL SELECT -k, 'c', c_ms, c_name, 99, 0, CASE WHEN k % 82 <> 0 THEN email END, created_at
    FROM u_base WHERE k % 41 = 0"""),
    ("FROM s_fin WHERE k % 50 = 0)", f"""
  UNION ALL SELECT -k, user_id + {NO_USER}, CASE WHEN k % 106 = 0 THEN 98 ELSE 7 END, started_at, 'c', start_ms,
         'bogus', NULL FROM s_fin WHERE k % 53 = 0"""),
]


def _faulty_ctes() -> str:
    """The CTEs with the faulty events.  Payments and events have another
    natural key than clean ones, so their raw rows are added whole."""
    out = CTES.replace(f"(VALUES {_plan_rows})", f"(VALUES {_plan_rows}, (7, 'Free', 0, 'weekly'))")
    for end, rows in _FAULT_ROWS:
        assert end in out
        out = out.replace(end, end[:-1] + rows + ")")
    pay = _finish("payments", f"""(SELECT *, 'c' AS op, created_at // 1000 AS ts_ms, 0 AS late_ms,
        st0 AS status_text, concat_ws('|', k, 'c', created_at // 1000) AS natural_key,
        json_object('payment_id', k, 'subscription_id', subscription_id, 'amount', amount_text, 'status', st0,
          'created_at', created_at)::VARCHAR AS after
      FROM (SELECT -l_orderkey AS k, l_orderkey + {NO_SUBSCRIPTION} AS subscription_id,
              l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
              created_at + CASE WHEN l_orderkey % 177 = 0 THEN {TEN_YEARS_US} ELSE 0 END AS created_at,
              CASE WHEN l_orderkey % 118 <> 0 THEN amount_text END AS amount_text,
              CASE WHEN l_orderkey % 177 = 0 THEN 'success' ELSE 'unknown' END AS st0
            FROM pay_base WHERE l_orderkey % 59 = 0 AND l_linenumber = 1))""")
    ev = _finish("events", f"""(SELECT *, 'c' AS op, created_at // 1000 AS ts_ms, 0 AS late_ms,
        concat_ws('|', k, 'c', created_at // 1000) AS natural_key,
        json_object('event_id', k, 'user_id', user_id, 'event_type', event_type, 'properties', NULL,
          'created_at', created_at)::VARCHAR AS after
      FROM (SELECT -event_id - 1 AS k, -event_id - 1 AS event_id, user_id + {NO_USER} AS user_id,
              NULL::VARCHAR AS event_type, created_at FROM e_base WHERE event_id % 61 = 0))""")
    out = out.replace("pay_raw AS (", f"pay_bad AS ({pay}),\npay_raw AS (SELECT * FROM pay_bad UNION ALL BY NAME (", 1)
    out = out.replace("),\ne_base AS (", ")),\ne_base AS (", 1)
    out = out.replace("raw_log AS (", f"e_bad AS ({ev}),\nraw_log AS (", 1)
    end = "ts_ms, consumed_at FROM e_raw),"
    assert end in out
    out = out.replace(end, end[:-2] + """
  UNION ALL SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at FROM e_bad),""")
    return out.replace("FROM e_raw WHERE op IN ('c', 'r')),", """FROM e_raw WHERE op IN ('c', 'r')
  UNION ALL BY NAME SELECT cdc_id, op AS cdc_op, ts_ms AS cdc_ts_ms, consumed_at AS cdc_consumed_at, event_id, user_id,
         event_type, make_timestamp(created_at) AS created_at FROM e_bad),""", 1)


_DRIFT = f"""drift_raw AS ({_finish("users", f"""(SELECT k, 'u' AS op, c_ms + {120 * DAY_MS} AS ts_ms, 0 AS late_ms,
    concat_ws('|', k, 'drift') AS natural_key,
    json_object('user_id', 'u' || k, 'mail', email, 'name', c_name, 'plan_id', 1, 'created_at', 'soon',
      'phone', '555')::VARCHAR AS after FROM u_base WHERE k % 47 = 0)""")}),
drifted_log AS (
  SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at FROM raw_log
  UNION ALL SELECT cdc_id, topic, partition, offset_value, op, source_table, before, after, ts_ms, consumed_at
  FROM drift_raw),
recent_log AS (SELECT * FROM drifted_log WHERE ts_ms >= {DRIFT_SINCE_MS})"""


def oracle_queries() -> dict[str, str]:
    q = {name: f"WITH {CTES}\n{body}" for name, body in BODIES.items()}
    faulty = _faulty_ctes()
    q |= {f"{name}_faulty": f"WITH {faulty}\n{BODIES[name]}"
          for name in ("dq_report", "fk_violations", "orphan_payments", "non_positive_mrr",
                       "revenue_by_day", "revenue_by_month", "source_constraints")}
    drifted = f"{CTES.rstrip()},\n{_DRIFT}\n"
    q["type_drift_faulty"] = f"WITH {drifted}{BODIES['type_drift'].replace('raw_log', 'drifted_log')}"
    q["schema_drift_recent"] = f"WITH {drifted}{BODIES['schema_drift'].replace('raw_log', 'recent_log')}"
    q["column_renames"] = f"WITH {drifted.rstrip()},\n{_RENAMES}\n{_RENAMES_BODY}"
    q["lifecycle_violations"] = f"WITH {CTES.rstrip()},\n{_LIFECYCLE}\n{_LIFECYCLE_BODY}"
    return q
