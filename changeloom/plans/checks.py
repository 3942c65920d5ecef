"""The project's test suite: 38 checks over staging and marts."""

from __future__ import annotations

from changeloom.operators.quality import Check
from changeloom.schemas import BILLING_CYCLES, PAYMENT_STATUSES, STAGED_OPS, SUBSCRIPTION_STATUSES

# The declared tests, model by model.
NOT_NULL = {
    "stg_users": ["cdc_id", "user_id", "email", "cdc_op"],
    "stg_plans": ["cdc_id", "plan_id", "price"],
    "stg_subscriptions": ["cdc_id", "subscription_id", "user_id"],
    "stg_payments": ["cdc_id", "payment_id", "amount"],
    "stg_events": ["cdc_id", "event_id", "user_id", "event_type"],
    "dim_users": ["user_id", "email"],
    "dim_plans": ["plan_id"],
    "dim_dates": ["date_day", "date_key"],
    "fct_subscriptions": ["subscription_id", "mrr"],
    "fct_payments": ["payment_id", "amount"],
}
UNIQUE = {
    "dim_users": ["user_id", "email"],
    "dim_plans": ["plan_id"],
    "dim_dates": ["date_day", "date_key"],
    "fct_payments": ["payment_id"],
}
ACCEPTED = [
    ("stg_users", "cdc_op", STAGED_OPS),
    ("stg_plans", "billing_cycle", BILLING_CYCLES),
    ("stg_subscriptions", "status", SUBSCRIPTION_STATUSES),
    ("stg_payments", "status", PAYMENT_STATUSES),
]


def project_checks() -> list[Check]:
    checks = [Check("not_null", m, c) for m, cols in NOT_NULL.items() for c in cols]
    checks += [Check("unique", m, c) for m, cols in UNIQUE.items() for c in cols]
    checks += [Check("accepted_values", m, c, list(v)) for m, c, v in ACCEPTED]
    checks.append(Check("non_positive", "fct_subscriptions", "mrr", name="assert_mrr_is_positive"))
    checks.append(Check("orphans", "fct_payments", "subscription_id", parent="fct_subscriptions",
                        name="assert_no_orphan_payments"))
    return checks
