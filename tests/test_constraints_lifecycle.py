"""Source constraints, lifecycle order and renames against plain loops."""

import json
import random

import pytest

from changeloom.operators.constraints import source_constraints
from changeloom.operators.lifecycle import lifecycle_violations
from changeloom.operators.monitor import column_renames
from changeloom.schemas import RAW_SCHEMA, SOURCE_CONSTRAINTS
import datetime as dt


def _raw(spark, rows):
    """(table, op, ts_ms, image) rows; the id is the row's number."""
    full = [(i, "t", 0, i, op, table, None, None if image is None else json.dumps(image), ts, dt.datetime(2024, 1, 1))
            for i, (table, op, ts, image) in enumerate(rows)]
    return spark.createDataFrame(full, RAW_SCHEMA)


def _user(k, email="a@x", name="n", **more):
    return {"user_id": k, "email": email, "name": name, "plan_id": 1, "created_at": 1, **more}


def test_each_kind_of_constraint(spark):
    rows = [("users", "c", 1, _user(1, "a@x")), ("users", "c", 2, _user(2, "b@x")),
            ("users", "u", 3, _user(1, "b@x")),              # now two users have b@x
            ("users", "c", 4, _user(3, "a@x")),              # free again: no violation
            ("users", "c", 5, _user(3, None)),               # second insert of 3, no email
            ("users", "u", 6, _user(4, "c@x", "n" * 101)), ("users", "u", 7, _user(5, "é" * 255, None)),
            ("users", "d", 8, None),
            ("plans", "c", 1, {"plan_id": 1, "name": "p", "price": None, "billing_cycle": "weekly", "created_at": 1}),
            ("payments", "c", 1, {"payment_id": 1, "subscription_id": 1, "amount": "1", "status": "x" * 21, "created_at": 1}),
            ("payments", "c", 1, {"payment_id": 1})]
    got = {(r.source_table, r.column_name, r.kind): r.violations for r in source_constraints(_raw(spark, rows)).collect()}
    assert len(got) == len(SOURCE_CONSTRAINTS)
    want = {("users", "email", "unique"): 1, ("users", "user_id", "primary_key"): 1, ("users", "email", "not_null"): 1,
            ("users", "name", "max_length"): 1, ("users", "name", "not_null"): 1, ("plans", "price", "not_null"): 1,
            ("plans", "billing_cycle", "check"): 1, ("payments", "status", "max_length"): 1, ("payments", "status", "check"): 1,
            ("payments", "payment_id", "primary_key"): 1, ("payments", "subscription_id", "not_null"): 1,
            ("payments", "amount", "not_null"): 1, ("payments", "status", "not_null"): 1, ("payments", "created_at", "not_null"): 1}
    assert {k: v for k, v in got.items() if v} == want
    assert {r.violations for r in source_constraints(_raw(spark, [])).collect()} == {0}


def test_marks_of_random_images_equal_a_loop(spark):
    rng = random.Random(10)
    rows = [("payments", rng.choice("ccur"), i, None if i % 17 == 0 else
             {"payment_id": rng.choice([None, *range(40)]), "subscription_id": rng.choice([None, 1]),
              "amount": rng.choice([None, "1"]), "status": rng.choice([None, "success", "odd", "x" * 21]),
              "created_at": 1}) for i in range(200)]
    rows += [("payments", "c", i, {"payment_id": i, "subscription_id": 1, "amount": "1", "status": "failed", "created_at": 1})
             for i in (7, 7, 1000)]
    images = [(op, image) for _, op, _, image in rows if image is not None]
    keys = [i["payment_id"] for op, i in images if op == "c" and i["payment_id"] is not None]
    states = [i["status"] for _, i in images]
    want = {("payment_id", "primary_key"): sum(keys.count(k) > 1 for k in set(keys)),
            ("status", "check"): sum(s in ("odd", "x" * 21) for s in states),
            ("status", "max_length"): states.count("x" * 21), ("created_at", "not_null"): 0,
            **{(c, "not_null"): sum(i[c] is None for _, i in images)
               for c in ("payment_id", "subscription_id", "amount", "status")}}
    done = source_constraints(_raw(spark, rows))
    assert {(r.column_name, r.kind): r.violations for r in done.collect() if r.source_table == "payments"} == want
    # no interpreted lambda runs per image
    assert "lambda" not in done._jdf.queryExecution().optimizedPlan().toString()


def test_images_without_a_json_writer_have_its_text(spark, tmp_path):
    from pyspark.sql import functions as F
    from changeloom.sources.changelog import DEVICES, PLAN_NAMES, change_log
    folder = str(tmp_path)
    kinds = {"view": "page_view", "click": "button_click", "signup": "login", "purchase": "checkout_started",
             "error": "support_ticket_opened"}
    types = [*kinds, 'a"b\\c\n\té \x01', "", None]
    events = [(n, dt.datetime(2024, 1, 1, 0, 0, n), n if n % 3 else None, t, p)
              for n, (t, p) in enumerate((t, p) for t in types for p in ('{"k":5}', '{"k":8}', '{"k":10}'))]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string") \
        .write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(1, 2, 3, 4, 10.5, "N", dt.datetime(1997, 1, 1)), (1, 2, 3, 7, 0.125, "R", None),
                           (None, 2, 3, 7, None, "?", dt.datetime(1997, 1, 1))],
                          "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double,"
                          "l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    log = change_log(spark, folder, ["events", "payments"])
    got = {r.source_table + str(i): r.after for i, r in enumerate(
        log.orderBy("source_table", F.get_json_object("after", "$.event_id").cast("int"), "after").collect())}
    for n, (event_id, ts, user, kind, props) in enumerate(events):
        k = json.loads(props)["k"]
        name, us = kinds.get(kind, kind), 1704067200000000 + event_id * 1_000_000
        inner = json.dumps({"button": f"btn_{k % 5}" if name == "button_click" else None,
                            "device": DEVICES[k % 3], "duration_seconds": k,
                            "method": ("sso" if k % 2 else "password") if name == "login" else None,
                            "page": f"/page/{k % 10}",
                            "plan": PLAN_NAMES[k % 3] if name == "checkout_started" else None,
                            "referrer": "direct" if k % 2 else "search"}, separators=(",", ":"))
        image = {"event_id": event_id, "user_id": user, "event_type": name,
                 "properties": json.loads(inner) if event_id % 2 == 0 else inner, "created_at": us}
        text = got[f"events{n}"]
        assert json.loads(text) == image
        if name != types[5]:                # the writer spells control characters in capitals
            assert text == json.dumps(image, separators=(",", ":"), ensure_ascii=False)
    us = 852076800000000 + 10_592 * 86_400_000_000
    assert sorted(v for k, v in got.items() if k.startswith("payments")) == sorted([
        f'{{"payment_id":14,"subscription_id":1,"amount":"10.50","status":"success","created_at":{us}}}',
        '{"payment_id":17,"subscription_id":1,"amount":"0.13","status":"REFUNDED ","created_at":null}',
        f'{{"payment_id":null,"subscription_id":null,"amount":null,"status":null,"created_at":{us}}}'])
    # payments and events are written by no JSON writer, but for event types outside the map
    plan = change_log(spark, folder, ["payments"])._jdf.queryExecution().optimizedPlan().toString()
    assert "StructsToJson" not in plan


def _brute(rows):
    out = {}
    state = {}
    for key, op, ts, i in sorted(rows, key=lambda r: (r[2], r[3])):
        if key is None:
            continue
        s = state.get(key)
        v = None
        if op in "ud":
            v = "before_create" if s is None else "after_delete" if s == "d" else None
        elif op == "c" and s in ("c", "r"):
            v = "second_create"
        if v:
            out[i] = (v, s)
        if op in "crd":
            state[key] = op
    return out


@pytest.mark.parametrize("parts", [1, 40, None])
def test_lifecycle_equals_a_plain_loop(spark, parts):
    """One hot key with most events, ties in time, null keys."""
    rng = random.Random(3)
    rows = [(rng.choice([1] * 8 + [2, 3, 4, None]), rng.choice("cuuurd"), rng.randint(1, 300), i) for i in range(1500)]
    events = spark.createDataFrame(rows, "k bigint, cdc_op string, cdc_ts_ms bigint, cdc_id bigint")
    got = {r.cdc_id: (r.violation, r.state) for r in lifecycle_violations(events, "k", parts=parts).collect()}
    assert got == _brute(rows) and len(got) > 300


def test_renames(spark):
    old = [("users", "c", k, {"user_id": k, "email": f"u{k}@x", "fax": f"{k}"}) for k in range(40)]
    new = [("users", "u", 100 + k, {"user_id": k, "mail": f"u{k}@x", "phone": "5", "note": None, "__deleted": "x"}) for k in range(20)]
    got = column_renames(_raw(spark, old + new + [("plans", "c", 100, {"email": "u1@x"})]), 100).collect()
    # phone shares its one value with fax, so that is a pair as well
    assert {(r.source_table, r.old_column, r.new_column, r.new_values, r.shared_values) for r in got} == {
        ("users", "email", "mail", 20, 20), ("users", "fax", "phone", 1, 1)}
    assert column_renames(_raw(spark, old), 100).collect() == []


def test_payments_are_parsed_once_and_small_plans_broadcast(spark):
    """Facts read staged payments and plans: the payments' JSON is parsed once for
    three uses, and a small catalogue moves no subscription to its plan."""
    from changeloom.plans import queries
    rows = [("plans", "c", 1, {"plan_id": 1, "name": "a", "price": "9.99", "billing_cycle": "monthly", "created_at": 0}),
            ("plans", "c", 1, {"plan_id": 2, "name": "b", "price": "0.00", "billing_cycle": "monthly", "created_at": 0}),
            ("subscriptions", "c", 2, {"subscription_id": 5, "user_id": 1, "plan_id": 2, "status": "active",
                                       "started_at": 0, "ended_at": None}),
            ("payments", "c", 3, {"payment_id": 7, "subscription_id": 5, "amount": "1.00", "status": "success", "created_at": 0}),
            ("payments", "c", 4, {"payment_id": 8, "subscription_id": None, "amount": "1.00", "status": "failed", "created_at": 0})]
    def log(s, d):
        return _raw(s, rows)
    facts = queries._fct_payments(spark, "", log)
    assert "= payments" not in facts._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.payment_id, r.user_id, r.is_retry) for r in facts.collect()} == {(7, 1, False), (8, None, False)}
    bad = queries.non_positive_mrr(spark, "", log)
    assert "BroadcastHashJoin" in bad._jdf.queryExecution().sparkPlan().toString()
    assert [r.subscription_id for r in bad.collect()] == [5]
    assert [r.payment_id for r in queries.orphan_payments(spark, "", log).collect()] == [8]
    found = {r.fk: r.violations for r in queries.fk_violations(spark, "", log).collect()}
    assert found["subscriptions.user_id"] == 1 and found["payments.subscription_id"] == 0


def test_renames_sketch_only_tables_that_can_have_one(spark):
    """A table without a vanished and a new column is not sketched."""
    users = [("users", "c", t, {"user_id": t, "email" if t < 100 else "mail": f"{t % 50}@x"}) for t in range(50, 150)]
    other = [("plans", "c", t, {"plan_id": t, "name": "n"}) for t in (1, 200)]
    got = column_renames(_raw(spark, users + other), 100)
    assert "IN (plans" not in (p := got._jdf.queryExecution().optimizedPlan().toString()) and "users" in p
    assert [(r.old_column, r.new_column) for r in got.collect()] == [("email", "mail")]
