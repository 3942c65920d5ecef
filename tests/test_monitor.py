"""Monitors against brute force on small fixtures."""

import datetime as dt
import json

from pyspark.sql import functions as F

from changeloom.operators import monitor
from changeloom.schemas import RAW_SCHEMA


def _raw(spark, rows):
    full = [(i, "t", 0, i, "c", table, None, after, 0, ts) for i, (table, after, ts) in enumerate(rows)]
    return spark.createDataFrame(full, RAW_SCHEMA)


def test_silence_gaps(spark):
    base = dt.datetime(2024, 1, 1)
    times = [0, 1, 5, 50, 51, 52, 120, 121]        # minutes: holes of 45 and 68 minutes
    rows = [("users", '{"user_id":1}', base + dt.timedelta(minutes=m, seconds=s))
            for m in times for s in (0, 30)]
    gaps = monitor.silence_gaps(_raw(spark, rows)).orderBy("gap_start").collect()
    assert [g.minutes_silent for g in gaps] == [44, 67]
    assert gaps[0].gap_start == base + dt.timedelta(minutes=5, seconds=30)
    now = F.lit(base + dt.timedelta(minutes=200)).cast("timestamp_ntz")
    cur = monitor.current_silence(_raw(spark, rows), now).collect()
    assert cur[0].minutes_silent == 78
    both = monitor.current_silence(_raw(spark, rows), now, tables=["users", "plans"]).collect()
    assert {r.source_table: r.minutes_silent for r in both} == {"users": 78, "plans": None}


def test_batch_stats_keeps_nulls_apart_from_totals(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (None, None)], "b int, source_table string")
    got = {(r.b, r.source_table, r.is_total): r.events for r in monitor.batch_stats(df, "b").collect()}
    assert got == {(1, "a", False): 1, (1, None, False): 1, (1, None, True): 2,
                   (None, "a", False): 1, (None, None, False): 1, (None, None, True): 2}


def test_schema_and_type_drift(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [("users", '{"user_id":1,"email":"a","name":"n","plan_id":1,"created_at":5,"phone":"x"}', ts),
            ("users", '{"user_id":"abc","mail":"a","name":"n","plan_id":1,"created_at":5}', ts)]
    raw = _raw(spark, rows)
    drift = {(r.column_name, r.status) for r in
             monitor.schema_drift(raw, monitor.expected_columns(spark)).collect()}
    assert ("phone", "new") in drift and ("mail", "new") in drift
    assert ("email", "expected") in drift
    # a column that was renamed is missing from then on
    rows = [(i, "t", 0, i, "c", "users", None, json.dumps({"user_id": i, k: "a"}), i, ts)
            for i, k in enumerate(["email", "mail", "mail", "mail"])]
    later = {(r.column_name, r.status, r.last_ts_ms) for r in monitor.schema_drift(
        spark.createDataFrame(rows, RAW_SCHEMA), monitor.expected_columns(spark), since_ts_ms=1).collect()}
    assert ("email", "missing", None) in later and ("mail", "new", 3) in later
    types = {r.column_name: r for r in monitor.type_drift(raw).where("source_table = 'users'").collect()}
    assert types["user_id"].bad_values == 1 and types["user_id"].values == 2
    assert types["email"].values == 1


def test_late_events_and_dedup(spark):
    rows = [(1, 10, 100, dt.datetime(2024, 1, 1)), (1, 30, 101, dt.datetime(2024, 1, 2)),
            (1, 20, 102, dt.datetime(2024, 1, 5)), (2, 5, 103, dt.datetime(2024, 1, 1))]
    ev = spark.createDataFrame(rows, "user_id bigint, cdc_ts_ms bigint, cdc_id bigint, cdc_consumed_at timestamp_ntz")
    for parts in (None, 1, 100):
        late = monitor.late_events(ev, "user_id", parts=parts).collect()
        assert [(r.cdc_id, r.newer_ts_ms) for r in late] == [(102, 30)]
