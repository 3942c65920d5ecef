"""Parser cases: the consumer's unit cases plus edge cases of its rules."""

import json

import pytest
from pyspark.sql import functions as F

from changeloom.operators.parse import parse_change_events
from changeloom.schemas import MESSAGE_SCHEMA

TS = 1709251200123
USER = {"user_id": 1, "email": "ada@example.org", "name": "Ada", "plan_id": 1,
        "created_at": 1704153600000000}


def _parse(spark, values, topic="shop.public.users"):
    rows = [(topic, 0, i + 1, v, None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    valid, rejected = parse_change_events(df, consumed_at=F.lit("2025-01-01 00:00:00"))
    return ({r.offset_value: r for r in valid.collect()},
            {r.offset_value: r for r in rejected.collect()})


def test_unit_cases(spark):
    cases = [
        dict(USER, op="c", table="users", ts_ms=TS),                          # 1 flat
        {"schema": {"type": "struct"}, "payload": dict(USER, op="c", table="users", ts_ms=TS)},
        {"user_id": 1, "__op": "u", "__table": "users", "__ts_ms": TS},       # 3 prefix
        {"user_id": 1, "op": "d", "table": "users", "ts_ms": TS, "__deleted": "true"},
        {"user_id": 1, "op": "r", "table": "users", "ts_ms": TS},             # 5 snapshot
        {"user_id": 42, "email": "x@example.com", "op": "c", "table": "users", "ts_ms": TS},
    ]
    valid, rejected = _parse(spark, [json.dumps(c) for c in cases] + ['{"user_id": 7, "op"'])
    assert valid[1].op == "c" and valid[1].source_table == "users" and valid[1].ts_ms == TS
    assert valid[1].topic == "shop.public.users" and valid[1].offset_value == 1
    assert valid[1].before is None
    assert json.loads(valid[1].after) == USER
    assert valid[2].op == "c" and valid[2].source_table == "users"
    assert json.loads(valid[2].after) == USER
    assert valid[3].op == "u" and valid[3].source_table == "users"
    assert json.loads(valid[3].after) == {"user_id": 1}
    assert valid[4].op == "d" and valid[4].after is None
    assert valid[5].op == "r"
    after6 = json.loads(valid[6].after)
    assert after6 == {"user_id": 42, "email": "x@example.com"}
    assert isinstance(after6["user_id"], int)
    assert 7 in rejected and 7 not in valid


def test_rejects_non_objects(spark):
    values = [None, "[1,2]", "5", "null", '{"schema":{},"payload":null}',
              '{"schema":{},"payload":[1]}']
    valid, rejected = _parse(spark, values)
    assert not valid
    assert set(rejected) == {1, 2, 3, 4, 5, 6}


def test_truthiness_and_key_removal(spark):
    values = [
        # both present, prefixed truthy -> plain op stays in the row image
        json.dumps({"id": 1, "op": "x", "__op": "u", "table": "t", "ts_ms": 5}),
        # prefixed empty string -> falls back to plain; both removed
        json.dumps({"id": 1, "op": "c", "__op": "", "table": "t", "ts_ms": 5}),
        # missing op -> rejected
        json.dumps({"id": 1, "table": "t", "ts_ms": 5}),
        # ts_ms 0 is kept (plain value is used even when falsy)
        json.dumps({"id": 1, "op": "c", "table": "t", "ts_ms": 0}),
        # prefixed 0 falls back to plain ts
        json.dumps({"id": 1, "op": "c", "table": "t", "__ts_ms": 0, "ts_ms": 9}),
        # duplicate keys: last wins
        '{"id": 1, "id": 2, "op": "c", "table": "t", "ts_ms": 5}',
        # properties as object and as string
        json.dumps({"id": 1, "properties": {"a": 1}, "op": "c", "table": "t", "ts_ms": 5}),
        json.dumps({"id": 1, "properties": '{"a": 1}', "op": "c", "table": "t", "ts_ms": 5}),
    ]
    valid, rejected = _parse(spark, values)
    assert valid[1].op == "u" and json.loads(valid[1].after) == {"id": 1, "op": "x"}
    assert valid[2].op == "c" and json.loads(valid[2].after) == {"id": 1}
    assert 3 in rejected and rejected[3].reason == "missing op"
    assert valid[4].ts_ms == 0
    assert valid[5].ts_ms == 9 and json.loads(valid[5].after) == {"id": 1}
    assert json.loads(valid[6].after) == {"id": 2}
    assert json.loads(valid[7].after)["properties"] == {"a": 1}
    assert json.loads(valid[8].after)["properties"] == '{"a": 1}'


def test_replayed_message_keeps_id(spark):
    v = json.dumps(dict(USER, op="c", table="users", ts_ms=TS))
    rows = [("t", 0, 7, v, None), ("t", 0, 7, v, None), ("t", 1, 7, v, None)]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    valid, _ = parse_change_events(df, consumed_at=F.lit("2025-01-01 00:00:00"))
    ids = [r.cdc_id for r in valid.orderBy("partition").collect()]
    assert ids[0] == ids[1] != ids[2]


def test_whole_text_nulls_and_nested_duplicates(spark):
    ok = json.dumps({"id": 1, "op": "c", "table": "t", "ts_ms": 5})
    values = [ok + " trailing", ok + ok, ok + "," + ok, ok + "]}", ok + " \n",
              '{"id":1,"op":null,"table":"t","ts_ms":5}', '{"id":1,"op":"c","table":null,"ts_ms":5}',
              '{"id":{"a":1,"a":2},"op":"c","table":"t","ts_ms":5}',
              '{"l":[{"z":1}],"op":"c","table":"t","ts_ms":5}',
              '{"id":1,"__deleted":"false","op":"u","table":"t","ts_ms":5}',
              '{"schema":{},"payload":{"b":1,"a":{"y":1,"y":2},"op":"c","table":"t","ts_ms":5}}']
    valid, rejected = _parse(spark, values)
    assert {i: rejected[i].reason for i in (1, 2, 3, 4)} == dict.fromkeys((1, 2, 3, 4), "not a JSON object")
    assert valid[5].source_table == "t"
    assert rejected[6].reason == "missing op" and rejected[7].reason == "missing source_table"
    assert json.loads(valid[8].after) == {"id": {"a": 2}}
    assert json.loads(valid[9].after) == {"l": [{"z": 1}]}
    assert json.loads(valid[10].after) == {"id": 1, "__deleted": "false"}
    assert list(json.loads(valid[11].after)) == ["b", "a"] and json.loads(valid[11].after)["a"] == {"y": 2}


def test_numbers_keep_their_kind_and_value(spark):
    body = '"a":1.0,"b":12345678901234567890123456789012345678901234567890,"c":1e3,"s":"1.0 \\"x\\"","n":null,"l":[1.50],"o":{"y":2.0}'
    meta = '"op":"c","table":"t","ts_ms":5'
    valid, _ = _parse(spark, ["{" + body + "," + meta + "}",
                              '{"schema":{},"payload":{' + body + "," + meta + "}}",
                              '{"id":1,"__deleted":"false","v":2.50,' + meta + "}"])
    same = lambda text: json.dumps(json.loads(text), separators=(",", ":"))     # noqa: E731
    assert valid[1].after == valid[2].after == same("{" + body + "}")
    assert valid[3].after == same('{"id":1,"__deleted":"false","v":2.50}')



def test_common_messages_avoid_interpreted_lambdas(spark):
    """Messages spelled as they are written back take their row image from the text;
    spaces, another key order or a respelled number give the same image."""
    from changeloom.operators.parse import parse_change_events
    plain = '{"id":1,"o":{"a":[1,"x"],"op":"c"},"op":"c","table":"t","ts_ms":5}'
    texts = [plain, '{"schema":{},"payload":' + plain + '}', plain.replace(',"', ' , "'),
             '{"op":"c","table":"t","ts_ms":5,' + plain[1:].replace(',"op":"c","table":"t","ts_ms":5', "") ,
             plain.replace('"op":"c","table":"t","ts_ms"', '"__op":"c","__table":"t","__ts_ms"')]
    df = spark.createDataFrame([("q", 0, i, v, None) for i, v in enumerate(texts)],
                               "topic string, partition int, offset bigint, value string, timestamp timestamp_ntz")
    valid, _ = parse_change_events(df)
    assert {r.after for r in valid.collect()} == {'{"id":1,"o":{"a":[1,"x"],"op":"c"}}'}
    assert valid.count() == len(texts)
    # The valid / rejected split itself is compiled: no lambda over every row.
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert "inline(filter(" not in plan and "inline(CASE WHEN" in plan
