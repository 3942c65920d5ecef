"""Retracted sums equal a full recomputation after every batch."""

import random
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from changeloom.operators import retraction
from changeloom.operators.retraction import RetractedSums

SCHEMA = "k bigint, g string, amount decimal(10,2), ok boolean, cdc_ts_ms bigint, cdc_id bigint"


def _brute(rows):
    latest = {}
    for r in rows:
        if r[0] not in latest or (r[4], r[5]) > (latest[r[0]][4], latest[r[0]][5]):
            latest[r[0]] = r
    out = {}
    for r in latest.values():
        if r[3]:
            n, s = out.get(r[1], (0, Decimal(0)))
            out[r[1]] = (n + 1, s + (r[2] or 0))
    return out


def _state(sums):
    return {r.g: (r.rows, r.amount) for r in sums.read().collect()}


def _sums(spark, base):
    return RetractedSums(spark, base, ["k"], ["g"], {"amount": "decimal(18,2)"}, F.col("ok"), buckets=4)


def test_batches_in_any_order(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(12)]), rng.choice(["a", "b", "c", None]), rng.choice([None, Decimal(f"{i}.25")]),
             rng.choice([True, True, False, None]), rng.randint(1, 40), i) for i in range(120)]
    sums, seen = _sums(spark, tempfile.mkdtemp(prefix="cl-retract-")), []
    for b, part in enumerate((rows[:50], rows[50:60], rows[40:55], [], rows[60:])):      # overlapping, one empty
        sums.apply(spark.createDataFrame(part, SCHEMA), b)
        seen += part
        assert _state(sums) == _brute(seen), b


def test_a_batch_repeated_after_a_failure_counts_once(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="cl-retract-")
    sums, df = _sums(spark, base), lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = [(1, "a", Decimal(5), True, 1, 1), (2, "a", Decimal(7), True, 1, 2)]
    second = [(1, "b", Decimal(6), True, 2, 3), (3, "b", Decimal(1), True, 1, 4)]
    sums.apply(df(first), 0)

    def dies(*_):
        raise RuntimeError("lost")

    # between the two commits
    monkeypatch.setattr(retraction, "upsert_latest", dies)
    try:
        sums.apply(df(second), 1)
        raise AssertionError("should have died")
    except RuntimeError:
        pass
    monkeypatch.undo()
    again = _sums(spark, base)
    again.apply(df(second), 1)
    assert _state(again) == _brute(first + second) == {"a": (1, Decimal(7)), "b": (2, Decimal(7))}
    again.apply(df([(3, "a", Decimal(4), True, 2, 5)]), 2)
    assert _state(again) == {"a": (2, Decimal(11)), "b": (1, Decimal(6))}
    # the last row of a group leaves: the group is absent
    again.apply(df([(1, "a", Decimal(1), False, 9, 6)]), 3)
    assert _state(again) == {"a": (2, Decimal(11))}


def test_a_batch_is_written_once(spark, monkeypatch):
    from changeloom.sources import bucketed
    written, stage = [], bucketed.stage
    monkeypatch.setattr(bucketed, "stage", lambda df, name: written.append(df.columns) or stage(df, name))
    sums = _sums(spark, tempfile.mkdtemp(prefix="cl-retract-"))
    for b, rows in enumerate(([(1, "a", Decimal(5), True, 1, 1), (None, "a", Decimal(2), True, 1, 2)],
                              [(1, "b", Decimal(6), True, 2, 3), (None, "a", Decimal(3), True, 2, 4)])):
        sums.apply(spark.createDataFrame(rows, SCHEMA), b)
    # only the changed sums; the batch's rows are staged by then
    assert written == [["g", "rows", "amount"]] * 2
    assert _state(sums) == {"a": (1, Decimal(3)), "b": (1, Decimal(6))}
