"""Interval state of the streaming dedup: exact, and as small as the gaps."""

import random
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from changeloom.streaming.dedup import _unseen, add, dedup_positions, pack, seen, unpack

EMPTY = np.zeros(0, np.int64)


def test_intervals_equal_a_plain_set():
    rng = random.Random(5)
    starts, ends, known = EMPTY, EMPTY, set()
    for _ in range(200):
        batch = np.array([rng.randint(-40, 400) for _ in range(rng.randint(0, 12))], np.int64)
        assert seen(starts, ends, batch).tolist() == [b in known for b in batch.tolist()]
        starts, ends = add(starts, ends, batch)
        known |= set(batch.tolist())
        assert sorted(known) == [p for a, b in zip(starts, ends) for p in range(a, b + 1)]
        assert (starts[1:] > ends[:-1] + 1).all()          # touching intervals are one
    full = add(EMPTY, EMPTY, np.random.default_rng(1).permutation(1_000_000))
    assert [len(x) for x in full] == [1, 1] and (full[0][0], full[1][0]) == (0, 999_999)


def test_packed_intervals_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 5000):
        for low, high in ((0, 10), (-50, 9000), (-2**63, 2**63 - 1), (0, 2**60)):
            starts, ends = add(EMPTY, EMPTY, rng.integers(low, high, n, dtype=np.int64))
            packed = pack(starts, ends)
            assert [x.tolist() for x in unpack(packed)] == [starts.tolist(), ends.tolist()]
    # a position among many costs less than a plain number
    assert len(packed) < 7.5 * 5000


class State:
    """A group's state as the engine keeps it."""
    exists, held = False, None

    @property
    def get(self):
        return self.held

    def update(self, value):
        self.exists, self.held = True, value


def test_an_arrow_batch_costs_its_own_size_not_that_of_the_state(monkeypatch):
    """Positions with gaps everywhere: the state holds each, and is merged once a micro-batch."""
    from changeloom.streaming import dedup
    sizes, plain = [], dedup.add_all

    def counted(*a):
        sizes.append(sum(map(len, a)))
        return plain(*a)
    monkeypatch.setattr(dedup, "add_all", counted)
    run, state = _unseen("p", ["at"]), State()

    def batch(positions, at=0):
        return pd.DataFrame({"p": positions, "at": at, "_slot": 0})
    old = np.arange(0, 200_000, 2)
    assert sum(len(x) for x in run((), iter([batch(old)]), state)) == 100_000
    assert isinstance(state.get[0], bytes) and len(state.get[0]) < 200_000
    sizes.clear()
    # ten batches: half of each was seen, and one position comes in all of them
    fresh = [np.r_[1, old[k * 50:k * 50 + 50], np.arange(300_000 + 100 * k, 300_100 + 100 * k, 2)] for k in range(10)]
    out = [p for x in run((), (batch(b, k) for k, b in enumerate(fresh)), state) for p in x["p"]]
    assert sorted(out) == [1, *range(300_000, 301_000, 2)]
    assert sum(n >= 100_000 for n in sizes) == 1
    # of copies in one batch the first by time stays
    copies = pd.DataFrame({"p": [9, 7, 9, 9], "at": [3, 1, 2, 4], "_slot": 0}, index=[5, 1, 5, 2])
    [got] = run((), iter([copies]), state)
    assert sorted(zip(got["p"], got["at"])) == [(7, 1), (9, 2)]


def test_columns_that_no_one_wants_are_not_worked_out(spark):
    from changeloom.operators.parse import parse_change_events
    from changeloom.schemas import MESSAGE_SCHEMA
    rows = [("t", 0, 1, '{"id":1,"op":"c","table":"users","ts_ms":5}', None), ("t", 0, 2, "no", None)]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    wanted = ["source_table", "offset_value", "cdc_id", "ts_ms"]
    valid, rejected = parse_change_events(df, columns=wanted)
    full, _ = parse_change_events(df)
    assert valid.columns == wanted and valid.collect() == full.select(*wanted).collect()
    assert [(r.offset_value, r.value, r.reason) for r in rejected.collect()] == [(2, "no", "not a JSON object")]
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (full, valid)]
    assert ["EndsWith" in p for p in plans] == [True, False]       # the row image


def test_a_million_contiguous_positions_leave_few_intervals(spark):
    base = tempfile.mkdtemp(prefix="cl-intervals-")
    n = 1_000_000
    # four files in mixed order, each with a tenth of the positions again
    rows = spark.range(n).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset_value"),
                                 F.pmod(F.xxhash64("id"), F.lit(4)).alias("f"))
    rows = rows.unionByName(rows.where("offset_value % 10 = 0").withColumn("f", (F.col("f") + 1) % 4))
    rows = rows.unionByName(rows.where("offset_value % 1000 = 0"))
    for k in range(4):
        rows.where(F.col("f") == k).drop("f").coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = "topic string, partition int, offset_value bigint"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    q = (dedup_positions(stream, slots=4).writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == n and out.select("offset_value").distinct().count() == n
    state = q.lastProgress.stateOperators[0]
    assert len(q.recentProgress) >= 4
    # one range of 2^20 positions: one state, of one interval, however many rows
    assert state.numRowsTotal == 1 and state.customMetrics["stateOnCurrentVersionSizeBytes"] < 10_000
