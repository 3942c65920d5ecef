"""Landing stream: availableNow runs, restart after a lost commit, replay
dedup, and the streaming dedup operator."""

import datetime as dt
import glob
import json
import os
import tempfile

from pyspark.sql import functions as F

from changeloom.operators.monitor import dedup_offsets
from changeloom.operators.parse import parse_change_events
from changeloom.schemas import MESSAGE_SCHEMA
from changeloom.sources.files import read_raw, write_raw
from changeloom.streaming.landing import compact_landed, read_change_stream, read_landed, start_landing


def _msg(i, off, table="users"):
    v = {"user_id": i, "email": f"u{i}@example.com", "op": "c", "table": table, "ts_ms": 1000 + i}
    return ("shop.public.users", 0, off, json.dumps(v), None)


def test_landing_restart_and_replay(spark):
    base = tempfile.mkdtemp(prefix="cl-stream-")
    inp = f"{base}/in"
    # three files, the second overlapping the first (a replay), one malformed
    files = [[_msg(1, 1), _msg(2, 2)], [_msg(2, 2), _msg(3, 3)],
             [_msg(4, 4), ("shop.public.users", 0, 5, "not json {", None)]]
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(inp)
    stream = read_change_stream(spark, "parquet", {}, inp)
    kw = dict(rejects_path=f"{base}/rej", consumed_at=F.lit("2024-01-01 00:00:00"))
    q = start_landing(stream, f"{base}/raw", f"{base}/ck", **kw)
    q.awaitTermination()
    q.stop()
    landed = read_landed(spark, f"{base}/raw")
    assert sorted(r.offset_value for r in landed.collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(f"{base}/rej").count() == 1
    # lose the last commit: the batch is replayed into the same folder
    commits = sorted(glob.glob(f"{base}/ck/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    last = commits[-1]
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    q = start_landing(read_change_stream(spark, "parquet", {}, inp), f"{base}/raw", f"{base}/ck", **kw)
    q.awaitTermination()
    q.stop()
    again = read_landed(spark, f"{base}/raw")
    assert sorted(r.offset_value for r in again.collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(f"{base}/raw").count() == 5   # replayed message landed twice, read once


def test_streaming_dedup_keeps_unseen_late_events(spark):
    """Replays go; an event nine days late that was never seen stays."""
    base = tempfile.mkdtemp(prefix="cl-dedup-")
    stamps = ["2024-03-10", "2024-03-11", "2024-03-01", "2024-03-12", "2024-03-11"]
    for off, day in zip([1, 2, 3, 4, 2], stamps):
        row = (*_msg(off, off)[:4], dt.datetime.fromisoformat(day))
        spark.createDataFrame([row], MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = read_change_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, f"{base}/in")
    valid, _ = parse_change_events(stream, consumed_at=F.col("timestamp"))
    q = (dedup_offsets(valid).writeStream.format("memory").queryName("dedup_out")
         .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.offset_value for r in spark.sql("SELECT * FROM dedup_out").collect()) == [1, 2, 3, 4]


def test_landed_log_compacts_to_one_row_per_position(spark):
    base = tempfile.mkdtemp(prefix="cl-compact-")
    for batch, rows in enumerate([[_msg(1, 1), _msg(2, 2)], [_msg(2, 2)]]):
        valid, _ = parse_change_events(spark.createDataFrame(rows, MESSAGE_SCHEMA),
                                       consumed_at=F.lit("2024-01-01 00:00:00"))
        valid.write.partitionBy("source_table").parquet(f"{base}/raw/batch_id={batch}")
    compact_landed(spark, f"{base}/raw", f"{base}/log")
    assert sorted(r.offset_value for r in read_raw(spark, f"{base}/log").collect()) == [1, 2]


def test_overwrite_leaves_no_stale_partition(spark):
    base = tempfile.mkdtemp(prefix="cl-stale-")
    def rows(*tables):
        valid, _ = parse_change_events(
            spark.createDataFrame([_msg(i, i, t) for i, t in enumerate(tables)], MESSAGE_SCHEMA),
            consumed_at=F.lit("2024-01-01 00:00:00"))
        return valid
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_raw(rows("users", "plans"), f"{base}/raw")
        write_raw(rows("users"), f"{base}/raw")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.source_table for r in read_raw(spark, f"{base}/raw").collect()] == ["users"]


def test_silence_heartbeat(spark):
    import time
    from changeloom.streaming.monitor import start_silence_monitor
    base = tempfile.mkdtemp(prefix="cl-silence-")
    # a landed log whose last event is long ago
    msgs = [_msg(1, 1), _msg(2, 2)]
    df = spark.createDataFrame(msgs, MESSAGE_SCHEMA)
    valid, _ = parse_change_events(df, consumed_at=F.lit("2024-01-01 00:00:00"))
    valid.write.parquet(f"{base}/raw")
    q = start_silence_monitor(spark, f"{base}/raw", f"{base}/alerts", f"{base}/ck",
                              minutes=30, interval="1 second")
    deadline = time.time() + 60
    while time.time() < deadline and not glob.glob(f"{base}/alerts/*/_SUCCESS"):
        time.sleep(1)
    q.stop()
    alerts = spark.read.parquet(f"{base}/alerts").collect()
    assert alerts and alerts[0].source_table == "users" and alerts[0].minutes_silent > 30


def test_latest_upsert_out_of_order(spark):
    from changeloom.sources.bucketed import BucketedTable
    from changeloom.streaming.landing import start_latest_upsert
    base = tempfile.mkdtemp(prefix="cl-upsert-")
    schema = "user_id bigint, email string, cdc_ts_ms bigint, cdc_id bigint"
    # batch 1 holds the newest event of user 1; batch 2 brings an older one late
    spark.createDataFrame([(1, "new@x", 200, 1), (2, "b@x", 100, 2)], schema) \
        .coalesce(1).write.parquet(f"{base}/in/b1")
    spark.createDataFrame([(1, "old@x", 150, 3), (3, "c@x", 50, 4)], schema) \
        .coalesce(1).write.parquet(f"{base}/in/b2")
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{base}/in/*"))
    q = start_latest_upsert(rows, f"{base}/dim", ["user_id"], f"{base}/ck")
    q.awaitTermination()
    q.stop()
    got = {r.user_id: r.email for r in BucketedTable(spark, f"{base}/dim").read().collect()}
    assert got == {1: "new@x", 2: "b@x", 3: "c@x"}


def test_silence_from_the_last_seen_table(spark):
    """The landing keeps first and last consumption per table; a replayed batch
    changes nothing, and the check reads no log."""
    from changeloom.operators.monitor import silent_tables
    from changeloom.sources.bucketed import BucketedTable
    base = tempfile.mkdtemp(prefix="cl-seen-")
    stamps = {"users": ["2024-01-01 00:00:00", "2024-01-01 09:00:00"], "plans": ["2024-01-01 08:00:00"]}
    for n, (table, times) in enumerate(sorted(stamps.items())):
        rows = [(*_msg(i, 10 * n + i, table)[:4], dt.datetime.fromisoformat(t)) for i, t in enumerate(times)]
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    for _ in range(2):      # the second query reads everything again
        q = start_landing(read_change_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, f"{base}/in"), f"{base}/raw",
                          tempfile.mkdtemp(prefix="cl-ck-"), consumed_at=F.col("timestamp"), seen_path=f"{base}/seen")
        q.awaitTermination()
        assert q.exception() is None
    seen = BucketedTable(spark, f"{base}/seen").read()
    assert {(r.source_table, str(r.first_event), str(r.last_event)) for r in seen.collect()} == {
        ("users", "2024-01-01 00:00:00", "2024-01-01 09:00:00"), ("plans", "2024-01-01 08:00:00", "2024-01-01 08:00:00")}
    now = F.lit("2024-01-01 09:20:00").cast("timestamp_ntz")
    got = silent_tables(seen, now, 30, ["users", "plans", "events"])
    assert {(r.source_table, r.minutes_silent) for r in got.collect()} == {("plans", 80), ("events", None)}
    assert f"{base}/raw" not in got._jdf.queryExecution().toString()
