"""Record-exact micro-batches of message files, restart, and Kafka options."""

import glob
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from changeloom.schemas import MESSAGE_SCHEMA
from changeloom.streaming.landing import kafka_options, read_landed, start_landing
from changeloom.streaming.messages import read_bounded_messages


def _msg(i):
    v = {"user_id": i, "email": f"u{i}@example.com", "op": "c", "table": "users", "ts_ms": 1000 + i}
    return ("shop.public.users", i % 3, i, json.dumps(v), None)


def _file(spark, path, ids):
    spark.createDataFrame([_msg(i) for i in ids], MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _land(spark, base, n):
    q = start_landing(read_bounded_messages(spark, f"{base}/in", n, rows_per_task=3), f"{base}/raw", f"{base}/ck",
                      trigger={"processingTime": "0 seconds"}, stats_path=f"{base}/stats",
                      consumed_at=F.lit("2024-01-01 00:00:00"))
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None
    stats = spark.read.parquet(f"{base}/stats").where("is_total")
    return {r.batch_id: r.events for r in stats.collect()}


def test_batches_hold_exactly_the_bound(spark):
    base = tempfile.mkdtemp(prefix="cl-bounded-")
    for ids in (range(10), range(10, 11), range(11, 33)):
        _file(spark, f"{base}/in", ids)
    sizes = _land(spark, base, 7)
    assert [sizes[b] for b in sorted(sizes)] == [7, 7, 7, 7, 5]
    # Restart: goes on behind the checkpointed position, in the middle of nothing read twice.
    _file(spark, f"{base}/in", range(33, 50))
    sizes = _land(spark, base, 4)
    assert [sizes[b] for b in sorted(sizes)][5:] == [4, 4, 4, 4, 1]
    assert sorted(r.offset_value for r in spark.read.parquet(f"{base}/raw").collect()) == list(range(50))
    # No new file: no new batch.
    assert _land(spark, base, 4) == sizes
    assert read_landed(spark, f"{base}/raw").count() == 50


def test_restart_inside_a_file(spark):
    base = tempfile.mkdtemp(prefix="cl-bounded-")
    _file(spark, f"{base}/in", range(20))
    q = start_landing(read_bounded_messages(spark, f"{base}/in", 6), f"{base}/raw", f"{base}/ck",
                      trigger={"once": True}, consumed_at=F.lit("2024-01-01 00:00:00"))
    q.awaitTermination()
    first = spark.read.parquet(f"{base}/raw").count()
    assert first == 6
    _land(spark, base, 6)
    assert sorted(r.offset_value for r in spark.read.parquet(f"{base}/raw").collect()) == list(range(20))


def _tables(spark, path):
    """A customer, an order with two lines and two events, as base tables."""
    ts = F.expr("timestamp_ntz'2026-01-01 00:00:00'")
    spark.sql("SELECT 1L AS c_custkey, 'Customer#1' AS c_name").write.parquet(f"{path}/customer.parquet")
    (spark.sql("SELECT 7L AS o_orderkey, 1L AS o_custkey, 'F' AS o_orderstatus").withColumn("o_orderdate", ts)
     .write.parquet(f"{path}/orders.parquet"))
    (spark.sql("SELECT 7L AS l_orderkey, 3L AS l_partkey, 2L AS l_suppkey, CAST(id + 1 AS INT) AS l_linenumber, "
               "12.5D AS l_extendedprice, 'N' AS l_returnflag FROM range(2)").withColumn("l_shipdate", ts)
     .write.parquet(f"{path}/lineitem.parquet"))
    (spark.sql("SELECT id AS event_id, 1L AS user_id, 'view' AS event_type, '{\"k\": 3}' AS props FROM range(100, 102)")
     .withColumn("ts", ts).write.parquet(f"{path}/events.parquet"))
    return path


@pytest.mark.parametrize("name", ["stream_landing_bounded", "stream_landing"])
def test_landing_query_holds_nothing_it_has_landed(spark, monkeypatch, name):
    """All messages land without a copy of the batch, and are gone before the replays are removed."""
    from changeloom.plans.queries import raw, registry
    from pyspark.sql.classic.dataframe import DataFrame

    def no_copy(*_):
        raise AssertionError("the parsed batch is kept in memory")
    d = _tables(spark, tempfile.mkdtemp(prefix="cl-tables-"))
    monkeypatch.setattr(DataFrame, "persist", no_copy)
    got = registry()[name](spark, d)
    assert sorted(r.cdc_id for r in got.collect()) == sorted(r.cdc_id for r in raw(spark, d).collect())
    [landed] = {f.removeprefix("file://").partition("/raw/")[0] for f in got.inputFiles()}
    assert glob.glob(f"{landed}/raw/batch_id=*")
    assert not glob.glob(f"{landed}/in") and not glob.glob(f"{landed}/raw/_parsed")


def test_an_empty_batch_writes_nothing(spark):
    base = tempfile.mkdtemp(prefix="cl-empty-")
    for k, ids in enumerate(([], [1], [])):
        spark.createDataFrame([_msg(i) for i in ids], MESSAGE_SCHEMA).coalesce(1).write.parquet(f"{base}/in/f={k}")
    for kind, extra in (("plain", {}), ("rejects", {"rejects_path": f"{base}/rej"})):
        stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
        q = start_landing(stream, f"{base}/{kind}", f"{base}/ck-{kind}", consumed_at=F.lit("2024-01-01 00:00:00"), **extra)
        q.awaitTermination()
        assert q.exception() is None and len(glob.glob(f"{base}/ck-{kind}/commits/[0-9]*")) == 3
        assert len(glob.glob(f"{base}/{kind}/batch_id=*")) == 1
        assert [r.offset_value for r in read_landed(spark, f"{base}/{kind}").collect()] == [1]
    assert len(glob.glob(f"{base}/rej/batch_id=*")) == 1


@pytest.mark.parametrize("extra", [{}, {"rejects_path": "rej"}])
def test_landed_files_have_bounded_row_groups(spark, monkeypatch, extra):
    import pyarrow.parquet as pq
    from changeloom.streaming import landing
    monkeypatch.setattr(landing, "GROUP_BYTES", 1 << 16)
    base = tempfile.mkdtemp(prefix="cl-groups-")
    _file(spark, f"{base}/in", range(30_000))
    q = start_landing(landing.read_change_stream(spark, "parquet", {}, f"{base}/in"), f"{base}/raw", f"{base}/ck",
                      consumed_at=F.lit("2024-01-01 00:00:00"), **{k: f"{base}/{v}" for k, v in extra.items()})
    q.awaitTermination()
    files = [pq.read_metadata(f) for f in glob.glob(f"{base}/raw/batch_id=*/*/*.parquet")]
    assert sum(m.num_rows for m in files) == 30_000 and max(m.num_row_groups for m in files) > 2


def test_a_task_stops_reading_at_its_last_row(spark, monkeypatch):
    from changeloom.streaming import messages
    base = tempfile.mkdtemp(prefix="cl-range-")
    _file(spark, base, range(300_000))
    read = []

    class Counted(messages.pq.ParquetFile):
        def iter_batches(self, *a, **k):
            for batch in super().iter_batches(*a, **k):
                read.append(batch.num_rows)
                yield batch
    monkeypatch.setattr(messages.pq, "ParquetFile", Counted)
    reader = messages.MessageReader(base, 10, 10)
    [part] = reader.partitions({"time": 0, "file": "", "row": 0}, reader.latestOffset())
    rows = [o for b in reader.read(part) for o in b["offset"].to_pylist()]
    assert rows == list(range(10)) and sum(read) < 100_000


def test_kafka_options():
    got = kafka_options({"kafka.bootstrap.servers": "b:9092", "subscribePattern": "shop\\..*"}, max_records=100)
    assert got == {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "100", "failOnDataLoss": "true",
                   "kafka.bootstrap.servers": "b:9092", "subscribePattern": "shop\\..*"}
    assert kafka_options({"startingOffsets": "latest"})["startingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in kafka_options({})
