"""Landing change events: topic stream -> parse -> raw change log.

* ``read_change_stream``: any streaming source with the message columns.
  Kafka when its connector is on the classpath (earliest start, bounded
  batches via ``maxOffsetsPerTrigger``), otherwise a file source of message
  files (bounded via ``maxFilesPerTrigger``).
* ``start_landing``: ``foreachBatch`` parses each micro-batch and writes the
  valid rows under ``<path>/batch_id=<n>/source_table=<t>/`` and rejects
  under ``<rejects>/batch_id=<n>/``, overwriting that batch's folder — a batch
  replayed after a failure rewrites the same files, so the sink is
  idempotent.  Progress is committed by the checkpoint only after the batch
  function returned (write first, commit after).
* ``read_landed``: the landed log, one row per message position (replays
  across batches removed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.operators.latest import latest_by_key
from changeloom.operators.monitor import batch_stats, dedup_offsets, last_seen, merge_seen
from changeloom.operators.parse import parse_change_events, parse_messages, rejected_rows, valid_rows
from changeloom.schemas import MESSAGE_SCHEMA, RAW_COLUMNS, RAW_SCHEMA
from changeloom.session import remove_path
from changeloom.sources.bucketed import BucketedTable, exists, upsert_latest


def kafka_options(options: dict[str, str], max_records: int | None = None) -> dict[str, str]:
    """Options of the Kafka source: a new query starts with the earliest
    message, a micro-batch has at most ``max_records``, and messages that are gone
    before they were read fail the query.  ``options`` win."""
    bound = {"maxOffsetsPerTrigger": str(max_records)} if max_records else {}
    return {"startingOffsets": "earliest", "failOnDataLoss": "true", **bound, **options}


def read_change_stream(spark: SparkSession, fmt: str, options: dict[str, str],
                       path: str | None = None) -> DataFrame:
    """Streaming DataFrame ``(topic, partition, offset, value, timestamp)``.

    Bound a micro-batch with ``maxOffsetsPerTrigger`` (Kafka) or
    ``maxFilesPerTrigger`` (files) in ``options``; unset, a trigger takes all
    there is, so the stream can always catch up.
    """
    if fmt == "kafka":
        df = spark.readStream.format("kafka").options(**kafka_options(options)).load()
        return df.select("topic", "partition", "offset", F.col("value").cast("string"),
                         F.col("timestamp").cast("timestamp_ntz"))
    reader = spark.readStream.format(fmt).schema(MESSAGE_SCHEMA).options(**options)
    return reader.load(path) if path else reader.load()


def record_seen(batch: DataFrame, base: str) -> BucketedTable:
    """Merge the batch into the last-seen table (one row a source table) at ``base``."""
    spark, new = batch.sparkSession, last_seen(batch)
    if not exists(spark, base):
        return BucketedTable.create(new, base, ["source_table"], 1)
    table = BucketedTable(spark, base).update(new, merge_seen)
    table.vacuum()
    return table


# Bytes of a row group: a task that writes or reads a landed file holds one.
GROUP_BYTES = 32 << 20


def _land(valid: DataFrame, folder: str) -> None:
    (valid.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
     .option("parquet.block.size", GROUP_BYTES).partitionBy("source_table").parquet(folder))


def _batch_writer(path: str, rejects_path: str | None, stats_path: str | None,
                  consumed_at: Column | None, seen_path: str | None = None):
    def write_valid(batch: DataFrame, batch_id: int) -> None:
        # Nothing but the valid rows is asked for: they go from the parser to the sink.
        folder = f"{path}/batch_id={batch_id}"
        _land(parse_change_events(batch, consumed_at=consumed_at)[0], folder)
        landed = batch.sparkSession.read.schema(RAW_SCHEMA).parquet(folder)
        if not landed.inputFiles() and batch.isEmpty():     # an empty poll writes nothing
            remove_path(batch.sparkSession, folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One parse per batch: the parsed rows are written once, below a name that
        # readers pass over; valid and rejected ones are plain filters of them.
        spark, folder = batch.sparkSession, f"{path}/_parsed"
        parsed = parse_messages(batch, consumed_at=consumed_at)
        text = F.when(F.col("reason").isNotNull(), F.col("value"))      # only rejects show it
        try:
            (parsed.withColumn("value", text).write.mode("overwrite").option("compression", "zstd")
             .option("parquet.block.size", GROUP_BYTES).parquet(f"{folder}/batch_id={batch_id}"))
            kept = spark.read.schema(parsed.schema).parquet(f"{folder}/batch_id={batch_id}")
            if kept.isEmpty():       # an empty poll writes nothing
                return
            valid = valid_rows(kept.where("reason IS NULL"))
            rejected = rejected_rows(kept.where("reason IS NOT NULL"))
            _land(valid, f"{path}/batch_id={batch_id}")
            if rejects_path:
                rejected.write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
            if stats_path:
                (batch_stats(valid, F.lit(batch_id).cast("bigint").alias("batch_id"))
                 .write.mode("overwrite").parquet(f"{stats_path}/batch_id={batch_id}"))
            if seen_path:
                record_seen(valid, seen_path)
        finally:
            remove_path(spark, folder)
    return write if rejects_path or stats_path or seen_path else write_valid


def start_landing(messages: DataFrame, path: str, checkpoint: str,
                  trigger: dict | None = None, rejects_path: str | None = None,
                  stats_path: str | None = None, consumed_at: Column | None = None,
                  seen_path: str | None = None) -> StreamingQuery:
    """Start the landing query; ``trigger`` defaults to ``availableNow``
    (scheduled runs); use ``{"processingTime": "1 second"}`` for a
    continuously polling consumer.  ``seen_path`` is a table of the last
    consumption per source table, for the silence monitor."""
    trig = trigger or {"availableNow": True}
    return (messages.writeStream
            .foreachBatch(_batch_writer(path, rejects_path, stats_path, consumed_at, seen_path))
            .option("checkpointLocation", checkpoint)
            .trigger(**trig)
            .start())


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The landed raw log (``RAW_SCHEMA`` + batch_id), replays removed.

    The source table is part of the dedup key (a position has one table), so
    a filter on it passes below the dedup and prunes the folders read."""
    df = spark.read.parquet(path)
    return dedup_offsets(df, ["source_table"]).select(*RAW_COLUMNS, "batch_id")


def compact_landed(spark: SparkSession, path: str, out: str) -> None:
    """Rewrite the landed batches as one log without replays, ordered like
    ``write_raw``: later reads need neither the dedup nor many small folders."""
    from changeloom.sources.files import write_raw
    write_raw(read_landed(spark, path), out)


def start_latest_upsert(rows: DataFrame, base: str, keys: list[str], checkpoint: str,
                        trigger: dict | None = None, buckets: int = 64, keep: int = 2) -> StreamingQuery:
    """Keep a latest-state table current from a stream of staged rows.

    ``base`` is a ``sources.bucketed`` table: a micro-batch rewrites the buckets
    its keys hash to (newest ``cdc_ts_ms`` wins, ties by ``cdc_id``) and commits
    by a rename; a replayed batch yields the same state.  Versions before the
    newest ``keep`` are removed.
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if exists(spark, base):
            upsert_latest(BucketedTable(spark, base), batch).vacuum(keep)
        else:
            BucketedTable.create(latest_by_key(batch, keys), base, keys, buckets)

    return (rows.writeStream.foreachBatch(upsert)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())
