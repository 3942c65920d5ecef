"""Live silence detection.

A stateless stream fires no micro-batch while its source is idle, so the
silent stream cannot report its own silence.  A second stream on the
built-in ``rate`` source acts as a heartbeat: every trigger it checks for source
tables whose last consumption is at least ``minutes`` old and writes the
findings (with the check time) to a folder of its own under ``out_path``.  It
reads the last-seen table that the landing keeps (one row a source table); only
without one it scans the landed log.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.operators.monitor import last_seen, silent_tables
from changeloom.sources.bucketed import BucketedTable


def start_silence_monitor(spark: SparkSession, landed_path: str | None, out_path: str,
                          checkpoint: str, minutes: int = 30, interval: str = "1 minute",
                          seen_path: str | None = None, tables: list[str] | None = None) -> StreamingQuery:
    def check(_tick, batch_id: int) -> None:
        seen = BucketedTable(spark, seen_path).read() if seen_path else last_seen(spark.read.parquet(landed_path))
        now = F.current_timestamp().cast("timestamp_ntz")
        (silent_tables(seen, now, minutes, tables)
         .withColumn("checked_at", now)
         # One folder per tick: a replayed tick overwrites its own findings.
         .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    heartbeat = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (heartbeat.writeStream.foreachBatch(check)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval)
            .start())
