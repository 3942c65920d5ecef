"""Message files as a stream whose micro-batches are bounded by records.

``maxFilesPerTrigger`` bounds files, however many records they hold.  This
Python data source bounds records: its position is a file and a row in it, so a
micro-batch may end and the next begin in the middle of a file.  Files are taken
in the order of their modification time and name; they must appear whole (a
rename or a Spark write) and not change.  The driver reads footers only; every
task reads its row range of one file.

A restarted query goes on from the position in its checkpoint: the engine plans
the last batch of its log again, and from that the reader knows where it was.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "bounded_messages"
SCHEMA = "topic string, partition int, offset bigint, value string, timestamp timestamp_ntz"
ARROW = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
                   ("value", pa.string()), ("timestamp", pa.timestamp("us"))])


class RowRange(InputPartition):
    """Rows ``first`` to ``last`` (exclusive) of a file."""

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class MessageReader(DataSourceStreamReader):
    def __init__(self, path: str, max_records: int, rows_per_task: int):
        self.fs, self.root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        self.max_records, self.rows_per_task = max_records, rows_per_task
        self.at: dict | None = None
        self.rows: dict[str, int] = {}

    def _files(self, after: dict) -> list[tuple[int, str]]:
        """(time, path) of the files at or behind a position, in order."""
        found = self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True))
        names = [(f.mtime_ns or 0, f.path) for f in found if f.is_file and f.path.endswith(".parquet")
                 and not any(p.startswith(("_", ".")) for p in f.path[len(self.root):].split("/"))]
        return sorted(n for n in names if n >= (after["time"], after["file"]))

    def _count(self, path: str) -> int:
        if path not in self.rows:
            self.rows[path] = pq.read_metadata(path, filesystem=self.fs).num_rows
        return self.rows[path]

    def initialOffset(self) -> dict:
        return {"time": 0, "file": "", "row": 0}

    def latestOffset(self) -> dict:
        """The position ``max_records`` records on, or the last there is."""
        if self.at is None:
            self.at = self.initialOffset()
        left = self.max_records
        for time, path in self._files(self.at):
            first = self.at["row"] if path == self.at["file"] else 0
            step = min(left, self._count(path) - first)
            if step > 0 or path != self.at["file"]:
                self.at = {"time": time, "file": path, "row": first + step}
            left -= step
            if not left:
                break
        return self.at

    def partitions(self, start: dict, end: dict) -> list[RowRange]:
        if self.at is None:             # restarted: the last batch of the log
            self.at = end
        out = []
        for time, path in self._files(start):
            if (time, path) > (end["time"], end["file"]):
                break
            first = start["row"] if path == start["file"] else 0
            last = end["row"] if path == end["file"] else self._count(path)
            out += [RowRange(path, a, min(a + self.rows_per_task, last)) for a in range(first, last, self.rows_per_task)]
        return out

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        file, row = pq.ParquetFile(partition.path, filesystem=self.fs), 0
        for group in range(file.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            if row + rows > partition.first and row < partition.last:
                for batch in file.iter_batches(row_groups=[group], columns=ARROW.names):
                    a, b = max(partition.first - row, 0), min(partition.last - row, batch.num_rows)
                    if a < b:
                        yield pa.Table.from_batches([batch.slice(a, b - a)]).cast(ARROW).combine_chunks().to_batches()[0]
                    row += batch.num_rows
                    if row >= partition.last:
                        return
            else:
                row += rows


class MessageFiles(DataSource):
    """Options: ``path``, ``max_records`` (a micro-batch), ``rows_per_task``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> MessageReader:
        return MessageReader(self.options["path"], int(self.options["max_records"]),
                             int(self.options.get("rows_per_task", 100_000)))


def read_bounded_messages(spark: SparkSession, path: str, max_records: int, rows_per_task: int = 100_000) -> DataFrame:
    """Streaming messages from Parquet files, at most ``max_records`` a
    micro-batch.  Use a plain or processing-time trigger: with ``availableNow``
    the engine asks a Python source for its end once, which is one batch."""
    if max_records < 1:
        raise ValueError("max_records must be positive")
    spark.dataSource.register(MessageFiles)
    return (spark.readStream.format(NAME).option("path", path).option("max_records", max_records)
            .option("rows_per_task", rows_per_task).load())
