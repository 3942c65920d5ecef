"""Exact deduplication by a tree merge of sorted digest runs.

Every partition of the input turns its texts into a run: (digest, survivor,
count), sorted, one row per digest.  The digest space is cut into ranges, and
the runs of a range meet in rounds: ``fan_in`` runs at a time go to one task,
sorted by digest, and come out as one run that keeps, per digest, the best row
and the count.  After ``log(fan_in, partitions)`` rounds one run per range is
left.  A text with copies in every partition costs one row per run, so hot
groups shrink at the first level, and no task sees more than ``fan_in`` runs
of a range.

Equal means: same SHA-256, same byte length and same 64-bit BLAKE2 checksum
of the text with A-Z lower-cased, checked at every level (``verified``).

Defined results: a null text counts as empty; of equal rows of one id only one
is kept; a null id gives way to any other id; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import partitions_for
from changeloom.session import stage

KEY = ("sha256", "n_bytes", "check")
DIGESTS = "doc_id bigint, sha256 binary, n_bytes bigint, check bigint, run bigint, row_no bigint"
RUNS = "sha256 binary, n_bytes bigint, check bigint, keep_id bigint, keep_row bigint, group_size bigint, run bigint"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, length and checksum of every text; ``row_no`` tells rows apart."""
    run = TaskContext.get().partitionId()
    row = itertools.count(run << 40)
    for batch in batches:
        texts = [(t or b"").lower() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()),
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True)
                      for t in texts], pa.int64()),
            pa.array([run] * len(texts), pa.int64()),
            pa.array(list(itertools.islice(row, len(texts))), pa.int64()),
        ], names=["doc_id", *KEY, "run", "row_no"])


def _merge_runs(largest: bool):
    """Merge rows sorted by (run, digest): one row per digest, with the best
    survivor (largest or smallest id, then the first row) and the count."""
    def better(a, b):
        if a[0] is None or b[0] is None:
            return (b[0] is None, -a[1]) > (a[0] is None, -b[1])
        return (a[0] if largest else -a[0], -a[1]) > (b[0] if largest else -b[0], -b[1])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*KEY, "keep_id", "keep_row", "group_size", "run"]
        key, best, size = None, None, 0
        for batch in batches:
            out = []
            for sha, n, check, i, row, count, run in zip(*(batch.column(c).to_pylist() for c in names)):
                if (run, sha, n, check) != key:
                    if key is not None:
                        out.append((*key[1:], *best, size, key[0]))
                    key, best, size = (run, sha, n, check), (i, row), 0
                elif better((i, row), best):
                    best = (i, row)
                size += count
            if out:
                yield _rows(out, names)
        if key is not None:
            yield _rows([(*key[1:], *best, size, key[0])], names)
    return merge


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary(), *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "smallest", fan_in: int = 16) -> DataFrame:
    """One row per input row: doc_id, sha256, keep_id, group_size, kept.

    ``keep`` is ``smallest`` or ``largest``: which id of a group of equal texts
    stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is {keep!r}")
    digests = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                    .mapInArrow(_digests, DIGESTS), "digests")
    groups = stage(merge_tree(digests, keep == "largest", fan_in), "digest-groups").drop("run")
    return (digests.join(groups, list(KEY))
            .select("doc_id", "sha256", "keep_id", "group_size",
                    (F.col("row_no") == F.col("keep_row")).alias("kept")))


def merge_tree(digests: DataFrame, largest: bool, fan_in: int = 16) -> DataFrame:
    """The rounds of the tree: one row per distinct text."""
    ranges = partitions_for(digests)
    merge = _merge_runs(largest)
    runs = (digests.withColumnsRenamed({"doc_id": "keep_id", "row_no": "keep_row"})
            .withColumn("group_size", F.lit(1).cast("long"))
            .sortWithinPartitions("run", *KEY).mapInArrow(merge, RUNS))
    left = (digests.agg(F.max("run").alias("n")).first()["n"] or 0) + 1
    while True:
        left = -(-left // fan_in)
        cut = F.pmod(F.conv(F.hex(F.substring("sha256", 1, 4)), 16, 10).cast("long"), F.lit(ranges))
        runs = (runs.withColumn("run", F.floor(F.col("run") / fan_in))
                .repartition(cut, F.col("run"))
                .sortWithinPartitions("run", *KEY).mapInArrow(merge, RUNS))
        if left == 1:
            return runs


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.  Rows are found
    again by id and text digest, in one shuffle; of repeated rows any one stays
    (they are equal in both)."""
    def tag(c: Column) -> Column:       # never null: a plain equality join
        return F.coalesce(c.cast("string"), F.lit(""))

    kept = exact_dedup(docs, id_col, text_col, keep).where("kept").select(
        tag(F.col("doc_id")).alias("_id"), F.col("sha256").alias("_sha"))
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, UPPER.lower())
    own = F.unhex(F.sha2(lowered.cast("binary"), 256))
    once = Window.partitionBy("_own_id", "_own").orderBy(F.lit(0))
    return (docs.withColumns({"_own_id": tag(F.col(id_col)), "_own": own})
            .join(kept, (F.col("_own_id") == F.col("_id")) & (F.col("_own") == F.col("_sha")), "left_semi")
            .withColumn("_nth", F.row_number().over(once)).where("_nth = 1")
            .select(*[F.col(c) for c in docs.columns]))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
