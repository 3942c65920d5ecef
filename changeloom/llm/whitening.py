"""Whitening of embedding vectors with distributed block matrices.

Entries become integers, so that counts and sums are exact.  Rows are packed
into numbered chunks of about a megabyte; a chunk, centred, is one row block
of a ``BlockMatrix``.  Its transpose times itself is the scatter matrix, whose
eigenvectors are found locally (dimensions squared, whatever the number of
rows), and the block matrix times the whitening matrix projects every row.

The transposed product sums over as many splits of the rows as there are shuffle
partitions, so no task multiplies all of them.  What the driver holds: the
sums, the scatter matrix (``MAX_DIMENSIONS`` squared at most) and one
position per block.

Defined results: vectors that are null or empty, or hold a null, a non-finite
entry or one beyond +-2^50 / ``scale`` (not exact as a number), are left out; so are
those of another length than the most frequent one (the longer one on ties).
A component whose eigenvalue is zero to double precision has no whitening and
is left out, so a single vector, equal vectors and an empty table give an empty
result.  Repeated rows count as often as they occur; a null id stays null;
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix, Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import partitions_for
from changeloom.session import stage

SCALE, SHIFT = 64, 1_000_000
BLOCK_ENTRIES = 131_072             # entries of a block: 1 MB as doubles
MAX_DIMENSIONS = 8_192
LARGEST = 2.0 ** 50

CHUNKS = "run bigint, place bigint, rows bigint, ids array<bigint>, x binary, sums array<bigint>"


def _pack(scale: int, shift: int, dim: int):
    """Rows of a partition as chunks of integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = (np.floor(flat * scale).astype(np.int64) + shift).reshape(-1, dim)
            size = max(1, BLOCK_ENTRIES // dim)
            cuts = range(0, len(x), size)
            if not cuts:
                continue
            parts = [x[a:a + size] for a in cuts]
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.column(0)[0].as_py()] * len(parts), pa.int64()),
                pa.array(range(at, at + len(parts)), pa.int64()), pa.array([len(p) for p in parts], pa.int64()),
                pa.array([batch.column(1).slice(a, size).to_pylist() for a in cuts], pa.list_(pa.int64())),
                pa.array([p.tobytes() for p in parts], pa.binary()),
                pa.array([p.sum(axis=0).tolist() for p in parts], pa.list_(pa.int64()))],
                names=["run", "place", "rows", "ids", "x", "sums"])
            at += len(parts)
    return run


class Centre:
    """Exact deviations n * x - S of a chunk from the means."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.near = n, [round(s / n) for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.near)]

    def scaled(self, x: bytes) -> np.ndarray:
        """n * x - S, as Python integers where 64 bits cannot hold the squares' sum."""
        near = np.frombuffer(x, np.int64).reshape(-1, len(self.near)) - np.array(self.near, np.int64)
        widest = self.n * int(np.abs(near).max(initial=0)) + max(map(abs, self.rest))
        if widest * widest * len(self.near) >= 2 ** 63:
            near = near.astype(object)
        return near * self.n - np.array(self.rest, near.dtype)

    def centred(self, x: bytes) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)


def _spread(a: tuple, b: tuple) -> tuple:
    """Merge (rows, mean, centred products) of two sets of rows."""
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def _summary(block: tuple) -> tuple:
    y = block[1].toArray()
    mean = y.mean(axis=0)
    return len(y), mean, (y - mean).T @ (y - mean)


class Whitening:
    """The fitted transform of ``vectors`` (id, vector); see ``whiten``."""

    def __init__(self, vectors: DataFrame, id_col: str, vec_col: str, components: int, scale: int, shift: int):
        self.spark, bound = vectors.sparkSession, LARGEST / scale
        finite = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(bound)))
        rows = (vectors.select(F.col(id_col).cast("bigint").alias("_id"), F.col(vec_col).cast("array<double>").alias("_v"))
                .where(F.col("_v").isNotNull() & (F.size("_v") > 0) & finite))
        sizes = rows.groupBy(F.size("_v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
        usual = sizes.orderBy(F.desc("n"), F.desc("d")).first()
        self.n, self.dim = (usual["n"], usual["d"]) if usual else (0, 0)
        if self.dim > MAX_DIMENSIONS:
            raise ValueError(f"more than {MAX_DIMENSIONS} dimensions: the scatter matrix is solved locally")
        self.kept = 0
        if not self.n:
            return
        rows = rows.where(F.size("_v") == self.dim).select(F.spark_partition_id().cast("bigint").alias("_run"), "_id", "_v")
        packed = stage(rows.mapInArrow(_pack(scale, shift, self.dim), CHUNKS), "whitening-chunks")
        sums = (packed.select(F.posexplode("sums").alias("k", "s")).groupBy("k")
                .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("k").collect())
        self.centre = Centre(self.n, [int(r["s"]) for r in sums])
        # Blocks are numbered without gaps: the chunks of the runs before (one
        # row per partition of the input), then the place in the run.
        before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        offsets = stage(packed.groupBy("run").agg(F.count(F.lit(1)).alias("chunks")).select(
            "run", F.coalesce(F.sum("chunks").over(before), F.lit(0)).alias("before")), "whitening-offsets")
        self.blocks = (packed.join(offsets, "run")
                       .select((F.col("before") + F.col("place")).alias("block"), "ids", "x"))
        self.n_blocks = packed.count()
        self._fit(components)

    def _rows(self) -> BlockMatrix:
        centre, dim = self.centre, self.dim
        size = max(1, BLOCK_ENTRIES // dim)

        def block(r):
            c = centre.centred(bytes(r["x"]))
            return (r["block"], 0), DenseMatrix(len(c), dim, c.ravel(order="F"))

        blocks = self.blocks.select("block", "x").rdd.map(block)
        return BlockMatrix(blocks, size, dim, size * self.n_blocks, dim)

    def _fit(self, components: int) -> None:
        rows, dim = self._rows(), self.dim
        splits = min(self.n_blocks, partitions_for(self.blocks))
        product = rows.transpose()._java_matrix_wrapper.call("multiply", rows._java_matrix_wrapper._java_model, splits)
        scatter = BlockMatrix(product, dim, dim).toLocalMatrix().toArray()
        cov = (scatter + scatter.T) / (2 * self.n)
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        trace = float(np.trace(cov))
        positive = int((values > dim * np.finfo(np.float64).eps * max(values[0], 0.0)).sum())
        self.kept = min(components, positive)
        if not self.kept:
            return
        self.explained = [float(v / trace) for v in values[:self.kept]]
        matrix = vectors[:, :self.kept] / np.sqrt(values[:self.kept])
        whitening = BlockMatrix(self.spark.sparkContext.parallelize(
            [((0, 0), Matrices.dense(dim, self.kept, matrix.ravel(order="F")))], 1), dim, self.kept, dim, self.kept)
        self.projected = rows.multiply(whitening)
        n, _, products = self.projected.blocks.map(_summary).treeReduce(_spread)
        self.identity_error = float(np.abs(products / n - np.eye(self.kept)).max())

    def rows(self) -> DataFrame:
        """(id, deviation, whitened): one row a vector."""
        schema = "id bigint, deviation decimal(38,0), whitened array<double>"
        if not self.kept:
            return self.spark.createDataFrame([], schema)
        centre, kept = self.centre, self.kept
        made = self.spark.createDataFrame(
            self.projected.blocks.map(lambda b: (int(b[0][0]), bytearray(np.ascontiguousarray(b[1].toArray()).tobytes()))),
            "block bigint, y binary", verifySchema=False)
        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for ids, x, y in zip(batch.column("ids"), batch.column("x"), batch.column("y")):
                    scaled = centre.scaled(x.as_py())
                    squares = (scaled * scaled).sum(axis=1)
                    flat = np.frombuffer(y.as_py(), np.float64)
                    yield pa.RecordBatch.from_arrays([
                        ids.values, pa.array([int(s) for s in squares], pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, kept, dtype=np.int32), flat)],
                        names=["id", "deviation", "whitened"])

        return self.blocks.join(made, "block").select("ids", "x", "y").mapInArrow(unpack, schema)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 32,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per vector and component: (id, component, n, deviation, whitened,
    explained, identity_error).  ``x = floor(scale * entry) + shift``; components
    are numbered from 1 by falling eigenvalue.  ``deviation`` is the exact squared
    distance of n * x from the sums."""
    w = Whitening(vectors, id_col, vec_col, components, scale, shift)
    one = w.rows().select("id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    explained = F.array(*[F.lit(e) for e in (w.explained if w.kept else [0.0])])
    return one.select(F.col("id").alias(id_col), (F.col("k") + 1).alias("component"),
                      F.lit(w.n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.get(explained, F.col("k")).alias("explained"),
                      F.lit(w.identity_error if w.kept else 0.0).alias("identity_error"))
