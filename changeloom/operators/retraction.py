"""Metrics that follow a change stream without recomputing.

A metric is a sum over the latest row of every key, by group.  When a key gets
a newer row, its old contribution is subtracted and the new one added; a row
that is not newer than the stored one (late, or delivered again) changes
nothing.  So rows may come in any order and any batches, and the result is that
of the full query.

Two bucketed tables hold the state: ``rows``, the latest row per key (only the
columns that count), and ``sums``.  A batch rewrites the buckets its keys and
groups hash to.  ``sums`` is committed first, with the batch's number in the
same commit, then ``rows``; a batch that is repeated after a failure between
the two finds its number and only brings ``rows`` up to date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.operators.latest import DEFAULT_ORDER, latest_by_key
from changeloom.session import stage, unstage
from changeloom.sources.bucketed import BucketedTable, exists, upsert_latest


class RetractedSums:
    """Sums of ``measures`` (name -> SQL type) by ``groups`` over the latest row
    per key that ``counts`` (a condition on the row) holds for, below ``base``."""

    def __init__(self, spark: SparkSession, base: str, keys: list[str], groups: list[str],
                 measures: dict[str, str], counts: Column | None = None, buckets: int = 64):
        self.spark, self.keys, self.groups, self.measures = spark, keys, groups, measures
        self.counts = F.lit(True) if counts is None else F.coalesce(counts, F.lit(False))
        self.rows_at, self.sums_at, self.buckets = f"{base.rstrip('/')}/rows", f"{base.rstrip('/')}/sums", buckets

    def _narrow(self, rows: DataFrame) -> DataFrame:
        columns = dict.fromkeys([*self.keys, *DEFAULT_ORDER, *self.groups])
        return rows.select(*columns, self.counts.alias("_counts"),
                           *[F.col(m).cast(t).alias(f"_{m}") for m, t in self.measures.items()])

    def _contributions(self, rows: DataFrame, sign: int) -> DataFrame:
        return rows.where("_counts").select(
            *self.groups, F.lit(sign).cast("bigint").alias("rows"),
            *[(F.coalesce(F.col(f"_{m}"), F.lit(0)) * sign).cast(t).alias(m) for m, t in self.measures.items()])

    def _sum(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.groups).agg(
            F.sum("rows").alias("rows"), *[F.sum(m).cast(t).alias(m) for m, t in self.measures.items()])

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in a batch of staged rows; numbers of batches rise."""
        new = stage(latest_by_key(self._narrow(batch), self.keys), "retraction-batch")
        stored = BucketedTable(self.spark, self.rows_at) if exists(self.spark, self.rows_at) else \
            BucketedTable.create(new.limit(0), self.rows_at, self.keys, self.buckets)
        sums = BucketedTable(self.spark, self.sums_at) if exists(self.spark, self.sums_at) else \
            BucketedTable.create(self._sum(self._contributions(new.limit(0), 1)), self.sums_at, self.groups, self.buckets)
        if sums.properties.get("batch", -1) < batch_id:
            touched = [r[0] for r in new.select(stored.bucket_of().alias("b")).distinct().collect()]
            old = stored.read(touched)
            # Both sides have one row per key.  The new row counts if it comes out on
            # top, and then the old one goes.
            placed = F.struct(F.struct(*DEFAULT_ORDER).alias("at"), F.struct(*new.columns).alias("row"))
            same = reduce(Column.__and__, [F.col(f"_n{i}").eqNullSafe(F.col(f"_o{i}")) for i in range(len(self.keys))])
            n, o = (rows.select(*[F.col(k).alias(f"_{side}{i}") for i, k in enumerate(self.keys)], placed.alias(side))
                    for rows, side in ((new, "n"), (old, "o")))
            wins = n.join(o, same, "left").where(F.col("o").isNull() | (F.col("n.at") > F.col("o.at")))
            change = (self._contributions(wins.select("n.row.*"), 1)
                      .unionByName(self._contributions(wins.where(F.col("o").isNotNull()).select("o.row.*"), -1)))
            sums.update(self._sum(change), lambda s, c: self._sum(s.unionByName(c)).where("rows <> 0"),
                        {"batch": batch_id}).vacuum()
        upsert_latest(stored, new, DEFAULT_ORDER, True).vacuum()       # new is staged
        unstage(new)

    def read(self) -> DataFrame:
        """(groups, rows, measures): groups without a row are absent."""
        return BucketedTable(self.spark, self.sums_at).read()
