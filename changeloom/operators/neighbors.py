"""Next / previous row within a key, exact, with no task per key.

``lead``/``lag`` over ``Window.partitionBy(key)`` sends every row of a key to
one task.  Here the rows in the order (key, order columns) are thought cut into
parts of nearly equal size, and a key that a cut falls into is split there:

1. A uniform sample, the row of the smallest hash in each of a fixed number of
   hash cells, is sorted, and every so many rows one becomes a bound.  The
   bounds are a function of the rows alone, so they come out the same when a
   task is repeated or a plan computes them twice.
2. A row of a key that has bounds finds its part among them by binary search;
   all other keys are one part, and smaller than the distance of two bounds
   as far as the sample tells.
3. The window runs per (key, part).  A bound is a row of its own: the first of
   the part behind it when the next row is asked for, the last of the part
   before it for the previous one.  So a row that has no neighbour in its part
   finds it in the bound, which came along with it.

The bounds are broadcast; there are at most ``SPLIT`` a shuffle partition,
whatever the number of rows.  Rows equal in all order columns are not split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.functions import let

SPLIT = 16          # bounds of a shuffle partition
SAMPLE = 16         # sampled rows of a part


def _row(columns: list[str], letter: str) -> Column:
    return F.struct(*[F.col(c).alias(f"{letter}{i}") for i, c in enumerate(columns)])


def _same(keys: list[str], letter: str) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{letter}{i}")) for i, k in enumerate(keys)])


def _bounds(df: DataFrame, keys: list[str], order: list[str], values: list[str], parts: int) -> DataFrame:
    """Keys that a cut falls into, with the sorted rows (o, v) of the cuts."""
    x = F.struct(_row(keys, "k").alias("k"), _row(order, "o").alias("o"),
                 (_row(values, "v") if values else F.lit(0)).alias("v")).alias("x")
    sample = (df.select(x, F.xxhash64(*keys, *order).alias("h"))
              .groupBy(F.pmod("h", F.lit(parts * SAMPLE)).alias("cell"))
              .agg(F.min(F.struct("h", "x")).alias("m")))

    def cut(s: Column) -> Column:
        n = F.greatest(F.lit(1), F.least(F.lit(parts), (F.size(s) / SAMPLE).cast("int")))
        return F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda i: i > 0),
                           lambda i: F.get(s, (i * F.size(s) / n).cast("int")))

    cuts = sample.agg(let(F.array_sort(F.collect_list("m.x")), cut).alias("cuts"))
    return (cuts.select(F.explode("cuts").alias("x")).groupBy("x.k")
            .agg(F.array_sort(F.collect_set(F.struct("x.o", "x.v"))).alias("_cuts"))
            .select(*[F.col(f"k.k{i}").alias(f"_k{i}") for i in range(len(keys))], "_cuts"))


def in_parts(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None,
             values: list[str] | None = None, forward: bool = True) -> DataFrame:
    """Add ``_part`` (from 0, ascending along the order within a key; nulls come
    first), ``_split`` (the key has several parts) and ``_cut``, the row (o: order
    columns, v: ``values``) behind the part's end, which is the first of the next
    part; without ``forward`` the one before its begin, the last of the previous
    part.  ``parts`` (default: ``SPLIT`` a shuffle partition) bounds the cuts; a
    small table has fewer."""
    if parts is None:
        parts = SPLIT * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.join(F.broadcast(_bounds(df, keys, order, values or [], parts)), _same(keys, "k"), "left")
    rows, place = rows.withColumn("_part", F.lit(0)), _row(order, "o")
    for k in range(max(1, parts.bit_length()) - 1, -1, -1):
        beyond = F.col("_part") + (1 << k)
        bound = F.get("_cuts", beyond - 1)["o"]
        rows = rows.withColumn("_part", F.when(bound <= place if forward else bound < place, beyond)
                               .otherwise(F.col("_part")))
    return rows.select(*df.columns, "_part", F.col("_cuts").isNotNull().alias("_split"),
                       F.get("_cuts", F.col("_part") if forward else F.col("_part") - 1).alias("_cut"))


def with_neighbor(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                  direction: str = "next", prefix: str | None = None, parts: int | None = None) -> DataFrame:
    """Add ``<prefix><v>`` for each ``v`` in ``values``: the value on the next
    (``direction="next"``) or previous (``"prev"``) row of the same key in
    ascending ``order``.  A null key is a group like any other."""
    prefix = prefix or f"{direction}_"
    forward = direction == "next"
    fn = F.lead if forward else F.lag
    rows = in_parts(df, keys, order, parts, values, forward)
    w = Window.partitionBy(*keys, "_part").orderBy(*order)
    rows = rows.withColumn("_edge", fn(F.lit(1)).over(w).isNull())
    for i, v in enumerate(values):
        rows = rows.withColumn(prefix + v, F.when(F.col("_edge"), F.col(f"_cut.v.v{i}")).otherwise(fn(F.col(v)).over(w)))
    return rows.select(*df.columns, *[prefix + v for v in values])


def with_running_max(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str,
                     parts: int | None = None) -> DataFrame:
    """Add ``name``: the greatest ``value`` on an earlier row of the same key (nulls
    do not count).  The parts of a split key hand on their maxima through a table
    of at most two rows a cut."""
    cut = in_parts(df.withColumn("_v", value), keys, order, parts)
    w = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    across = (Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_to")
              .rowsBetween(Window.unboundedPreceding, -1))
    before = (cut.where("_split").groupBy(*named, F.col("_part").alias("_to"))
              .agg(F.max("_v").alias("_m")).withColumn("_before", F.max("_m").over(across)))
    here = F.col("_split") & (F.col("_part") == F.col("_to")) & _same(keys, "k")
    rows = cut.withColumn("_within", F.max("_v").over(w)).join(F.broadcast(before), here, "left")
    return rows.select(*df.columns, F.greatest("_within", "_before").alias(name))
