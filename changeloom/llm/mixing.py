"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; its documents get
``target / source size`` expected copies each.  The expected copies are
prefix-summed within the source, one random offset is added, and a document
is emitted once per integer boundary that its stretch of the sum crosses.
DataFrame operations only.

The order of the prefix sum is (size stratum, block, size, id): strata make
the words taken follow the target closely (each stratum of similar sizes is
sampled systematically), and blocks split a large source, so that ranks come
from two small prefix sums over cell counts plus one window per cell of about
``cell_rows`` rows.  No window ever spans a source.

Defined results: a null text has size 0; a null source is a source of its own
and comes last; repeated rows are separate documents; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import word_count
from changeloom.session import stage

WEIGHTS = (5.0, 2.0, 1.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5,
                   max_repeat: float = 2.0) -> DataFrame:
    """One row per source of ``sizes(source, size)``: its size, rows and target.

    Sources in code point order (null last) get ``weights`` in turn and share
    ``share`` times all words by weight; a target stops at ``max_repeat`` times
    the source's size and the excess goes to the others by weight.  Water level
    in closed form: with sources sorted by ``cap / weight``, those before the
    first one whose cap exceeds the level are full.  The windows here run over
    one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.lit(1)).alias("source_rows"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    everything = Window.partitionBy(F.lit(0))
    by_level = everything.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    ranked = (per
              .withColumn("weight", F.element_at(w, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
                                                     + 1).cast("int")))
              .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
              .withColumn("level", F.col("cap") / F.col("weight"))
              .withColumn("total", total)
              .withColumn("rest", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(onward)))
    # The water level is the level of the first source that it does not fill.
    open_level = F.min(F.when(F.col("rest") < F.col("level"), F.struct("level", "source", "rest"))).over(everything)
    return (ranked
            .withColumn("water", open_level["rest"])
            .withColumn("target", F.when(F.col("water").isNull(), F.col("cap"))
                        .otherwise(F.least("cap", F.col("water") * F.col("weight"))))
            .select("source", "source_size", "source_rows", "target"))


def _unit(text: Column) -> Column:
    """A fixed pseudo-random number in [0, 1) with 20 bits (sums with ranks
    stay exact in a double)."""
    return F.conv(F.substring(F.md5(text), 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights=WEIGHTS, share: float = 1.5,
                max_repeat: float = 2.0, seed: int = 17, cell_rows: int = 50_000) -> DataFrame:
    """Copies to take of every document.

    Returns doc_id, source, size, source_size, target, copies, taken.  Equal
    input gives equal output, in any partitioning.  ``cell_rows`` is the number
    of rows of one window (expected; ids are spread by hash).
    """
    # Texts are read once: all that follows needs three narrow columns.
    sized = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              word_count(F.col(text_col)).alias("size")), "mix-sizes")
    targets = source_targets(sized.select("source", "size"), weights, share, max_repeat)

    tag = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    blocks = F.ceil(F.col("source_rows") / F.lit(cell_rows))
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|block|"), tag)), 1, 8), 16, 10).cast("long")
    placed = (sized.alias("d")
              .join(targets.withColumnRenamed("source", "s").alias("t"), F.col("source").eqNullSafe(F.col("s")))
              .drop("s")
              .withColumn("stratum", F.floor(F.sqrt(F.col("size").cast("double"))))
              .withColumn("block", F.pmod(hashed, blocks)))

    # Rows of every cell and the rows before it within its source: blocks
    # within a stratum first, then strata within the source.
    cells = (placed.groupBy("source", "stratum", "block").agg(F.count(F.lit(1)).alias("n")))
    in_stratum = Window.partitionBy("source", "stratum").orderBy("block")
    cells = cells.withColumn("in_stratum", F.sum("n").over(in_stratum) - F.col("n"))
    strata = (cells.groupBy("source", "stratum").agg(F.sum("n").alias("m")))
    in_source = Window.partitionBy("source").orderBy("stratum")
    strata = strata.withColumn("in_source", F.sum("m").over(in_source) - F.col("m"))
    same = (F.col("c.source").eqNullSafe(F.col("s.source")) & (F.col("c.stratum") == F.col("s.stratum")))
    starts = (cells.alias("c").join(strata.alias("s"), same)
              .select("c.source", "c.stratum", "c.block",
                      (F.col("in_source") + F.col("in_stratum")).alias("before")))

    in_cell = Window.partitionBy("source", "stratum", "block").orderBy("size", F.col("doc_id").asc_nulls_last())
    cell = (F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.stratum") == F.col("b.stratum"))
            & (F.col("r.block") == F.col("b.block")))
    ranked = (placed.withColumn("nth", F.row_number().over(in_cell)).alias("r")
              .join(starts.alias("b"), cell)
              .select("doc_id", "r.source", "size", "source_size", "target",
                      (F.col("before") + F.col("nth")).cast("double").alias("k")))

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.concat(F.lit(f"{seed}|offset|"), F.coalesce(F.col("source"), F.lit("\0"))))
    crossed = F.floor(F.col("k") * rate + offset) - F.floor((F.col("k") - 1) * rate + offset)
    return (ranked.withColumn("copies", F.least(crossed, F.ceil(rate)).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def take_mix(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mix with all their columns, each repeated as often
    as it is taken.  Rows that share an id are told apart by their rank among
    the rows of that id (size, then source and the whole row's hash)."""
    names = docs.columns
    mixed = mix_sources(docs, **params)
    nth = lambda *order: F.row_number().over(Window.partitionBy("_id").orderBy(*order))
    size = word_count(F.col(params.get("text_col", "text")))
    left = (docs.withColumn("_id", F.coalesce(F.col(params.get("id_col", "doc_id")).cast("string"), F.lit("")))
            .withColumn("_nth", nth(size, F.col(params.get("source_col", "source")).asc_nulls_last(),
                                    F.xxhash64(*[F.col(c) for c in names]))))
    # All rows of an id take part in the ranking, also those with no copies.
    right = (mixed.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
             .withColumn("_nth", nth("size", F.col("source").asc_nulls_last(), F.col("copies").desc()))
             .where("copies > 0").select("_id", "_nth", F.col("copies").alias("_copies")))
    return (left.join(right, ["_id", "_nth"])
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
            .select(*[F.col(c) for c in names]))
