"""Merkle manifest of a dataset, with a proof for every row.

Every row is a leaf.  Within a source, leaves are ranked by id; every three
neighbouring nodes become one node of the level above, up to the source's
subroot, and the subroots, ranked by source, are in the same way the leaves of
the tree that ends in the root.

The rank's digits to base three are columns.  Grouping one digit column away
puts up to three child structs into their parent, so after ``BLOCK_LEVELS``
groupings a row is a whole block: a nested struct of at most 3^BLOCK_LEVELS
leaves.  All groupings of a block follow one shuffle by (source, block).  The
roots of the blocks are the leaves of the next layer of blocks, until a source
is one block.  From the top layer down, a transform of the nested struct gives
every node the siblings on its way to the block's root, followed by those of
the block itself, and an explode emits them; a block and what lies above it
meet in a union grouped by block, two rows a group.

Ranks come from one range sort and prefix sums over the partitions' counts, so
no task holds a source.

Defined results: a null in any field is written as ``-`` and differs from an
empty value; null sources are one source, which comes first; rows with null ids
come first within their source; rows that are equal in all fields are leaves of
their own (which of them takes which place does not show in any digest); a null
id counts as empty where the id's checksum decides; a lone leaf is its subroot
and a lone subroot the root, with a proof of no siblings; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import crc_mod
from changeloom.session import stage, unstage

FANOUT = 3
BLOCK_LEVELS = 6
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = "struct<before:string,after:string>"


def _h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field with its byte count in front, ``-`` for a
    null, so that no two rows share a text."""
    return _h(*[_field(f) for f in fields])


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return F.size(F.filter(F.array(*[F.lit(FANOUT ** k) for k in range(40)]), lambda p: p < n))


def _ranked(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``idx`` (rank within ``tree``, from 0) and ``depth`` (levels of that
    tree).  ``nodes`` is a written table; ``order`` is total within a tree."""
    keys = [F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    place = F.monotonically_increasing_id()         # partition, then place in it
    placed = stage(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("_run", F.shiftright(place, 33))
                   .withColumn("_pos", place.bitwiseAND(F.lit((1 << 33) - 1))), "merkle-placed")
    counts = placed.groupBy(tree, "_run").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(counts.select(
        F.col(tree).alias("_tree"), F.col("_run").alias("_at"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        _depth(F.sum("_n").over(whole)).alias("depth")), "merkle-offsets")
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_run") == F.col("_at"))
    return (placed.join(offsets, same).withColumn("idx", F.col("_pos") + F.col("_shift"))
            .drop("_run", "_pos", "_tree", "_at", "_shift", *order))


def _blocks(nodes: DataFrame, tree: str, done: int) -> DataFrame:
    """(tree, depth, block, h, children): nodes (tree, depth, idx, h, item) of
    level ``done`` nested into blocks.  Above a tree's depth a node is its only
    child."""
    size = FANOUT ** BLOCK_LEVELS
    digits = [f"_d{k}" for k in range(BLOCK_LEVELS)]
    rows = nodes.select(
        tree, "depth", F.expr(f"idx div {size}").alias("block"), "h", "item",
        *[F.pmod(F.expr(f"idx div {FANOUT ** k}"), F.lit(FANOUT)).cast("tinyint").alias(d)
          for k, d in enumerate(digits)]).repartition(tree, "block")
    payload = "item"
    for k, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("d"), "h", payload)
        rows = (rows.groupBy(tree, "depth", "block", *digits[k + 1:])
                .agg(F.sort_array(F.collect_list(child)).alias("children")))
        texts = F.array_join("children.h", "")
        rows = rows.withColumn("h", F.when(F.col("depth") > done + k, F.sha2(texts, 256)).otherwise(texts))
        payload = "children"
    return rows


def _down(children: Column, level: int, done: int, depth: Column, above: Column) -> Column:
    """Array of (item, h, path) of a nested block: every node's way is its
    siblings, then the way of its parent."""
    def one(c: Column, i: Column) -> Column:
        hashes = children["h"]
        step = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("before"),
                        F.array_join(F.slice(hashes, i + 2, F.lit(FANOUT)), "").alias("after"))
        way = F.when(depth > done + level, F.concat(F.array(step), above)).otherwise(above)
        if level:
            return _down(c["children"], level - 1, done, depth, way)
        return F.array(F.struct(c["item"].alias("item"), c["h"].alias("h"), way.alias("path")))
    return F.flatten(F.transform(children, one))


def _spread(blocks: DataFrame, above: DataFrame, tree: str, done: int, carried: list[str]) -> DataFrame:
    """(tree, item, h, path, carried): the nodes of the blocks, with the way
    ``up`` of their block appended.  ``above`` has (tree, block, up, carried)."""
    shape = {f.name: f.dataType for f in blocks.schema.fields}
    lower = blocks.select(tree, "block", "depth", "children", F.lit(None).cast(f"array<{STEP}>").alias("up"),
                          *[F.lit(None).cast("string").alias(c) for c in carried])
    upper = above.select(tree, "block", F.lit(None).cast(shape["depth"]).alias("depth"),
                         F.lit(None).cast(shape["children"]).alias("children"), "up", *carried)
    met = lower.unionByName(upper).groupBy(tree, "block").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("depth", "children", "up", *carried)])
    nodes = _down(F.col("children"), BLOCK_LEVELS - 1, done, F.col("depth"), F.col("up"))
    return met.select(tree, *carried, F.explode(nodes).alias("n")).select(tree, *carried, "n.*")


def _grow(nodes: DataFrame, tree: str) -> list[DataFrame]:
    """Layers of blocks over ranked nodes (tree, depth, idx, h, item), from
    the leaves up; in the last, each tree is one block."""
    layers = [stage(_blocks(nodes, tree, 0), "merkle-blocks")]
    deepest = layers[0].agg(F.max("depth")).first()[0] or 0
    while deepest > BLOCK_LEVELS * len(layers):
        roots = layers[-1].select(tree, "depth", F.col("block").alias("idx"), "h", F.col("block").alias("item"))
        layers.append(stage(_blocks(roots, tree, BLOCK_LEVELS * len(layers)), "merkle-blocks"))
    return layers


def _ways(layers: list[DataFrame], tree: str, above: DataFrame, carried: list[str]) -> DataFrame:
    """(tree, item, h, path, carried) of the leaves; ``above`` has one row
    (tree, up, carried) a tree."""
    up = above.withColumn("block", F.lit(0).cast("bigint"))
    for k in range(len(layers) - 1, -1, -1):
        nodes = _spread(layers[k], up, tree, BLOCK_LEVELS * k, carried)
        up = nodes.select(tree, F.col("item").alias("block"), F.col("path").alias("up"), *carried) if k else nodes
    return up


def manifest(docs: DataFrame, fields: list[str] | None = None, id_col: str = "doc_id",
             source_col: str = "source", check: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row.

    ``fields`` (default ``FIELDS``) are digested in this order.  ``check`` is a
    second leaf digest of the row as it is found now (null: unchanged); folding
    it with the row's siblings tells whether the row is still the one of the
    manifest.

    Returns (id, source, leaf, path, proof_sha256, subroot, root, folded_root,
    verified); ``path`` lists the siblings before and after the node, level by
    level.
    """
    found = check if check is not None else F.lit(None).cast("string")
    leaves = stage(docs.select(
        F.col(source_col).alias("_source"), F.col(id_col).alias("_id"),
        F.monotonically_increasing_id().alias("_serial"),
        leaf_digest([F.col(c) for c in fields or FIELDS]).alias("h"), found.alias("_found")), "merkle-leaves")
    nodes = leaves.select("_source", F.col("_id").alias("_order"), F.col("h").alias("_leaf"), "_serial", "h",
                          F.struct(F.col("_id").alias("id"), F.col("_found").alias("found")).alias("item"))
    layers = _grow(_ranked(nodes, "_source", ["_order", "_leaf", "_serial"]), "_source")
    unstage(leaves)

    subroots = layers[-1].select(F.lit(0).alias("_tree0"), F.col("_source").alias("_order"), "h",
                                 F.struct(F.col("_source").alias("source")).alias("item"))
    top = _grow(_ranked(subroots, "_tree0", ["_order"]), "_tree0")
    root = top[-1].select("_tree0", F.array().cast(f"array<{STEP}>").alias("up"), F.col("h").alias("root"))
    sources = _ways(top, "_tree0", root, ["root"]).select(
        F.col("item.source").alias("_source"), F.col("path").alias("up"), F.col("h").alias("subroot"), "root")
    rows = _ways(layers, "_source", sources, ["subroot", "root"])

    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    folded = F.aggregate("path", F.coalesce(F.col("item.found"), F.col("h")),
                         lambda acc, s: _h(s["before"], acc, s["after"]))
    return rows.select(F.col("item.id").alias(id_col), F.col("_source").alias(source_col), F.col("h").alias("leaf"),
                       "path", proof.alias("proof_sha256"), "subroot", "root", folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def line_feeds_deleted(fields: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Leaf of a row whose text has lost its line feeds, for the rows whose id
    has an even checksum; null for rows that this does not change."""
    stripped = F.translate(F.col(text_col), "\n", "")
    hit = (crc_mod(F.col(id_col), 2) == 0) & F.contains(F.col(text_col), F.lit("\n"))
    return F.when(hit, leaf_digest([stripped if c == text_col else F.col(c) for c in fields or FIELDS]))
