"""Near-duplicate documents: MinHash by one-permutation hashing.

Each document is the set of its distinct 5-word shingles.  Documents with equal
sets form a class; all further work is on one member per class.

* Signature: one hash per shingle, the smallest in each of ``BANDS * ROWS``
  bins; an empty bin borrows from a non-empty one that a random order of its
  own picks (optimal densification).
* Buckets: each band of ``ROWS`` bins is a key; classes that share a key meet.
* Star-shaped candidate edges: in each bucket one centre is compared with the
  other classes, so candidates grow with the rows, not with their square.  The
  first centre is the class with the most bucket mates, then random ones.
* Every candidate is confirmed on the full shingle sets; links are contracted
  to components after each round, and only classes of different components are
  compared again.
* The exact rest: a star may leave classes of a bucket uncompared.  Buckets of
  at most ``SMALL`` classes compare all that still differ.  In larger ones the
  classes outside the largest component of their family (the buckets that hang
  together) are looked up in an inverted index of blocks of the family's sets.
  That yields links only, no pairs, and leaves no pair of bucket mates out.

With 50 bands of 5 rows, a pair of similarity 0.75 shares a bucket with
probability 1 - 1e-6, and more similar pairs with higher.

Defined results: a null text or one without words has no shingles and is linked
with nothing; rows that share an id count as one document; rows with a null id
have no component and are kept; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.session import stage

WIDTH = 5
BANDS, ROWS = 50, 5
SMALL = 24              # classes of a bucket that are all compared
STARS = 4               # star rounds
BLOCK = 400             # classes of a family in one block of the index
SKETCH_FROM = 100       # sets at least this large are pre-compared by sketch
SKETCH_AGREE = 172      # equal sketch bits (of 250) below which no pair of such sets has 0.75
FILTER_BITS = 1 << 22

SIGNED = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch array<bigint>"
U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class Shingles:
    """Distinct word shingles of a text as sorted 64-bit hashes."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.known: dict[bytes, int] = {}
        self.factors = _mix(np.arange(1, width + 1, dtype=U)) | U(1)

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()       # ASCII lower case and white space
        if not words:
            return np.zeros(0, U)
        known = self.known
        if len(known) > 500_000:
            known.clear()
        new = xxhash.xxh64_intdigest
        codes = np.fromiter((known.get(w) or known.setdefault(w, new(w)) for w in words), U, len(words))
        if len(words) < self.width:
            # the whole sequence is one shingle, told apart by its length
            return np.array([xxhash.xxh64_intdigest(codes.tobytes(), seed=len(words))], U)
        n = len(words) - self.width + 1
        total = np.zeros(n, U)
        for k, factor in enumerate(self.factors):
            total += _mix(codes[k:k + n]) * factor
        return np.unique(_mix(total))


class Signature:
    """Band keys and a bit sketch of a shingle set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        # order[i, j]: how early bin i, if empty, tries bin j
        self.order = (_mix(np.arange(self.bins ** 2, dtype=U) + U(1)).reshape(self.bins, self.bins) >> U(32)).astype(np.uint32)
        self.factors = _mix(np.arange(1, rows + 1, dtype=U)) | U(1)
        self.band = _mix(np.arange(bands, dtype=U) + U(977))

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins = ((shingles >> U(32)) * U(self.bins) >> U(32)).astype(np.int64)    # rises with the hash
        first = np.concatenate([[0], np.flatnonzero(bins[1:] != bins[:-1]) + 1])
        filled = bins[first]
        values = np.zeros(self.bins, U)
        values[filled] = shingles[first]
        if len(filled) < self.bins:
            empty = np.ones(self.bins, bool)
            empty[filled] = False
            empty = np.flatnonzero(empty)
            values[empty] = values[filled[self.order[np.ix_(empty, filled)].argmin(axis=1)]]
        keys = _mix((_mix(values.reshape(self.bands, self.rows)) * self.factors).sum(axis=1, dtype=U) + self.band)
        bits = np.packbits((_mix(values) & U(1)).astype(np.uint8))
        return keys, np.frombuffer(bits.tobytes().ljust(-(-len(bits) // 8) * 8, b"\0"), np.int64)


def _sign(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signature = Shingles(width), Signature(bands, rows)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for at in range(0, batch.num_rows, 1000):
                sets = [shingles(t) for t in texts.slice(at, 1000).to_pylist()]
                signed = [signature(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, 1000), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                               for s in sets], pa.binary()),
                     pa.array([None if k is None else k.view(np.int64) for k, _ in signed], pa.list_(pa.int64())),
                     pa.array([b for _, b in signed], pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "digest", "bands", "sketch"])
    return run


def _sets(width: int, wanted):
    """Shingle sets of the documents whose id is in the filter ``wanted`` (a
    broadcast bit map of fixed size; it may let others pass)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            hit = np.flatnonzero((wanted.value[slot >> 5] >> (slot & 31)) & 1)
            chosen = batch.take(pa.array(hit))
            ids, texts = chosen.column("doc_id"), chosen.column("text").cast(pa.binary())
            for at in range(0, len(hit), 1000):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 1000),
                     pa.array([shingles(t).tobytes() for t in texts.slice(at, 1000).to_pylist()], pa.binary())],
                    names=["node", "shingles"])
    return run


def _slot(node: Column) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(FILTER_BITS))


def _similar(one: bytes, other: bytes, percent: int) -> bool:
    a, b = np.frombuffer(one, U), np.frombuffer(other, U)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("s").to_pylist(), batch.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array([_similar(s, t, percent) for s, t in pairs])],
                names=["u", "v", "linked"])
    return run


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that ``links(u, v)`` reach from each node.

    Labels spread to neighbours and then jump to their label's label, so the
    rounds grow with the logarithm of the longest path.  Tables are written
    between the steps: no lineage grows, and joins on hot nodes read plain
    tables, whose hot partitions Spark splits.
    """
    both = stage(links.select("u", "v").union(links.select("v", "u")).where("u <> v").distinct(), "near-links")
    labels = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label"))
                   .withColumnRenamed("u", "node"), "near-labels")
    while True:
        near = (both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("m")))
        spread = stage(labels.join(near, labels["node"] == near["u"])
                       .select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "near-spread")
        up = spread.select(F.col("node").alias("n"), F.col("label").alias("higher"))
        labels = stage(spread.join(up, spread["label"] == up["n"])
                       .select("node", "old", F.col("higher").alias("label")), "near-labels")
        if labels.where("old <> label").limit(1).count() == 0:
            return labels.select("node", "label")
        labels = labels.select("node", "label")


class _Search:
    """The rounds over the bucket table.  ``buckets(key, node, n, sketch)``
    holds the classes of buckets with two classes or more."""

    def __init__(self, buckets: DataFrame, sets: DataFrame, percent: int):
        self.buckets, self.sets, self.percent = buckets, sets, percent
        self.labels: DataFrame | None = None        # node, label of linked classes
        self.tested: DataFrame | None = None        # u, v of earlier candidates

    def labelled(self) -> DataFrame:
        """Rows of buckets that still hold classes of different components."""
        rows = self.buckets
        if self.labels is not None:
            rows = rows.join(self.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        else:
            rows = rows.withColumn("label", F.col("node"))
        spread = rows.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"),
                                         F.count(F.lit(1)).alias("size")).where("a <> b")
        return rows.join(spread.select("key", "size"), "key")

    def candidates(self, centres: DataFrame, rows: DataFrame) -> DataFrame:
        """Pairs of a centre and a bucket mate of another component that can be
        similar: sizes within the ratio, and sketches (of large sets) agree."""
        c = centres.select("key", *[F.col(x).alias(f"c_{x}") for x in ("node", "label", "n", "sketch")])
        agree = F.lit(64 * 4) - sum((F.bit_count(F.element_at("sketch", i).bitwiseXOR(F.element_at("c_sketch", i)))
                                     for i in range(1, 5)), F.lit(0))
        can = ((F.col("label") != F.col("c_label"))
               & (100 * F.least("n", "c_n") >= self.percent * F.greatest("n", "c_n"))
               & ((F.least("n", "c_n") < SKETCH_FROM) | (agree - 6 >= SKETCH_AGREE)))
        r = rows.select(F.col("key").alias("k"), "node", "label", "n", "sketch")
        pairs = (r.join(c, (F.col("k") == F.col("key")) & can)
                 .select(F.least("node", "c_node").alias("u"), F.greatest("node", "c_node").alias("v")).distinct())
        return pairs if self.tested is None else pairs.join(self.tested, ["u", "v"], "left_anti")

    def confirm(self, pairs: DataFrame) -> bool:
        """Compare the full sets of ``pairs``, contract the links; any found?"""
        pairs = stage(pairs, "near-pairs")
        self.tested = pairs if self.tested is None else self.tested.union(pairs)
        s, t = self.sets, self.sets
        checked = stage(pairs.join(s.select(F.col("node").alias("u"), F.col("shingles").alias("s")), "u")
                        .join(t.select(F.col("node").alias("v"), F.col("shingles").alias("t")), "v")
                        .select("u", "v", "s", "t")
                        .mapInArrow(_confirm(self.percent), "u bigint, v bigint, linked boolean"), "near-checked")
        return self.contract(checked.where("linked"))

    def contract(self, links: DataFrame) -> bool:
        if links.limit(1).count() == 0:
            return False
        if self.labels is None:
            self.labels = components(links)
            return True
        # The earlier components keep their shape: link labels, then rename them.
        old = self.labels
        named = links
        for side in ("u", "v"):
            named = (named.join(old.select(F.col("node").alias(side), F.col("label").alias("_l")), side, "left")
                     .withColumn(side, F.coalesce("_l", side)).drop("_l"))
        renamed = components(named)
        kept = (old.join(renamed.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
                .select("node", F.coalesce("to", "label").alias("label")))
        fresh = renamed.join(old, "node", "left_anti").select("node", "label")
        self.labels = stage(kept.union(fresh), "near-components")
        return True

    def star(self, round_no: int) -> bool:
        rows = stage(self.labelled().where((F.col("size") > SMALL) | F.lit(round_no == 0)), "near-open")
        if round_no == 0:
            mates = rows.groupBy("node").agg(F.sum("size").alias("mates"))
            pick = F.max(F.struct(F.col("mates"), -F.col("node")))
            chosen = (rows.join(mates, "node").groupBy("key").agg(pick.alias("p"))
                      .select("key", (-F.col("p")["col2"]).alias("node")))
        else:
            # a random component of the bucket, and a random class of it
            draw = F.struct(F.xxhash64(F.lit(round_no), "label").alias("a"),
                            F.xxhash64(F.lit(-round_no), "node").alias("b"), F.col("node"))
            chosen = rows.groupBy("key").agg(F.min(draw).alias("p")).select("key", F.col("p")["node"].alias("node"))
        centres = rows.join(stage(chosen, "near-centres"), ["key", "node"])
        return self.confirm(self.candidates(centres, rows))

    def small(self) -> bool:
        rows = stage(self.labelled().where(F.col("size") <= SMALL), "near-small")
        return self.confirm(self.candidates(rows, rows))

    def large(self) -> bool:
        """The exact rest of buckets of more than ``SMALL`` classes."""
        rows = stage(self.labelled().where(F.col("size") > SMALL), "near-large")
        if rows.limit(1).count() == 0:
            return False
        hubs = rows.groupBy("key").agg(F.min("node").alias("u"))
        family = components(rows.join(stage(hubs, "near-hubs"), "key").select("u", F.col("node").alias("v")))
        members = stage(rows.select("node", "label").distinct()
                        .join(family.withColumnRenamed("label", "family"), "node"), "near-members")
        sizes = members.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n"))
        family_of = sizes.groupBy("family").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"))
        members = members.join(stage(family_of.select("family", F.col("top")["label"].alias("top"), "size"),
                                     "near-families"), "family")
        blocks = F.ceil(F.col("size") / BLOCK)
        with_sets = members.join(self.sets, "node")
        block = with_sets.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("query", F.lit(False))
        query = (with_sets.where("label <> top")
                 .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
                 .withColumn("query", F.lit(True)))
        columns = ["family", "block", "query", "node", "label", "shingles"]
        links = stage(block.select(*columns).union(query.select(*columns))
                      .groupBy("family", "block").applyInArrow(_look_up(self.percent), "u bigint, v bigint"), "near-found")
        return self.contract(links)

    def run(self) -> DataFrame | None:
        for round_no in range(STARS):
            if not self.star(round_no) and round_no:
                break
            if round_no == 0:
                self.small()
        self.large()
        return self.labels


def _look_up(percent: int):
    """Links between the queries and the sets of a block, over an inverted
    index of the block's shingles."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["query", "node", "label", "shingles"]).to_pylist()
        own = [r for r in rows if not r["query"]]
        sets = [np.frombuffer(r["shingles"], U) for r in own]
        found: list[tuple[int, int]] = []
        if own:
            values = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            length = np.array([len(s) for s in sets])
            for r in rows:
                if not r["query"]:
                    continue
                q = np.frombuffer(r["shingles"], U)
                lo, hi = np.searchsorted(values, q, "left"), np.searchsorted(values, q, "right")
                hits = hi - lo
                at = np.repeat(lo - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
                both = np.bincount(owner[at], minlength=len(sets))
                for k in np.flatnonzero(100 * both >= percent * (length + len(q) - both)):
                    if own[k]["label"] != r["label"]:
                        found.append((min(own[k]["node"], r["node"]), max(own[k]["node"], r["node"])))
        return pa.table({"u": pa.array([a for a, _ in found], pa.int64()),
                         "v": pa.array([b for _, b in found], pa.int64())})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 75, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets; a component is named by its smallest id, whose row is kept.
    The sketch test holds for 75 percent or more and 250 bins, others are refused.
    """
    if percent < 75 or bands * rows != BANDS * ROWS:
        raise ValueError(f"percent must be at least 75 and bands * rows {BANDS * ROWS}: the sketch test is made for these")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    signed = stage(docs.mapInArrow(_sign(width, bands, rows), SIGNED), "near-signatures")

    # One node per class of equal sets: the smallest id.
    filled = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = stage(filled.groupBy("digest").agg(F.min("doc_id").alias("node")), "near-classes")
    heads = (filled.join(classes.select(F.col("digest").alias("d"), "node"),
                         (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("node")))
             .select("node", F.col("n_shingles").alias("n"), "bands", "sketch").dropDuplicates(["node", "n"]))
    heads = stage(heads, "near-heads")
    keyed = heads.select(F.explode("bands").alias("key"), "node")
    shared = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "near-keys")
    mates = stage(keyed.join(shared, "key"), "near-mates")
    buckets = stage(mates.join(heads.select("node", "n", "sketch"), "node").select("key", "node", "n", "sketch"),
                    "near-buckets")

    # The sets of the classes in buckets; a bit map of fixed size picks them.
    words = (mates.select(_slot(F.col("node")).alias("slot")).distinct()
             .groupBy(F.shiftright("slot", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 31 AS INT))")).alias("bits")).toArrow())
    bitmap = np.zeros(FILTER_BITS // 32, np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    wanted = spark.sparkContext.broadcast(bitmap)
    sets = stage(docs.where("doc_id IS NOT NULL").withColumn("slot", _slot(F.col("doc_id")))
                 .mapInArrow(_sets(width, wanted), "node bigint, shingles binary"), "near-sets")

    labels = _Search(buckets, sets, percent).run()
    member = classes.select(F.col("digest").alias("d"), "node")
    out = signed.select("doc_id", "n_shingles", "digest").join(member, F.col("digest") == F.col("d"), "left")
    if labels is not None:
        out = out.join(labels, "node", "left")
    else:
        out = out.withColumn("label", F.lit(None).cast("long"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component."""
    gone = near_duplicates(docs, id_col=id_col, **params).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
