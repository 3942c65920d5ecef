"""Language-model scores: a hashed maximum-entropy model with classes.

``P(word | history) = P(class | history) * P(word | class)``.  The class
factor is a softmax over sparse features of the two words before: each alone
(n-gram and skip feature), both together, and the pair of their classes; words
enter by a hash of their ending, frequent words by themselves.  The word factor
has the word alone as its feature, for which maximum entropy gives the relative
frequency, from counts over all training text, with one count of mass in every
class for words not seen.  Frequent words are classes of their own, the others
are clustered by the frequent words around their endings.

1. One pass over all texts turns documents into numbers of a block dictionary
   (a block is a run of documents of bounded size within a partition) and
   writes both.  Word counts are summed over the blocks: they, and what is
   shuffled, grow with the corpus; only totals per class reach the driver.
2. The counts are joined back to the block dictionaries; every document is
   written as the buckets of its words, with its base score and what of its
   word factor does not depend on the classes.
3. The class factor is fitted on all training documents by distributed gradient
   updates: every shard (their number grows with the corpus) runs mini-batch
   steps from the broadcast weights, equal histories of a run of text as one;
   the shards' weights are averaged piece by piece in a tree, every feature row
   by how often a shard met it, and the next round starts from the mean.
4. Documents are scored in numpy, sparse rows of weights added up per token.

Defined results: a null text is empty and scores its end token; a null id
counts as empty text for the fold; repeated rows are scored alike; an empty
table gives an empty result, and without training documents all counts are 0;
other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import crc_mod
from changeloom.session import stage

HEADS = 28              # frequent words (with the end of text) that are classes of their own
TAILS = 36              # classes of the other words
ENDINGS = 4096          # hashed word endings
WEIGHT_ROWS = 1 << 14   # hashed feature rows
SHARDS, ROUNDS = 8, 3   # fewest shards, if there are so many partitions
SHARD_TOKENS = 1 << 23  # expected training tokens of a shard of a larger corpus
RUN_TOKENS = 1 << 20    # tokens whose equal histories are trained as one
PIECES, FAN_IN = 64, 16  # of the weights, and of the tree that averages them
BLOCK_BYTES = 8 << 20   # text of a block
RATE = 0.3
END = b""               # the end of a text; no word is empty

TOKENS = ("block bigint, doc_id bigint, held_out boolean, words binary, "
          "place int, token binary, n bigint")
BUCKETS = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
           "word_score double, buckets binary")
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
PART = "piece bigint, part bigint, n binary, weights binary"


def _blocks(block_bytes: int):
    """Documents as numbers of their block's dictionary, and the dictionaries
    with counts over the training documents."""
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.binary(), pa.int64()]
    names = ["block", "doc_id", "held_out", "words", "place", "token", "n"]

    def rows(many: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(many, k) for c, k in zip(names, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part = 0, TaskContext.get().partitionId()
        places: dict[bytes, int] = {END: 0}
        docs: list[tuple] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            me = (part << 32) + number
            trained = [w for _, held, w in docs if not held]
            n = np.bincount(np.concatenate(trained), minlength=len(places)) if trained else np.zeros(len(places), int)
            yield rows(len(docs), block=[me] * len(docs), doc_id=[d for d, _, _ in docs],
                       held_out=[h for _, h, _ in docs], words=[w.tobytes() for _, _, w in docs])
            yield rows(len(places), block=np.full(len(places), me), place=np.arange(len(places)),
                       token=list(places), n=n)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for at in range(0, batch.num_rows, 500):
                part_of = zip(*(batch.column(c).slice(at, 500).to_pylist() for c in ("doc_id", "held_out")),
                              texts.slice(at, 500).to_pylist())
                for doc, held, text in part_of:
                    words = (text or b"").lower().split()
                    put = places.setdefault
                    docs.append((doc, held, np.array([*(put(w, len(places)) for w in words), 0], "<u4")))
                    size += len(text or b"")
                    if size >= block_bytes:
                        yield from close()
                        number, size = number + 1, 0
                        places, docs = {END: 0}, []
        if docs:
            yield from close()
    return run


def ending(token: bytes) -> int:
    """Bucket of a word: a hash of its last three bytes."""
    return zlib.crc32(token[-3:]) % ENDINGS


def ending_of(token: Column) -> Column:
    return F.pmod(F.crc32(F.substring(token, -3, 3)), F.lit(ENDINGS)).cast("int")


@dataclass
class Model:
    heads: list[bytes]          # words that are buckets (ENDINGS + i) and classes (i) of their own
    classes: np.ndarray         # class of every bucket
    bias: np.ndarray
    weights: np.ndarray         # feature rows x classes
    mass: np.ndarray            # counts plus one, summed over the known words of a class
    total: int                  # N: training tokens
    distinct: int               # V: distinct training tokens

    def plain(self) -> dict:
        """As a dict of numbers and arrays, which executors read without this package."""
        return {**vars(self), "size": len(self.bias)}


def features(buckets: np.ndarray, classes: np.ndarray, n_classes: int, n_rows: int) -> np.ndarray:
    """Feature rows (4 x positions) of a padded sequence: bucket 1 and 2 back,
    both, and both classes.  The first two positions are padding."""
    return _feature_rows(np.roll(buckets, 1), np.roll(buckets, 2), np.roll(classes, 1), np.roll(classes, 2),
                         n_classes, n_rows)


def _feature_rows(b1: np.ndarray, b2: np.ndarray, c1: np.ndarray, c2: np.ndarray, n_classes: int,
                  n_rows: int) -> np.ndarray:
    b1, b2 = b1.astype(np.uint64), b2.astype(np.uint64)
    pairs = (n_classes + 1) ** 2
    room = np.uint64(n_rows - pairs)

    def hashed(x: np.ndarray) -> np.ndarray:
        x = x * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) % room).astype(np.int64) + pairs

    return np.stack([hashed(b1 * np.uint64(3)), hashed(b2 * np.uint64(3) + np.uint64(1)),
                     hashed(((b1 << np.uint64(20)) + b2) * np.uint64(3) + np.uint64(2)),
                     c1 * (n_classes + 1) + c2])


def _padded(sequences: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences one after another, each behind two paddings; and a mask."""
    flat = np.concatenate([x for s in sequences for x in (np.array([pad, pad]), s)])
    real = np.ones(len(flat), bool)
    starts = np.cumsum([0, *(len(s) + 2 for s in sequences[:-1])])
    real[starts] = real[starts + 1] = False
    return flat, real


def _scores(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of the classes, the highest of a position at 0."""
    z = weights[rows[0]]
    for r in rows[1:]:
        z += weights[r]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z


def _log_softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = _scores(weights, bias, rows)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def class_logs(m, buckets: np.ndarray, real: np.ndarray, size: int = 1 << 20, chunk: int = 1 << 15) -> np.ndarray:
    """Log probability of the class at every position of padded sequences (0 at
    paddings).  Of ``size`` positions at a time, equal histories are computed
    once, ``chunk`` of them together."""
    n, classes = len(m.classes) + 1, np.append(m.classes, m.size)
    out, at = np.zeros(len(buckets)), np.flatnonzero(real)
    for here in (at[k:k + size] for k in range(0, len(at), size)):
        history = buckets[here - 1] * n + buckets[here - 2]
        order = np.argsort(history)
        history, here = history[order], here[order]
        first = np.flatnonzero(np.diff(history, prepend=-1))
        ends = np.append(first, len(here))
        for a in range(0, len(first), chunk):
            own = first[a:a + chunk]
            lo, hi = own[0], ends[min(a + chunk, len(first))]
            b1, b2 = np.divmod(history[own], n)
            z = _log_softmax(m.weights, m.bias, _feature_rows(b1, b2, classes[b1], classes[b2], m.size, len(m.weights)))
            which = np.repeat(np.arange(len(own)), np.diff(np.append(own, hi)))
            out[here[lo:hi]] = z[which, classes[buckets[here[lo:hi]]]]
    return out


def _buckets_of(text: bytes | None, heads: dict[bytes, int]) -> np.ndarray:
    words = [*(text or b"").lower().split(), END]
    return np.array([heads[w] if w in heads else zlib.crc32(w[-3:]) % ENDINGS for w in words], np.int64)


def _sequences(heads: dict[bytes, int]):
    """The buckets of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([_buckets_of(t, heads).astype("<u2").tobytes() for t in texts], pa.binary())], names=["buckets"])
    return run


def _runs(batches: Iterator[pa.RecordBatch], pad: int, size: int = RUN_TOKENS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Padded sequences, and masks of what is to be predicted, about ``size``
    tokens at a time; a longer text goes on behind its last two tokens."""
    held, many = [], 0
    for batch in batches:
        for b in batch.column("buckets").to_pylist():
            held.append(np.frombuffer(b, "<u2").astype(np.int64))
            many += len(held[-1])
            if many >= size:
                flat, real = _padded(held, pad)
                for at in range(0, len(flat), 2 * size):
                    lo = max(0, at - 2)
                    part = real[lo:at + 2 * size].copy()
                    part[:at - lo] = False
                    yield flat[lo:at + 2 * size], part
                held, many = [], 0
    if held:
        yield _padded(held, pad)


def _profiles(n_heads: int, span: int = 4):
    """How often each head occurs within ``span`` words of every bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = ENDINGS + n_heads
        table = np.zeros(n * n_heads, np.int64)
        for flat, real in _runs(batches, n):
            text = np.cumsum(~real)
            for k in range(1, span + 1):
                same = (text[:-k] == text[k:]) & real[:-k] & real[k:]
                for x, y in ((flat[:-k], flat[k:]), (flat[k:], flat[:-k])):
                    hit = same & (y >= ENDINGS)
                    table += np.bincount(x[hit] * n_heads + y[hit] - ENDINGS, minlength=len(table))
            # the first column: occurrences
            table[::n_heads] += np.bincount(flat[real], minlength=n)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at // n_heads), pa.array(at % n_heads), pa.array(table[at])],
                                         names=["bucket", "head", "n"])
    return run


def _cluster(table: np.ndarray, heads: int, tails: int, rounds: int = 10) -> np.ndarray:
    """Class of every bucket: heads keep their own, endings are clustered by
    the heads around them (k-means over square roots of frequencies)."""
    occurs, around = table[:ENDINGS, 0].astype(float), table[:ENDINGS, 1:].astype(float)
    shares = np.sqrt((around + 0.02) / (around + 0.02).sum(axis=1, keepdims=True))
    seeds = [int(occurs.argmax())]
    gap = np.full(ENDINGS, np.inf)
    for _ in range(tails - 1):          # spread the first centres: far and frequent
        gap = np.minimum(gap, ((shares - shares[seeds[-1]]) ** 2).sum(axis=1))
        seeds.append(int((gap * occurs).argmax()))
    centres = shares[seeds]
    for _ in range(rounds):
        near = ((shares ** 2).sum(axis=1)[:, None] - 2 * shares @ centres.T + (centres ** 2).sum(axis=1)).argmin(axis=1)
        for k in range(tails):
            own = near == k
            if occurs[own].sum() > 0:
                centres[k] = (shares[own] * occurs[own, None]).sum(axis=0) / occurs[own].sum()
    return np.concatenate([heads + near, np.arange(heads)]).astype(np.int64)


def _sums(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of every group; group g is ``order[first[g]:first[g + 1]]``.
    Most groups are small: their k-th members are added for all groups at once."""
    many = np.diff(first, append=len(order))
    out = values[order[first]]
    live = np.flatnonzero(many > 1)
    for k in range(1, 8):
        if not len(live):
            return out
        out[live] += values[order[first[live] + k]]
        live = live[many[live] > k + 1]
    for g in live:
        out[g] += values[order[first[g] + 8:first[g] + many[g]]].sum(axis=0)
    return out


def _train(m, weights: np.ndarray, bias: np.ndarray, speed: np.ndarray, seen: np.ndarray, flat: np.ndarray,
           real: np.ndarray, rate: float, batch: int) -> None:
    """Mini-batch steps, in place, over the histories of a run of text, each
    with the counts of the classes that follow it."""
    n = len(m.classes) + 1
    at = np.flatnonzero(real)
    classes = np.append(m.classes, m.size)
    found = np.sort((flat[at - 1] * n + flat[at - 2]) * m.size + classes[flat[at]])
    first = np.flatnonzero(np.diff(found, prepend=-1))
    many = np.diff(first, append=len(found))                    # of a history and a class
    history, goal = np.divmod(found[first], m.size)
    start = np.flatnonzero(np.diff(history, prepend=-1))        # of a history
    rank = np.random.default_rng(len(found)).permutation(len(start))
    place = np.repeat(rank, np.diff(start, append=len(history)))
    order = np.argsort(place, kind="stable")
    place, goal, many = place[order], goal[order], many[order]
    whole = np.empty(len(start), np.int64)
    whole[rank] = history[start]
    b1, b2 = np.divmod(whole, n)
    rows = _feature_rows(b1, b2, classes[b1], classes[b2], m.size, len(weights))
    total = np.bincount(place, weights=many, minlength=len(whole)).astype(np.float32)
    for f in rows:
        seen[:-1] += np.bincount(f, weights=total, minlength=len(weights))
    seen[-1] += len(found)
    cuts = np.searchsorted(place, np.arange(0, len(whole) + batch, batch))
    for i, lo, hi in zip(range(0, len(whole), batch), cuts, cuts[1:]):
        r, each = rows[:, i:i + batch], total[i:i + batch]
        slope = _scores(weights, bias, r)
        np.exp(slope, out=slope)
        slope *= (each / slope.sum(axis=1))[:, None]
        slope[place[lo:hi] - i, goal[lo:hi]] -= many[lo:hi]
        bias -= rate * slope.sum(axis=0) / each.sum()
        for f in r:                     # sum the slopes of equal rows, one step per row
            order = np.argsort(f.astype(np.uint16) if len(weights) <= 1 << 16 else f, kind="stable")
            first = np.flatnonzero(np.diff(f[order], prepend=-1))
            where, step = f[order][first], _sums(slope, order, first)
            speed[where] += (step ** 2).mean(axis=1)
            weights[where] -= rate * step / np.sqrt(speed[where])[:, None] / 4


def _train_shard(model, rate: float, batch: int = 2048):
    """Mini-batch steps over one shard, a partition; yields by piece its weights
    and how often it met each of their rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = SimpleNamespace(**model.value)
        weights, bias = m.weights.copy(), m.bias.copy()
        speed, seen = np.full(len(weights), 1e-3, np.float32), np.zeros(len(weights) + 1)
        for flat, real in _runs(batches, len(m.classes)):
            _train(m, weights, bias, speed, seen, flat, real, rate, batch)
        if seen[-1]:
            whole = np.vstack([weights, bias[None]]).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PIECES), pa.int64()), pa.array([TaskContext.get().partitionId()] * PIECES, pa.int64()),
                 pa.array([p.tobytes() for p in np.array_split(seen, PIECES)], pa.binary()),
                 pa.array([p.tobytes() for p in np.array_split(whole, PIECES)], pa.binary())],
                names=["piece", "part", "n", "weights"])
    return run


def _mean(table: pa.Table) -> pa.Table:
    """Mean of every row, weighted by how often the shards met it: a row that
    few shards met is not drawn to where the round began."""
    seen, total = 0.0, 0.0
    table = table.sort_by("part")
    for n, w in zip(table.column("n").to_pylist(), table.column("weights").to_pylist()):
        n = np.frombuffer(n, "<f8")
        share = np.maximum(n, 1e-9)     # not met by any: all are where the round began
        seen, total = seen + share, total + np.frombuffer(w, "<f4").reshape(len(n), -1) * share[:, None]
    return pa.table({"piece": table.column("piece").slice(0, 1), "part": table.column("part").slice(0, 1),
                     "n": pa.array([seen.tobytes()], pa.binary()),
                     "weights": pa.array([(total / seen[:, None]).astype("<f4").tobytes()], pa.binary())})


def _averaged(parts: DataFrame, many: int) -> DataFrame:
    """One row a piece, by a tree over the numbers of at most ``many`` shards."""
    while many > FAN_IN:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("piece", "part").applyInArrow(_mean, PART)
        many = -(-many // FAN_IN)
    return parts.groupBy("piece").applyInArrow(_mean, PART)


def fit_classes(docs: DataFrame, heads: list[bytes], tails: int = TAILS, rounds: int = ROUNDS,
                n_rows: int = WEIGHT_ROWS, rate: float = RATE) -> Model:
    """The class factor from all of ``docs(doc_id, text)``."""
    numbered = {w: ENDINGS + i for i, w in enumerate(heads)}
    return _fit(docs.select("text").mapInArrow(_sequences(numbered), "buckets binary"), heads, tails, rounds, n_rows, rate)


def _fit(sequences: DataFrame, heads: list[bytes], tails: int = TAILS, rounds: int = ROUNDS,
         n_rows: int = WEIGHT_ROWS, rate: float = RATE) -> Model:
    """The class factor from all of ``sequences(buckets)``, which are read once
    for the classes and once a round."""
    spark = sequences.sparkSession
    counted = (sequences.mapInArrow(_profiles(len(heads)), "bucket bigint, head bigint, n bigint")
               .groupBy("bucket", "head").agg(F.sum("n").alias("n")).toArrow())
    table = np.zeros((ENDINGS + len(heads), len(heads)), np.int64)
    table[counted["bucket"].to_numpy(), counted["head"].to_numpy()] = counted["n"].to_numpy()
    classes = _cluster(table, len(heads), tails)
    size = len(heads) + tails
    share = np.bincount(classes, weights=table[:, 0], minlength=size) + 1.0
    model = Model(heads, classes, np.log(share / share.sum()).astype(np.float32),
                  np.zeros((n_rows, size), np.float32), np.zeros(size), 0, 0)
    shards = max(SHARDS, -(-int(table[:, 0].sum()) // SHARD_TOKENS))
    sharded = sequences.coalesce(shards)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(model.plain())
        pieces = _averaged(sharded.mapInArrow(_train_shard(now, rate), PART), shards).toArrow()
        found = dict(zip(pieces["piece"].to_pylist(), pieces["weights"].to_pylist()))
        if found:
            whole = np.frombuffer(b"".join(found[k] for k in range(PIECES)), "<f4").reshape(n_rows + 1, size)
            model.weights, model.bias = whole[:-1].copy(), whole[-1].copy()
        now.unpersist()
    return model


def _bucketed(total: int, distinct: int):
    """Documents of a block as buckets, given its dictionary, with what of their
    scores does not depend on the classes."""
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        docs = docs.sort_by("doc_id")
        order = np.argsort(words.column("place").to_numpy())
        count = words.column("c").to_numpy()[order].astype(np.float64)
        bucket = words.column("bucket").to_numpy()[order]
        # per dictionary entry: log10 of the base and of the word factor's count
        base = np.log10(count + 1) - np.log10(total + distinct + 1)
        word = np.where(bucket >= ENDINGS, 0.0, np.log10(count + 1))
        known = (count > 0).astype(np.int64)
        sequences = [np.frombuffer(b, "<u4") for b in docs.column("words").to_pylist()]
        starts = np.cumsum([0, *(len(s) for s in sequences[:-1])])
        flat = np.concatenate(sequences)
        summed = lambda x: np.add.reduceat(x[flat], starts)       # noqa: E731  no sequence is empty
        bucket = bucket.astype("<u2")
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
            "n_tokens": pa.array([len(s) for s in sequences], pa.int64()), "n_known": pa.array(summed(known)),
            "base_score": pa.array(summed(base)), "word_score": pa.array(summed(word)),
            "buckets": pa.array([bucket[s].tobytes() for s in sequences], pa.binary())})
    return run


def _score(model):
    """Scores of documents given as buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = SimpleNamespace(**model.value)
        mass = np.append(np.where(np.arange(m.size) < len(m.heads), 0.0, np.log10(m.mass + 1)), 0.0)
        classes = np.append(m.classes, m.size)
        for batch in (b.slice(k, 2000) for b in batches for k in range(0, b.num_rows, 2000)):
            sequences = [np.frombuffer(b, "<u2").astype(np.int64) for b in batch.column("buckets").to_pylist()]
            buckets, real = _padded(sequences, len(m.classes))
            logs = class_logs(m, buckets, real) / np.log(10) - mass[classes[buckets]]
            starts = np.cumsum([0, *(len(s) for s in sequences[:-1])])
            score = np.add.reduceat(logs[real], starts)     # no sequence is empty
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")),
                 pa.array(score + batch.column("word_score").to_numpy())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2,
                sample: int | None = None, heads: int = HEADS, tails: int = TAILS,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (log10 probability of the text) of every row.  The class factor is fitted on
    all training documents, or on about ``sample`` of them."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       (crc_mod(F.col(id_col), folds) == fold).alias("held_out"))
    tokens = stage(docs.mapInArrow(_blocks(block_bytes), TOKENS), "lm-tokens")
    entries = tokens.where("token IS NOT NULL").select("block", "place", "token", "n")
    counts = stage(entries.groupBy("token").agg(F.sum("n").alias("c")), "lm-counts")

    frequent = [bytes(r["token"]) for r in counts.where((F.length("token") > 0) & (F.col("c") > 0))
                .orderBy(F.col("c").desc(), "token").limit(heads - 1).collect()]
    head_words = [END, *frequent]
    own = F.create_map(*[x for i, w in enumerate(head_words) for x in (F.lit(bytearray(w)), F.lit(ENDINGS + i))])
    bucket = F.coalesce(F.try_element_at(own, F.col("token")), ending_of(F.col("token")))
    counts = counts.withColumn("bucket", bucket)
    known = (counts.where("c > 0").groupBy("bucket")
             .agg(F.sum(F.col("c") + 1).alias("mass"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect())
    total, distinct = sum(r["c"] for r in known), sum(r["v"] for r in known)

    words = (entries.select("block", "place", "token").join(counts, "token")
             .select("block", "place", "c", "bucket"))
    texts = tokens.where("words IS NOT NULL").select(F.col("block").alias("own"), "doc_id", "held_out", "words")
    texts = stage(texts.groupBy("own").cogroup(words.groupBy("block")).applyInArrow(_bucketed(total, distinct), BUCKETS),
                  "lm-buckets")

    trained = texts.where(~F.col("held_out"))
    if sample is not None:
        share = min(1.0, sample / max(1, trained.count()))
        trained = trained.where(F.pmod(F.xxhash64(F.lit("lm"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    model = _fit(trained.select("buckets"), head_words, tails)
    for r in known:
        model.mass[model.classes[r["bucket"]]] += r["mass"]
    model.total, model.distinct = total, distinct
    now = spark.sparkContext.broadcast(model.plain())
    return texts.mapInArrow(_score(now), SCORES).withColumn("train_tokens", F.lit(int(total)).cast("long"))
