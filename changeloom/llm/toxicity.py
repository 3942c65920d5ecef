"""Toxicity: a support vector machine over a gap-weighted subsequence kernel.

Two strings are similar by the subsequences of four symbols they share, within
``SPAN`` positions, each worth ``DECAY`` per position skipped.  So an insult is
met with characters put in, and its letters count although they are spaced out
or have signs between them, which the symbols leave out.

Landmarks are words of the labelled sentences, most of them those that label 1
favours; a sentence is the vector of its kernel values with them, whitened by
the landmarks' own kernel matrix (Nystroem).  A label belongs to a document, and
most sentences of a toxic one are clean, so the machine is trained in rounds: the
sentences of a toxic document that score highest are its positive examples, and
those of a clean one that score highest, and some others, the negative ones.
Sentences are scored in overlapping windows of ``WINDOW`` symbols.  A document's
``TOP`` highest windows that do not overlap, and the logarithm of their number,
become a probability by a logistic fit on labelled documents that took no part
in the training.

The trained function is linear in the subsequences of the landmarks.  It is
broadcast as one table over all quadruples of symbols (4 MB at any size of the
corpus), and a text costs twenty look-ups a position, in numpy over a batch.

Fitting uses at most about ``sample`` documents of either label, drawn by id
hash; all documents are scored, in full.

Defined results: a null or empty text, or one without a letter, has no window
and scores as a text that resembles no landmark; a document with several labels
is toxic if one of them says so, null labels do not count; without documents of
both labels every score is 0; a null id counts as empty text for the fold;
repeated rows are scored alike; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import crc_mod
from changeloom.session import stage

ORDER, SPAN, DECAY = 4, 7, 0.6
WINDOW, STRIDE = 24, 8
SAMPLE = 3_000              # most documents of a label to fit on, about
LANDMARKS, COMMON = 384, 128  # words that label 1 favours, frequent words
ROUNDS, COST = 4, 600.0     # COST: of all training windows together
TOP = 3                     # windows of a document that count, and that a round takes of each kind
BLANK, DROP = 0, 255
CHUNK, SLICE = 1 << 20, 1 << 16
TABLE = 32 ** ORDER

# Offsets of the other three symbols of a quadruple, by the positions skipped.
PATTERNS = [[p for p in combinations(range(1, SPAN), ORDER - 1) if p[-1] == ORDER - 1 + gap]
            for gap in range(SPAN - ORDER + 1)]


def _symbols() -> np.ndarray:
    """Symbol of every code point: letters to 1-30 (accents off, scripts other
    than Latin share four symbols), white space blank, the rest left out."""
    table = np.full(0x110000, DROP, np.uint8)
    for c in range(0x3000):
        t = chr(c)
        if t.isspace():
            table[c] = BLANK
        elif t.isalpha():
            base = unicodedata.normalize("NFKD", t.lower())[:1]
            table[c] = ord(base) - 96 if "a" <= base <= "z" else 27 + c % 4
    high = np.arange(0x3040, 0xD800)
    table[high] = 27 + high % 4
    table[0x3000] = BLANK
    return table


class Reader:
    """Texts as symbols, cut into windows."""

    def __init__(self):
        self.table = _symbols()

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Symbols of all texts (``SPAN`` blanks behind), and for every window its
        start, its end, its text's number and whether it begins a sentence."""
        codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        starts = 1 + np.cumsum(lengths) - lengths
        raw = self.table[codes]
        stop = (codes == 46) | (codes == 33) | (codes == 63)
        ends = codes == 10
        ends[:-1] |= stop[:-1] & (raw[1:] == BLANK)
        sentence = np.cumsum(ends)
        at = np.flatnonzero(raw != DROP)
        s = raw[at]
        # One blank for several, none between single letters.
        at = at[~((s == BLANK) & np.r_[False, s[:-1] == BLANK])]
        s = raw[at]
        blank = s == BLANK
        spaced = np.zeros(len(s), bool)
        if len(s) > 4:
            spaced[2:-2] = blank[2:-2] & blank[:-4] & blank[4:] & ~blank[1:-3] & ~blank[3:-1]
        at, s = at[~spaced], s[~spaced]
        same = sentence[at]
        first = np.flatnonzero(np.r_[True, same[1:] != same[:-1]]) if len(s) else np.zeros(0, np.int64)
        size = np.diff(np.r_[first, len(s)])
        letters = np.add.reduceat(s != BLANK, first, dtype=np.int64) if len(first) else size
        first, size = first[letters > 0], size[letters > 0]
        n = np.maximum(1, -(-(size - WINDOW) // STRIDE) + 1)
        begin = np.repeat(first, n) + STRIDE * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        end = np.minimum(begin + WINDOW, np.repeat(first + size, n))
        # A text's first sentence begins with the line feed in front of it.
        text = np.searchsorted(starts, at[begin] + 1, "right") - 1
        return np.r_[s, np.zeros(SPAN, np.uint8)], begin, end, text, np.isin(begin, first)


def quadruples(symbols: np.ndarray, n: int) -> Iterator[tuple[float, np.ndarray]]:
    """For each pattern, its worth and the quadruple that begins at each of the
    first ``n`` positions."""
    x = symbols.astype(np.int32)
    a, b, c = x << 15, x << 10, x << 5
    for gap, patterns in enumerate(PATTERNS):
        for i, j, k in patterns:
            yield DECAY ** gap, a[:n] | b[i:i + n] | c[j:j + n] | x[k:k + n]


def window_values(symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of the subsequences that begin in each window."""
    n = len(symbols) - SPAN
    each = np.zeros(n + 1)
    for a in range(0, n, SLICE):
        size = min(SLICE, n - a)
        for worth, at in quadruples(symbols[a:a + size + SPAN], size):
            each[a + 1:a + 1 + size] += worth * weights[at]
    np.cumsum(each, out=each)
    return each[end] - each[begin]


def peaks(value: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Windows that are as high as the one before and higher than the one
    behind in their sentence; no two of them overlap."""
    before = np.r_[-np.inf, value[:-1]]
    before[new] = -np.inf
    behind = np.r_[value[1:], -np.inf]
    behind[:-1][new[1:]] = -np.inf
    return np.flatnonzero((value >= before) & (value > behind))


class Kernel:
    """The landmarks: their subsequences, and the map that whitens kernel values."""

    def __init__(self, words: list[bytes]):
        rows, cols, vals = [], [], []
        for j, word in enumerate(words):
            s = np.frombuffer(bytes([BLANK]) + word + bytes(SPAN + 1), np.uint8)
            n = len(word) + 1
            at, worth = zip(*[(q, np.full(n, w)) for w, q in quadruples(s, n)])
            found, where = np.unique(np.concatenate(at), return_inverse=True)
            value = np.bincount(where, np.concatenate(worth))
            rows.append(found)
            cols.append(np.full(len(found), j))
            vals.append(value / np.sqrt((value * value).sum()))
        self.features, where = np.unique(np.concatenate(rows), return_inverse=True)
        self.table = np.zeros((len(self.features), len(words)))
        self.table[where, np.concatenate(cols)] = np.concatenate(vals)
        values, vectors = np.linalg.eigh(self.table.T @ self.table)
        good = values > 1e-6 * values[-1]
        self.whiten = vectors[:, good] / np.sqrt(values[good])

    def weights(self, alpha: np.ndarray) -> np.ndarray:
        """The function sum of alpha_j k(., landmark j), as a table over quadruples."""
        out = np.zeros(TABLE, np.float32)
        out[self.features] = self.table @ alpha
        return out

    def vectors(self, windows: np.ndarray) -> np.ndarray:
        """Whitened kernel values of windows (rows of WINDOW + SPAN symbols; what
        lies behind a window's end is DROP)."""
        row = np.full(TABLE, -1, np.int32)
        row[self.features] = np.arange(len(self.features))
        out = np.zeros((len(windows), self.table.shape[1]))
        for a in range(0, len(windows), 500):
            part = windows[a:a + 500]
            inside = part[:, :WINDOW] != DROP
            x = np.where(part == DROP, BLANK, part)
            flat = np.zeros((len(part), len(self.features)), np.float32)
            lines = np.repeat(np.arange(len(part)), WINDOW).reshape(len(part), WINDOW)
            for worth, q in quadruples_rows(x):
                hit = row[q]
                ok = inside & (hit >= 0)
                np.add.at(flat, (lines[ok], hit[ok]), np.float32(worth))
            out[a:a + 500] = flat @ self.table
        return out @ self.whiten


def quadruples_rows(x: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """``quadruples`` of the first WINDOW positions of every row."""
    x = x.astype(np.int32)
    for gap, patterns in enumerate(PATTERNS):
        for i, j, k in patterns:
            yield DECAY ** gap, (x[:, :WINDOW] << 15 | x[:, i:i + WINDOW] << 10
                                 | x[:, j:j + WINDOW] << 5 | x[:, k:k + WINDOW])


def fit_svm(z: np.ndarray, y: np.ndarray, cost: float = COST) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss and balanced
    classes, by Newton steps; ``y`` is +1 or -1."""
    x = np.c_[z, np.ones(len(z))]
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        inside = y * (x @ w) < 1
        c = cost * share * inside
        new = np.linalg.solve(ridge + (x * c[:, None]).T @ x, x.T @ (c * y))
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of the probability of label 1, with a ridge; targets
    are drawn in by the counts, as a separable sample asks for."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    weight = weight / weight.mean()
    ridge = np.diag([0.3] * x.shape[1] + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        c = weight * p * (1 - p) + 1e-9
        step = np.linalg.solve((z * c[:, None]).T @ z + ridge, z.T @ (weight * (t - p)) - ridge @ w)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1] / spread, float(w[-1] - (w[:-1] * mean / spread).sum())


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > CHUNK:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, label, documents) of a partition's labelled texts (text, label)."""
    reader, counts = Reader(), {}
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = reader([text or ""])[0]
            for word in {w for w in s.tobytes().split(bytes([BLANK])) if 3 <= len(w) <= 24}:
                counts[word, label] = counts.get((word, label), 0) + 1
    words, labels = zip(*counts) if counts else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(labels, pa.int32()),
                                      pa.array(counts.values(), pa.int64())], names=["word", "label", "n"])


def _cut(symbols: np.ndarray, begin: int, end: int) -> bytes:
    """A window for ``Kernel.vectors``: what begins behind its end is left out."""
    out = np.full(WINDOW + SPAN, DROP, np.uint8)
    out[:end - begin] = symbols[begin:end]
    out[WINDOW:] = symbols[end:end + SPAN] if end - begin == WINDOW else DROP
    return out.tobytes()


def _picked(weights):
    """The windows of a labelled document (serial, text, label) that score
    highest; of a clean one also some at places drawn from its number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, out = Reader(), []
        for batch in batches:
            for serial, text, label in zip(*(batch.column(i).to_pylist() for i in range(3))):
                symbols, begin, end, _, new = reader([text or ""])
                if not len(begin):
                    continue
                value = window_values(symbols, begin, end, weights.value)
                best = peaks(value, new)
                best = list(best[np.argsort(-value[best], kind="stable")[:TOP]])
                if not label:
                    best += list(np.random.default_rng(serial).integers(len(begin), size=TOP))
                out += [(label, _cut(symbols, begin[i], end[i])) for i in best]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()),
                                          pa.array([o[1] for o in out], pa.binary())], names=["label", "window"])
    return run


def highest(reader: Reader, texts: list[str], weights: np.ndarray) -> np.ndarray:
    """For every text its ``TOP`` highest windows (0 for those it lacks) and
    the logarithm of one plus their number."""
    out = np.zeros((len(texts), TOP + 1))
    for a, b in _batches(texts):
        symbols, begin, end, text, new = reader(texts[a:b])
        if not len(begin):
            continue
        value = window_values(symbols, begin, end, weights)
        at = peaks(value, new)
        at = at[np.lexsort((-value[at], text[at]))]
        own = text[at]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        top = place < TOP
        out[a + own[top], place[top]] = value[at[top]]
        out[a:b, TOP] = np.log1p(np.bincount(text, minlength=b - a))
    return out


def _valued(weights, text_at: int, names: list[str]):
    """Pass all columns but the text, and the features of ``highest``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            value = highest(reader, [t or "" for t in batch.column(text_at).to_pylist()], weights.value)
            rest = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            lists = pa.ListArray.from_arrays(np.arange(0, value.size + 1, TOP + 1, dtype=np.int32), value.ravel())
            yield pa.RecordBatch.from_arrays([*rest, lists], names=[*names, "value"])
    return run


class Model:
    """Table of weights, slopes and offset of the probability, and the least and
    largest logarithm of a number of windows it was fitted on."""

    def __init__(self, weights: np.ndarray, slopes: np.ndarray, offset: float, ends: tuple[float, float]):
        self.weights, self.slopes, self.offset, self.ends = weights, slopes, offset, ends


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on ``docs(doc_id, text)`` with ``labels(doc_id, label)``, one row an id,
    0 or 1; None without both.  The labels are drawn first, so that few rows look
    for their texts."""
    spark = docs.sparkSession
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    share = {k: min(1.0, sample / n) for k, n in counts.items()}
    drawn = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 20))
    bound = F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0])) * F.lit(1 << 20)
    # About 2 x ``sample`` rows at most, whatever the number of labels.
    chosen = F.broadcast(labels.where(drawn < bound))
    rows = stage(docs.join(chosen, "doc_id").select(
        F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).alias("serial"), "text",
        F.col("label").cast("int").alias("label"), (F.pmod(F.xxhash64(F.lit("sigmoid"), "doc_id"), F.lit(4)) == 0)
        .alias("aside")), "toxicity-sample")
    learn, aside = rows.where("NOT aside"), rows.where("aside")

    # Landmarks: a word's share of toxic and of clean documents, as a z-score.
    n = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        learn, aside = rows, rows
        n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    words = learn.select("text", "label").mapInArrow(_words, "word binary, label int, n bigint")
    words = words.groupBy("word").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("c1"),
                                      F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("c0"))
    pooled = (F.col("c1") + F.col("c0") + 1) / (n[0] + n[1] + 2)
    z = (F.col("c1") / n[1] - F.col("c0") / n[0]) / F.sqrt(pooled * (1 - pooled) * (1 / n[1] + 1 / n[0]))
    ranked = stage(words.where("c1 + c0 > 1").withColumn("z", z), "toxicity-words")
    toxic = ranked.where("z > 0").orderBy(F.desc("z"), "word").limit(LANDMARKS).collect()
    common = ranked.orderBy(F.desc("c0"), "word").limit(COMMON).collect()
    landmarks = {bytes(r["word"]): max(0.0, r["z"]) for r in [*common, *toxic]}
    if not landmarks:
        return None
    kernel = Kernel(list(landmarks))

    alpha, bias = np.array(list(landmarks.values())), 0.0
    clean: set[bytes] = set()
    for _ in range(ROUNDS):
        weights = spark.sparkContext.broadcast(kernel.weights(alpha))
        picked = (learn.select("serial", "text", "label")
                  .mapInArrow(_picked(weights), "label int, window binary").collect())
        clean |= {bytes(r["window"]) for r in picked if not r["label"]}
        toxic_ones = sorted({bytes(r["window"]) for r in picked if r["label"]} - clean)
        windows = np.frombuffer(b"".join([*toxic_ones, *sorted(clean)]), np.uint8).reshape(-1, WINDOW + SPAN)
        weights.unpersist()
        if not toxic_ones or not clean:
            break
        v, bias = fit_svm(kernel.vectors(windows), np.r_[np.ones(len(toxic_ones)), -np.ones(len(clean))])
        alpha = kernel.whiten @ v
    weights = kernel.weights(alpha)
    shared = spark.sparkContext.broadcast(weights)
    got = (aside.select("text", "label").mapInArrow(_valued(shared, 0, ["label"]), "label int, value array<double>")
           .collect())
    x, y = np.array([r["value"] for r in got]), np.array([r["label"] for r in got])
    if len(set(y)) < 2:
        return Model(weights, np.r_[1.0, np.zeros(TOP)], bias, (0.0, 0.0))
    slopes, offset = fit_logistic(x, y, np.where(y > 0, 1 / share[1], 1 / share[0]))
    return Model(weights, slopes, offset, (float(x[:, TOP].min()), float(x[:, TOP].max())))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", folds: int = 5, fold: int = 0, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.  ``labels``
    (id, label) cover some of them; those of the held-out fold are not read."""
    held_out = crc_mod(F.col(id_col), folds) == fold
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out)
             .groupBy(F.col(id_col).alias("doc_id")).agg((F.max(label_col) > 0).cast("int").alias("label")))
    model = train(rows.where(~F.col("held_out")).select("doc_id", "text"), known, sample)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    valued = rows.mapInArrow(_valued(shared, 1, ["doc_id", "held_out"]),
                             f"doc_id {kinds['doc_id']}, held_out boolean, value array<double>")
    # Numbers of windows that the fit has not seen count as the nearest seen.
    features = [F.col("value")[k] for k in range(TOP)]
    features.append(F.least(F.greatest(F.col("value")[TOP], F.lit(model.ends[0])), F.lit(model.ends[1])))
    total = F.lit(model.offset)
    for slope, feature in zip(model.slopes, features):
        total = total + F.lit(float(slope)) * feature
    score = 1 / (1 + F.exp(-total))
    return (valued.withColumn("score", score)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
