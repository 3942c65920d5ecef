"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in the partitions of a bounded sample of
labelled documents and sums them in Spark; the log-probability matrix (buckets
x languages, its size fixed by the parameters) is broadcast.  Scoring turns a
batch of whole texts into code points, hashes all n-grams with numpy, and adds
up the matrix rows per document.

Only letters count: everything else becomes one blank, letters are lower-cased,
and n-grams of blanks are left out.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with no labelled training text every document is ``und``; a null id counts as
empty text for the fold; repeated rows are scored alike; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import crc_mod

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SAMPLE = 1500           # expected training documents per language
LANGUAGES = 512         # most languages a model may have: bounds the broadcast
CHUNK = 1 << 19         # code points scored at a time


def _letters() -> np.ndarray:
    """For every code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """Hashed n-grams of texts as one array, with the documents they are from."""

    def __init__(self, orders=ORDERS, buckets: int = BUCKETS):
        self.orders, self.mask, self.letter = orders, np.uint32(buckets - 1), _letters()

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of all texts (each between blanks) and where each starts."""
        joined = " " + " ".join(texts) + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return np.where(self.letter[codes], codes, np.uint32(32)), np.cumsum(lengths) - lengths

    def hashes(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        """For every order, the bucket of the n-gram at each position, and
        buckets + 1 standing for n-grams without a letter."""
        blank = codes == 32
        for n in self.orders:
            h = codes * np.uint32(0x9E3779B1)
            empty = blank.copy()
            for k in range(1, n):
                h[:-k] = (h[:-k] ^ codes[k:]) * np.uint32(0x85EBCA6B) + np.uint32(n)
                empty[:-k] &= blank[k:]
            h ^= h >> np.uint32(15)
            h &= self.mask
            h[empty] = self.mask + np.uint32(1)
            h[len(h) - n + 1:] = self.mask + np.uint32(1)
            yield h


def _lowered(column: pa.Array) -> list[str]:
    return [t or "" for t in pc.utf8_lower(column.cast(pa.string())).to_pylist()]


def _chunks(texts: list[str], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` characters in all."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def _count(buckets: int):
    """N-gram counts per language of a partition, summed before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = Grams(buckets=buckets), {}
        for batch in batches:
            texts, langs = _lowered(batch.column("text")), batch.column("lang").to_pylist()
            for text, lang in zip(texts, langs):
                own = counts.setdefault(lang, np.zeros(buckets + 1, np.int64))
                for h in grams.hashes(grams.codes([text])[0]):
                    own += np.bincount(h, minlength=buckets + 1)
        for lang, own in counts.items():
            at = np.flatnonzero(own[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(own[at], pa.int64())],
                names=["lang", "bucket", "n"])
    return run


def train(docs: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities (buckets + 1 rows) from ``docs(doc_id,
    text, lang)``: about ``sample`` documents of every language, chosen by id
    hash.  What reaches the driver is bounded by buckets x languages."""
    labelled = docs.where(F.col("lang").isNotNull())
    per = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
           .limit(LANGUAGES + 1).collect()}
    if len(per) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: the model has one column each")
    if not per:
        return [], np.zeros((buckets + 1, 0), np.float32)
    langs = sorted(per)
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / per[lang]))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("langid"), F.col("doc_id")), F.lit(1 << 20)) < share * F.lit(1 << 20)
    counted = (labelled.where(drawn).select("text", "lang")
               .mapInArrow(_count(buckets), "lang string, bucket bigint, n bigint")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    matrix = np.zeros((buckets + 1, len(langs)))
    column = pc.index_in(counted["lang"].combine_chunks().cast(pa.string()), pa.array(langs)).to_numpy()
    matrix[counted["bucket"].to_numpy(), column] = counted["n"].to_numpy()
    smooth = 0.1
    logp = np.log(matrix + smooth) - np.log(matrix[:-1].sum(axis=0) + smooth * buckets)
    logp[-1] = 0.0                      # n-grams without a letter say nothing
    return langs, logp.astype(np.float32)


class Scorer:
    """Languages and scores of lower-cased texts; ``model`` is (languages, log
    probabilities)."""

    def __init__(self, model: tuple, buckets: int = BUCKETS):
        self.langs, self.logp = model
        self.grams = Grams(buckets=buckets)

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        names, scores = [], [np.zeros(0)]
        for a, b in _chunks(texts):
            codes, starts = self.grams.codes(texts[a:b])
            total = np.zeros((b - a, max(1, len(self.langs))))
            letters = np.add.reduceat(codes != 32, starts, dtype=np.int64)
            if self.langs:
                for h in self.grams.hashes(codes):
                    for k in range(len(self.langs)):
                        total[:, k] += np.add.reduceat(self.logp[:, k][h], starts, dtype=np.float64)
            best = total.argmax(axis=1)
            top = total[np.arange(b - a), best]
            sure = (letters > 0) & bool(self.langs)
            names += [self.langs[i] if s else UNKNOWN for i, s in zip(best, sure)]
            scores.append(np.where(sure, 1.0 / np.exp(total - top[:, None]).sum(axis=1), 0.0))
        return names, np.concatenate(scores)


def _score(model, buckets: int):
    """``model`` is a broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value, buckets)
        for batch in batches:
            names, scores = scorer(_lowered(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def _accept(model, buckets: int, place: int):
    """Pass the rows on whose text (column number ``place``) is in a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value, buckets)
        for batch in batches:
            names, _ = scorer(_lowered(batch.column(place)))
            yield batch.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))
    return run


def _fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, fold: int,
            sample: int, buckets: int):
    """The rows to score and a broadcast of the model of the training folds."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"),
                       (crc_mod(F.col(id_col), folds) == fold).alias("held_out"))
    langs, logp = train(docs.where(~F.col("held_out")), sample, buckets)
    return docs, docs.sparkSession.sparkContext.broadcast((langs, np.asfortranarray(logp)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 3, fold: int = 1, sample: int = SAMPLE, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, held_out, lang_pred and score (posterior of the prediction) of
    every row; documents of the held-out fold take no part in the training."""
    docs, model = _fitted(docs, id_col, text_col, lang_col, folds, fold, sample, buckets)
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _score(model, buckets), "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    folds: int = 3, fold: int = 1, sample: int = SAMPLE, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose prediction names a
    language.  No shuffle."""
    _, model = _fitted(docs, id_col, text_col, lang_col, folds, fold, sample, buckets)
    return docs.mapInArrow(_accept(model, buckets, docs.columns.index(text_col)), docs.schema)
