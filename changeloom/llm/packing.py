"""Packing documents into fixed token windows: concatenate and cut.

First pass: every partition tokenises its documents once and writes the ids
with their offset in the partition.  The partitions' token totals (one row per
partition) are prefix-summed into global offsets.  Second pass: every document
is cut at the multiples of the window length; a document that crosses window
borders gives one boundary record per window it touches, so no two partitions
need to meet.  Only the last window can be partly filled.

The order of documents is that of the written first pass, which does not
change when tasks are repeated.

Defined results: a null text is empty, an empty document is its end token
alone; repeated rows are packed as often as they occur; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeloom.session import stage

TOKENS = "doc_id bigint, run bigint, run_offset bigint, n_tokens bigint, ids binary"
PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, ids binary")
# Fixed value: the pattern by which byte-level vocabularies split a text.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 600_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokenizer:
    """Ids of a byte-level tokenizer file as little-endian uint32 bytes.

    A byte-level vocabulary splits a text before it merges bytes, and always
    before a blank or line feed that follows a visible character.  So the
    stretches between those are encoded each by itself, and frequent ones are
    looked up.  The look-up table is emptied when it holds ``CACHE`` entries,
    which bounds its memory and changes no id.  A text with white space next to
    white space, and any text of another kind of tokenizer, is encoded whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.merge = self._merger(json.loads(definition))
        self.known: dict[str, bytes | None] = {}
        self.first: dict[str, bytes | None] = {}            # stretches that begin a line
        self.line = self._whole("\n")

    @staticmethod
    def _merger(definition: dict):
        """Encoder of single stretches, if the file is a plain byte-level
        vocabulary whose ids rise in merge order."""
        model, split = definition["model"], definition.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or ()]
        vocabulary = model.get("vocab") or {}
        if (model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or not split.get("use_regex", True) or definition.get("normalizer") or model.get("dropout")):
            return None
        ids = [vocabulary[a + b] for a, b in merges]
        special = {t["content"] for t in definition.get("added_tokens") or ()}
        if not merges or ids != sorted(ids):
            return None
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        return tiktoken.Encoding("packing", pat_str=PRE_TOKEN, mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _new(self, stretch: str, begins: bool) -> bytes | None:
        """Ids of a stretch (after a blank, unless it begins a line); None if it
        is empty or white space is at its border."""
        if not stretch or stretch[-1].isspace() or (begins and stretch[0].isspace()):
            ids = None
        else:
            ids = array("I", self.merge(stretch if begins else " " + stretch)).tobytes()
        (self.first if begins else self.known)[stretch] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.merge is None or not text:
            return self._whole(text)
        if len(self.known) + len(self.first) > CACHE:
            self.known.clear()
            self.first.clear()
        known, first, new, out = self.known, self.first, self._new, []
        try:
            for line in text.split("\n"):
                head, *rest = line.split(" ")
                out.append(first[head] if head in first else new(head, True))
                out += [known[w] if w in known else new(w, False) for w in rest]
                out.append(self.line)
            out.pop()
            return b"".join(out)
        except TypeError:               # a None: white space meets white space
            return self._whole(text)


def _tokenise(definition, end_id: int, step: int = 1 << 20):
    """``definition`` is a broadcast of the tokenizer's JSON."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteTokenizer(definition.value)
        me, offset, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                # a chunk: texts of about ``step`` characters in all
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to] or "") <= step):
                    chars += len(texts[to] or "")
                    to += 1
                packed = [tokenizer.encode(t or "") + end for t in texts[at:to]]
                counts = np.array([len(x) // 4 for x in packed], np.int64)
                starts = offset + np.concatenate([[0], np.cumsum(counts)[:-1]])
                offset += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids_of[at:to], pa.int64()), pa.array([me] * (to - at), pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(counts), pa.array(packed, pa.binary())],
                    names=["doc_id", "run", "run_offset", "n_tokens", "ids"])
                at = to
    return run


def _cut(window: int, step: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        for batch in batches:
            rows, held = [], 0
            for doc, at, n, ids in zip(*(batch.column(c) for c in ("doc_id", "at", "n_tokens", "ids"))):
                doc, at, n, ids = doc.as_py(), at.as_py(), n.as_py(), ids.as_py()
                start = 0
                while start < n:
                    offset = (at + start) % window
                    length = min(window - offset, n - start)
                    rows.append((doc, start, length, n, (at + start) // window, offset,
                                 ids[4 * start:4 * (start + length)]))
                    start, held = start + length, held + length
                if held > step:
                    yield _pieces(rows, names)
                    rows, held = [], 0
            if rows:
                yield _pieces(rows, names)
    return run


def _pieces(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
         end_id: int = 1, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset and ids
    (little-endian uint32).  ``start`` counts the document's ids before the
    piece, ``offset`` the ids before it in its sequence."""
    spark = docs.sparkSession
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    tokens = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                   .mapInArrow(_tokenise(definition, end_id), TOKENS), "tokens")
    # One row per partition of the first pass: a bounded prefix sum, and small
    # enough to send to every task (16 bytes a partition).
    totals = tokens.groupBy("run").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("run", (F.sum("total").over(Window.partitionBy(F.lit(0)).orderBy("run"))
                                  - F.col("total")).alias("base"))
    return (tokens.join(F.broadcast(bases), "run")
            .select("doc_id", (F.col("base") + F.col("run_offset")).alias("at"), "n_tokens", "ids")
            .mapInArrow(_cut(window), PIECES))


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """The packed sequences: sequence_id, length (without padding) and ids.

    A sequence shorter than the window is padded with ``pad_id``, unless its
    length is a power of two.  A group holds at most one window of ids.
    """
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filler = np.array([pad_id], "<u4").tobytes()
        for b in batches:
            out = []
            for parts in b.column("parts").to_pylist():
                ids = b"".join(p["ids"] for p in parts)
                n = len(ids) // 4
                out.append(ids if n & (n - 1) == 0 else ids + filler * (window - n))
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), b.column("length"), pa.array(out, pa.binary())],
                                             names=["sequence_id", "length", "ids"])

    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
            .mapInArrow(assemble, "sequence_id bigint, length bigint, ids binary"))
