"""Merkle manifest, toxicity and whitening on odd rows and against plain loops."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeloom.llm import merkle, toxicity, whitening
from helpers import documents, odd_documents, prose


# Merkle manifest

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    i, _, lang, source = row
    fields = [i, source, lang, None if row[1] is None else len(row[1]), text]
    return _h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def _climb(hashes):
    """Root of the hashes, and for each its siblings level by level."""
    ways, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for k, i in enumerate(at):
            run = i - i % 3
            ways[k].append(("".join(hashes[run:i]), "".join(hashes[i + 1:run + 3])))
        hashes = [_h(*hashes[r:r + 3]) for r in range(0, len(hashes), 3)]
        at = [i // 3 for i in at]
    return hashes[0], ways


def _fold(digest, way):
    for before, after in way:
        digest = _h(before, digest, after)
    return digest


def _brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, _leaf(r, r[1]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda g: g[:3])
    tops = [_climb([g[2] for g in groups[s]]) for s in order]
    root, up = _climb([t[0] for t in tops])
    out = []
    for s, (subroot, ways), above in zip(order, tops, up):
        for (_, _, leaf, r), way in zip(groups[s], ways):
            text = r[1]
            if text is not None and zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = _fold(_leaf(r, text), way + above)
            proof = _h(*[a + b for a, b in way + above])
            out.append((r[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def _manifest(spark, rows):
    docs = documents(spark, rows).withColumn("n_chars", F.char_length("text").cast("bigint"))
    got = merkle.manifest(docs, check=merkle.line_feeds_deleted())
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                        "verified").collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, levels):
    """Also when blocks are so small that a source takes several layers."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rows = odd_documents() + [(1000 + k, f"line {k}\nline", "en", "hot") for k in range(100)]
    assert _manifest(spark, rows) == _brute_manifest(rows)


def test_manifest_of_few_rows(spark):
    one = [(5, "a\nb", None, None)]
    assert _manifest(spark, one) == _brute_manifest(one)
    assert _manifest(spark, []) == []
    same = [(1, "x", "en", "s")] * 7
    assert _manifest(spark, same) == _brute_manifest(same)


def test_manifest_finds_any_change(spark):
    rows = [(k, f"text {k}", "en", "ab"[k % 2]) for k in range(20)]
    docs = documents(spark, rows).withColumn("n_chars", F.lit(6).cast("bigint"))
    changed = F.when(F.col("doc_id") == 7, merkle.leaf_digest([F.col(c) for c in ("doc_id", "lang", "source", "n_chars", "text")]))
    got = {r.doc_id: r.verified for r in merkle.manifest(docs, check=changed).collect()}
    assert [k for k, ok in got.items() if not ok] == [7]


# Toxicity

INSULTS = ["stupid", "idiot", "moron", "loser", "trash", "clown"]


def _labelled(n, seed):
    rng, rows, labels = random.Random(seed), [], []
    for k in range(n):
        words = prose(seed * 1000 + k, rng.randint(30, 120)).split(" ")
        toxic = k % 5 == 0
        for _ in range(2 * toxic):
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        rows.append((k, " ".join(words), "en", "a"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_kernel_table_equals_a_plain_sum():
    kernel = toxicity.Kernel([toxicity.Reader()([w])[0].tobytes().strip(b"\0") for w in INSULTS])
    alpha = np.arange(1.0, 7.0)
    weights = kernel.weights(alpha)

    def phi(s):
        out = {}
        for a in range(len(s)):
            for gap, patterns in enumerate(toxicity.PATTERNS):
                for i, j, k in patterns:
                    at = [a, a + i, a + j, a + k]
                    q = tuple(s[x] if x < len(s) else 0 for x in at)
                    out[q] = out.get(q, 0.0) + toxicity.DECAY ** gap
        return out

    def sym(t):
        return [ord(c) - 96 if c != " " else 0 for c in t]

    marks = []
    for w in INSULTS:
        f = phi([0, *sym(w)])
        norm = sum(v * v for v in f.values()) ** 0.5
        marks.append({q: v / norm for q, v in f.items()})
    text = "you are an idxiot my friend"
    got = toxicity.highest(toxicity.Reader(), [text], weights)[0][0]
    own = phi([0, *sym(text)])
    expect = sum(a * sum(v * m.get(q, 0.0) for q, v in own.items()) for a, m in zip(alpha, marks))
    assert abs(got - expect) < 1e-3 * abs(expect)
    assert len(toxicity.PATTERNS[0]) == 1 and sum(map(len, toxicity.PATTERNS)) == 20


def test_symbols_leave_signs_out():
    reader = toxicity.Reader()
    plain = reader(["an idiot here"])[0].tobytes()
    for text in ("an i.d.i.o.t here", "AN Ídiót here", "an i*d-i_o~t  here", "an i d i o t here"):
        assert reader([text])[0].tobytes() == plain, text
    assert len(reader(["", "12 34 !!"])[1]) == 0
    # sentences and windows cover every symbol
    symbols, begin, end, text, _ = reader(["One two. " + "abc " * 500 + "\nend", "x" * 33])
    hit = np.zeros(len(symbols), bool)
    for a, b in zip(begin, end):
        hit[a:b] = True
    assert hit[:-toxicity.SPAN][symbols[:-toxicity.SPAN] > 0].all() and set(text) == {0, 1}


def test_toxicity_held_out_and_disguised(spark):
    rows, labels = _labelled(1500, 1)
    # Two insults a document, as in the labelled ones, none of them in a plain form.
    disguised = [("st-upid", "an i d i o t"), ("m.o.r.o.n", "losxer"), ("a losxer", "trrash"), ("c*l*o*w*n", "idi0ot"),
                 ("STU_PID", "tra$h trash!"), ("m0oron", "clo wn")]
    planted = [(5000 + k, f"{prose(900 + k, 20)} {a} {prose(930 + k, 20)} {b} {prose(960 + k, 20)}", "en", "a")
               for k, (a, b) in enumerate(disguised)]
    labels_df = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(documents(spark, rows + planted + [(9000, None, None, None)]), labels_df).collect()}
    truth = {i: t for i, _, t in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i in got if got[i].held_out and i in truth] and all(got[i].held_out for i in held)
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    assert [got[5000 + k].predicted for k in range(6)] == [1] * 6
    assert got[9000].predicted == 0
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_toxicity_without_both_labels_and_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.toxicity(documents(spark), none).collect()
    assert len(got) == len(odd_documents()) and {r.score for r in got} == {0.0}
    few = spark.createDataFrame([(1, 1), (2, 0), (7, 0), (10, 0), (9, 1), (9, 0)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(documents(spark), few).collect()
    assert len(got) == len(odd_documents())
    assert toxicity.toxicity(documents(spark, []), few).collect() == []


# Whitening

def _vectors(spark, rows):
    schema = "vec_id bigint, embedding array<float>, k string, n string, block string, ids string, x string, id string"
    return spark.createDataFrame([(i, v, *["c"] * 6) for i, v in rows], schema)


def test_whitening_equals_plain_algebra(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(8, 8))
    good = [(k, [float(c) for c in np.float32(mix @ rng.normal(size=8) + 3)]) for k in range(500)]
    good += [(7, good[7][1]), (None, good[8][1])]
    bad = [(900, None), (901, [None] + [0.0] * 7), (902, [float("nan")] + [0.0] * 7), (903, [float("inf")] * 8), (904, []),
           (905, [1.0] * 7), (906, [1e30] * 8)]
    got = whitening.whiten(_vectors(spark, good + bad), components=5).collect()
    x = np.floor(64 * np.array([v for _, v in good])).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == 5 * n and {r.n for r in got} == {n}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    expect = (centred @ vectors[:, :5]) / np.sqrt(values[:5])
    for c in range(5):
        rows = sorted((r for r in got if r.component == c + 1), key=lambda r: (repr(r.vec_id), r.whitened))
        assert abs(rows[0].explained - values[c] / values.sum()) < 1e-12
        ids = [i for i, _ in good]
        plain = sorted(zip(map(repr, ids), expect[:, c], deviation))
        flipped = sorted(zip(map(repr, ids), -expect[:, c], deviation))
        near = [max(abs(r.whitened - w) for r, (_, w, _) in zip(rows, p)) for p in (plain, flipped)]
        assert min(near) < 1e-7
        assert sorted((repr(r.vec_id), int(r.deviation)) for r in rows) == sorted((i, int(d)) for i, _, d in plain)


def test_whitening_without_spread(spark):
    assert whitening.whiten(_vectors(spark, [])).collect() == []
    assert whitening.whiten(_vectors(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(_vectors(spark, [(k, [1.0, 2.0]) for k in range(5)])).collect() == []
    # one dimension constant: one component only
    got = whitening.whiten(_vectors(spark, [(k, [1.0, float(k)]) for k in range(5)])).collect()
    assert {r.component for r in got} == {1} and len(got) == 5


def test_whitening_of_wide_values_is_exact(spark):
    rows = [(k, [float(k * 10 ** 9), float(-k)]) for k in range(50)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(_vectors(spark, rows), components=1).collect()}
    x = [[int(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    assert got == {k: sum((50 * c - s) ** 2 for c, s in zip(v, sums)) for k, v in enumerate(x)}
