"""Document operators on odd rows, an empty table and clashing columns."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeloom.llm import exact, langid, lm, mixing, near, packing, quality
from helpers import brute_components, documents, edited, odd_documents, prose, shingles, words_of

OPERATORS = {
    "exact": exact.exact_dedup, "drop_exact": exact.drop_duplicates, "near": near.near_duplicates,
    "langid": langid.identify, "lm": lm.score_texts, "mix": mixing.mix_sources, "take": mixing.take_mix,
    "pack": packing.pack, "quality": quality.quality_filter,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](documents(spark, [])).collect() == []


def lowered(text):
    return (text or "").encode().lower()


def test_exact(spark):
    rows = odd_documents()
    for keep, best in (("largest", max), ("smallest", min)):
        got = exact.exact_dedup(documents(spark), keep=keep, fan_in=2).collect()
        assert len(got) == len(rows)
        groups = {}
        for i, text, *_ in rows:
            groups.setdefault(hashlib.sha256(lowered(text)).hexdigest(), []).append(i)
        for r in got:
            group = groups[r.sha256.hex()]
            ids = [i for i in group if i is not None]
            assert r.group_size == len(group) and r.keep_id == (best(ids) if ids else None)
        assert sum(r.kept for r in got) == len(groups)
    stays = exact.drop_duplicates(documents(spark), keep="largest")
    assert stays.count() == len(groups) and stays.columns == documents(spark).columns


def test_near_equals_brute_force(spark):
    rows = odd_documents()
    truth = brute_components(rows)
    got = near.near_duplicates(documents(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == truth[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    sizes = {(i, len(shingles(t))) for i, t, *_ in rows}
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes


def test_near_family_above_and_below_the_threshold(spark, monkeypatch):
    """Copies whose pairs lie around 0.75: stars alone miss links; the exact
    rest must find them.  Small bounds force every path."""
    monkeypatch.setattr(near, "SMALL", 3)
    monkeypatch.setattr(near, "BLOCK", 7)
    base = prose(9, 150)
    rows = [(k, edited(base, k, 3 + k % 9), None, None) for k in range(60)]
    rows += [(200 + k, edited(prose(300 + k // 2, 90), k, 2 + k % 4), None, None) for k in range(20)]
    truth = brute_components(rows)
    got = {r.doc_id: r.component_id for r in near.near_duplicates(documents(spark, rows)).collect()}
    assert got == truth
    assert len(set(truth.values())) > 3


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = dict(near.components(spark.createDataFrame(links, "u bigint, v bigint")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}


def test_language(spark):
    rows = [(300 + k, " ".join(t * 5), lang, None) for k, (lang, t) in enumerate(
        [("en", ["the", "house", "with", "this"]), ("de", ["das", "haus", "mit", "der"]),
         ("fr", ["la", "maison", "avec", "cette"])] * 20)] + odd_documents()[3:14]
    rows += [(900, "the house with this", None, None), (901, "1234 !?", "en", None)]
    got = {r.doc_id: r for r in langid.identify(documents(spark, rows)).collect()}
    assert got[900].lang_pred == "en" and got[901].lang_pred == "und" and got[901].score == 0.0
    assert got[4].lang_pred in ("und", "en", "de", "fr")
    for r in got.values():
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1)
        assert 0.0 <= r.score <= 1.0 and r.lang_pred in ("en", "de", "fr", "und")
    held = [got[k] for k in range(300, 360) if got[k].held_out]
    assert held and all(r.lang_pred == ("en", "de", "fr")[r.doc_id % 3] for r in held)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()["a"] > 0.98


def test_unsure_languages_are_kept(spark):
    """Letters that no language has: no posterior reaches a half."""
    rows = [(k, "same text", "abcd"[k // 3 % 4], None) for k in range(24)] + [(99, "12", "a", None), (24, "zzz", None, None)]
    docs = documents(spark, rows)
    named = {r.doc_id for r in langid.identify(docs).where("lang_pred <> 'und'").collect()}
    assert {r.doc_id for r in langid.keep_identified(docs).collect()} == named == set(range(25))


def test_too_many_languages_are_an_error(spark):
    rows = [(k, "some text", f"l{k}", None) for k in range(3 * langid.LANGUAGES)]
    with pytest.raises(ValueError, match="languages"):
        langid.identify(documents(spark, rows))


@pytest.mark.parametrize("params", [{"percent": 50}, {"bands": 20}, {"rows": 6}])
def test_near_duplicates_refuse_what_the_sketch_is_not_made_for(spark, params):
    with pytest.raises(ValueError, match="sketch"):
        near.near_duplicates(documents(spark, []), **params)


def test_language_without_labels(spark):
    rows = [(k, "some text", None, None) for k in range(5)]
    assert {r.lang_pred for r in langid.identify(documents(spark, rows)).collect()} == {"und"}


def test_language_model_base_and_probability(spark):
    rows = odd_documents()
    got = lm.score_texts(documents(spark), block_bytes=5000, sample=40).collect()
    assert len(got) == len(rows)
    counts, tokens = {}, {}
    for i, text, *_ in rows:
        t = [*words_of(text), b""]
        tokens.setdefault((i, len(t)), []).append(t)
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            for w in t:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    for r in got:
        t = tokens[r.doc_id, r.n_tokens][0]
        assert r.train_tokens == total and r.n_known == sum(w in counts for w in t)
        base = sum(np.log10((counts.get(w, 0) + 1) / (total + distinct + 1)) for w in t)
        assert abs(base - r.base_score) < 1e-6 * max(1, len(t)) and r.score < 0


def test_language_model_score_is_a_plain_sum(spark, monkeypatch):
    """Class and word factor of every token, history by history."""
    kept, fit = {}, lm._fit
    monkeypatch.setattr(lm, "_fit", lambda *a, **k: kept.setdefault("model", fit(*a, **k)))
    rows = [r for r in odd_documents() if r[0] != 10]
    got = lm.score_texts(documents(spark, rows)).collect()
    m, counts, scores = kept["model"], {}, {}
    for i, text, *_ in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            for w in [*words_of(text), b""]:
                counts[w] = counts.get(w, 0) + 1
    bucket = lambda w: lm.ENDINGS + m.heads.index(w) if w in m.heads else lm.ending(w)      # noqa: E731
    mass = {}
    for w, c in counts.items():
        mass[m.classes[bucket(w)]] = mass.get(m.classes[bucket(w)], 0) + c + 1
    pad, size = len(m.classes), len(m.bias)
    for i, text, *_ in rows:
        b = [pad, pad, *(bucket(w) for w in [*words_of(text), b""])]
        total = 0.0
        for k, w in enumerate([*words_of(text), b""], 2):
            c = [size if x == pad else m.classes[x] for x in (b[k - 1], b[k - 2])]
            at = lm._feature_rows(*(np.array([x]) for x in (b[k - 1], b[k - 2], *c)), size, len(m.weights))[:, 0]
            z = m.weights[at].astype(float).sum(axis=0) + m.bias
            own = m.classes[b[k]]
            total += (z[own] - z.max() - np.log(np.exp(z - z.max()).sum())) / np.log(10)
            if w not in m.heads:
                total += np.log10((counts.get(w, 0) + 1) / (mass.get(own, 0) + 1))
        scores.setdefault((i, len(b) - 2), []).append(total)
    assert len(got) == len(rows)
    for r in got:
        assert min(abs(r.score - s) for s in scores[r.doc_id, r.n_tokens]) < 1e-4 * max(1, r.n_tokens)


def test_class_logs_do_not_depend_on_the_cuts():
    rng = np.random.default_rng(4)
    m = lm.Model([b""], rng.integers(0, 6, lm.ENDINGS + 1), rng.normal(size=6).astype(np.float32),
                 rng.normal(size=(200, 6)).astype(np.float32), np.zeros(6), 0, 0)
    m.size = 6
    flat, real = lm._padded([rng.integers(0, 40, k) for k in (1, 300, 7, 90)], len(m.classes))
    whole = lm.class_logs(m, flat, real)
    rows = lm.features(flat, np.append(m.classes, 6)[flat], 6, 200)[:, real]
    plain = lm._log_softmax(m.weights, m.bias, rows)[np.arange(real.sum()), m.classes[flat[real]]]
    assert np.allclose(whole[real], plain, atol=1e-5) and (whole[~real] == 0).all()
    assert np.allclose(lm.class_logs(m, flat, real, size=37, chunk=5), whole, atol=1e-5)
    f = rng.integers(0, 9, 100)
    order = np.argsort(f, kind="stable")
    first = np.flatnonzero(np.diff(f[order], prepend=-1))
    values = rng.normal(size=(100, 3))
    assert np.allclose(lm._sums(values, order, first), np.add.reduceat(values[order], first, axis=0))


def test_language_model_beats_unigrams_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = (lm.score_texts(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"),
                                                    F.sum("n_tokens").alias("n")).first())
    assert r["s"] / r["n"] > r["b"] / r["n"] + 0.1


def test_class_factor_is_fitted_on_all_training_documents(spark):
    """Histories that stand only in documents which a draw of 6000 leaves out."""
    left_out = F.pmod(F.xxhash64(F.lit("lm"), "id"), F.lit(1 << 20)) >= 1 << 19
    docs = spark.range(16_000).select(F.col("id").alias("doc_id"), F.when(left_out, "c d c d c d").otherwise("a b a b a b").alias("text"))
    got = lm.score_texts(docs).join(docs, "doc_id").where("held_out").groupBy("text").agg(
        F.avg("score").alias("s"), F.avg("base_score").alias("b")).collect()
    assert len(got) == 2 and all(r.s > r.b + 2 for r in got)


def test_long_texts_are_trained_whole():
    """Runs of a text longer than a run lose and repeat no token."""
    texts = [np.arange(k) % 4000 for k in (1, 7, 95, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.astype("<u2").tobytes() for t in texts])], names=["buckets"])
    runs = list(lm._runs(iter([batch]), 5000, size=10))
    assert len(runs) > 3 and [int(x) for f, r in runs for x in f[r]] == [int(x) for t in texts for x in t]
    for flat, real in runs:
        for i in np.flatnonzero(real):
            assert i >= 2 and flat[i - 1] == (flat[i] - 1 if flat[i] else 5000)


def test_means_weigh_shards_by_what_they_met():
    def part(k, n, w):
        return {"piece": 0, "part": k, "n": np.array(n, "<f8").tobytes(), "weights": np.array(w, "<f4").tobytes()}
    got = lm._mean(pa.Table.from_pylist([part(1, [3, 0], [[1, 1], [5, 5]]), part(2, [1, 0], [[5, 5], [5, 5]])])).to_pylist()[0]
    assert np.allclose(np.frombuffer(got["weights"], "<f4"), [2, 2, 5, 5])


def test_class_factor_sums_to_one(spark):
    sample = documents(spark).select("doc_id", "text")
    m = lm.fit_classes(sample, [b"", b"word"], tails=5, rounds=1)
    flat, real = lm._padded([lm._buckets_of(b"a word in time", {b"": lm.ENDINGS, b"word": lm.ENDINGS + 1})], len(m.classes))
    rows = lm.features(flat, np.append(m.classes, len(m.bias))[flat], len(m.bias), len(m.weights))[:, real]
    assert np.allclose(np.exp(lm._log_softmax(m.weights, m.bias, rows)).sum(axis=1), 1, atol=1e-4)


def test_mixing_targets_and_limits(spark):
    rows = odd_documents()
    got = mixing.mix_sources(documents(spark), cell_rows=4).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words_of(text))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        target.update({s: 2.0 * sizes[s] for s in over} or share)
        left -= sum(2 * sizes[s] for s in over)
        open_ = open_ - over if over else set()
    taken = {}
    for r in got:
        assert r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        largest = max(len(words_of(r[1])) for r in rows if r[3] == s)
        assert abs(t - target[s]) <= 2 * largest
    again = mixing.mix_sources(documents(spark).repartition(5, "text"), cell_rows=4).collect()
    key = lambda r: (str(r.doc_id), r.size, r.copies)      # noqa: E731
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.take_mix(documents(spark), cell_rows=4)
    assert mixed.columns == documents(spark).columns and mixed.count() == sum(r.copies for r in got)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    rows = [r for r in odd_documents() if r[0] is not None and r[0] != 3]
    pieces = packing.pack(documents(spark, rows).repartition(3), window=64).collect()
    parts, filled = {}, {}
    for p in pieces:
        parts.setdefault(p.doc_id, []).append(p)
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, text, *_ in rows:
        own = sorted(parts[i], key=lambda p: p.start)
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in own]).tolist()
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert all(p.doc_tokens == len(ids) for p in own)
    for s, spans in filled.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 64 or s == max(filled)
    whole = packing.sequences(packing.pack(documents(spark, rows), window=64), 64).collect()
    for r in whole:
        n = len(r.ids) // 4
        assert n == 64 or (n == r.length and n & (n - 1) == 0)


def test_stretchwise_ids_equal_whole_text_ids():
    import random
    with open(packing.default_tokenizer(), encoding="utf-8") as f:
        t = packing.ByteTokenizer(f.read())
    signs = ["a", " ", "\n", "\t", "é", "'s", "'", "1", "!", " ", "　", "日", "\r", "  ", " the", "<|endoftext|>",
             "\x1c", "🙂", "\x00"]
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 9)))
        assert t.encode(text) == np.array(t.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_quality_counts_and_order(spark):
    rows = odd_documents()
    got = quality.quality_filter(documents(spark), measured=True).collect()
    assert len(got) == len(rows)
    left = [(r[0], r[1]) for r in rows]
    for r in got:
        text = r.text or ""
        w = text.encode().split()
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        twice = {k for k, g in enumerate(grams) if grams.count(g) > 1} if len(grams) < 3000 else set()
        repeats = len({k + j for k in twice for j in range(8)})
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert r.n_words == len(w) and r.word_chars == sum(len(x.decode()) for x in w)
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == repeats
        assert r.kept == (r.failed_rule is None)
        assert r.kept or len(w) < 20 or repeats * 100 > 30 * len(w) or r.failed_rule not in ("short", "repeats")
        left.remove((r.doc_id, r.text))
    lazy = {(r.doc_id, r.text): r.kept for r in quality.quality_filter(documents(spark)).collect()}
    assert lazy == {(r.doc_id, r.text): r.kept for r in got}


def test_cascade_stops_at_the_first_rejection(spark):
    f = {"n": F.col("n_")}
    boom = quality.Rule("boom", lambda f: F.raise_error(F.lit("evaluated")).cast("boolean"))
    first = quality.Rule("first", lambda f: f["n"] > 0)
    out = spark.range(3).withColumn("n_", F.col("id") + 1).select(quality.cascade([first, boom], f).alias("r"))
    assert {r.r for r in out.collect()} == {"first"}
