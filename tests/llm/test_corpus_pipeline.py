"""The pipeline stage by stage: each takes effect on all its predecessor kept."""

from collections import Counter

import corpus_pipeline
from changeloom.llm import langid
from helpers import brute_components, documents, odd_documents, prose, words_of


def test_stages(spark, tmp_path):
    rows = odd_documents() + [(500 + k, prose(900 + k, 60), ("en", "de")[k % 2], "a") for k in range(40)]
    docs = documents(spark, rows)
    names, stages = [n for n, _ in corpus_pipeline.STAGES], dict(corpus_pipeline.STAGES)
    assert names == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    kept = {}
    for name in names:
        out = stages[name](spark, docs, str(tmp_path))
        if name != "pack":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()

    judged = langid.identify(documents(spark, rows)).collect()
    accepted = Counter(r.doc_id for r in judged if r.lang_pred != langid.UNKNOWN)
    assert Counter(r.doc_id for r in kept["language_id"]) == accepted
    assert not [r for r in kept["language_id"] if r.text is None or not any(c.isalpha() for c in r.text)]

    texts = {}
    for r in kept["language_id"]:
        texts.setdefault(r.text.encode().lower(), []).append(-1 if r.doc_id is None else r.doc_id)
    assert {r.text.encode().lower(): r.doc_id for r in kept["exact_dedup"]} == {
        t: None if max(i) == -1 else max(i) for t, i in texts.items()}
    assert len(kept["exact_dedup"]) == len(texts)

    truth = brute_components([(r.doc_id, r.text) for r in kept["exact_dedup"]])
    assert {r.doc_id for r in kept["near_dedup"] if r.doc_id is not None} == {i for i, c in truth.items() if i == c}

    sizes = {r.doc_id: len(words_of(r.text)) for r in kept["near_dedup"]}
    copies = Counter(r.doc_id for r in kept["mix_sources"])
    assert set(copies) <= set(sizes) and max(copies.values()) <= 2
    taken, total = sum(sizes[i] * n for i, n in copies.items()), sum(sizes.values())
    assert abs(taken - 1.5 * total) <= 4 * max(sizes.values())

    tokens = Counter()
    for p in kept["pack"]:
        tokens[p.doc_id] += p.length
    for i, n in copies.items():
        assert tokens[i] == n * next(p.doc_tokens for p in kept["pack"] if p.doc_id == i)
    spans = sorted((p.sequence_id, p.offset, p.length) for p in kept["pack"])
    at = 0
    for sequence, offset, length in spans:
        assert (sequence, offset) == divmod(at, 2048)
        at += length


def test_run_and_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and "sequence_id" in out.columns
