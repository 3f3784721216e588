"""The pipeline against its stages done by hand."""

import re

from tests.llm.test_operators import brute_fingerprint, components_of, lower

import corpus_pipeline
from tidemark.llm import decontamination, language_id


def test_stages(spark):
    d = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    bench = spark.read.parquet(f"{d}/benchmark.parquet")
    left = {i: t for i, t in rows.items() if t and re.search(r"[^\W\d_]", t)}
    last = {}
    for i, t in left.items():
        last[lower(t)] = max(i, last.get(lower(t), i))
    left = {i: left[i] for i in last.values()}
    ids = sorted(left)
    fps = [brute_fingerprint(left[i]) for i in ids]
    root = components_of(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4])
    left = {i: left[i] for k, i in enumerate(ids) if root[k] == k}

    def grams(t):
        w = re.findall(r"[^\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    items = [g for g in (grams(r.text) for r in bench.collect()) if g]
    left = {i: t for i, t in left.items() if not any(len(g & grams(t)) >= decontamination.LEAST * len(g) for g in items)}
    out = corpus_pipeline.run(spark, d).collect()
    assert sorted(r.doc_id for r in out) == sorted(left) and len(left) < len(rows)


def test_language_stage_takes_the_prediction(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language_id.identify_language(docs, language_id.fit_language_model(docs)).collect()
    for wanted in (["en"], ["de", "fr"], ["none"]):
        monkeypatch.setattr(corpus_pipeline, "LANGUAGES", wanted)
        kept = corpus_pipeline.language(spark, docs, "").collect()
        assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in found if r.lang_pred in wanted and r.likeness >= 0.5)
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", None)
    odd_one = spark.createDataFrame([(-1, "Привет, как дела?", None)], "doc_id long, text string, lang string")
    more = docs.select("doc_id", "text", "lang").unionByName(odd_one)
    assert {r.doc_id for r in corpus_pipeline.language(spark, more, "").collect()} == {r.doc_id for r in found if r.lang_pred != "und"}


def test_stages_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert k == len(corpus_pipeline.STAGES) or out.columns == docs.columns
            out.count()
