"""The pipeline: columns, what each stage drops, and odd rows through all stages."""

import brute
import corpus_pipeline
import numpy as np
import pytest
import sentencepiece

from corpusprep.llm import decontaminate, quality, secrets
from corpusprep.llm.common import tokenizer_file
from corpusprep.session import stage

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_decide(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes, ids = [docs.count()], {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf), name)
        assert docs.columns == DOCUMENTS
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids
        ids = now
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] and sizes[3] == sizes[4] > 0
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == ids and len(out) == sizes[-1]


@pytest.mark.parametrize("table", ["odd", "none"])
def test_odd_rows_pass(spark, sf, table, request):
    docs = request.getfixturevalue(table)
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf), name)
        assert docs.columns == columns
    corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()


def plain_redaction(text, spans):
    """Spans, overlapping ones as one, replaced one after the other."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], "[SECRET]"]
        at = max(at, s["end"])
    return "".join(out) + text[at:] if spans else text


def test_each_stage_equals_its_plain_version(spark, sf):
    """Every stage on its own input: the rows it keeps, and what it writes."""
    stages = dict(corpus_pipeline.STAGES)
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    def after(name, docs):
        out = stage(stages[name](spark, docs, sf), name)
        return out, {r["doc_id"]: r for r in out.collect()}

    model, _ = quality.fit_documents(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    weights = np.array(model.weights)
    scores = {i: 1 / (1 + np.exp(-(model.bias + np.array(quality.features(t), np.float32) @ weights))) for i, t in rows.items()}
    docs, kept = after("quality", docs)
    assert set(kept) == {i for i, s in scores.items() if s >= quality.THRESHOLD}

    prints = {i: brute.fingerprint(r["text"]) for i, r in kept.items()}
    least = brute.components(prints, brute.near_fingerprints(prints))
    docs, kept = after("simhash", docs)
    assert set(kept) == {i for i, c in least.items() if i == c}

    texts = [(i, r["text"]) for i, r in kept.items()]
    literal = {i for i, _ in brute.literal_matches(texts, [(r["item_id"], r["text"]) for r in items.collect()])}
    template = {r["doc_id"] for r in decontaminate.op6(docs, items).filter("n_template > 0").collect()}
    before = set(kept)
    docs, kept = after("decontaminate", docs)
    assert literal and before - set(kept) == literal | template

    spans = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(docs).collect()}
    texts = {i: r["text"] for i, r in kept.items()}
    docs, kept = after("secrets", docs)
    assert {i: r["text"] for i, r in kept.items()} == {i: plain_redaction(t, spans[i]) for i, t in texts.items()}
    changed = {i for i, r in kept.items() if r["text"] != texts[i]}
    assert {i for i, t in texts.items() if brute.secrets(t)[:3] != (0, 0, 0)} <= changed
    assert all(r["n_chars"] == len(r["text"]) for i, r in kept.items() if i in changed)

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    out = stages["tokens"](spark, docs, sf).collect()
    assert {r["doc_id"] for r in out} == set(kept)
    for r in out:
        text = kept[r["doc_id"]]["text"] or ""
        assert r["ids"] == library.encode(text) and r["n_tokens"] == len(r["ids"])
        assert r["round_trip"] == (library.decode(r["ids"]) == text)
