"""Each operator's query against a plain version over the same rows."""

import hashlib
from collections import Counter
from zlib import crc32

import brute
import numpy as np
import pytest
import sentencepiece
import tokenizers

from corpusprep.llm import decontaminate, embeddings, hilbert, lm, orc_tokens, secrets, sentencepieces, simhash
from corpusprep.llm.common import tokenizer_file

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def test_embedding_links_and_components(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    odd = [(9001, None), (9002, []), (9003, [0.0] * 4), (9004, [1.0, None]), (9005, [float("nan"), 1.0]),
           (9006, [float("inf"), 1.0]), (9007, [1.0, 2.0]), (9008, [2.0, 4.0]), (9009, [1.0, 2.0])]
    both = rows.unionByName(spark.createDataFrame(odd, rows.schema))
    vectors = {r["vec_id"]: r["embedding"] for r in both.collect()}
    edges = brute.cosine_links(vectors)
    links = Counter(i for e in edges for i in e)
    least = brute.components(vectors, edges)
    found = {r["vec_id"]: r for r in embeddings.op1(both).collect()}
    assert found.keys() == vectors.keys()
    for i, r in found.items():
        assert (r["n_links"], r["component_id"], r["kept"]) == (links[i], least[i], least[i] == i)


def test_embedding_groups_cut_into_blocks_lose_no_link(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (np.ones(8) + rng.normal(0, 0.35, 8)).tolist()) for i in range(120)] + [(200 + i, [1.0] * 8) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    edges = brute.cosine_links(dict(rows))
    links = Counter(i for e in edges for i in e)
    found = embeddings.near_vectors(df, "vec_id", "embedding", block=16).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == {i: links[i] for i, _ in rows}


def test_shards_are_even_and_gapless(docs):
    rows = hilbert.op2(docs).collect()
    assert len(rows) == docs.count()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    for r in rows:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, crc32(raw), "rows")


@pytest.mark.parametrize("dims", [2, 3])
def test_hilbert_neighbours_differ_by_one_step(dims):
    side = 8
    cells = [c.ravel() for c in np.meshgrid(*[np.arange(side)] * dims, indexing="ij")]
    at = hilbert.hilbert_index(cells, 3)
    assert sorted(at.tolist()) == list(range(side**dims))
    path = np.stack(cells)[:, np.argsort(at)]
    assert (np.abs(np.diff(path)).sum(0) == 1).all()


def test_base_secrets(spark, docs):
    more = ["API_key='abc/def+1' token:x", "AKIA" + "A1" * 9 + " AKIASHORT", "é password = \"hunter2x\"", "f" * 24 + "g" + "0" * 23, None, ""]
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(more)], "doc_id bigint, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    text = {r["doc_id"]: r["text"] for r in both.collect()}
    for r in secrets.op3(both).collect():
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == brute.secrets(text[r["doc_id"]])


def test_entropy_spans_are_those_of_full_counts(spark):
    random = "q9Zx7Lm2Vb8Kc4Tn6Rw1Yp3Hs5Jd0Gf"
    text = f"id {random} end, path/to/some/thing/long/enough and {'xy1' * 12}"
    spans = secrets.find_secrets(spark.createDataFrame([(text,)], "text string")).first()["spans"]
    for s in spans:
        c = next(c for c in secrets.CLASSES if c.kind == s["kind"])
        hit = text[s["start"] : s["end"]]
        assert brute.entropy(hit[: c.width]) >= c.bits - 1e-6 and brute.entropy(hit[-c.width :]) >= c.bits - 1e-6
    assert [text[s["start"] : s["end"]] for s in spans] == [random]


def test_language_model(docs, texts):
    base = brute.base_scores(texts)
    rows = lm.op4(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        i = r["doc_id"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == base[i][:3]
        assert r["base_score"] == pytest.approx(base[i][3], rel=1e-9)
        assert r["held_out"] == (crc32(str(i).encode()) % 7 == 2)


def test_language_model_scores(docs, texts):
    full = brute.bigram_scores(texts, lm.DISCOUNT)
    for r in lm.op4(docs).collect():
        assert r["score"] == pytest.approx(full[r["doc_id"]], rel=2e-3)


def test_sentencepiece_equals_the_library(docs, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(PIECES))
    found = {r["doc_id"]: r for r in sentencepieces.op5(docs, tokenizer_file(PIECES)).collect()}
    for i, text in texts:
        ids = library.encode(text or "")
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_piece_spans_cover_the_source(spark):
    text = "Grüße  an\talle \U0001f600 und 日本 ok\n"
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = sentencepieces.encode_checked(df, tokenizer_file(PIECES)).first()
    assert row["starts"][0] == 0 and row["ends"][-1] == len(text.encode())
    assert all(a <= b for a, b in zip(row["starts"], row["ends"]))
    assert row["starts"] == sorted(row["starts"])


def test_orc_ids_equal_the_library(docs, texts):
    library = tokenizers.Tokenizer.from_file(tokenizer_file(WORDS))
    found = {r["doc_id"]: r for r in orc_tokens.op7(docs, tokenizer_file(WORDS)).collect()}
    start = 0
    for i, text in sorted(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        r = found[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_simhash_fingerprints_and_components(docs, texts):
    prints = {i: brute.fingerprint(t) for i, t in texts}
    least = brute.components(prints, brute.near_fingerprints(prints))
    rows = simhash.op10(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == least


def test_simhash_large_groups_are_cut_again(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 4)
    prints = sorted({int(c) ^ sum(1 << int(b) for b in rng.integers(0, 62, rng.integers(0, 5))) for c in centres for _ in range(150)})
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    edges = [(r["a"], r["b"]) for r in simhash.links(df, most=100).collect()]
    # A group sends a forest: its edges join members of a component, not always neighbours.
    expected = brute.components(prints, brute.near_fingerprints({p: p for p in prints}))
    assert brute.components(prints, edges) == expected


def test_literal_windows_of_the_benchmark(spark, sf, texts):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["n_literal"] for r in decontaminate.op6(docs, items).collect() if r["n_literal"]}
    assert found == brute.literal_matches(texts, [(r["item_id"], r["text"]) for r in items.collect()])


def test_short_items_are_whole_documents(spark):
    texts = [(1, "Yes, it is!"), (2, "yes it is"), (3, "Yes it is not"), (4, "yes"), (5, ""), (6, None)]
    items = [(10, "yes it is"), (11, "Yes."), (12, ""), (13, "a b c d e f g h")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["n_literal"] for r in decontaminate.op6(docs, bench).collect()}
    assert found == brute.literal_matches(texts, items) == {(1, 10): 1, (2, 10): 1, (4, 11): 1}


def test_templates_need_consistent_slots(spark):
    def ask(name, a, other, b, c):
        return f"Yesterday afternoon {name} bought {a} red apples from {other} and then sold {b} of them to {name} for {c} dollars at the old market"

    items = spark.createDataFrame([(1, ask("Maria", 12, "Peter", 5, 12))], "item_id bigint, text string")
    rows = [
        (1, "We heard. " + ask("Anna", 40, "Tomas", 7, 40) + " and left."),  # the same question with other values
        (2, ask("Anna", 40, "Tomas", 7, 41)),  # 12 stands for two values
        (3, ask("Anna", 40, "Anna", 7, 40)),  # two names stand for one
        (4, "Yesterday afternoon nobody bought any apples at all and everyone went home to sleep early in the end"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"] for r in decontaminate.op6(docs, items).collect()} == {1}
