"""Token ids in ORC files: special tokens and odd white space against the library, and lookups that skip."""

import random

import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

from corpusprep.llm import orc_tokens
from corpusprep.llm.common import tokenizer_file

FILE = tokenizer_file("word_bpe_49k.json")
PARTS = [
    "<|endoftext|>", "<|startoftext|>", "<|", "|>", "<", "|", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0",
    " ", "　", "Hello", "world", "'s", "'S", "don't", "É", "é", "é", "ß", "İ", "Σ", "ΑΣ", "7", "42", "½",
    "漢字", "かな", "😀", "👩‍👩‍👧", "...", "!?", "a", "B", "ﬁ", "​", "K", "Å", "<|ENDOFTEXT|>", "&amp;", "\x00",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


def check(library, texts):
    flat, counts = orc_tokens.encode_texts(pa.array(texts, pa.string()), FILE, 2)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert flat[at : at + n].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2], repr(text)
        at += n
    assert at == len(flat)


def test_two_thousand_odd_texts(library):
    rng = random.Random(1)
    check(library, ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(2000)])


def test_special_tokens_alone_and_glued(library):
    glue = ["", " ", "x", ".", "\n", "É", "<", "|"]
    check(library, [f"{a}{s}{b}" for s in ("<|endoftext|>", "<|startoftext|>") for a in glue for b in glue])


def test_nulls_blanks_and_long_texts(library):
    check(library, ["", None, " \n\t ", "a" * 5000, "word " * 50_000, "<|endoftext|>" * 3])
    check(library, [])


def test_a_worker_that_forgets_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(orc_tokens, "_MOST_CHARS", 10)
    rng = random.Random(2)
    for _ in range(20):
        check(library, [" ".join(f"w{rng.randrange(50)}" for _ in range(30)) for _ in range(5)])


def test_slices_bound_what_is_encoded_together():
    texts = pa.array(["x" * n for n in (5, 5, 5, 100, 1, 1)] + [None])
    assert list(orc_tokens.slices(texts, 10)) == [(0, 2), (2, 3), (3, 4), (4, 7)]


def test_lookups_skip_files_and_stripes(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") * 3).alias("doc_id"), F.concat(F.lit("word "), F.col("id")).alias("text"))
    path = str(tmp_path / "orc")
    orc_tokens.write_tokens(rows, path, FILE, 2, files=4, row_group=1_000)
    some = [3, 60_000, 119_997]
    found = orc_tokens.look_up(spark, path, [*some, 4]).orderBy("doc_id")
    assert [r["doc_id"] for r in found.collect()] == some
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [In(doc_id" in plan.toString()

    def read(df):
        """Rows that the scan hands on, before Spark filters them once more."""
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        stack = [node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node]
        while stack:
            at = stack.pop()
            if at.nodeName().startswith("Scan"):
                return at.metrics().apply("numOutputRows").value()
            children = at.children()
            stack += [children.apply(i) for i in range(children.size())]

    # Three ids lie in three row groups of 1,000; an id between two others is ruled out by the Bloom filters.
    assert read(orc_tokens.look_up(spark, path, some)) <= 3 * 1_000
    assert read(orc_tokens.look_up(spark, path, [60_001])) <= 1_000
    assert read(spark.read.schema(orc_tokens.SCHEMA).orc(path).filter("n_tokens > 0")) == 40_000
