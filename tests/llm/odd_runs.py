"""The queries' operators by short names, over any documents."""

from __future__ import annotations

from corpusprep.llm import decontaminate, hilbert, langid, lm, merkle, mixing, orc_tokens, quality, secrets, sentencepieces, simhash
from corpusprep.llm.common import tokenizer_file

COUNTED = ["op2", "op3", "op4", "op5", "op7", "op8", "op9", "op10", "op11", "op12"]


def run_all(spark, name, docs):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (3, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, None), (None, "x"), (2, ""), (3, "too short")], "item_id bigint, text string")
    found = {
        "op2": lambda: hilbert.op2(docs),
        "op3": lambda: secrets.op3(docs),
        "op4": lambda: lm.op4(docs),
        "op5": lambda: sentencepieces.op5(docs, tokenizer_file("piece_bpe_32k.model")),
        "op6": lambda: decontaminate.op6(docs, items),
        "op7": lambda: orc_tokens.op7(docs, tokenizer_file("word_bpe_49k.json")),
        "op8": lambda: langid.op8(docs),
        "op9": lambda: quality.op9(docs, labels),
        "op10": lambda: simhash.op10(docs),
        "op11": lambda: merkle.op11(docs),
        "op12": lambda: mixing.op12(docs),
    }
    return found[name]().collect()
