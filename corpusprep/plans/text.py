"""Lines, tokens, vocabularies and packed sequences of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.arrays import drop_special, stop_at_eos, truncate_context
from corpusprep.functions.text import NON_BLANK, byte_ids, is_blank, words
from corpusprep.operators.dense import dense_vocabulary, recode
from corpusprep.operators.loss import pad_mask, shift_tokens
from corpusprep.operators.pack import pack, pack_tokens
from corpusprep.operators.split import document_lines, split_by_bytes, split_by_rank
from corpusprep.operators.tokens import (
    EOS,
    EOS_ID,
    FIRST_ID,
    UNK,
    UNK_ID,
    append_eos,
    build_vocab,
    count_tokens,
    pad_vocab,
    special_ids,
    text_tokens,
    to_ids,
)
from corpusprep.plans.common import (
    SEQ_LEN,
    SQL_COUNTS,
    SQL_IDS,
    SQL_KEPT,
    SQL_LINES,
    SQL_PACKED,
    SQL_TOKENS,
    SQL_VOCAB,
    docs,
    joined,
    lines,
    vocab,
)
from corpusprep.sources.documents import read_table

CONTEXT = 32
NEW_TOKENS = 16
PAD_MULTIPLE = 128
VOCAB_SIZE = 2000


def doc_lines(spark, sf):
    return document_lines(docs(spark, sf))


def drop_blank_lines(spark, sf):
    return lines(spark, sf)


def drop_blank_pieces(spark, sf):
    """Texts cut at full stops: after the last one, and between two, there is nothing or white space."""
    pieces = docs(spark, sf).select("doc_id", F.posexplode(F.split("text", r"\.", -1)).alias("piece_no", "piece"))
    return pieces.filter(~is_blank(F.col("piece")))


def special_token_ids(spark, sf):
    """Ids of the closing and the padding token; this vocabulary has no padding token."""
    special = spark.createDataFrame([(UNK, UNK_ID), (EOS, EOS_ID)], "token string, id int")
    return special_ids(vocab(spark, sf).select("token", "id").unionByName(special))


def encode_words(spark, sf):
    ids = append_eos(words(F.col("line")), EOS)
    return lines(spark, sf).select("doc_id", "line_no", joined(ids).alias("tokens"))


def encode_bytes(spark, sf):
    located = document_lines(docs(spark, sf), offsets=True).filter(~is_blank(F.col("line")))
    ended = F.concat("line", F.when(F.col("end") - F.col("start") > F.octet_length("line"), "\n").otherwise(""))
    return located.select("doc_id", "line_no", joined(byte_ids(ended), ",").alias("byte_ids"))


def split_documents_by_rank(spark, sf):
    return split_by_rank(read_table(spark, sf, "documents").select("doc_id"), "doc_id")


def split_lines_by_bytes(spark, sf):
    located = document_lines(docs(spark, sf), offsets=True)
    return split_by_bytes(located).select("doc_id", "line_no", "start", "end", "split")


def vocabulary(spark, sf):
    """The optional cap: the most frequent tokens only."""
    return build_vocab(count_tokens(docs(spark, sf), words(F.col("text"))), VOCAB_SIZE)


def whole_vocabulary(spark, sf):
    return build_vocab(count_tokens(docs(spark, sf), words(F.col("text"))))


def padded_vocabulary(spark, sf):
    return pad_vocab(vocab(spark, sf), PAD_MULTIPLE)


def _tokens(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(text_tokens(F.col("text"))).alias("pos", "token"))


def token_ids(spark, sf):
    return to_ids(_tokens(spark, sf), vocab(spark, sf))


def decode_lines(spark, sf):
    """Each line to ids and back, as whole arrays; the words come back, the closing token does not."""
    table = vocab(spark, sf)
    tokens = append_eos(words(F.col("line")), EOS)
    dense = dense_vocabulary(table)
    if dense is not None:
        ids = lines(spark, sf).select("doc_id", "line_no", dense.encode(tokens).alias("ids"))
        return ids.select("doc_id", "line_no", dense.decode(F.col("ids")).alias("text"))
    return recode(lines(spark, sf), tokens, table).select("doc_id", "line_no", "text")


def pack_sequences(spark, sf):
    packed = pack(read_table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"], text_tokens(F.col("text")), SEQ_LEN)
    return packed.select("seq_id", joined(F.col("ids")).alias("tokens"))


def pack_token_ids(spark, sf):
    packed = pack_tokens(
        read_table(spark, sf, "documents").select("doc_id", "text"),
        ["doc_id"],
        text_tokens(F.col("text")),
        vocab(spark, sf),
        SEQ_LEN,
    )
    return packed.select("seq_id", joined(F.col("ids"), ",").alias("ids"))


def next_token_pairs(spark, sf):
    return shift_tokens(docs(spark, sf), text_tokens(F.col("text")), "doc_id")


def padding_mask(spark, sf):
    pairs = shift_tokens(docs(spark, sf), text_tokens(F.col("text")), "doc_id")
    return pairs.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("labels"), F.sum(pad_mask(F.col("label"), EOS)).cast("bigint").alias("kept")
    )


def context_window(spark, sf):
    tail = truncate_context(F.col("tokens"), CONTEXT)
    return (
        docs(spark, sf).select("doc_id", text_tokens(F.col("text")).alias("tokens"))
        .select("doc_id", joined(tail).alias("context"))
    )


def stop_tokens(spark, sf):
    head = stop_at_eos(F.col("tokens"), F.lit(EOS), NEW_TOKENS)
    return (
        docs(spark, sf).select("doc_id", text_tokens(F.col("text")).alias("tokens"))
        .select("doc_id", joined(head).alias("tokens"))
    )


def without_special(spark, sf):
    plain = drop_special(F.col("tokens"), [EOS])
    return (
        docs(spark, sf).select("doc_id", text_tokens(F.col("text")).alias("tokens"))
        .select("doc_id", joined(plain).alias("tokens"))
    )


QUERIES = {
    "doc_lines": doc_lines,
    "drop_blank_lines": drop_blank_lines,
    "drop_blank_pieces": drop_blank_pieces,
    "special_ids": special_token_ids,
    "encode_words": encode_words,
    "encode_bytes": encode_bytes,
    "split_by_rank": split_documents_by_rank,
    "split_by_bytes": split_lines_by_bytes,
    "build_vocab": vocabulary,
    "build_vocab_uncapped": whole_vocabulary,
    "pad_vocab": padded_vocabulary,
    "token_ids": token_ids,
    "decode": decode_lines,
    "pack_sequences": pack_sequences,
    "pack_token_ids": pack_token_ids,
    "next_token_pairs": next_token_pairs,
    "pad_mask": padding_mask,
    "truncate_context": context_window,
    "stop_at_eos": stop_tokens,
    "drop_special": without_special,
}

_DOC_TOKENS = f"""{SQL_TOKENS},
doc_tokens AS (
  SELECT d.doc_id, coalesce(t.toks, []) AS toks
  FROM documents d LEFT JOIN (SELECT doc_id, list(tok ORDER BY pos) AS toks FROM tokens GROUP BY doc_id) t
  USING (doc_id)
)"""

SQL = {
    "doc_lines": f"WITH {SQL_LINES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM raw_lines",
    "drop_blank_lines": f"WITH {SQL_KEPT} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM kept",
    "drop_blank_pieces": f"""
        SELECT doc_id, CAST(piece_no AS INTEGER) AS piece_no, piece
        FROM (SELECT doc_id, unnest(parts) AS piece, generate_subscripts(parts, 1) - 1 AS piece_no
              FROM (SELECT doc_id, string_split(text, '.') AS parts FROM documents))
        WHERE regexp_matches(piece, '{NON_BLANK}')""",
    "special_ids": f"""WITH {SQL_VOCAB},
        every AS (SELECT token, id FROM vocab UNION ALL VALUES ('{UNK}', {UNK_ID}), ('{EOS}', {EOS_ID})),
        found AS (SELECT max(id) FILTER (token = '{EOS}') AS eos_id, max(id) FILTER (token = '<pad>') AS pad_id FROM every)
        SELECT CAST(eos_id AS INTEGER) AS eos_id, CAST(coalesce(pad_id, eos_id) AS INTEGER) AS pad_id FROM found""",
    "encode_words": f"""WITH {SQL_TOKENS}
        SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, array_to_string(toks, ' ') AS tokens FROM line_tokens""",
    "encode_bytes": f"""WITH {SQL_LINES},
        ended AS (
          SELECT doc_id, line_no,
                 hex(encode(line || CASE WHEN line_no < max(line_no) OVER (PARTITION BY doc_id)
                                           OR suffix(text, chr(10)) THEN chr(10) ELSE '' END)) AS h, line
          FROM raw_lines)
        SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
               array_to_string(list_transform(range(0, len(h) // 2), lambda i:
                 16 * (instr('0123456789ABCDEF', substr(h, CAST(2 * i + 1 AS INTEGER), 1)) - 1)
                    + (instr('0123456789ABCDEF', substr(h, CAST(2 * i + 2 AS INTEGER), 1)) - 1)), ',') AS byte_ids
        FROM ended WHERE regexp_matches(line, '{NON_BLANK}')""",
    "split_by_rank": """
        SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1
                                 < floor(0.9 * (SELECT count(*) FROM documents)) THEN 'train' ELSE 'val' END AS split
        FROM documents""",
    "split_by_bytes": f"""WITH {SQL_LINES},
        ends AS (
          SELECT doc_id, line_no, strlen(line) + 1 AS len, strlen(text) AS size,
                 CAST(sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS stop
          FROM raw_lines),
        located AS (
          SELECT doc_id, line_no, stop - len AS start, least(stop, size) AS "end",
                 floor(size * CAST(0.9 AS DOUBLE)) AS cut FROM ends)
        SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end",
               CASE WHEN "end" <= cut THEN 'train' ELSE 'val' END AS split
        FROM located WHERE "end" <= cut OR start > cut""",
    "build_vocab": f"WITH {SQL_VOCAB} SELECT token, id, n FROM vocab WHERE id < {VOCAB_SIZE + FIRST_ID}",
    "build_vocab_uncapped": f"""WITH {SQL_COUNTS}
        SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id, n FROM counts""",
    "pad_vocab": f"""WITH {SQL_VOCAB},
        size AS (SELECT max(id) AS top FROM vocab)
        SELECT token, id FROM vocab
        UNION ALL
        SELECT '<pad_' || i || '>' AS token, CAST(top + 1 + i AS INTEGER) AS id
        FROM size, range({PAD_MULTIPLE}) r(i)
        WHERE i < ({PAD_MULTIPLE} - (top + 1) % {PAD_MULTIPLE}) % {PAD_MULTIPLE}""",
    "token_ids": f"WITH {SQL_IDS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, id FROM ids",
    "decode": f"""WITH {SQL_IDS}
        SELECT i.doc_id, CAST(i.line_no AS INTEGER) AS line_no,
               coalesce(string_agg(v.token, ' ' ORDER BY i.pos) FILTER (WHERE i.id NOT IN ({UNK_ID}, {EOS_ID})), '') AS text
        FROM ids i LEFT JOIN vocab v USING (id) GROUP BY i.doc_id, i.line_no""",
    "pack_sequences": f"WITH {SQL_PACKED} SELECT seq_id, tokens FROM packed",
    "pack_token_ids": f"""WITH {SQL_IDS},
        stream AS (SELECT id, row_number() OVER (ORDER BY doc_id, pos) - 1 AS place FROM ids)
        SELECT place // {SEQ_LEN} AS seq_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) AS ids
        FROM stream GROUP BY place // {SEQ_LEN} HAVING count(*) = {SEQ_LEN}""",
    "next_token_pairs": f"""WITH {SQL_TOKENS}
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, tok AS input, label
        FROM (SELECT *, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS label FROM tokens)
        WHERE label IS NOT NULL""",
    "pad_mask": f"""WITH {SQL_TOKENS}
        SELECT doc_id, count(*) AS labels, CAST(sum(CASE WHEN tok <> '<eos>' THEN 1 ELSE 0 END) AS BIGINT) AS kept
        FROM tokens WHERE pos > 0 GROUP BY doc_id""",
    "truncate_context": f"""WITH {_DOC_TOKENS}
        SELECT doc_id, array_to_string(list_slice(toks, greatest(len(toks) - {CONTEXT} + 1, 1), len(toks)), ' ') AS context
        FROM doc_tokens""",
    "stop_at_eos": f"""WITH {_DOC_TOKENS}
        SELECT doc_id, array_to_string(list_slice(toks, 1,
                 least({NEW_TOKENS}, coalesce(nullif(list_position(toks, '<eos>'), 0), len(toks)))), ' ') AS tokens
        FROM doc_tokens""",
    "drop_special": f"""WITH {_DOC_TOKENS}
        SELECT doc_id, array_to_string(list_filter(toks, lambda t: t <> '<eos>'), ' ') AS tokens FROM doc_tokens""",
}
