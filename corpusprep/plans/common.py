"""Pieces that several queries and their SQL share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusprep.functions.text import NON_BLANK, is_blank, words
from corpusprep.operators.order import micros
from corpusprep.operators.split import document_lines
from corpusprep.operators.tokens import build_vocab, count_tokens, text_tokens
from corpusprep.session import stage
from corpusprep.sources.documents import read_documents, read_table

SEED = 42
SEQ_LEN = 64
DIMS = 64

TOKENS = text_tokens  # word tokens of a text, ``<eos>`` after each non-blank line


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_documents(spark, sf)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return document_lines(read_documents(spark, sf)).filter(~is_blank(F.col("line")))


def vocab(spark: SparkSession, sf: str) -> DataFrame:
    """The whole vocabulary, counted and ranked once."""
    return stage(build_vocab(count_tokens(docs(spark, sf), words(F.col("text")))), "vocab")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings")


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as a log of runs: one run per user, one micro-batch per event."""
    return read_table(spark, sf, "events").select(
        F.col("user_id").alias("run"), "event_id", micros(F.col("ts")).alias("ts"), F.col("value").alias("loss")
    )


def joined(items: Column, sep: str = " ") -> Column:
    return F.array_join(items.cast("array<string>"), sep)


def millionths(vector: Column) -> Column:
    """A vector as text: each element times a million, rounded."""
    whole = F.transform(vector, lambda x: F.round(x * F.lit(1e6)).cast("bigint").cast("string"))
    return F.array_join(whole, ",")


def r6(value: Column) -> Column:
    return F.round(value, 6)


# --- SQL -------------------------------------------------------------------

SQL_LINES = """
raw_lines AS (
  SELECT doc_id, text, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS line_no
  FROM (
    SELECT doc_id, text,
           list_slice(string_split(text, chr(10)), 1,
                      len(string_split(text, chr(10)))
                      - CASE WHEN text = '' OR suffix(text, chr(10)) THEN 1 ELSE 0 END) AS parts
    FROM documents)
)"""

SQL_KEPT = f"""{SQL_LINES},
kept AS (SELECT * FROM raw_lines WHERE regexp_matches(line, '{NON_BLANK}'))"""

SQL_TOKENS = f"""{SQL_KEPT},
line_tokens AS (
  SELECT doc_id, line_no, list_append(regexp_extract_all(lower(line), '[a-z0-9]+'), '<eos>') AS toks FROM kept
),
tokens AS (
  SELECT doc_id, line_no, k, tok,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no, k) - 1 AS pos
  FROM (SELECT doc_id, line_no, unnest(toks) AS tok, generate_subscripts(toks, 1) AS k FROM line_tokens)
)"""

SQL_COUNTS = """
counts AS (
  SELECT token, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents)
  GROUP BY token
)"""

SQL_VOCAB = f"""{SQL_COUNTS},
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id, n FROM counts
)"""

SQL_IDS = f"""{SQL_TOKENS}, {SQL_VOCAB},
ids AS (
  SELECT t.doc_id, t.line_no, t.pos, t.tok,
         CAST(CASE WHEN t.tok = '<eos>' THEN 1 ELSE coalesce(v.id, 0) END AS INTEGER) AS id
  FROM tokens t LEFT JOIN vocab v ON v.token = t.tok
)"""

SQL_PACKED = f"""{SQL_TOKENS},
stream AS (SELECT tok, row_number() OVER (ORDER BY doc_id, line_no, k) - 1 AS place FROM tokens),
packed AS (
  SELECT place // {SEQ_LEN} AS seq_id, string_agg(tok, ' ' ORDER BY place) AS tokens
  FROM stream GROUP BY place // {SEQ_LEN} HAVING count(*) = {SEQ_LEN}
)"""

SQL_LOG = """
log AS (SELECT user_id AS run, event_id, epoch_us(ts) AS ts, value AS loss FROM events),
steps AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY ts, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY run) AS n, min(ts) OVER (PARTITION BY run) AS t0
  FROM log
)"""
