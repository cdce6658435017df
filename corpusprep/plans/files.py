"""Sources and sinks: the given tables written as files of each kind and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.text import repair_utf8, words
from corpusprep.operators.batch import assign_shards, batch_at
from corpusprep.operators.pack import pack
from corpusprep.operators.tokens import text_tokens
from corpusprep.plans.common import SEQ_LEN, SQL_LOG, SQL_PACKED, joined, run_log
from corpusprep.session import stage, stage_path
from corpusprep.sources.arrow_stream import read_pretokenized, write_pretokenized
from corpusprep.sources.corpus import read_corpus, with_byte_offsets
from corpusprep.sources.documents import read_documents, read_table
from corpusprep.sources.packed import read_packed, write_packed
from corpusprep.sources.snapshot import load_snapshot, save_snapshot, snapshot_steps

BATCH, SHARDS = 16, 8
SNAPSHOTS, KEPT = 5, 3
CODES = 100  # an id is the first letter's code times this, plus the word's length


def word_codes(text):
    """Ids of a text's words that SQL can give too."""
    return F.transform(words(text), lambda w: (F.ascii(w) * CODES + F.length(w)).cast("bigint"))


def corpus_lines(spark, sf):
    """``documents`` as text files, read back as a corpus: its lines, their bytes, and how often each occurs."""
    path = stage_path(spark, "corpus")
    # A carriage return would be read as a line end too.
    rows = read_documents(spark, sf).select("lang", F.replace("text", F.lit("\r"), F.lit(" ")).alias("value"))
    # Each task writes its share of the scan, so there are as many files as the table asks for.
    rows.write.partitionBy("lang").text(path)
    corpus = read_corpus(spark, path)
    located = with_byte_offsets(corpus.lines, corpus.moved)
    return located.groupBy("line", (F.col("end") - F.col("start")).alias("bytes")).agg(F.count(F.lit(1)).alias("n"))


def arrow_rows(spark, sf):
    """``documents`` as pre-tokenized Arrow files, read back by ranges of record batches."""
    path = stage_path(spark, "arrow")
    ids = read_table(spark, sf, "documents").select("doc_id", word_codes(F.col("text")).alias("input_ids"))
    write_pretokenized(ids.repartition(SHARDS, "doc_id"), path)
    found = read_pretokenized(spark, path, position=True, split_bytes=1 << 20)
    text = joined(F.col("input_ids"), ",").alias("ids")
    # A position belongs to one row only, or it would count twice here.
    return found.dropDuplicates(["file_no", "row_no"]).groupBy(text).agg(F.count(F.lit(1)).alias("n"))


def packed_files(spark, sf):
    """Packed sequences in batches, written by split and shard, and the training part read back."""
    path = stage_path(spark, "sink")
    rows = read_table(spark, sf, "documents").select("doc_id", "text")
    # Tokens are made once, ahead of the shuffle that the packer reads several times. None holds a blank or is empty.
    tokens = rows.select("doc_id", joined(text_tokens(F.col("text"))).alias("tokens"))
    packed = pack(tokens, ["doc_id"], F.array_remove(F.split("tokens", " "), ""), SEQ_LEN)
    # Counting, planning and writing read the sequences; they are packed once.
    packed = stage(packed.select("seq_id", joined(F.col("ids")).alias("ids")), "packed")
    batched = batch_at(packed, "seq_id", BATCH)
    split = F.when(F.col("batch_id") % 10 < 9, "train").otherwise("val")
    sharded = assign_shards(batched, BATCH, SHARDS).withColumn("split", split)
    write_packed(sharded, path, target_bytes=1 << 20, unpack=F.split("ids", " "))
    kept = read_packed(spark, path).filter("split = 'train'")
    return kept.select("seq_id", F.col("shard_id").cast("int").alias("shard_id"), joined(F.col("ids")).alias("tokens"))


def snapshot_files(spark, sf):
    """Metrics of the log saved step by step, each step with one more fifth of the runs; the newest one read back."""
    root = stage_path(spark, "snapshots")
    log = run_log(spark, sf)
    for step in range(1, SNAPSHOTS + 1):
        part = log.filter(F.col("run") % SNAPSHOTS < step).groupBy("run").agg(F.count(F.lit(1)).alias("steps"), F.max("ts").alias("last"))
        save_snapshot(part, root, step, KEPT)
    kept = joined(F.array(*[F.lit(s) for s in snapshot_steps(spark, root)]), ",")
    return load_snapshot(spark, root).withColumn("kept", kept)


def repaired_text(spark, sf):
    """Texts whose bytes were cut off after 100: what is left of a character comes back as the replacement mark."""
    cut = F.substr(F.encode("text", "UTF-8"), F.lit(1), F.lit(100)).cast("string")
    return read_table(spark, sf, "documents").select("doc_id", F.length(repair_utf8(cut)).alias("chars"))


QUERIES = {
    "corpus_lines": corpus_lines,
    "arrow_rows": arrow_rows,
    "packed_files": packed_files,
    "snapshot_files": snapshot_files,
    "repaired_text": repaired_text,
}

SQL_CODES = f"""
codes AS (
  SELECT doc_id, source,
         list_transform(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: ascii(w) * {CODES} + length(w)) AS ids
  FROM documents)"""

SQL = {
    "corpus_lines": """
        SELECT line, CAST(strlen(line) + 1 AS BIGINT) AS bytes, count(*) AS n
        FROM (SELECT unnest(string_split(replace(text, chr(13), ' '), chr(10))) AS line FROM documents)
        GROUP BY line""",
    "arrow_rows": f"""WITH {SQL_CODES}
        SELECT ids, count(*) AS n FROM (SELECT array_to_string(ids, ',') AS ids FROM codes) GROUP BY ids""",
    "packed_files": f"""WITH {SQL_PACKED}
        SELECT seq_id, CAST(seq_id % {BATCH} // {BATCH // SHARDS} AS INTEGER) AS shard_id, tokens FROM packed
        WHERE seq_id // {BATCH} < (SELECT count(*) // {BATCH} FROM packed) AND seq_id // {BATCH} % 10 < 9""",
    "snapshot_files": f"""WITH {SQL_LOG}
        SELECT run, count(*) AS steps, max(ts) AS last, '{",".join(map(str, range(SNAPSHOTS - KEPT + 1, SNAPSHOTS + 1)))}' AS kept
        FROM log GROUP BY run""",
    "repaired_text": """
        WITH bytes AS (
          SELECT doc_id, hex(encode(text)[1:100]) AS h, encode(text) AS raw FROM documents),
        lead AS (
          SELECT doc_id, list_transform(range(0, len(h) // 2), lambda i: substr(h, CAST(2 * i + 1 AS INTEGER), 1)) AS firsts FROM bytes)
        SELECT doc_id, CAST(len(list_filter(firsts, lambda c: c NOT IN ('8', '9', 'A', 'B'))) AS INTEGER) AS chars FROM lead""",
}
