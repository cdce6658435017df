"""The manifest and its proofs against a plain tree in Python and against SQL."""

import hashlib
from collections import defaultdict
from zlib import crc32

import oracle
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import merkle
from corpusprep.llm.queries import QUERIES, SQL

ROW = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree int, Place string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, tampered=False):
    parts = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        if value is not None and name == "text" and tampered:
            value = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value)
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha("".join(parts))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climb(tree, at):
    """Siblings before and after the node at each level, from the leaf up."""
    path = []
    for nodes in tree[:-1]:
        begin = at // 16 * 16
        path.append((nodes[begin:at], nodes[at + 1 : begin + 16]))
        at //= 16
    return path


def plain(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = levels([leaf(r) for r in by_source[s]])
    top = levels([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for i, s in enumerate(names):
        for j, r in enumerate(by_source[s]):
            path = climb(trees[s], j) + climb(top, i)
            proof = sha("".join("".join(a) + "".join(b) for a, b in path))
            tampered = r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 5 == 0
            now = leaf(r, tampered)
            for a, b in path:
                now = sha("".join(a) + now + "".join(b))
            out.append((r["doc_id"], leaf(r), trees[s][-1][0], root, proof, now, now == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def same(df, rows):
    key = lambda t: tuple(map(str, t))
    assert sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=key) == sorted(plain(rows), key=key)


def make(n, source):
    rest = ("clash", 3, "clash")
    return [(i, source(i), "en" if i % 3 else None, i, f"Text {i} ÄB" * (i % 4), *rest) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 300])
def test_one_source_of_many_sizes(spark, n):
    df = spark.createDataFrame(make(n, lambda i: "s"), ROW)
    same(merkle.op11(df), df.collect())


def test_hot_and_single_row_sources(spark):
    """A source with most rows, forty with one row each, and a null one."""
    df = spark.createDataFrame(make(420, lambda i: "hot" if i < 370 else None if i < 380 else f"sö{i}"), ROW)
    same(merkle.op11(df), df.collect())


def test_nulls_repeats_and_long_texts(spark, odd):
    df = odd.withColumn("n_chars", F.col("n_chars").cast("bigint"))
    rows = df.select("doc_id", "source", "lang", "n_chars", "text").collect()
    same(merkle.op11(df), rows)


def test_empty_table(spark):
    assert merkle.op11(spark.createDataFrame([], ROW)).collect() == []


def test_query_equals_its_sql(spark, sf):
    found = oracle.differences(QUERIES["op11_merkle_manifest"](spark, sf), oracle.connect(sf), SQL["op11_merkle_manifest"])
    assert found == []


def test_few_requests_on_a_manifest_read_back(spark, tmp_path):
    """Proofs for some leaves only, from the stored manifest, and a changed leaf that fails."""
    df = spark.createDataFrame(make(500, lambda i: f"s{i % 3}"), ROW)
    leaves = merkle.placed_leaves(df)
    merkle.write_manifest(merkle.build(leaves), str(tmp_path / "m"))
    manifest = merkle.read_manifest(spark, str(tmp_path / "m"))
    some = leaves.filter("doc_id in (3, 4, 77, 499)").select("tree", "place", F.struct("doc_id", "digest").alias("payload"))
    proofs = merkle.prove(manifest, some).collect()
    assert sorted(p["payload"]["doc_id"] for p in proofs) == [3, 4, 77, 499]
    for p in proofs:
        assert p["digest"] == p["payload"]["digest"]
        for start, good in ((p["digest"], True), (sha("other"), False)):
            now = start
            for s in reversed(p["path"]):
                now = sha(s["before"] + now + s["after"])
            assert (now == manifest.root) is good


def test_records_are_addressed_by_content(spark):
    df = spark.createDataFrame(make(300, lambda i: f"s{i % 2}"), ROW)
    manifest = merkle.build(merkle.placed_leaves(df))
    records = {r["digest"]: r["children"] for r in manifest.records.collect()}
    assert all(sha("".join(c)) == d and 1 <= len(c) <= 16 for d, c in records.items())
    seen, todo = set(), [manifest.root]
    while todo:
        at = todo.pop()
        seen.add(at)
        todo += records.get(at, [])
    leaves = {leaf(r) for r in df.collect()}
    assert leaves <= seen and seen - leaves == records.keys()


def test_no_python_and_no_text_in_the_descent(spark, sf):
    plan = QUERIES["op11_merkle_manifest"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "text:string" not in plan
