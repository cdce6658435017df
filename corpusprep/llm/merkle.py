"""Merkle manifest of a dataset: a content-addressed tree per source, and proofs by descent.

``build`` hashes rows to leaves and folds them, 16 consecutive nodes at a time,
to one subroot per source and then to one root. The manifest keeps a record
``digest -> children`` for every inner node, found by content alone.

``descend`` answers leaf requests from the root: in each step a node's record
gives its children, the request's rank digit (base 16) selects one, and the
others become a segment of the path. Requests that share a node share its step,
so no record is looked up once per request: a step handles each wanted node
once, and the bits of a mask say which children are wanted. Reversed, the
segments are the siblings from the leaf up.

Trees are keyed by source, nulls being a source of their own that comes first.
A source may hold any share of the rows: positions come from range partitions,
and nodes are grouped by their parent, 16 at a time. Leaves with the same id
are ordered by their digest; rows that are equal in all hashed columns have
equal leaves, and so exchangeable places and different proofs. Rows without an
id are leaves too, come first in their source, and are never tampered with. An
empty table has no root and no rows. Texts of any length are hashed whole; only
digests are moved. Columns other than the hashed ones are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusprep.operators.lookup import lookup_join
from corpusprep.operators.order import global_index
from corpusprep.session import stage

FANOUT = 16  # fixed value
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BROADCAST_ROW = 64 << 10  # as if a row had this size: record tables beyond 2,048 rows are shuffled


def digest(*parts: Column) -> Column:
    """Hex sha256 of the parts laid end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its byte count, a colon and its value, or ``-`` for null."""

    def entry(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*[entry(f) for f in fields])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _height(n: int) -> int:
    """Steps from a root to its ``n`` leaves."""
    steps = 0
    while n > 1:
        n, steps = -(-n // FANOUT), steps + 1
    return steps


def _runs(nodes: DataFrame) -> DataFrame:
    """Parents ``(tree, place, digest, n, children)`` of nodes; a group holds at most 16."""
    ordered = F.array_sort(F.collect_list(F.struct("place", "digest")))
    whole = nodes.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("place")).agg(
        ordered["digest"].alias("children"), F.ceil(F.first("n") / FANOUT).alias("n")
    )
    return whole.withColumn("digest", digest(F.array_join("children", "")))


def fold(leaves: DataFrame, height: int, label: str) -> tuple[DataFrame | None, DataFrame]:
    """All records and the top ``(tree, digest, height)`` of each tree over ``(tree, place, digest, n)``.

    Every level is staged; it has a sixteenth of the rows of the one below.
    """
    nodes, levels, tops = leaves, [], []
    for step in range(height + 1):
        top = nodes.filter(F.col("n") == 1)
        tops.append(top.select("tree", "digest", F.lit(step).alias("height")))
        if step < height:
            nodes = stage(_runs(nodes.filter(F.col("n") > 1)), f"{label}-{step + 1}")
            levels.append(nodes.select("digest", "children"))
    records = reduce(DataFrame.unionByName, levels) if levels else None
    return records, reduce(DataFrame.unionByName, tops)


@dataclass(frozen=True)
class Manifest:
    """``records (digest, children)``, the subroots ``trees (tree, digest, height, place)`` and the root over them."""

    records: DataFrame
    trees: DataFrame
    root: str | None
    height: int  # of the tree over the subroots
    deepest: int  # of the trees below


def build(leaves: DataFrame) -> Manifest:
    """The manifest of staged leaves ``(tree, place, digest, n)``, ``n`` being the leaves of the tree."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    deepest = _height(most)
    below, tops = fold(leaves.select("tree", "place", "digest", "n"), deepest, "merkle")
    order = [F.col("tree").asc_nulls_first()]
    trees = stage(global_index(tops, order, out="place", total="n"), "subroots")
    count = trees.agg(F.max("n")).first()[0] or 0
    height = _height(count)
    above, root = fold(trees.select(F.lit(0).alias("tree"), "place", "digest", "n"), height, "subroots")
    found = [r for r in (below, above) if r is not None]
    empty = leaves.select("digest", F.array("digest").alias("children")).limit(0)
    records = reduce(DataFrame.unionByName, found).dropDuplicates(["digest"]) if found else empty
    first = root.select("digest").first() if count else None
    return Manifest(stage(records, "records"), trees.drop("n"), first and first["digest"], height, deepest)


def _bit(digit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), digit.cast("int"))


def _wanted(requests: DataFrame, steps: int) -> DataFrame:
    """Nodes ``steps`` above the requested leaves, each with a mask of the children that lead to them."""
    width = FANOUT ** (steps - 1)
    digit = F.floor(F.col("place") / width) % FANOUT
    node = F.floor(F.col("place") / (width * FANOUT)).alias("place")
    return requests.groupBy("tree", node).agg(F.bit_or(_bit(digit)).alias("mask"))


def _others(children: Column, digit: Column) -> Column:
    """The children before and after the selected one, each laid end to end."""
    before = F.array_join(F.slice(children, F.lit(1), digit), "")
    after = F.array_join(F.slice(children, digit + 2, F.size(children)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def descend(records: DataFrame, tops: DataFrame, requests: DataFrame, height: int) -> DataFrame:
    """``(tree, place, digest, path, top, payload)`` of each request ``(tree, place, payload)``.

    ``tops`` holds ``(tree, digest, height, path)``: where to start and what led
    there. ``path`` lists the segments from the root down, ``top`` is the digest
    of the tree. A request names a leaf by its rank; there is at most one for
    each leaf.
    """
    zero = F.lit(0).cast("bigint").alias("place")
    start = tops.select("tree", zero, "digest", "path", F.col("digest").alias("top"), "height")
    # Trees of a single leaf are their own top.
    alone = start.filter(F.col("height") == 0).join(requests, ["tree", "place"])
    answers = alone.select("tree", "place", "digest", "path", "top", "payload")
    at = None
    for steps in range(height, 0, -1):
        begun = start.filter(F.col("height") == steps).drop("height")
        at = begun if at is None else at.unionByName(begun)
        last = steps == 1
        if last:
            digit = (F.col("place") % FANOUT).cast("int").alias("digit")
            mine = F.collect_list(F.struct(digit, F.col("payload"))).alias("asked")  # 16 at most
            wanted = requests.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("place")).agg(mine)
        else:
            wanted = _wanted(requests, steps)
        met = lookup_join(at.join(wanted, ["tree", "place"]), records, "digest", "inner", row_bytes=_BROADCAST_ROW, skewed=False)
        if last:
            selected = F.explode("asked")
        else:
            digits = F.sequence(F.lit(0), F.size("children") - 1)
            selected = F.explode(F.filter(digits, lambda d: F.col("mask").bitwiseAND(_bit(d)) != 0))
        chosen = met.select("tree", "place", "children", "path", "top", selected.alias("one"))
        digit = F.col("one.digit") if last else F.col("one")
        at = chosen.select(
            "tree",
            (F.col("place") * FANOUT + digit).alias("place"),
            F.get("children", digit).alias("digest"),
            F.concat("path", F.array(_others(F.col("children"), digit))).alias("path"),
            "top",
            *([F.col("one.payload").alias("payload")] if last else []),
        )
    return answers if at is None else at.unionByName(answers)


_PATH = "array<struct<before:string,after:string>>"


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``descend`` from the manifest's root to the leaves ``(tree, place)``, through the subroots."""
    spark = requests.sparkSession
    root = spark.createDataFrame([(0, manifest.root, manifest.height, [])], f"tree int, digest string, height int, path {_PATH}")
    asked = manifest.trees.select(
        F.lit(0).alias("tree"), "place", F.struct("tree", "height").alias("payload")
    )
    subroots = descend(manifest.records, root, asked, manifest.height)
    tops = subroots.select("payload.tree", "digest", "payload.height", "path")
    return descend(manifest.records, tops, requests, manifest.deepest)


def siblings(path: Column) -> Column:
    """Digests that a proof lists: level by level from the leaf up, each from left to right."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["before"], s["after"])), "")


def folded(digest_: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(F.reverse(path), digest_, lambda at, s: digest(s["before"], at, s["after"]))


def write_manifest(manifest: Manifest, path: str) -> None:
    """Keep a manifest as three Parquet tables below ``path``."""
    manifest.records.write.parquet(f"{path}/records")
    manifest.trees.write.parquet(f"{path}/trees")
    head = [(manifest.root, manifest.height, manifest.deepest)]
    spark = manifest.records.sparkSession
    spark.createDataFrame(head, "root string, height int, deepest int").coalesce(1).write.parquet(f"{path}/head")


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    head = spark.read.parquet(f"{path}/head").first()
    records, trees = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/trees")
    return Manifest(records, trees, head["root"], head["height"], head["deepest"])


def placed_leaves(docs: DataFrame) -> DataFrame:
    """Leaves ``(tree, place, digest, n, doc_id, shown)`` of documents, staged.

    ``shown`` is the digest of the tampered row where the id's checksum asks for one, else null.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = leaf([*fields[:-1], lower_ascii(fields[-1])])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    # Texts are read once, for their digests.
    rows = stage(
        docs.select(
            F.struct("source").alias("tree"), "doc_id", leaf(fields).alias("digest"), F.when(tampered, changed).alias("shown")
        ),
        "leaves",
    )
    return stage(global_index(rows, ["doc_id", "digest"], by=["tree"], out="place", total="n"), "placed")


def op11(docs: DataFrame) -> DataFrame:
    """The contract's columns: every row is a leaf and a request."""
    leaves = placed_leaves(docs)
    manifest = build(leaves)
    proofs = prove(manifest, leaves.select("tree", "place", F.struct("doc_id", "shown").alias("payload")))
    root = F.lit(manifest.root).cast("string")
    again = folded(F.coalesce("payload.shown", "digest"), F.col("path"))
    found = proofs.select(
        F.col("payload.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        root.alias("root"),
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        again.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(levels: int = 6) -> str:
    """The same rows in DuckDB's SQL, for up to 16 ** ``levels`` rows a source and as many sources."""
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    plain = " || ".join(field.format(c) for c in FIELDS)
    changed = " || ".join(field.format(c) for c in (*FIELDS[:-1], f"translate(text, '{_UPPER}', '{_LOWER}')"))
    # CRC-32 of the id's digits, bit by bit.
    bit = "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    bytes_ = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), {byte}), 4294967295)"
    parts = [
        f"""WITH RECURSIVE l0 AS (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
                 count(*) OVER (PARTITION BY source) AS n, digest AS top
          FROM (SELECT doc_id, source, sha256({plain}) AS digest,
                       CASE WHEN {crc} % 5 = 0 THEN sha256({changed}) END AS shown FROM documents))"""
    ]

    def rise(name: str, key: str, count: int) -> None:
        for i in range(count):
            parts.append(
                f"""{name}{i + 1} AS (
          SELECT {key}, place // 16 AS place, (n + 15) // 16 AS n,
                 CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest
          FROM {name}{i} GROUP BY {key}, place // 16, n)"""
            )

    rise("l", "source", levels)
    parts.append(
        f"""t0 AS (SELECT 0 AS tree, source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
                 count(*) OVER () AS n FROM l{levels})"""
    )
    rise("t", "tree", levels)

    def climb(name: str, level: str, place: str, same: str, before: str) -> str:
        """The digests to the left and the right of a node in its run, and what they fold to."""
        parts.append(
            f"""{name} AS (
          SELECT b.doc_id, b.source, b.leaf, b.place, b.subplace, b.proof || coalesce(x.l, '') || coalesce(x.r, '') AS proof,
                 CASE WHEN x.n > 1 THEN sha256(coalesce(x.l, '') || b.now || coalesce(x.r, '')) ELSE b.now END AS now
          FROM {before} b JOIN (
            SELECT a.{same}, a.place, a.n, string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < a.place) AS l,
                   string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > a.place) AS r
            FROM {level} a JOIN {level} o
              ON a.{same} IS NOT DISTINCT FROM o.{same} AND a.place // 16 = o.place // 16
            GROUP BY a.{same}, a.place, a.n) x
          ON x.place = {place} AND {'x.tree = 0' if same == 'tree' else 'x.source IS NOT DISTINCT FROM b.source'})"""
        )
        return name

    parts.append(
        """b0 AS (SELECT l0.doc_id, l0.source, l0.digest AS leaf, l0.place, t0.place AS subplace, '' AS proof,
                 coalesce(l0.shown, l0.digest) AS now
          FROM l0 JOIN t0 ON l0.source IS NOT DISTINCT FROM t0.source)"""
    )
    at = "b0"
    for i in range(levels):
        at = climb(f"c{i}", f"l{i}", f"b.place // {16**i}", "source", at)
    for i in range(levels):
        at = climb(f"d{i}", f"t{i}", f"b.subplace // {16**i}", "tree", at)
    return (
        ", ".join(parts)
        + f""" SELECT {at}.doc_id, leaf, t0.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256,
          now AS folded_root, now = r.digest AS verified
        FROM {at} JOIN t0 ON {at}.source IS NOT DISTINCT FROM t0.source, t{levels} r"""
    )


SQL = _sql()
