"""Dataset and metric snapshots by step, committed in two phases.

A save first writes its files to a folder of its own, then one manifest that
names the folder, its files and the schema. The manifest appears by a rename,
whole or not at all, and only what a manifest names is ever read: a save that
was killed leaves files that nobody sees. Retention goes the other way round:
the manifest goes first, then the files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpusprep.operators.metrics import retain_latest
from corpusprep.sources.files import children, exists, read_text, remove, replace_text, sizes

KEEP = 3  # fixed value
_MANIFESTS, _DATA = "manifests", "data"


@dataclass(frozen=True)
class SnapshotManifest:
    step: int
    folder: str  # below the root
    files: dict[str, int]  # names and bytes
    schema: str

    def path(self, root: str) -> str:
        return f"{root}/{_DATA}/{self.folder}"


def _manifest_path(root: str, step: int) -> str:
    return f"{root}/{_MANIFESTS}/step={step}.json"


def _data_files(spark: SparkSession, path: str) -> dict[str, int]:
    return {n: size for n, size in sizes(spark, path).items() if not n.startswith(("_", "."))}


def read_manifest(spark: SparkSession, root: str, step: int) -> SnapshotManifest:
    return SnapshotManifest(**json.loads(read_text(spark, _manifest_path(root, step))))


def snapshot_steps(spark: SparkSession, root: str) -> list[int]:
    """Steps with a committed snapshot, ascending."""
    names = [n.removeprefix("step=").removesuffix(".json") for n in children(spark, f"{root}/{_MANIFESTS}")]
    return sorted(int(n) for n in names if n.isdigit())


def prepare_snapshot(df: DataFrame, root: str, step: int) -> SnapshotManifest:
    """First phase: write the files of a step to a new folder."""
    folder = f"step={step}-{uuid.uuid4().hex}"
    path = f"{root}/{_DATA}/{folder}"
    df.write.parquet(path)
    return SnapshotManifest(step, folder, _data_files(df.sparkSession, path), df.schema.json())


def commit_snapshot(spark: SparkSession, root: str, manifest: SnapshotManifest) -> None:
    """Second phase: the step is this manifest's from now on; an older save of the step is dropped."""
    before = read_manifest(spark, root, manifest.step) if manifest.step in snapshot_steps(spark, root) else None
    replace_text(spark, _manifest_path(root, manifest.step), json.dumps(asdict(manifest)))
    if before and before.folder != manifest.folder:
        remove(spark, before.path(root))


def drop_snapshot(spark: SparkSession, root: str, step: int) -> None:
    """Forget a step, then delete its files."""
    manifest = read_manifest(spark, root, step)
    remove(spark, _manifest_path(root, step))
    remove(spark, manifest.path(root))


def save_snapshot(df: DataFrame, root: str, step: int, keep: int = KEEP) -> str:
    """Commit a snapshot of ``df`` as ``step``, then drop all but the newest ``keep``; returns its folder."""
    spark = df.sparkSession
    manifest = prepare_snapshot(df, root, step)
    commit_snapshot(spark, root, manifest)
    table = spark.createDataFrame([(s,) for s in snapshot_steps(spark, root)], "step bigint")
    kept = {r["step"] for r in retain_latest(table, keep).collect()}
    for old in snapshot_steps(spark, root):
        if old not in kept:
            drop_snapshot(spark, root, old)
    return manifest.path(root)


def remove_abandoned(spark: SparkSession, root: str) -> list[str]:
    """Delete folders that no manifest names, left by killed saves; only while no save runs."""
    named = {read_manifest(spark, root, s).folder for s in snapshot_steps(spark, root)}
    left = sorted(n for n in children(spark, f"{root}/{_DATA}") if n not in named)
    for folder in left:
        remove(spark, f"{root}/{_DATA}/{folder}")
    return left


def latest_snapshot(spark: SparkSession, root: str) -> int | None:
    """The newest committed step, or None; step 0 is a step like any other."""
    steps = snapshot_steps(spark, root)
    return steps[-1] if steps else None


def load_snapshot(spark: SparkSession, root: str, step: int | None = None) -> DataFrame:
    """The snapshot of ``step``, or the newest one: exactly the files of its manifest."""
    step = latest_snapshot(spark, root) if step is None else step
    if step is None or not exists(spark, _manifest_path(root, step)):
        raise FileNotFoundError(f"no snapshot{'' if step is None else f' of step {step}'} in {root}")
    manifest = read_manifest(spark, root, step)
    path = manifest.path(root)
    found = _data_files(spark, path)
    wrong = sorted(n for n, size in manifest.files.items() if found.get(n) != size)
    if wrong:
        raise OSError(f"snapshot of step {step} in {root} lacks {wrong[0]} and {len(wrong) - 1} more files as committed")
    schema = StructType.fromJson(json.loads(manifest.schema))
    if not manifest.files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in sorted(manifest.files)])
