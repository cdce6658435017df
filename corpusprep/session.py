"""Session defaults and the shared folder that staged tables live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from corpusprep.sources.files import remove


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusprep")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when the master is local, where the
    driver and the executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="corpusprep-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def _stage_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/corpusprep/{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application staged; DataFrames that read it stop working."""
    remove(spark, _stage_dir(spark))


_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def stage_path(spark: SparkSession, label: str = "stage") -> str:
    """A new place in the shared folder, below the one that ``clear_staged`` deletes."""
    path = f"{_stage_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _SCOPES.get()[-1:]:
        scope.append(path)
    return path


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block at its end; for jobs that go on for long."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in paths:
            remove(spark, path)


def stage(df: DataFrame, label: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of that table.

    Cuts lineage, survives lost executors, and later passes read only the
    columns they need.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
