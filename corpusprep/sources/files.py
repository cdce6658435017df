"""Listing and small texts through the Hadoop file system that the session reads with."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def is_file(spark: SparkSession, path: str) -> bool:
    fs, place = _path(spark, path)
    return fs.exists(place) and fs.getFileStatus(place).isFile()


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _path(spark, path)
    return fs.exists(place)


def any_file(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether there is a file of that ending anywhere below a directory; the listing stops at the first."""
    fs, place = _path(spark, path)
    if not fs.exists(place):
        return False
    found = fs.listFiles(place, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory."""
    fs, place = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _path(spark, path)
    fs.delete(place, True)


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and bytes of the files directly in a directory."""
    fs, place = _path(spark, path)
    found = fs.listStatus(place) if fs.exists(place) else []
    return {s.getPath().getName(): s.getLen() for s in found if s.isFile()}


def read_text(spark: SparkSession, path: str) -> str:
    fs, place = _path(spark, path)
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old text or the new one, never a part."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, place = _path(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
        out.hsync()
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), hadoop)
    context.rename(temporary, fs.makeQualified(place), options)
