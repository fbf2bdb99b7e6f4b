"""Small file-system helpers (existence, markers, sizes) over the Hadoop FileSystem of the running
Spark session, so that a path without a scheme means the same here as in Spark's own reads and writes."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _of(spark, path)
    return bool(fs.exists(hpath))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, hpath = _of(spark, path)
    fs.mkdirs(hpath)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (and its parent folders)."""
    fs, hpath = _of(spark, path)
    fs.create(hpath, True).close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a file or folder."""
    fs, hpath = _of(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder of our own; nothing happens if it is not there."""
    fs, hpath = _of(spark, path)
    fs.delete(hpath, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, hpath = _of(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one go, in place of one that is there."""
    fs, hpath = _of(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it is not there."""
    fs, hpath = _of(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Switch a small file to a new text: readers see the old one or the new one, never a part.
    The new text is written beside it and renamed over it in one step."""
    beside = f"{path}.{uuid.uuid4().hex[:8]}"
    write_text(spark, beside, text)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    _, old = _of(spark, path)
    fs, new = _of(spark, beside)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    at = fs.makeQualified(new).toUri()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at, spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(new), fs.makeQualified(old), how)
