"""Files at given paths on any store that Hadoop knows: looking, writing, and joining what Spark wrote in parts into one file."""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """(file system, path). Local files are taken without the checksums that would forbid editing them by hand."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        fs = spark._jvm.org.apache.hadoop.fs.RawLocalFileSystem()
        fs.initialize(spark._jvm.java.net.URI.create("file:///"), spark._jsc.hadoopConfiguration())
    return fs, p


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern, in order."""
    fs, p = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).isDirectory()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def one_file(df: DataFrame, path: str, kind: str, head: str = "", **options: object) -> None:
    """Write `df` as one file at `path`, in its order. The parts are written by all tasks and then copied one behind the other as a stream,
    so neither a task nor the driver holds the table. What was at the path is replaced last, so that `df` may come from it."""
    spark = df.sparkSession
    parts, fresh = (f"{path}.{x}-{uuid.uuid4().hex}" for x in ("parts", "new"))
    df.write.format(kind).options(**options).save(parts)
    fs, target = _at(spark, path)
    try:
        out = fs.create(_at(spark, fresh)[1], True)
        try:
            out.write(bytearray(head.encode()))
            for part in found(spark, f"{parts}/part-*"):
                src = fs.open(_at(spark, part)[1])
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(src, out, 1 << 16, False)
                src.close()
        finally:
            out.close()
        fs.delete(target, True)
        fs.rename(_at(spark, fresh)[1], target)
    finally:
        fs.delete(_at(spark, parts)[1], True)
