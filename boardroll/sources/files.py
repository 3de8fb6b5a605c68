"""Small files beside the tables, on whatever file system the path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None if there is no file."""
    where, files = _place(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another; a reader sees the old or the new one whole."""
    jvm, draft = spark.sparkContext._jvm, f"{path}.{uuid.uuid4().hex}"
    where, files = _place(spark, draft)
    stream = files.create(where)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(where, jvm.org.apache.hadoop.fs.Path(path), options)


def delete(spark: SparkSession, path: str) -> None:
    where, files = _place(spark, path)
    files.delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it is not there."""
    where, files = _place(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.isDirectory())
