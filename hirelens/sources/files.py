"""Folders and small files through Hadoop's file system API, so that any shared
store works (never ``open`` or ``os.path``)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern names."""
    found = _system(spark, pattern).globStatus(_path(spark, pattern))
    return [f.getPath().toString() for f in found or ()]


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _system(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a file; False if the new name is taken."""
    return not path_exists(spark, new) and _system(spark, old).rename(_path(spark, old), _path(spark, new))
