"""Small file-system steps through Hadoop's API, for any store Spark can write to."""

from __future__ import annotations

from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of ``path``, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop(spark, path)
    return fs.exists(where)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder or file this library wrote, once what it was for is done."""
    fs, where = hadoop(spark, path)
    fs.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; none if it is absent."""
    fs, where = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a small file such as a pointer or a mark."""
    fs, where = hadoop(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: it is written beside and renamed. An existing one raises."""
    fs, where = hadoop(spark, path)
    beside = where.suffix(".writing")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(where) or not fs.rename(beside, where):
        fs.delete(beside, False)
        raise FileExistsError(path)


def folders_of(spark: SparkSession, files: list[str], root: str) -> list[str]:
    """Folders of files as Spark lists them (encoded addresses), relative to ``root``; ``""`` for the root itself."""
    fs, where = hadoop(spark, root)
    base = fs.makeQualified(where).toUri().getPath().rstrip("/")
    return sorted({unquote(urlsplit(file).path).rsplit("/", 1)[0].removeprefix(base).strip("/") for file in files})
