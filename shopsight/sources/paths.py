"""Path operations through Hadoop's FileSystem: local disk, HDFS, object stores."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _resolve(spark, source)
    _, dst = _resolve(spark, target)
    if fs.exists(dst):
        raise FileExistsError(f"Cannot rename '{source}': '{target}' exists.")
    if not fs.rename(src, dst):
        raise OSError(f"Could not rename '{source}' to '{target}'.")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)


def parent(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0] or "/"


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if it does not exist."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; raises if the name is taken."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    fs, p = _resolve(spark, temporary)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        rename(spark, temporary, path)
    except BaseException:
        delete(spark, temporary)
        raise


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of last change in milliseconds) of what is in a folder; empty if there is none."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p))
