"""Folder operations on the cluster file system (Hadoop FileSystem through the session).

Used only for metadata work of the publish step (replace a day folder by its
staged copy) and for listing; data is always read and written by Spark jobs.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    d = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    if not fs.rename(s, d):
        raise IOError(f"could not move {src} to {dst}")


def copy(spark: SparkSession, src: str, dst: str) -> None:
    """Copy one (small) file, creating the target folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs, s = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    dfs = d.getFileSystem(conf)
    dfs.mkdirs(d.getParent())
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(fs, s, dfs, d, False, conf):
        raise IOError(f"could not copy {src} to {dst}")


def list_children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def read_text(spark: SparkSession, path: str, encoding: str = "utf-8") -> str:
    """Read a small file on the driver (any file system the cluster knows)."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    if not fs.exists(p) or not fs.getFileStatus(p).isFile():
        raise FileNotFoundError(path)
    stream = fs.open(p)
    try:
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode(encoding)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file (test faults, markers)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def create_new(spark: SparkSession, path: str, content: str) -> bool:
    """Put a small file if there is none of this name; False if another writer was first.

    The file is read back: on a file system whose exclusive create is no single step the last writer wins,
    and the other one sees that.
    """
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as taken:
        if fs.exists(p):
            return False
        raise taken
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    return read_text(spark, path) == content
