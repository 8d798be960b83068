"""File system steps through Hadoop, so any storage Spark can write to works."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    hadoop_path, fs = _path(spark, path)
    target, _ = _path(spark, new)
    fs.mkdirs(target.getParent())
    if not fs.rename(hadoop_path, target):
        raise OSError(f"{path} could not be renamed to {new}")


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; 0 if there is none."""
    hadoop_path, fs = _path(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is none."""
    hadoop_path, fs = _path(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless there is one; of two writers one is told False."""
    hadoop_path, fs = _path(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    try:
        out = fs.create(hadoop_path, False)
    except Py4JJavaError:
        if fs.exists(hadoop_path):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is none."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        io = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils
        return bytes(io.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()
