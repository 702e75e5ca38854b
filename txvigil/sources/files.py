"""Paths on whatever file system the cluster uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _open(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str, folders: bool = True) -> list[str]:
    """Names of the folders, or of everything, directly below."""
    files, target = _open(spark, path)
    found = [s for s in files.listStatus(target) if s.isDirectory() or not folders]
    return sorted(s.getPath().getName() for s in found)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below; 0 if there is nothing."""
    files, target = _open(spark, path)
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def remove(spark: SparkSession, path: str) -> None:
    files, target = _open(spark, path)
    files.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, None if there is none."""
    files, target = _open(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small file in place of another in one step."""
    files, target = _open(spark, path)
    fs = spark._jvm.org.apache.hadoop.fs
    fresh = fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, target, options)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which every executor can reach.

    It is removed when the session's JVM ends. A local session without that setting gets
    one folder of its own, also only until then; a cluster has to name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="txvigil-")
        spark.conf.set("spark.checkpoint.dir", root)
        _forget(spark, root)
    path = f"{root.rstrip('/')}/txvigil-{uuid.uuid4().hex}"
    _forget(spark, path)
    return path


def _forget(spark: SparkSession, path: str) -> None:
    files, target = _open(spark, path)
    files.deleteOnExit(target)
