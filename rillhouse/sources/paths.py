"""File-system helpers that work on whatever store the path names (HDFS, object store, local)."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def from_uri(spark: SparkSession, uri: str) -> str:
    """The path of a file as a scan's metadata names it, in which special characters are encoded."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under ``path``."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isFile())


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _fs(spark, source)
    _, to = _fs(spark, target)
    if not fs.rename(where, to):
        raise OSError(f"cannot move {source} to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file over another one in a single step."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fs, where = _fs(spark, source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        where.toUri() if where.toUri().getScheme() else fs.getUri(),
        spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(where, _fs(spark, target)[1], options)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A directory whose write job committed."""
    return exists(spark, f"{path}/_SUCCESS")


def _glob(spark: SparkSession, path: str, below: str) -> list:
    fs, where = _fs(spark, re.sub(r"([\[\]{}*?\\])", r"\\\1", path) + below)
    return list(fs.globStatus(where) or [])


def completed(spark: SparkSession, path: str) -> dict[str, float]:
    """Directories right under ``path`` whose write job committed, and when (epoch seconds)."""
    return {s.getPath().getParent().getName(): s.getModificationTime() / 1000
            for s in _glob(spark, path, "/*/_SUCCESS")}


def grandchildren(spark: SparkSession, path: str, child: str) -> list[tuple[str, str]]:
    """(directory, directory in it) two levels under ``path``; the inner names begin with ``child``."""
    return sorted((s.getPath().getParent().getName(), s.getPath().getName())
                  for s in _glob(spark, path, f"/*/{child}*"))


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``.

    Where that setting is absent a local temporary folder is used, gone when the driver ends;
    that works on one machine only, so a cluster without the setting is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    return f"{_local_root()}/{label}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="rillhouse-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root
