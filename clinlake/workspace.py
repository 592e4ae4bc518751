"""Where jobs put intermediate tables, and small file-system look-ups."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting falls back to a temporary folder, because driver and executors
    are then the same machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        root = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[app] = root
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never the same one twice."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path, or at least one match of the glob, exists."""
    hadoop_path, fs = _hadoop_path(spark, path)
    matches = fs.globStatus(hadoop_path)
    return matches is not None and len(matches) > 0


def canonical(spark: SparkSession, path: str) -> str:
    """The form of a path in which Spark reports the files below it; plain for local paths."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return plain_local(fs.makeQualified(hadoop_path).toUri().toString())


def qualified(spark: SparkSession, path: str) -> str:
    """The full path as it is written, without escapes."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def plain_local(uri: str) -> str:
    return re.sub("^file:/+", "/", uri)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder is missing."""
    hadoop_path, fs = _hadoop_path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """All paths that match a glob, from one look-up."""
    hadoop_path, fs = _hadoop_path(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(hadoop_path) or [])


def modified_at(spark: SparkSession, path: str) -> int:
    """Modification time of a path in epoch milliseconds."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return int(fs.getFileStatus(hadoop_path).getModificationTime())


def drop_tree(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop file system."""
    hadoop_path, fs = _hadoop_path(spark, path)
    return bool(fs.delete(hadoop_path, True))
