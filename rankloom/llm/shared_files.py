"""Files that tasks write and read themselves, in the file system Spark resolves a path to."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority of the session's Hadoop configuration.

    A path without a scheme means the cluster's default file system, not the disk of whichever
    machine opens it.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(conf).makeQualified(hadoop).toString()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a qualified folder or file."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)
