"""Files that tasks open themselves, in the file system Spark resolves a path to."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Qualified name and size of the data files at ``path``: a file, a folder or a pattern."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in store.globStatus(where) or []:
        inside = store.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(f.getPath().toString(), f.getLen()) for f in inside if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    if not found:
        raise FileNotFoundError(f"no files at {path}")
    return sorted(found)


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a qualified name."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)
