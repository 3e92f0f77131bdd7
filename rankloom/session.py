"""Session builder and shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "rankloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution on; ``master`` is only for local runs."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    _ship_package(spark)
    return spark


_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Give the workers this package, which need not be installed where they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="rankloom-"), "rankloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("rankloom", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only where a local session names none (tests) a temporary one is made, and it is
    then set on the session so later calls agree; a cluster without one is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        configured = tempfile.mkdtemp(prefix="rankloom-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
