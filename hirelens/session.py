"""Session for local runs (tests, bench) and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(app: str = "hirelens", cores: str | int = "*", partitions: int = 8,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A single-JVM session on loopback; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.hirelens.scanPartitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def short_methods(spark: SparkSession, limit: int = 8000) -> None:
    """In this session, no whole-stage code with methods of more than ``limit`` bytes of byte code.

    The JVM never compiles longer ones (its HugeMethodLimit) but interprets them for good; Spark then runs
    the operators one by one, whose code is cut into short methods.
    """
    if int(spark.conf.get(METHOD_LIMIT)) > limit:
        spark.conf.set(METHOD_LIMIT, str(limit))


TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def finer_tasks(spark: SparkSession, size: str = "4MB") -> Iterator[None]:
    """Within it, adaptive execution merges shuffle partitions up to ``size`` only, unless the job sets a size itself.

    It counts bytes, 64 MB a task: of short texts with much work a row that is a minute a task, with cores idle at the end.
    """
    if spark.conf.get(TASK_BYTES, None) is not None:
        yield
        return
    spark.conf.set(TASK_BYTES, size)
    try:
        yield
    finally:
        spark.conf.unset(TASK_BYTES)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without the setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_root
    if _local_root is None or not os.path.isdir(_local_root):
        _local_root = tempfile.mkdtemp(prefix="hirelens-")
    return _local_root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


_local_root: str | None = None
