"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Shuffle files go when the query that made them ends, and files are written smaller.
SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


def build_session(app_name: str = "tickforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tested with.

    Shuffle width and join strategy are left to adaptive execution.  Extra
    settings are passed as keyword arguments with ``__`` for each dot, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    defaults.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a folder of
    its own under the machine's temporary directory.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = os.environ.get("TICKFORGE_LOCAL_SCRATCH") or tempfile.mkdtemp(prefix="tickforge-")
    os.environ["TICKFORGE_LOCAL_SCRATCH"] = folder
    return folder


@contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """Keeps the disk small for what is executed within.

    Spark drops shuffle files only when the driver has collected their plan as garbage, so the steps of a job
    would add up.  A frame executed twice within makes its shuffle files twice.
    """
    before = {key: spark.conf.get(key, None) for key in SPARING}
    for key, value in SPARING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
