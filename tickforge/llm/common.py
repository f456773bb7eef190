"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole; workers of this session can import this package."""
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> None:
    """Adds this checkout to the import path of Python workers started from now on.

    A cluster that gets the package with ``--py-files`` or an archive does not need it.
    """
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([*paths, ROOT])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back, which cuts the lineage.

    A lost executor can then neither change nor recompute them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text modulo ``modulus``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def in_fold(key: str, modulus: int, remainder: int) -> Column:
    """True for keys of the fold; false for others and for null keys."""
    return F.coalesce(fold(key, modulus) == remainder, F.lit(False))


def out_of_fold(key: str, modulus: int, remainder: int) -> Column:
    """True for keys known to lie outside the fold; a null key is in neither part."""
    return F.coalesce(fold(key, modulus) != remainder, F.lit(False))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, also not in another case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def local_form(uri: str) -> tuple[object, str]:
    """File system and path for code that runs in tasks (local, shared mount, HDFS, object store)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)
