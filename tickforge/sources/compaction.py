"""Compaction: the many small files of closed months become few sorted ones.

1. ``compact`` writes the merged files to a folder readers do not list, then one marker that
   names the files they replace. Until the marker is there, nothing has happened.
2. ``read_compacted`` follows the markers; plain readers still see the old files. Both give
   the same rows, and files appended meanwhile are seen by both.
3. ``sweep``, called when no plain reader is at work, moves the merged files to their months,
   removes the old ones and then the marker. It can be repeated after a failure at any point.

One compaction runs at a time. File names of the months at hand come to the driver, as
they do in every listing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.schemas import HISTORY_COLUMNS, HISTORY_SCHEMA, MONTH
from tickforge.sources.upsert import located, stored_months
from tickforge.sources.writers import SYMBOL_FILTER, by_symbol

BY_MONTH = T.StructType([*HISTORY_SCHEMA.fields, T.StructField(MONTH, T.StringType())])
FILE_BYTES = 256 * 2**20
#: Spark's readers skip folders with an underscore.
WORK = "_compaction"
COMMITTED = ".commit"


def _children(spark: SparkSession, path: str) -> dict[str, int]:
    """Names below a folder with their sizes; none if it does not exist."""
    files, place = located(spark, path)
    return {s.getPath().getName(): s.getLen() for s in files.listStatus(place)} if files.exists(place) else {}


def _data_files(spark: SparkSession, folder: str) -> dict[str, int]:
    return {n: size for n, size in _children(spark, folder).items() if n.endswith(".parquet") and n[0] not in "._"}


def _month_files(spark: SparkSession, root: str) -> list[str]:
    """Data files below a folder, as month folder and name."""
    months = [m for m in _children(spark, root) if m.startswith(f"{MONTH}=")]
    return [f"{m}/{n}" for m in sorted(months) for n in sorted(_data_files(spark, f"{root}/{m}"))]


def _commits(spark: SparkSession, history: str) -> dict[str, list[str]]:
    """Names of committed compactions that are not swept yet, with the files they replace."""
    names = [n for n in _children(spark, f"{history}/{WORK}") if n.endswith(COMMITTED)]
    read = spark.read.schema("replaced array<string>")
    return {n.removesuffix(COMMITTED): read.json(f"{history}/{WORK}/{n}").first()["replaced"] for n in names}


def _write_marker(spark: SparkSession, path: str, content: dict) -> None:
    """The marker appears whole or not at all."""
    files, unfinished = located(spark, f"{path}.unfinished")
    out = files.create(unfinished, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if not files.rename(unfinished, located(spark, path)[1]):
        raise OSError(f"cannot commit {path}")


def _read(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(BY_MONTH).option("basePath", base).parquet(*[f"{base}/{p}" for p in paths])


def closed_months(spark: SparkSession, history: str, before: str) -> list[str]:
    """Stored months before the month ``before`` (yyyy-MM)."""
    return [m for m in stored_months(spark, history) if m < before]


def compact(spark: SparkSession, history: str, months: list[str], file_bytes: int = FILE_BYTES) -> str | None:
    """Rewrites months that hold more files than their size asks for; the name of the compaction, None if there is none.

    Files are cut by ranges of (month, symbol, time), so one symbol with most of a month is
    spread over several, and sorted within.  Raises if the merged files hold another number
    of rows, or if an earlier compaction waits to be swept.
    """
    if _commits(spark, history):
        raise RuntimeError("sweep the last compaction first")
    replaced, parts = [], 0
    for month in months:
        found = _data_files(spark, f"{history}/{MONTH}={month}")
        wanted = max(1, -(-sum(found.values()) // file_bytes))
        # A cut may fall within a month, so it may hold one file more.
        if len(found) > wanted + 1 or (wanted == 1 and len(found) == 2):
            replaced += [f"{MONTH}={month}/{n}" for n in sorted(found)]
            parts += wanted
    if not replaced:
        return None
    name = uuid.uuid4().hex
    merged = f"{history}/{WORK}/{name}"
    old = _read(spark, history, replaced)
    dealt = old.repartitionByRange(parts, MONTH, "symbol", "scrape_time")
    by_symbol(dealt).write.options(**SYMBOL_FILTER).partitionBy(MONTH).parquet(merged)
    if old.count() != spark.read.schema(BY_MONTH).parquet(merged).count():
        raise RuntimeError("the merged files do not hold the rows of the old ones")
    _write_marker(spark, f"{merged}{COMMITTED}", {"replaced": replaced})
    return name


def read_compacted(spark: SparkSession, history: str) -> DataFrame:
    """The history with merged files in place of those they replace, swept or not.

    Merged files are listed before the months, and what has been moved meanwhile is read from its
    month, so no row is missed or read twice.  A file removed after the listing fails the scan.
    """
    commits = _commits(spark, history)
    if not commits:
        return spark.read.schema(BY_MONTH).parquet(history).select(*HISTORY_COLUMNS)
    waiting = {name: _month_files(spark, f"{history}/{WORK}/{name}") for name in commits}
    replaced = {f for files in commits.values() for f in files}
    touched = {f.split("/")[0] for f in replaced}
    folders = [m for m in _children(spark, history) if m.startswith(f"{MONTH}=")]
    current = [f"{m}/{n}" for m in sorted(touched.intersection(folders)) for n in _data_files(spark, f"{history}/{m}")]
    paths = [m for m in folders if m not in touched] + [f for f in current if f not in replaced]
    frames = [_read(spark, history, paths)] if paths else []
    for name, files in waiting.items():
        left = [f for f in files if f not in set(current)]
        frames += [_read(spark, f"{history}/{WORK}/{name}", left)] if left else []
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.unionByName(more)
    return rows.select(*HISTORY_COLUMNS)


def sweep(spark: SparkSession, history: str) -> None:
    """Puts committed files into their months and removes what they replace, and what was never committed."""
    for name, replaced in _commits(spark, history).items():
        merged = f"{history}/{WORK}/{name}"
        for file in _month_files(spark, merged):
            files, target = located(spark, f"{history}/{file}")
            if not files.rename(located(spark, f"{merged}/{file}")[1], target):
                raise OSError(f"cannot move {file}")
        for file in replaced:
            files, old = located(spark, f"{history}/{file}")
            files.delete(old, False)
        files, marker = located(spark, f"{merged}{COMMITTED}")
        files.delete(marker, False)
    files, work = located(spark, f"{history}/{WORK}")
    files.delete(work, True)
