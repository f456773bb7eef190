"""Compaction of small appends: fewer files, the same rows for every reader at every step."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickforge.sources import compaction as K
from tickforge.sources.readers import read_history
from tickforge.sources.writers import append_history, append_new


@pytest.fixture(scope="module")
def days(bars):
    """Two months and a row without a day."""
    day = F.date_add(F.lit("1996-03-01").cast("date"), F.pmod(F.xxhash64("symbol", "scrape_time"), F.lit(61)).cast("int"))
    rows = bars.withColumn("trading_date", day)
    return rows.unionByName(rows.limit(1).withColumn("trading_date", F.lit(None).cast("date"))).coalesce(1).cache()


@pytest.fixture
def path(days, tmp_path):
    """A hundred small files a month, as many appends leave them."""
    root = str(tmp_path / "history")
    append_history(days.filter("trading_date IS NULL"), root)
    for month in ("1996-03", "1996-04"):
        rows = days.filter(F.date_format("trading_date", "yyyy-MM") == month)
        rows.repartition(100).write.parquet(f"{root}/history_month={month}")
    return root


def files(root, month):
    return sorted(Path(root, f"history_month={month}").glob("*.parquet"))


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_two_hundred_small_files_become_two(spark, days, path, history):
    assert sum(len(files(path, m)) for m in ("1996-03", "1996-04")) >= 190
    waiting = read_history(spark, path)
    assert K.closed_months(spark, path, "1996-05") == ["1996-03", "1996-04"]
    assert K.compact(spark, path, K.closed_months(spark, path, "1996-05"))
    assert same(waiting, days) and same(read_history(spark, path), days) and same(K.read_compacted(spark, path), days)
    late = history([("LATE", "1996-03-09 09:00", 1), ("LATE", "1996-06-03 09:00", 1)])
    append_new(days.unionByName(late), path)
    assert same(K.read_compacted(spark, path), days.unionByName(late))
    with pytest.raises(RuntimeError, match="sweep"):
        K.compact(spark, path, ["1996-03"])
    K.sweep(spark, path)
    assert len(files(path, "1996-03")) <= 3 and len(files(path, "1996-04")) <= 2
    for reader in (read_history, K.read_compacted):
        assert same(reader(spark, path), days.unionByName(late))


def test_a_run_lost_before_the_marker_changes_nothing(spark, days, path, monkeypatch):
    right = K._write_marker
    monkeypatch.setattr(K, "_write_marker", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        K.compact(spark, path, ["1996-03"])
    assert same(K.read_compacted(spark, path), days) and same(read_history(spark, path), days)
    monkeypatch.setattr(K, "_write_marker", right)
    K.sweep(spark, path)
    assert not Path(path, K.WORK).exists()
    assert K.compact(spark, path, ["1996-03"]) and same(K.read_compacted(spark, path), days)


def test_an_interrupted_sweep_is_finished_by_the_next(spark, days, path):
    name = K.compact(spark, path, ["1996-03", "1996-04"])
    moved = K._month_files(spark, f"{path}/{K.WORK}/{name}")[0]
    Path(path, K.WORK, name, moved).rename(Path(path, moved))
    files(path, "1996-04")[0].unlink()
    assert same(K.read_compacted(spark, path), days)
    K.sweep(spark, path)
    assert same(read_history(spark, path), days)


def test_files_have_the_target_size_and_few_symbols(spark, days, path):
    size = sum(f.stat().st_size for f in files(path, "1996-03"))
    assert K.compact(spark, path, ["1996-03"], size // 4)
    K.sweep(spark, path)
    left = files(path, "1996-03")
    assert 3 <= len(left) <= 5 and K.compact(spark, path, ["1996-03"]) is not None
    ranges = sorted(tuple(spark.read.parquet(str(f)).agg(F.min("symbol"), F.max("symbol")).first()) for f in left)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_nothing_to_do(spark, history, tmp_path):
    root = str(tmp_path / "history")
    append_history(history([("A", "2026-06-01 09:00", 1)]).coalesce(1), root)
    assert K.compact(spark, root, ["2026-06", "2026-07"]) is None
    assert K.read_compacted(spark, root).count() == 1
    K.sweep(spark, root)
