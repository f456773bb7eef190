"""Streamed minute totals: any order of files gives the batch result plus the side table."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickforge.streaming import minutes as Y


def lists(df):
    return sorted(map(str, df.select("symbol", "trading_date", "minute", "value", "volume", "n").collect()))


@pytest.fixture(scope="module")
def snapshots():
    """Four files: three in order, one with rows long past and rows of open minutes."""
    rng = random.Random(8)
    start = datetime(2026, 3, 2, 9)
    files = []
    for part in range(3):
        files.append([("AB"[i % 2], str(start + timedelta(minutes=60 * part + rng.random() * 59)), rng.randint(1, 99), rng.randint(1, 10**6)) for i in range(60)])
    files.append([("A", str(start + timedelta(minutes=3, seconds=s)), 7, 5) for s in range(5)] + [
        ("B", str(start + timedelta(minutes=178, seconds=s)), 8, 5) for s in range(5)])
    return files


def run(spark, history, files, folder):
    landing, root = f"{folder}/landing", f"{folder}/root"
    for rows in files:
        df = history(rows)
        df.write.mode("append").parquet(landing)
        Y.stream_minutes(spark.readStream.schema(df.schema).parquet(landing), root).awaitTermination()
    return root


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (2, 0, 3, 1)])
def test_any_order_gives_the_batch_result(spark, history, snapshots, tmp_path, order):
    root = run(spark, history, [snapshots[i] for i in order], tmp_path)
    whole = history([r for f in snapshots for r in f])
    assert lists(Y.complete_totals(spark, root)) == lists(Y.minute_totals(whole))
    late = Y.read_late(spark, root)
    assert late.exceptAll(whole).count() == 0 and late.count() > 0
    if order == (0, 1, 2, 3):
        assert late.count() == 5 and {r[0] for r in late.select("symbol").collect()} == {"A"}
    before = lists(Y.read_totals(spark, root)), late.count()
    Y.stream_minutes(spark.readStream.schema(whole.schema).parquet(f"{tmp_path}/landing"), root).awaitTermination()
    assert (lists(Y.read_totals(spark, root)), Y.read_late(spark, root).count()) == before


def test_vwap_of_the_day(spark, history):
    rows = history([("A", "2026-03-02 09:00:10", 10, 1), ("A", "2026-03-02 09:00:50", 20, 3), ("A", "2026-03-02 09:07:00", 30, 4)])
    got = [(r["volume"], float(r["vwap"])) for r in Y.day_vwap(Y.minute_totals(rows)).orderBy("minute").collect()]
    assert got == [(4, 17.5), (4, 23.75)]


def test_rows_without_a_minute(spark, history, tmp_path):
    rows = history([("A", "2026-03-02 09:00:10", 10, 1), ("A", "2026-03-02 09:00:11", None, None)])
    odd = rows.withColumn("symbol", F.lit(None).cast("string")).unionByName(rows)
    odd.write.parquet(f"{tmp_path}/landing")
    Y.stream_minutes(spark.readStream.schema(odd.schema).parquet(f"{tmp_path}/landing"), f"{tmp_path}/root").awaitTermination()
    assert [(r["symbol"], float(r["value"]), r["volume"], r["n"]) for r in Y.read_totals(spark, f"{tmp_path}/root").collect()] == [("A", 10.0, 1, 2)]
    assert Y.read_late(spark, f"{tmp_path}/root").count() == 0


def test_python_is_called_per_slot_not_per_symbol(spark, history, tmp_path, monkeypatch):
    monkeypatch.setattr(Y, "SLOTS", 4)
    files = [[(f"S{i}", f"2026-03-02 09:{m:02}:{i:02}", 10 + i, i) for i in range(50)] for m in (1, 2)]
    root = run(spark, history, files, tmp_path)
    whole = history([r for f in files for r in f])
    assert lists(Y.complete_totals(spark, root)) == lists(Y.minute_totals(whole))
    assert 0 < spark.read.format("statestore").load(f"{root}/checkpoint").count() <= 4
