"""Appends by high-water marks against appends that look up every key; row groups read for a few symbols."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickforge.operators.filters import for_symbols
from tickforge.schemas import MONTH, SNAPSHOT_KEY
from tickforge.sources import marks as H
from tickforge.sources.readers import read_history
from tickforge.sources.writers import append_history, append_new


@pytest.fixture(scope="module")
def some(bars):
    """A few months; some rows without a time, a symbol or a day, and repeated ones."""
    rows = bars.filter("trading_date BETWEEN '1996-03-01' AND '1996-05-31'").cache()
    odd = [rows.limit(3).withColumn(c, F.lit(None).cast(t)) for c, t in (
        ("scrape_time", "timestamp_ntz"), ("symbol", "string"), ("trading_date", "date"))]
    for more in odd:
        rows = rows.unionByName(more)
    return rows.unionByName(rows.limit(20)).coalesce(2).cache()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "history"), str(tmp_path / "marks")


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def spoil(root):
    """Replace data files by text; whoever opens one fails."""
    for file in Path(root).rglob("*.parquet"):
        file.write_text("not to be read")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def month_file_bytes(root):
    return {f: f.stat().st_size for f in Path(root).rglob("*.parquet")}


def test_equal_to_looking_up_every_key(spark, some, folder, tmp_path):
    late = F.coalesce(F.pmod(F.xxhash64("symbol", "scrape_time", "close"), F.lit(3)) == 0, F.lit(True))
    plain = str(tmp_path / "plain")
    for part in (some.filter(~late), some, some.filter(late), some.filter("false")):
        H.append_marked(part, *folder)
        append_new(part, plain)
        assert same(read_history(spark, folder[0]), read_history(spark, plain))
    assert read_history(spark, plain).groupBy(*SNAPSHOT_KEY).count().filter("count > 1").count() == 0


def test_a_fresh_batch_opens_no_old_data_file(spark, history, folder):
    H.append_marked(history([("A", "2026-06-01 09:00", 1), ("B", "2026-06-01 09:00", 2)]), *folder)
    old = month_file_bytes(folder[0])
    spoil(folder[0])
    fresh = history([("A", "2026-06-01 09:00:01", 3), ("C", "2026-06-01 08:00", 4), ("A", "2026-07-01 09:00", 5)])
    assert H.append_marked(fresh, *folder) == []
    for file in old:
        file.unlink()
    assert same(read_history(spark, folder[0]), fresh)


def test_late_and_repeated_rows_are_looked_up(spark, history, folder):
    first = history([("A", "2026-06-01 09:00", 1), ("A", "2026-07-01 09:00", 2)])
    H.append_marked(first, *folder)
    late = history([("A", "2026-06-01 08:00", 3)])
    assert H.append_marked(late.unionByName(first.filter("close = 1")), *folder) == ["2026-06"]
    assert same(read_history(spark, folder[0]), first.unionByName(late))


def test_a_history_without_marks_gets_them_first(spark, history, folder):
    first = history([("A", "2026-06-01 09:00", 1), ("B", "2026-06-01 09:00", 2)])
    append_history(first, folder[0])
    assert H.append_marked(first.filter("symbol = 'A'"), *folder) == ["2026-06"]
    assert H.append_marked(first, *folder) == ["2026-06"]
    assert same(read_history(spark, folder[0]), first)
    H.update_marks(spark, *folder)
    assert spark.read.parquet(folder[1]).count() == 2


def test_a_run_lost_between_marks_and_rows_is_made_good(spark, history, folder, monkeypatch):
    rows = history([("A", "2026-06-01 09:00", 1)])
    right = H.append_history
    monkeypatch.setattr(H, "append_history", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        H.append_marked(rows, *folder)
    monkeypatch.setattr(H, "append_history", right)
    H.append_marked(rows, *folder)
    H.append_marked(rows, *folder)
    assert same(read_history(spark, folder[0]), rows)


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_row_groups_of_other_symbols_are_skipped(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.format_string("S%06d", F.pmod(F.xxhash64("id"), F.lit(2000))).alias("symbol"), F.lit("2026-06-01").cast("date").alias("trading_date"),
        F.timestamp_seconds(F.col("id") + 1_780_000_000).cast("timestamp_ntz").alias("scrape_time"), F.lit("x").alias("source"),
        *[F.rand(i).cast("decimal(18,4)").alias(c) for i, c in enumerate(("close", "open", "high", "low"))], F.col("id").alias("volume"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("parquet.block.size")
    conf.set("parquet.block.size", str(1 << 18))
    try:
        append_history(rows, str(tmp_path / "sorted"))
        monthly = rows.withColumn(MONTH, F.lit("2026-06")).coalesce(1)
        monthly.write.partitionBy(MONTH).parquet(str(tmp_path / "mixed"))
    finally:
        conf.set("parquet.block.size", before) if before else conf.unset("parquet.block.size")
    wanted = ["S000007", "S001000", "S001500"]

    def groups(name):
        met = every = 0
        for file in (tmp_path / name).rglob("*.parquet"):
            data = pq.ParquetFile(file)
            at = data.schema_arrow.get_field_index("symbol")
            for i in range(data.metadata.num_row_groups):
                stats = data.metadata.row_group(i).column(at).statistics
                every += 1
                met += any(stats.min <= w <= stats.max for w in wanted)
        return met, every

    met, every = groups("sorted")
    assert every >= 10 and met <= 2 * len(wanted)
    assert groups("mixed")[0] == groups("mixed")[1]
    answers = [for_symbols(read_history(spark, str(tmp_path / n)), wanted) for n in ("sorted", "mixed")]
    assert same(*answers)
    assert rows_scanned(answers[0]) * 5 < rows_scanned(answers[1])


def test_a_stream_keeps_marks(spark, some, folder, tmp_path):
    from tickforge.schemas import HISTORY_SCHEMA
    from tickforge.streaming.consumer import intake

    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    days = F.dayofmonth("trading_date")
    for part in (some.filter(days <= 20), some.filter(days > 10)):
        part.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(HISTORY_SCHEMA).parquet(landing)
        intake(stream, folder[0], checkpoint, marks=folder[1]).awaitTermination()
    append_new(some.filter(days.isNotNull()), str(tmp_path / "plain"))
    assert same(read_history(spark, folder[0]), read_history(spark, str(tmp_path / "plain")))


def test_the_stage_is_stored_compactly(spark, history, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(H, "drop_stage", lambda s, path: kept.append(path))
    H.append_marked(history([("A", "2024-01-02 10:00", 1)]), str(tmp_path / "history"), str(tmp_path / "marks"))
    names = [f.name for f in Path(kept[0]).glob("*.parquet")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)
