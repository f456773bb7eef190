"""Joins of bucketed tables against joins of frames."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickforge.operators import consolidate as C
from tickforge.plans import queries as Q
from tickforge.schemas import DAILY_KEY
from tickforge.sources import buckets as B

PARTS = ["volumes", "ranges", "streaks"]


@pytest.fixture(scope="module")
def frames(spark):
    """Three frames with keys of their own, keys in common, a repeated key and keys with nulls."""
    rows = spark.range(3000).select(
        F.format_string("S%03d", F.col("id") % 40).alias("symbol"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") / 40).cast("int")).alias("calc_date"), "id")
    odd = spark.sql("SELECT cast(NULL AS string) symbol, date'2026-01-01' calc_date, 1L id UNION ALL SELECT 'S001', NULL, 2L")
    rows = rows.unionByName(odd)
    return {name: rows.filter((F.col("id") % n > 0) | (F.col("id") < 3)).withColumnRenamed("id", f"value_{name}")
            for name, n in zip(PARTS, (2, 3, 7))} | {"ranges": rows.filter("id % 5 < 3").unionByName(rows.limit(9)).withColumnRenamed("id", "value_ranges")}


@pytest.fixture(scope="module")
def stored(spark, frames, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("together"))
    B.store_together(frames, "trial", root, DAILY_KEY, 4)
    yield root
    for part in [*PARTS, B.KEYS]:
        spark.sql(f"DROP TABLE IF EXISTS trial_{part}")


def same(a, b):
    b = b.select(a.columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def plan_without_broadcast(spark, make):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_equal_to_joining_the_frames(spark, frames, stored):
    want = C.outer_join_daily([frames[p] for p in PARTS])
    assert want.filter("symbol IS NULL OR calc_date IS NULL").count() > 3
    assert same(B.outer_join_stored(spark, PARTS, "trial", DAILY_KEY), want)


def test_no_row_is_moved(spark, frames, stored):
    plan = plan_without_broadcast(spark, lambda: B.outer_join_stored(spark, PARTS, "trial", DAILY_KEY))
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
    moved = plan_without_broadcast(spark, lambda: C.outer_join_daily([spark.table(f"trial_{p}") for p in PARTS]))
    assert "Exchange" in moved


def test_one_file_per_bucket(stored):
    assert all(len(list(Path(stored, part).glob("*.parquet"))) <= 4 for part in [*PARTS, B.KEYS])


def test_replaced_and_opened_again(spark, frames, stored):
    fewer = {p: f.filter("symbol < 'S020'") for p, f in frames.items()}
    B.store_together(fewer, "trial", stored, DAILY_KEY, 4)
    for part in [*PARTS, B.KEYS]:
        spark.sql(f"DROP TABLE trial_{part}")
    B.open_together(spark, PARTS, "trial", stored, DAILY_KEY, 4)
    again = lambda: B.outer_join_stored(spark, PARTS, "trial", DAILY_KEY)
    assert same(again(), C.outer_join_daily([fewer[p] for p in PARTS]))
    assert "Exchange" not in plan_without_broadcast(spark, again)


def test_indicators_are_stored_from_one_summary(spark, sf_dir, monkeypatch):
    """No stored table computes the summary of the snapshots again."""
    seen = []
    monkeypatch.setattr(Q.B, "store_together", lambda frames, *rest: seen.extend(frames.values()))
    monkeypatch.setattr(Q.B, "outer_join_stored", lambda s, *rest: s.range(1))
    Q.QUERIES["j01_stored_outer_join"](spark, f"{sf_dir}/.")
    assert len(seen) == 6 and not any("l_orderkey" in f._jdf.queryExecution().executedPlan().toString() for f in seen)
