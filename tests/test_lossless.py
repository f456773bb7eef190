"""Nothing is lost or mixed: odd keys, equal keys, restarts, ranges, pruning."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F

from tickforge.functions import parsing as P
from tickforge.operators import daily as D
from tickforge.operators import filters as R
from tickforge.operators import ordering as O
from tickforge.operators import prices as X
from tickforge.operators import snapshots as S
from tickforge.plans import queries as Q
from tickforge.plans import views as V
from tickforge.schemas import DAILY_SCHEMA, MONTH, MONTHLY_SCHEMA
from tickforge.sources import messages as M
from tickforge.sources import readers as I
from tickforge.sources import upsert as U
from tickforge.sources import writers as W
from tickforge.streaming import consumer as Z


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def by_month(spark, tmp_path_factory, bars):
    path = str(tmp_path_factory.mktemp("months") / "history")
    W.append_history(bars, path)
    return path


def test_ranges_take_unpadded_days_and_single_ends(spark, by_month, bars):
    for start, end in (("1996-3-5", "1996-12-31"), ("1996-03-05 10:00:00", None), (None, date(1996, 3, 5)), ("1996-3-5", "1996-3-5")):
        got = I.read_history(spark, by_month, start, end)
        want = bars
        if start:
            want = want.filter("trading_date >= date'1996-03-05'")
        if end:
            want = want.filter(F.col("trading_date") <= F.lit(R.as_day(end)))
        assert got.count() == want.count() > 0 and got.columns == bars.columns


@pytest.mark.parametrize("operator", [
    lambda df: R.between_days(df, "1996-3-1", "1996-04-30"), lambda df: R.look_back(df, "3 months", "1996-06-30"),
    lambda df: R.in_years(df, [1996, 1999]), lambda df: R.between_months(df, (1996, 11), (1997, 2)),
    lambda df: X.close_extremes(R.in_years(df, 1996)), lambda df: R.one_day(df, "S000001", "1996-05-05"),
])
def test_range_operators_prune_months(spark, by_month, operator):
    from tickforge.schemas import HISTORY_SCHEMA

    frame = operator(I.read_by_month(spark, by_month, HISTORY_SCHEMA))
    assert f"PartitionFilters: [" in plan_of(frame) and f"{MONTH}#" in plan_of(frame).split("PartitionFilters: [")[1].split("]")[0]


def test_serving_table_has_its_own_columns_and_prunes(spark, tmp_path, bars):
    table = str(tmp_path / "daily")
    daily = V.daily_analysis(bars)
    U.upsert_daily(daily.withColumn("seq", F.lit(1)), table, str(tmp_path / "stage"))
    frame = I.read_daily(spark, table, start="1996-01-01", end="1996-12-31")
    assert frame.columns == [*DAILY_SCHEMA.fieldNames(), "avg_close_price"]
    assert f"{MONTH}#" in plan_of(frame).split("PartitionFilters: [")[1].split("]")[0]
    assert frame.count() == daily.filter("year(calc_date) = 1996").count()


def test_day_texts(spark):
    texts = ["2026-06-12", "2026-06-12 00:00:00", "2026-6-2T10:11:12.5", "12/06/2026 09:00", "1-2-2026", "2026-13-01", "2026-06-12x",
             "20260612", "", None]
    got = values(spark.createDataFrame([(t,) for t in texts], "t string").select(P.parse_day_text(F.col("t")).alias("d")), "d")
    june = (date(2026, 6, 12),)
    assert got == [june, june, (date(2026, 6, 2),), june, (date(2026, 2, 1),), (None,), (None,), (None,), (None,), (None,)]


def test_slices_and_pages_keep_rows_with_null_levels(history):
    rows = history([("A", "2026-06-12 09:00:00", 1), ("B", "2026-06-12 09:00:00", 2), ("C", "2026-06-11 09:00:00", 3)])
    odd = rows.withColumns({
        "scrape_time": F.when(F.col("symbol") != "A", F.col("scrape_time")), "trading_date": F.when(F.col("symbol") != "C", F.col("trading_date")),
        "symbol": F.when(F.col("symbol") != "B", F.col("symbol"))})
    assert O.newest_rows(odd, 3).count() == 3
    for deep in (False, True):
        got = sorted(O.history_page(odd, 1, deep=deep).collect(), key=lambda r: r.position)
        assert [r.symbol for r in got] == [None, "A", "C"] and {r.page_count for r in got} == {1}


def test_shallow_and_deep_pages_agree(bars):
    for number in (1, 7):
        a, b = (O.history_page(bars, number, deep=deep) for deep in (False, True))
        assert a.count() == 25 and a.exceptAll(b.select(a.columns)).count() == 0


def test_pivot_refuses_years_outside_its_columns(bars):
    with pytest.raises(Exception, match="outside the columns"):
        X.pivot_volume(X.yearly_volume(bars), "symbol", "year", [1996, 1997]).collect()


def test_equal_keys_give_one_closing_row(bars, history):
    rows = history([("A", "2026-06-12 09:00:00", 20, 7, 20, 21, 19), ("A", "2026-06-12 09:00:00", 10, 100, 10, 11, 9),
                    ("A", "2026-06-12 09:00:00", 20, 9, 1, 30, 1), ("A", "2026-06-12 08:00:00", 99)])
    for seed in range(3):
        mixed = rows.orderBy(F.rand(seed)).repartition(3)
        assert [int(x) for x in S.closing_values(mixed, "close", "volume", "open", "high", "low").first()[2:]] == [20, 9, 1, 30, 1]
        assert V.daily_analysis(mixed).filter("symbol = 'A'").first().total_volume == 100
    twice = bars.unionByName(bars.withColumn("close", F.col("close") + 1))
    shuffled = twice.orderBy(F.rand(5)).repartition(7)
    assert V.daily_analysis(twice).exceptAll(V.daily_analysis(shuffled)).count() == 0
    columns = ["symbol", "trading_date", "close", "volume", "open", "high", "low"]
    assert S.latest_snapshot(twice).select(columns).exceptAll(S.closing_values(shuffled, *columns[2:])).count() == 0


def test_rerun_guard_takes_null_keys_once(spark, tmp_path, history):
    rows = history([("A", "2026-06-12 09:00:00", 1), ("B", "2026-06-12 09:00:00", 2), ("C", "2020-01-01 09:00:00", 3)])
    odd = rows.withColumns({
        "scrape_time": F.when(F.col("symbol") != "A", F.col("scrape_time")), "trading_date": F.when(F.col("symbol") != "B", F.col("trading_date"))})
    path = str(tmp_path / "h")
    for _ in range(3):
        W.append_new(odd, path)
    assert I.read_history(spark, path).count() == 3


def message(volume, symbol="A"):
    return json.dumps({"symbol": symbol, "calc_date": "2026-06-12", "total_volume": volume})


def topic(spark, path, *rows):
    """Rows of (partition, offset, hour, value), in the daily topic."""
    frame = spark.createDataFrame(
        [(None, v, M.DAILY_TOPIC, p, o, datetime(2026, 6, 12, h)) for p, o, h, v in rows], M.TOPIC_SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(path)


def volumes(spark, root):
    return sorted(values(U.read_serving(spark, f"{root}/daily", DAILY_SCHEMA), "symbol", "total_volume"))


def test_a_lost_checkpoint_loses_no_message(spark, tmp_path):
    path, root = str(tmp_path / "topic"), str(tmp_path / "root")
    topic(spark, path, (0, 1, 1, message(5)))
    Z.consume(Z.read_topics(spark, {"path": path}), root).awaitTermination()
    (tmp_path / "root" / "checkpoint").rename(tmp_path / "lost")
    topic(spark, path, (0, 2, 2, message(7)))
    Z.consume(Z.read_topics(spark, {"path": path}), root).awaitTermination()
    assert volumes(spark, root) == [("A", 7)]


def test_messages_of_two_partitions_are_ordered_by_time(spark, tmp_path):
    path, root = str(tmp_path / "topic"), str(tmp_path / "root")
    topic(spark, path, (0, 90, 1, message(5)), (1, 3, 2, message(7)), (1, 4, 2, message(8)))
    Z.consume(Z.read_topics(spark, {"path": path}), root).awaitTermination()
    assert volumes(spark, root) == [("A", 8)]


def test_messages_without_a_key_are_quarantined(spark, tmp_path):
    path, root = str(tmp_path / "topic"), str(tmp_path / "root")
    keyless = ['{"symbol":"A"}', '{"calc_date":"2026-06-12"}', "{}", "{oops"]
    assert Z.read_quarantine(spark, root).count() == 0
    topic(spark, path, (0, 1, 1, message(5)))
    Z.consume(Z.read_topics(spark, {"path": path}), root).awaitTermination()
    assert Z.read_quarantine(spark, root).count() == 0
    topic(spark, path, *[(0, 2 + i, 2, v) for i, v in enumerate(keyless)])
    Z.consume(Z.read_topics(spark, {"path": path}), root).awaitTermination()
    assert sorted(r[M.CORRUPT] for r in Z.read_quarantine(spark, root).collect()) == sorted(keyless)


def test_a_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    """What is upserted and rejected reads written rows: no JSON is parsed again, and nothing is held in memory."""
    path, root, seen = str(tmp_path / "topic"), str(tmp_path / "root"), []
    for name in ("upsert_daily", "upsert_monthly", "_quarantine"):
        plain = getattr(Z, name)
        monkeypatch.setattr(Z, name, lambda rows, *a, plain=plain, **k: (seen.append(plan_of(rows)), plain(rows, *a, **k)))
    month = json.dumps({"symbol": "A", "calc_year": 2026, "calc_month": 6, "monthly_total_volume": 3})
    topic(spark, path, (0, 1, 1, message(5)), (0, 2, 1, "{oops"), (0, 3, 1, ""), (0, 4, 1, None))
    spark.createDataFrame([(None, v, M.MONTHLY_TOPIC, 1, i, datetime(2026, 6, 12)) for i, v in enumerate((month, "[]", "{}"))],
                          M.TOPIC_SCHEMA).write.mode("append").parquet(path)
    Z.consume(Z.read_topics(spark, {"path": path}), root).awaitTermination()
    assert len(seen) == 3
    assert not any(word in plan for plan in seen for word in ("from_json", "JsonToStructs", "InMemoryTableScan"))
    assert volumes(spark, root) == [("A", 5)]
    assert values(U.read_serving(spark, f"{root}/monthly", MONTHLY_SCHEMA), "monthly_total_volume") == [(3,)]
    both = spark.read.schema(M.TOPIC_SCHEMA).parquet(path)
    want = M.daily_messages(both).select("topic", "offset", M.CORRUPT).unionByName(
        M.monthly_messages(both).select("topic", "offset", M.CORRUPT)).filter(F.col(M.CORRUPT).isNotNull())
    got = Z.read_quarantine(spark, root).select("topic", "offset", M.CORRUPT)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 5


def test_rejected_messages_survive_a_new_checkpoint(spark, tmp_path):
    path, root = str(tmp_path / "topic"), str(tmp_path / "root")
    topic(spark, path, (0, 1, 1, "{one"), (0, 2, 1, "{two"))
    Z.consume(Z.read_topics(spark, {"path": path}), root).awaitTermination()
    Path(root, "checkpoint").rename(Path(root, "old-checkpoint"))
    topic(spark, f"{path}-new", (0, 3, 2, "{three"))
    Z.consume(Z.read_topics(spark, {"path": f"{path}-new"}), root).awaitTermination()
    assert sorted(r[M.CORRUPT] for r in Z.read_quarantine(spark, root).collect()) == ["{one", "{three", "{two"]


def test_coalesced_months_keep_a_stored_average(spark, tmp_path):
    table = str(tmp_path / "m")
    for seq, average in ((1, 10.5), (2, None)):
        rows = spark.createDataFrame([("A", 2026, 1, average, seq, seq), ("B", 2026, 1, None, seq, seq)],
                                     "symbol string, calc_year int, calc_month int, monthly_avg_close double, monthly_total_volume long, seq long")
        U.upsert_monthly(rows, table, f"{table}-stage/{seq}", "coalesce")
    got = sorted((r.symbol, float(r.monthly_avg_close), r.monthly_total_volume) for r in U.read_serving(spark, table, MONTHLY_SCHEMA).collect())
    assert got == [("A", 10.5, 2), ("B", 0.0, 2)]


def test_watermarked_intake_into_a_filled_history(spark, tmp_path, history):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "history")
    old = history([("A", "2026-06-11 09:00:00", 9), ("A", "2026-06-12 09:00:00", 10)])
    W.append_new(old, path)
    rows = history([("A", "2026-06-12 09:00:00", 10), ("A", "2026-06-12 09:05:00", 11)])
    rows.unionByName(rows).write.parquet(landing)
    Z.intake_within(spark.readStream.schema(rows.schema).parquet(landing), path, f"{path}-checkpoint").awaitTermination()
    W.append_new(history([("B", "2026-06-13 09:00:00", 1)]), path)
    assert I.read_history(spark, path).count() == 4
    assert I.read_history(spark, path, "2026-06-12", "2026-06-12").count() == 2


def test_batch_layout_can_be_read_as_history(spark, tmp_path, bars):
    path = str(tmp_path / "batches")
    some = bars.filter("trading_date between date'1996-03-01' and date'1996-03-31'")
    W.replace_partitions(W.with_batch_partitions(some), path, ["p_year", "p_month", "p_day"])
    assert I.read_history(spark, path, "1996-03-05", "1996-03-09").count() == some.filter("day(trading_date) between 5 and 9").count() > 0


def test_views_are_built_without_writing(spark, sf_dir):
    """Only the schema of the given tables is read when a query is built."""
    def stored():
        import os

        return sorted(os.listdir(spark.conf.get("spark.checkpoint.dir")))

    before = stored()
    for name, run in Q.QUERIES.items():
        # The guard is about a store, and the partition date about its layout.
        if name[0] in "awfvtupxj" and name not in ("j06_rerun_guard", "p04_partition_date"):
            run(spark, sf_dir)
    assert stored() == before


@pytest.mark.parametrize("name", ["j01_daily_outer_join", "a16_sparse_rows_merged", "v03_increment_daily_merged", "a12_monthly_absolute_change",
                                  "t05_page", "v10_daily_view"])
def test_few_scans_run(spark, sf_dir, name):
    df = Q.QUERIES[name](spark, sf_dir)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert 1 <= final.count("FileScan") <= 4, final.count("FileScan")
