from datetime import date, datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from conftest import values
from pyspark.sql import functions as F

from tickforge.functions import labels as L
from tickforge.operators import consolidate as C
from tickforge.operators import daily as D
from tickforge.operators import ordering as O
from tickforge.operators import prices as P
from tickforge.operators import snapshots as S
from tickforge.plans import views as V
from tickforge.schemas import DAILY_KEY, DAILY_SCHEMA


def days(history, closes, start="2026-06-08", weekdays=True, opens=None, volumes=None):
    moment, rows = datetime.fromisoformat(start), []
    for i, close in enumerate(closes):
        while weekdays and moment.weekday() > 4:
            moment += timedelta(days=1)
        open_ = opens[i] if opens else close
        rows.append(("A", moment.isoformat(), close, volumes[i] if volumes else 1, open_, close, close))
        moment += timedelta(days=1)
    return history(rows)


def ordered(df, *columns, by="calc_date"):
    return values(df.orderBy(by), *columns)


def test_close_streak_ties(history):
    runs = ordered(D.close_streaks(days(history, [10, 11, 12, 12, 11, 10, 11])), "up_days_count", "down_days_count")
    assert runs == [(0, 0), (1, 0), (2, 0), (0, 0), (0, 1), (0, 2), (1, 0)]


def test_close_streak_skips_weekend(history):
    rows = days(history, [10, 99, 11], start="2026-06-12", weekdays=False)
    rows = rows.filter(F.dayofweek("trading_date") != 1).unionByName(days(history, [11], start="2026-06-15"))
    assert ordered(D.close_streaks(rows), "calc_date", "up_days_count") == [
        (date(2026, 6, 12), 0), (date(2026, 6, 15), 1)]
    wide = V.daily_analysis(rows).filter("symbol = 'A'")
    assert ordered(wide, "up_days_count") == [(0,), (None,), (1,)]


def test_candle_streak_doji(history):
    rows = days(history, [11, 12, 12, 11], opens=[10, 11, 12, 12])
    assert ordered(D.candle_streaks(rows), "up_days_count", "down_days_count") == [(1, 0), (2, 0), (0, 0), (0, 1)]


def test_streaks_equal_a_plain_loop(bars):
    closes = S.closing_values(bars, "close")

    def loop(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("trading_date").reset_index(drop=True)
        sign = pdf["close"].astype(float).diff().fillna(0).apply(lambda x: (x > 0) - (x < 0))
        run = sign.groupby((sign != sign.shift()).cumsum()).cumcount() + 1
        return pd.DataFrame({"symbol": pdf["symbol"], "calc_date": pdf["trading_date"],
                             "up_days_count": run.where(sign > 0, 0).astype("int32"),
                             "down_days_count": run.where(sign < 0, 0).astype("int32")})

    expected = D.weekdays(closes).groupBy("symbol").applyInPandas(
        loop, "symbol string, calc_date date, up_days_count int, down_days_count int")
    native = D.close_streaks(closes)
    assert native.exceptAll(expected).count() == 0 and expected.exceptAll(native).count() == 0


def test_record_volume_tie_is_the_earlier_day(history):
    record = D.record_volume_day(D.daily_volume_max(days(history, [1, 1, 1], volumes=[5, 9, 9]))).first()
    assert (record.max_volume_date, record.max_volume_value) == (date(2026, 6, 9), 9)


def test_short_averages(history):
    rows = days(history, [10, 20, 30])
    assert ordered(D.sma(rows), "sma_price") == [(Decimal("10.00"),), (Decimal("15.00"),), (Decimal("20.00"),)]
    assert ordered(D.strict_smas(rows, (3, 5)), "sma3", "sma5", by="trading_date") == [
        (None, None), (None, None), (20.0, None)]


def test_mean_rounds_half_up(history):
    rows = days(history, [10.01, 10.02])
    assert D.monthly_average_close(rows).first().monthly_avg_close == Decimal("10.02")


def test_period_vwap(history):
    rows = days(history, [10, 20, 30], volumes=[1, 3, 0])
    assert ordered(P.period_vwap(rows), "vwap", by="trading_date") == [(10.0,), (17.5,), (17.5,)]


def test_vwap_of_zero_volume_is_null(history):
    assert P.running_vwap(days(history, [10], volumes=[0])).first().vwap is None


def _plain_vwap(rows):
    frame = rows.toPandas().sort_values("scrape_time")
    turnover = (frame["close"].astype(float) * frame["volume"]).cumsum() / frame["volume"].cumsum()
    return dict(zip(frame["scrape_time"], turnover))


def test_vwap_and_increments_of_one_hot_day(history):
    start = datetime(2026, 6, 12, 9)
    rows = history([("A", (start + timedelta(seconds=7 * i)).isoformat(), 10 + i % 13, 1 + i % 5) for i in range(500)])
    expected = _plain_vwap(rows)
    got = {r.scrape_time: r.vwap for r in P.running_vwap(rows).collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    added = ordered(P.snapshot_increments(rows), "volume", "added_volume", by="scrape_time")
    assert [a for _, a in added] == [v - p for (v, _), p in zip(added, [0, *[v for v, _ in added]])]


def test_bars_skip_null_first_open_and_last_close(history):
    rows = history([("A", "2026-06-12 09:00:00", 10, 1, None, 10, 9), ("A", "2026-06-12 09:05:00", 11, 2, 8, 12, 7),
                    ("A", "2026-06-12 09:10:00", None, 3, 9, 11, 8)])
    bar = P.ohlc_bars(rows).first()
    assert [int(x) for x in (bar.open, bar.high, bar.low, bar.close, bar.volume)] == [8, 12, 7, 11, 6]
    assert P.ohlc_bars(rows, "max").first().volume == 3


def test_cross_when_the_gap_touches_zero(history):
    # With windows of 1 and 2 days the gap is half the last change.
    closes = [10, 8, 8, 10, 10, 8]
    crosses = ordered(P.moving_average_crosses(days(history, closes), 1, 2), "trading_date", "cross", by="trading_date")
    assert crosses == [(date(2026, 6, 11), "golden"), (date(2026, 6, 15), "death")]
    with pytest.raises(ValueError):
        P.moving_average_gap(days(history, closes), 5, 5)


def test_box_figures(history):
    box = P.monthly_distribution(days(history, [1, 2, 4, 9, 100])).first()
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.outliers) == (2, 4, 9, 1, 9, [100.0])
    even = P.monthly_distribution(days(history, [1, 2, 4, 9])).first()
    assert (even.q1, even.median, even.q3) == (1.75, 3.0, 5.25)


def test_closing_values_equal_latest_snapshot(bars):
    columns = ["symbol", "trading_date", "close", "volume", "open", "high", "low"]
    assert S.latest_snapshot(bars).select(*columns).exceptAll(S.closing_values(bars, *columns[2:])).count() == 0


def test_one_pass_table_equals_join_chain_and_sparse_merge(bars):
    closes = S.closing_values(bars, "close", "volume", "open", "high", "low")
    volumes = D.daily_volume_max(bars)
    frames = [C.with_market_rows(volumes, D.market_volume(bars)), D.running_close_range(closes), D.close_streaks(closes),
              D.intraday_volatility(closes), D.liquidity(closes), D.max_intraday_drop(bars), D.sma(closes)]
    chain = C.conform(C.attach_record_day(C.outer_join_daily(frames), D.record_volume_day(volumes)), DAILY_SCHEMA)
    merged = C.merge_sparse(C.union_sparse(frames), DAILY_KEY, "seq")
    merged = C.conform(C.attach_record_day(merged.drop("max_volume_date", "max_volume_value"), D.record_volume_day(volumes)),
                       DAILY_SCHEMA)
    one_pass = V.daily_analysis(bars)
    assert one_pass.count() == chain.count()
    assert one_pass.exceptAll(chain).count() == 0
    assert one_pass.exceptAll(merged).count() == 0


def test_partitioning_does_not_change_results(bars):
    reference = V.daily_analysis(bars)
    shuffled = V.daily_analysis(bars.orderBy(F.rand(3)).repartition(11))
    assert reference.exceptAll(shuffled).count() == 0


def test_sparse_merge_modes(spark):
    rows = spark.createDataFrame([("A", 1, 1, None), ("A", 2, None, "x"), ("A", 3, 7, None)], "k string, seq int, v int, w string")
    assert values(C.merge_sparse(rows, ["k"], "seq"), "k", "v", "w") == [("A", 7, "x")]


def test_pages_clamp(history):
    rows = history([("A", f"2026-06-12 09:{i:02d}:00", 10 + i) for i in range(51)])
    for number, page, size in [(0, 1, 25), (1, 1, 25), (3, 3, 1), (99, 3, 1)]:
        got = O.history_page(rows, number).collect()
        assert {(r.page, r.page_count) for r in got} == {(page, 3)} and len(got) == size
    first = sorted(O.history_page(rows, 1).collect(), key=lambda r: r.position)
    assert [r.scrape_time.minute for r in first] == list(range(50, 25, -1))


def test_slices_equal_a_global_sort(bars):
    expected = bars.orderBy(F.desc("trading_date"), "symbol", F.desc("scrape_time")).limit(1234)
    got = O.newest_rows(bars, 1234)
    assert got.count() == 1234 and got.exceptAll(expected).count() == 0


def test_display_text(spark):
    frame = spark.createDataFrame([(1_250_000,), (4_400,), (999,)], "v long")
    assert values(frame.select(L.volume_text(F.col("v")).alias("t")), "t") == [("1.3M",), ("4K",), ("999",)]


def test_pivots_take_their_columns_from_the_data(spark, history):
    rows = history([("B", "2025-12-30 10:00", 10, 5), ("A", "2026-01-02 10:00", 10, 7), ("A", "2026-01-05 10:00", 11, 1),
                    (None, "2026-01-05 10:00", 11, 100)])
    wide = P.yearly_matrix(P.yearly_volume(rows))
    assert wide.columns == ["year", "A", "B", "total"]
    assert sorted(tuple(r) for r in wide.collect()) == [(2025, 0, 5, 5), (2026, 8, 0, 108)]
    chosen = P.yearly_matrix(P.yearly_volume(rows), ["B", "C"])
    assert sorted(tuple(r) for r in chosen.collect()) == [(2025, 5, 0, 5), (2026, 0, 0, 108)]
    changes = P.monthly_change_matrix(rows.filter("symbol IS NOT NULL").select("symbol", "trading_date", "close"), 1)
    assert changes.columns == ["symbol", "2026-01"]
    assert [(r[0], round(r[1], 6)) for r in changes.collect()] == [("A", 10.0)]
    with pytest.raises(ValueError):
        P.column_values(rows, "symbol", 1)
    nothing = P.yearly_matrix(P.yearly_volume(rows.filter("false")))
    assert nothing.columns == ["year", "total"] and nothing.count() == 0


def test_a_matrix_has_as_many_columns_as_symbols(spark):
    n = 5200
    long = spark.range(2 * n).select(
        F.when(F.col("id") < n, 2025).cast("int").alias("year"), F.format_string("S.%d", F.col("id") % n).alias("symbol"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("volume")).filter("id % 11 > 0")
    wide = P.yearly_matrix(long)
    assert wide.columns == ["year", *sorted({f"S.{i % n}" for i in range(2 * n) if i % 11}), "total"]
    rows = {r[0]: dict(zip(wide.columns, r)) for r in wide.collect()}
    for year, first in ((2025, 0), (None, n)):
        want = {f"S.{i % n}": i for i in range(first, first + n) if i % 11 and i % 7}
        assert {k: v for k, v in rows.pop(year).items() if k != "year" and v} == {**want, "total": sum(want.values())}
    assert not rows


@pytest.mark.parametrize("name", ["a16_sparse_rows_merged", "v03_increment_daily_merged"])
def test_merged_frames_share_one_scan(spark, sf_dir, name):
    """The frames come from one aggregation of the snapshots; before, each had a scan of its own."""
    from tickforge.plans.queries import QUERIES

    df = QUERIES[name](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1


def test_frames_of_one_row_drop_rows_without_a_key(spark, history):
    rows = history([("A", "2024-01-02 10:00", 5), (None, "2024-01-02 11:00", 7)])
    streaks, spread = V.increment_daily_parts(rows)[2:4]
    assert [r["symbol"] for r in streaks.collect()] == [r["symbol"] for r in spread.collect()] == ["A"]
    merged = C.union_sparse(V.increment_daily_parts(rows))
    few, many = (C.merge_sparse(merged, DAILY_KEY, "seq", few=x) for x in (True, False))
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_market_rows_beside_stored_rows(spark, history):
    """As by grouping sets, but rows keep their place: only day and volume are aggregated."""
    rows = S.daily_summary(history([("A", "2024-01-05 10:00", 5, 9), (None, "2024-01-05 11:00", 7, 2), ("B", "2024-01-06 10:00", 3, 4)]))
    rows = rows.withColumn("calc_date", F.col("trading_date")).withColumn("total_volume", F.col("max_volume"))
    values_of = {c: F.lit(None).cast(DAILY_SCHEMA[c].dataType) for c in DAILY_SCHEMA.fieldNames() if c not in rows.columns}
    rows = rows.withColumns(values_of)
    want = C.add_market_rows(rows, weekdays_only=True)
    got = C.beside_market_rows(rows, rows, weekdays_only=True)
    assert got.schema == want.schema and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
