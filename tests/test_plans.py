"""Shape of the physical plans that matter at scale."""

import pytest

from tickforge.operators import daily as D
from tickforge.operators import snapshots as S
from tickforge.plans import views as V


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_table_reads_history_once(bars):
    plan = plan_of(V.daily_analysis(bars))
    assert plan.count("FileScan") == 1
    assert "Python" not in plan and "Join" not in plan


def test_latest_snapshot_limits_before_the_shuffle(bars):
    plan = plan_of(S.latest_snapshot(bars))
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("operator, columns", [
    (D.daily_volume_max, "struct<symbol:string,trading_date:date,volume:bigint>"),
    (D.max_intraday_drop, "struct<symbol:string,trading_date:date,open:decimal(18,4),low:decimal(18,4)>"),
])
def test_only_needed_columns_are_read(bars, operator, columns):
    plan = plan_of(operator(bars))
    assert f"ReadSchema: {columns}" in plan
    assert "partial_" in plan.split("Exchange")[-1]


def test_filters_reach_the_scan(bars):
    from tickforge.operators.filters import between_days, for_symbols

    plan = plan_of(between_days(for_symbols(bars, ["S000001"]), "1996-01-01", "1996-12-31"))
    pushed = plan.split("PushedFilters: [")[1]
    assert "symbol" in pushed and "GreaterThanOrEqual(trading_" in pushed


def test_month_folders_are_pruned(spark, bars, tmp_path):
    from tickforge.sources.readers import read_history
    from tickforge.sources.writers import append_history

    path = str(tmp_path / "history")
    append_history(bars, path)
    frame = read_history(spark, path, "1996-03-05", "1996-04-02")
    assert "PartitionFilters: [isnotnull(history_month" in plan_of(frame)
    expected = bars.filter("trading_date between date'1996-03-05' and date'1996-04-02'")
    assert frame.count() == expected.count() and frame.exceptAll(expected).count() == 0


def test_unique_keys_are_summarised_without_a_sort(bars):
    unique = S.deduplicate(bars)
    columns = ["close", "volume", "open", "high", "low"]
    for ordered, hashed in ((S.daily_summary(unique), S.daily_summary(bars, unique=True)),
                            (S.closing_values(unique, *columns), S.closing_values(bars, *columns, unique=True))):
        assert "SortAggregate" in plan_of(ordered)
        assert "SortAggregate" not in plan_of(hashed) and "HashAggregate" in plan_of(hashed)
    got, want = S.daily_summary(unique, unique=True), S.daily_summary(unique)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert V.daily_analysis(unique, unique=True).exceptAll(V.daily_analysis(unique)).count() == 0


def test_a_missing_time_never_closes_a_day(spark):
    from tickforge.schemas import HISTORY_SCHEMA

    rows = spark.sql("""
        SELECT 'A' symbol, date'2026-06-12' trading_date, t scrape_time, 's' source, c close, v volume, c open, c high, c low
        FROM VALUES (cast(NULL AS timestamp_ntz), 9, 1L), (timestamp_ntz'0001-01-01 00:00:00', NULL, 2L) AS x(t, c, v)
        UNION ALL SELECT 'B', date'2026-06-12', cast(NULL AS timestamp_ntz), 's', 5, 3L, 5, 5, 5
    """).select(*[f.name for f in HISTORY_SCHEMA])
    for unique in (False, True):
        got = {r.symbol: (r.close, r.volume) for r in S.closing_values(rows, "close", "volume", unique=unique).collect()}
        assert got == {"A": (None, 2), "B": (5, 3)}
