from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from tickforge.functions import parsing as P
from tickforge.operators import clean as Q
from tickforge.operators import filters as R
from tickforge.schemas import RAW_SCHEMA
from tickforge.tables import bars_raw


@pytest.fixture
def raw(spark):
    def build(*rows):
        base = dict(symbol="ACB", trading_date="2026-06-12", scrape_time="2026-06-12 09:00:05.0", source="x",
                    close_price="22.83", volume=10, open_price="23.00", high_price="23.35", low_price="22.83")
        return spark.createDataFrame([tuple({**base, **r}[c] for c in RAW_SCHEMA.fieldNames()) for r in rows], RAW_SCHEMA)

    return build


def test_price_sentinels(raw):
    texts = [None, "", "NULL", "null", "\\N", "abc", "22.83"]
    frame = raw(*[{"close_price": t, "scrape_time": f"2026-06-12 09:00:0{i}"} for i, t in enumerate(texts)])
    assert values(Q.clean(frame), "close") == [(Decimal("22.8300"),)]
    assert sorted(r[0] for r in Q.reject_missing(frame).select("close_price").collect()) == ["22.83", "\\N", "abc"]


def test_symbol_spelling(raw):
    frame = raw({"symbol": " acb"}, {"symbol": "ACB "}, {"symbol": "Acb"})
    assert values(Q.clean(frame), "symbol") == [("ACB",)]
    assert Q.clean(frame, strict=False).count() == 3


def test_date_notations(raw):
    millis = str(int(datetime(2026, 6, 12).timestamp() * 1000))
    texts = [millis, "2026-06-12", "12/06/2026", "12-06-2026", "junk", "2026-13-40"]
    frame = raw(*[{"trading_date": t, "scrape_time": f"2026-06-12 09:00:0{i}"} for i, t in enumerate(texts)])
    assert values(Q.clean(frame), "trading_date") == [(date(2026, 6, 12),)] * 4


def test_numbers_out_of_range_are_null(spark):
    frame = spark.createDataFrame([("9" * 18,), ("9" * 25,), ("-5",), ("12.5",)], "t string")
    got = frame.select(P.millis_to_timestamp(F.col("t")).alias("m")).collect()
    assert [r.m is None for r in got] == [True, True, False, True]


def test_bad_winner_removes_its_key(history):
    rows = history([("A", "2026-06-12 09:00:00", 12, 5, 10, 9, 11), ("A", "2026-06-12 09:00:00", 10, 5, 10, 11, 9)])
    assert Q.sane_bars(Q.deduplicate(rows)).count() == 0
    assert Q.sane_bars(rows).count() == 1


def test_sanity_edges(history):
    good = dict(close=10, volume=5, open=10, high=11, low=9)
    cases = [{k: 0} for k in good] + [
        {"high": 8}, {"high": 9.5, "close": 9.8}, {"low": 10.5, "high": 12}, {"open": 15}]
    rows = [(f"S{i}", "2026-06-12 09:00:00", *{**good, **c}.values()) for i, c in enumerate(cases)]
    assert values(Q.sane_bars(history(rows)), "symbol") == [(f"S{len(cases) - 1}",)]


def test_clean_is_stable_and_ignores_order(spark, sf_dir):
    rows = bars_raw(spark, sf_dir)
    once = Q.sane_bars(Q.deduplicate(rows))
    shuffled = Q.sane_bars(Q.deduplicate(rows.orderBy(F.rand(7)).repartition(13)))
    assert once.exceptAll(shuffled).count() == 0
    assert once.exceptAll(Q.sane_bars(Q.deduplicate(once))).count() == 0


def test_epoch_repair(spark):
    millis = 1781222400000
    frame = spark.createDataFrame([(millis,), (millis * 1_000_000,)], "raw long")
    days = values(frame.select(P.repair_epoch_day(F.col("raw")).alias("day")), "day")
    assert days == [(date(2026, 6, 12),)] * 2


def test_search_literal_and_regex(spark):
    frame = spark.createDataFrame([("a.b",), ("axb",), ("(x",)], "t string")
    assert values(R.search(frame, "A.B"), "t") == [("a.b",)]
    assert values(R.search(frame, "("), "t") == [("(x",)]
    assert R.search(frame, "a.b", regex=True).count() == 2


def test_open_ended_filters(history):
    rows = history([("A", "2026-06-12 09:00:00", 10)])
    assert R.for_symbols(rows, []).count() == 1
    assert R.between_days(rows, "2026-07-01", None).count() == 1
    assert R.in_years(rows, 2025).count() == 0
    assert R.in_years(rows, None).count() == 1


def test_canonical_names(spark):
    frame = spark.createDataFrame([("A", "12/06/2026", "1.5", "x")], "ticker string, date string, close string, volume string")
    row = Q.canonicalise(frame).first()
    assert (row.symbol, row.trading_date, row.close, row.volume) == ("A", date(2026, 6, 12), Decimal("1.5000"), None)


def test_days_are_parsed_once(spark):
    """No filter builds and parses the text of the day a second time."""
    raw = spark.range(3).select(F.lit("A").alias("symbol"), F.concat(F.lit("2024-01-0"), F.col("id") + 1).alias("trading_date"),
                                F.lit("2024-01-02 10:00:00").alias("scrape_time"), F.lit("1").alias("close"))
    plan = Q.canonicalise(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("yyyy-M-d") == 1


def test_prices_without_digits_are_null(spark):
    frame = spark.createDataFrame([("A", "2024-01-02", p) for p in ("abc", "", "\\N", None, " 1.5 ", "1e2", "-.5", "\u0661", "1x")],
                                  "symbol string, trading_date string, close string")
    kept = [r["close"] for r in Q.canonicalise(frame).collect()]
    assert kept == [None, None, None, None, Decimal("1.5"), Decimal(100), Decimal("-0.5"), Decimal(1), None]
