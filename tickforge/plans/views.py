"""Composite views: the named results a user of the package asks for.

``unique`` states that the history holds each snapshot key once; see ``closing_values``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.operators import catalogue as K
from tickforge.operators import consolidate as C
from tickforge.operators import daily as D
from tickforge.operators import filters as R
from tickforge.operators import ordering as O
from tickforge.operators import prices as P
from tickforge.operators.snapshots import daily_summary, deduplicate, shared
from tickforge.schemas import DAILY_KEY, MARKET_SYMBOL


def daily_analysis(history: DataFrame, unique: bool = False) -> DataFrame:
    """Wide daily table with all daily indicators and market rows."""
    return C.daily_analysis(daily_summary(history, unique))


def monthly_analysis(history: DataFrame, unique: bool = False) -> DataFrame:
    """Monthly averages and volumes."""
    return C.monthly_table(daily_summary(history, unique))


def increment_daily_analysis(history: DataFrame, market_filler: bool = True, unique: bool = False) -> DataFrame:
    """Daily table in the variant for increment snapshots.

    Volumes are sums, the close range is that of the day, streaks compare the
    close with the open.  Market rows carry constant filler if asked.
    """
    summary = daily_summary(history, unique)
    rows = D.with_streaks(summary, D.candle_step()).withColumns({
        "calc_date": F.col("trading_date"),
        "total_volume": F.col("sum_volume"),
        "max_close_price": D.two_digits(F.col("close")),
        "min_close_price": D.two_digits(F.col("close")),
        "max_volume_date": F.lit(None).cast("date"),
        "max_volume_value": F.lit(None).cast("bigint"),
        "max_intraday_volatility": D.two_digits(F.col("high") - F.col("low")),
        "max_intraday_drop": D.two_digits(F.col("max_drop")),
        "sma_price": D.rounded_partial_sma(5),
    })
    daily = C.add_market_rows(rows, weekdays_only=False)
    return C.market_filler(daily) if market_filler else daily


def _market(summary: DataFrame) -> DataFrame:
    """Market volume per day from closing volumes."""
    per_day = summary.groupBy(F.col("trading_date").alias("calc_date")).agg(F.sum("volume").alias("total_volume"))
    return per_day.select(F.lit(MARKET_SYMBOL).alias("symbol"), "calc_date", "total_volume")


def indicator_frames(summary: DataFrame) -> list[DataFrame]:
    """The daily indicators as separate frames, all from one ``daily_summary``.

    They share its shuffle, so the history is read once however many frames are joined.
    """
    volumes = D._as_calc_date(summary, F.col("max_volume").alias("total_volume"))
    return [
        C.with_market_rows(volumes, _market(summary)), D.running_close_range(summary), D.close_streaks(summary),
        D.intraday_volatility(summary), D.liquidity(summary),
        D._as_calc_date(summary, D.two_digits(F.col("max_drop")).alias("max_intraday_drop")),
    ]


def increment_daily_parts(history: DataFrame, unique: bool = False) -> list[DataFrame]:
    """The same figures as separate partial frames, one per job that computes them."""
    summary = shared(daily_summary(history, unique))
    return [
        D._as_calc_date(summary, F.col("sum_volume").alias("total_volume"),
                        D.two_digits(F.col("max_drop")).alias("max_intraday_drop")),
        D.close_range_by_day(summary),
        # Figures of one and the same row need no join; rows without a full key are left out, as a join would.
        D.candle_streaks(summary, D.liquidity_class(F.col("volume")).alias("liquidity_status")).dropna(subset=DAILY_KEY),
        D.intraday_volatility(summary, D.rounded_partial_sma(5).alias("sma_price")).dropna(subset=DAILY_KEY),
        C.market_filler(_market(summary)),
    ]


def candlesticks(history: DataFrame) -> DataFrame:
    """Daily bars with their direction."""
    return P.candle_direction(P.ohlc_bars(history))


def intraday(history: DataFrame) -> DataFrame:
    """Snapshots with price, volume and running VWAP of their day."""
    return P.running_vwap(deduplicate(history))


def moving_averages(history: DataFrame, short: int = 10, long: int = 20) -> DataFrame:
    """Bars with two moving averages and the crosses between them."""
    gaps = P.moving_average_gap(P.ohlc_bars(history), short, long)
    before = F.lag("gap").over(D.by_day())
    golden = (F.col("gap") > 0) & (before <= 0)
    death = (F.col("gap") < 0) & (before >= 0)
    return gaps.withColumn("cross", F.when(golden, "golden").when(death, "death"))


def volume_direction(history: DataFrame) -> DataFrame:
    """Daily bars with the colour of their volume column."""
    return P.volume_direction(P.ohlc_bars(history))


def market_overview(history: DataFrame, catalogue: DataFrame, unique: bool = False) -> DataFrame:
    """Price, change, range and volume per symbol with its name and source."""
    summary = daily_summary(history, unique)
    first, last = F.min_by("close", "trading_date"), F.max_by("close", "trading_date")
    per_symbol = P.with_changes(summary).groupBy("symbol").agg(
        last.alias("price"),
        F.max_by("change", "trading_date").alias("price_change"),
        (F.max_by("pct_change", "trading_date") * 100).alias("pct_change"),
        ((P.ratio(last, first) - 1) * 100).alias("return_pct"),
        F.max("close").alias("max_close"),
        F.min("close").alias("min_close"),
        F.max_by("volume", "trading_date").alias("volume"),
    )
    return K.with_catalogue(per_symbol, catalogue)


def _filtered(df: DataFrame, symbols, start, end, text: str, day: str) -> DataFrame:
    return R.search(R.between_days(R.for_symbols(df, symbols), start, end, day), text)


def history_view(
    history: DataFrame, number: int = 1, symbols=None, start=None, end=None, text: str = "", all_columns: bool = False
) -> DataFrame:
    """Filtered page of the snapshot table."""
    columns = ["symbol", "trading_date", "open", "high", "low", "close", "volume", "source"] if all_columns else [
        "symbol", "trading_date", "close", "volume"]
    rows = _filtered(history, symbols, start, end, text, "trading_date")
    return R.pick_columns(O.history_page(rows, number), [*columns, "position", "page", "page_count"])


def daily_view(daily: DataFrame, number: int = 1, symbols=None, start=None, end=None, text: str = "") -> DataFrame:
    """Filtered page of the daily table."""
    return O.daily_page(_filtered(daily, symbols, start, end, text, "calc_date"), number)


def monthly_view(monthly: DataFrame, number: int = 1, symbols=None, year: int | None = None) -> DataFrame:
    """Filtered page of the monthly table."""
    rows = R.for_symbols(monthly, symbols)
    rows = rows if year is None else rows.filter(F.col("calc_year") == int(year))
    return O.monthly_page(rows, number)


def without_market(daily: DataFrame) -> DataFrame:
    return daily.filter(F.col("symbol") != MARKET_SYMBOL)
