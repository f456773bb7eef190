"""Daily and monthly indicators.

Functions that take ``history`` aggregate snapshots with map-side partials.
Functions that take ``closes`` expect one row per symbol and day (the result of
``closing_values``, ``latest_snapshot`` or ``daily_summary``); their windows by
symbol are therefore bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickforge.functions.labels import liquidity_class
from tickforge.functions.numeric import clamp_at_zero, exact_mean, ratio, rounded_mean, two_digits
from tickforge.operators.snapshots import DAY_KEY, closing_values
from tickforge.schemas import MARKET_SYMBOL


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol")


def by_day() -> WindowSpec:
    return by_symbol().orderBy("trading_date")


def to_date() -> WindowSpec:
    return by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)



def weekdays(df: DataFrame, day: str = "trading_date") -> DataFrame:
    """Without Saturdays and Sundays."""
    return df.filter(~F.dayofweek(day).isin(1, 7))


def _as_calc_date(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select("symbol", F.col("trading_date").alias("calc_date"), *columns)


# Snapshot aggregates ---------------------------------------------------------

def daily_volume_max(history: DataFrame) -> DataFrame:
    """Volume of a day when snapshots are cumulative: the largest one."""
    return _as_calc_date(history.groupBy(*DAY_KEY).agg(F.max("volume").alias("total_volume")), "total_volume")


def daily_volume_sum(history: DataFrame, day: str = "trading_date") -> DataFrame:
    """Volume of a day when snapshots are increments: their sum."""
    return history.groupBy("symbol", F.col(day).alias("calc_date")).agg(F.sum("volume").alias("total_volume"))


def max_intraday_drop(history: DataFrame) -> DataFrame:
    """Largest fall from open to low over all snapshots of a day."""
    drop = F.max(clamp_at_zero(F.col("open") - F.col("low")))
    return _as_calc_date(history.groupBy(*DAY_KEY).agg(two_digits(drop).alias("max_intraday_drop")), "max_intraday_drop")


def market_volume(history: DataFrame, unique: bool = False) -> DataFrame:
    """Whole-market volume per day from the newest snapshot of each symbol."""
    closes = closing_values(history, "volume", unique=unique)
    per_day = closes.groupBy(F.col("trading_date").alias("calc_date")).agg(F.sum("volume").alias("total_volume"))
    return per_day.select(F.lit(MARKET_SYMBOL).alias("symbol"), "calc_date", "total_volume")


def with_market_key(per_day: DataFrame) -> DataFrame:
    """Rows of the whole market, named as such."""
    return per_day.withColumn("symbol", F.lit(MARKET_SYMBOL))


def _monthly(closes: DataFrame, *aggregates: Column) -> DataFrame:
    keys = ["symbol", F.year("trading_date").alias("calc_year"), F.month("trading_date").alias("calc_month")]
    return closes.groupBy(*keys).agg(*aggregates)


def monthly_volume(closes: DataFrame) -> DataFrame:
    return _monthly(closes, F.sum("volume").alias("monthly_total_volume"))


def monthly_average_close(closes: DataFrame) -> DataFrame:
    return _monthly(closes, rounded_mean(F.col("close")).alias("monthly_avg_close"))


def monthly_analysis(closes: DataFrame) -> DataFrame:
    """Average close and total volume per month in one aggregation."""
    return _monthly(
        closes,
        rounded_mean(F.col("close")).alias("monthly_avg_close"),
        F.sum("volume").alias("monthly_total_volume"),
    )


def close_range_by_day(closes: DataFrame) -> DataFrame:
    """Highest and lowest close of each day after deduplication."""
    per_day = closes.groupBy(*DAY_KEY).agg(
        two_digits(F.max("close")).alias("max_close_price"), two_digits(F.min("close")).alias("min_close_price")
    )
    return _as_calc_date(per_day, "max_close_price", "min_close_price")


def record_volume_day(volumes: DataFrame) -> DataFrame:
    """Day and size of the largest daily volume per symbol; the earliest day wins ties."""
    best = F.max(F.struct("total_volume", (-F.unix_date("calc_date")).alias("earlier")))
    return volumes.groupBy("symbol").agg(best.alias("best")).select(
        "symbol",
        F.date_from_unix_date(-F.col("best.earlier")).alias("max_volume_date"),
        F.col("best.total_volume").alias("max_volume_value"),
    )


# Windows over one row per symbol and day -------------------------------------

def running_close_range(closes: DataFrame) -> DataFrame:
    """Highest and lowest close so far."""
    return _as_calc_date(
        closes,
        two_digits(F.max("close").over(to_date())).alias("max_close_price"),
        two_digits(F.min("close").over(to_date())).alias("min_close_price"),
    )


def with_streaks(closes: DataFrame, step: Column) -> DataFrame:
    """Length of the current run of rising and of falling steps.

    ``step`` is the sign of each row; zero or null ends both runs.  A run is the
    distance to the last row whose sign differs, so one sorted pass is enough.
    """
    stepped = closes.withColumn("_row", F.row_number().over(by_day())).withColumn("_step", F.coalesce(step, F.lit(0)))
    last_not_up = F.max(F.when(F.col("_step") <= 0, F.col("_row"))).over(to_date())
    last_not_down = F.max(F.when(F.col("_step") >= 0, F.col("_row"))).over(to_date())
    return stepped.withColumns({
        "up_days_count": F.col("_row") - F.coalesce(last_not_up, F.lit(0)),
        "down_days_count": F.col("_row") - F.coalesce(last_not_down, F.lit(0)),
    }).drop("_row", "_step")


def close_step() -> Column:
    """Sign of the close against the previous day's close."""
    return F.signum(F.col("close") - F.lag("close").over(by_day())).cast("int")


def candle_step() -> Column:
    """Sign of the close against the same day's open."""
    return F.signum(F.col("close") - F.col("open")).cast("int")


def close_streaks(closes: DataFrame) -> DataFrame:
    """Runs of closes above or below the previous weekday's close."""
    return _as_calc_date(with_streaks(weekdays(closes), close_step()), "up_days_count", "down_days_count")


def candle_streaks(closes: DataFrame, *more: Column) -> DataFrame:
    """Runs of days closing above or below their own open; weekends stay in.

    ``more`` are further figures of the same rows.
    """
    return _as_calc_date(with_streaks(closes, candle_step()), "up_days_count", "down_days_count", *more)


def intraday_volatility(closes: DataFrame, *more: Column) -> DataFrame:
    """Spread of the day; ``more`` are further figures of the same rows."""
    spread = two_digits(F.col("high") - F.col("low"))
    return _as_calc_date(closes, spread.alias("max_intraday_volatility"), *more)


def liquidity(closes: DataFrame) -> DataFrame:
    """Liquidity class of the newest snapshot of each weekday."""
    return _as_calc_date(weekdays(closes), liquidity_class(F.col("volume")).alias("liquidity_status"))


def _last(n: int) -> WindowSpec:
    return by_day().rowsBetween(1 - n, Window.currentRow)


def strict_sma(n: int) -> Column:
    """Mean of the last ``n`` closes, null until ``n`` closes exist."""
    return F.when(F.count("close").over(_last(n)) == n, exact_mean(F.col("close"), _last(n)))


def rounded_partial_sma(n: int = 5) -> Column:
    return rounded_mean(F.col("close"), 2, _last(n))


def sma(closes: DataFrame, n: int = 5) -> DataFrame:
    """Mean of the last ``n`` closes, or of as many as exist."""
    return _as_calc_date(closes, rounded_partial_sma(n).alias("sma_price"))


def strict_smas(closes: DataFrame, windows: tuple[int, ...] = (20, 50, 200)) -> DataFrame:
    return closes.withColumns({f"sma{n}": strict_sma(n) for n in windows})


# Change, return and volatility -----------------------------------------------

def with_changes(closes: DataFrame) -> DataFrame:
    """Previous close, difference and relative change."""
    return closes.withColumn("prev_close", F.lag("close").over(by_day())).withColumns({
        "change": F.col("close") - F.col("prev_close"),
        "pct_change": ratio(F.col("close"), F.col("prev_close")) - 1,
    })
