"""Wide daily and monthly tables from separate indicator frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.labels import liquidity_class
from tickforge.functions.numeric import two_digits
from tickforge.operators import daily as D
from tickforge.schemas import (
    DAILY_KEY, DAILY_SCHEMA, DAILY_VALUES, MARKET_LIQUIDITY_FILLER, MARKET_SYMBOL, MONTHLY_KEY, MONTHLY_SCHEMA,
)


def conform(df: DataFrame, schema) -> DataFrame:
    """All columns of ``schema`` in order; missing ones become typed nulls."""
    present = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def outer_join_daily(frames: list[DataFrame]) -> DataFrame:
    """Full outer joins on (symbol, calc_date); value columns must be disjoint."""
    return reduce(lambda left, right: left.join(right, DAILY_KEY, "full_outer"), frames)


def attach_record_day(daily: DataFrame, records: DataFrame) -> DataFrame:
    """Record-volume day next to every row of its symbol."""
    return daily.join(records.select("symbol", "max_volume_date", "max_volume_value"), "symbol", "left")


def outer_join_monthly(averages: DataFrame, volumes: DataFrame) -> DataFrame:
    return averages.join(volumes, MONTHLY_KEY, "full_outer")


def with_market_rows(symbol_rows: DataFrame, market_rows: DataFrame) -> DataFrame:
    return symbol_rows.unionByName(market_rows, allowMissingColumns=True)


def merge_sparse(rows: DataFrame, keys: list[str], sequence: str, few: bool = False) -> DataFrame:
    """One row per key from partial rows: for each column the newest non-null value.

    With ``few`` the caller states that a key has a handful of rows, as where each of some frames holds it once.
    Rows then move as they are: tasks would sort them beforehand and merge none.
    """
    if few:
        rows = rows.repartition(*keys)
    values = [c for c in rows.columns if c not in keys and c != sequence]
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(sequence))).alias(c) for c in values]
    return rows.groupBy(*keys).agg(*newest)


def union_sparse(frames: list[DataFrame], schema=DAILY_SCHEMA, sequence: str = "seq") -> DataFrame:
    """Partial frames padded to ``schema`` and numbered in the order given."""
    padded = [conform(f, schema).withColumn(sequence, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(DataFrame.unionByName, padded)


def daily_analysis(summary: DataFrame) -> DataFrame:
    """Wide daily table with market rows from ``daily_summary`` output.

    The history is read once.  Market totals come out of the same frame through grouping
    sets, so no second scan is needed.
    """
    return add_market_rows(daily_figures(summary), weekdays_only=True)


def daily_figures(summary: DataFrame) -> DataFrame:
    """The daily figures next to each row of ``daily_summary``; all windows share one distribution and order by symbol and day."""
    weekday = ~F.dayofweek("trading_date").isin(1, 7)
    # The previous weekday's close, skipping weekend rows.
    seen = F.when(weekday, F.col("close"))
    before = D.by_day().rowsBetween(Window.unboundedPreceding, -1)
    step = F.signum(F.col("close") - F.last(seen, ignorenulls=True).over(before)).cast("int")
    base = summary.withColumns({
        "_weekday": weekday,
        "_step": F.when(weekday, F.coalesce(step, F.lit(0))),
        "_row": F.sum(F.when(weekday, 1).otherwise(0)).over(D.to_date()).cast("int"),
        "max_close_price": two_digits(F.max("close").over(D.to_date())),
        "min_close_price": two_digits(F.min("close").over(D.to_date())),
        "sma_price": D.rounded_partial_sma(5).cast("decimal(18,2)"),
        "max_volume_value": F.max("max_volume").over(D.by_symbol()),
    })
    not_up = F.coalesce(F.max(F.when(F.col("_step") <= 0, F.col("_row"))).over(D.to_date()), F.lit(0))
    not_down = F.coalesce(F.max(F.when(F.col("_step") >= 0, F.col("_row"))).over(D.to_date()), F.lit(0))
    record = F.min(F.when(F.col("max_volume") == F.col("max_volume_value"), F.col("trading_date"))).over(D.by_symbol())
    return base.withColumns({
        "up_days_count": F.when(F.col("_weekday"), F.col("_row") - not_up),
        "down_days_count": F.when(F.col("_weekday"), F.col("_row") - not_down),
        "max_volume_date": record,
        "total_volume": F.col("max_volume"),
        "max_intraday_volatility": two_digits(F.col("high") - F.col("low")),
        "max_intraday_drop": two_digits(F.col("max_drop")),
        "calc_date": F.col("trading_date"),
    })


def add_market_rows(rows: DataFrame, weekdays_only: bool) -> DataFrame:
    """Daily rows plus one market row per day, from one pass over ``rows``.

    ``rows`` also carries ``volume``, the closing volume of the day.

    Each row is kept as it is and once more as a bare volume for its day; the
    bare volumes are then summed per day with map-side partials.  Only
    fixed-width values are aggregated, so the aggregation hashes and does not
    sort; the liquidity text is derived afterwards from the closing volume.
    """
    values = [c for c in DAILY_VALUES if c not in ("total_volume", "liquidity_status")]
    grouped = rows.select(*DAILY_KEY, "total_volume", *values, "volume").groupingSets(
        [["symbol", "calc_date"], ["calc_date"]], "symbol", "calc_date"
    ).agg(
        F.grouping("symbol").alias("_market"),
        F.max("total_volume").alias("_total"),
        F.sum("volume").alias("_volume"),
        *[F.max(c).alias(f"_{c}") for c in values],
    )
    market = F.col("_market") == 1
    classed = ~market & (~F.dayofweek("calc_date").isin(1, 7) if weekdays_only else F.lit(True))
    return conform(grouped.select(
        F.when(market, MARKET_SYMBOL).otherwise(F.col("symbol")).alias("symbol"),
        "calc_date",
        F.when(market, F.col("_volume")).otherwise(F.col("_total")).alias("total_volume"),
        F.when(classed, liquidity_class(F.col("_volume"))).alias("liquidity_status"),
        *[F.when(~market, F.col(f"_{c}")).alias(c) for c in values],
    ), DAILY_SCHEMA)


def beside_market_rows(rows: DataFrame, stored: DataFrame, weekdays_only: bool) -> DataFrame:
    """As ``add_market_rows``, for one row per symbol and day in files: only day and volume are read again, no row moves.

    ``stored`` holds the rows' ``calc_date`` and ``volume``.
    """
    market = stored.groupBy("calc_date").agg(F.sum("volume").alias("total_volume")).withColumn("symbol", F.lit(MARKET_SYMBOL))
    return without_market_rows(rows, weekdays_only).unionByName(conform(market, DAILY_SCHEMA))


def without_market_rows(rows: DataFrame, weekdays_only: bool) -> DataFrame:
    """The rows of ``add_market_rows`` that are no market rows, for one row per symbol and day: none moves."""
    classed = ~F.dayofweek("calc_date").isin(1, 7) if weekdays_only else F.lit(True)
    return conform(rows.withColumn("liquidity_status", F.when(classed, liquidity_class(F.col("volume")))), DAILY_SCHEMA)


def market_filler(daily: DataFrame) -> DataFrame:
    """Market rows with constant filler and their own day as record day; other rows unchanged."""
    zero_price = F.lit(0).cast("decimal(18,2)")
    filler = {
        "max_volume_date": F.col("calc_date"),
        "max_volume_value": F.col("total_volume"),
        "up_days_count": F.lit(0),
        "down_days_count": F.lit(0),
        "liquidity_status": F.lit(MARKET_LIQUIDITY_FILLER),
        **dict.fromkeys(
            ["max_intraday_drop", "max_close_price", "min_close_price", "max_intraday_volatility", "sma_price"],
            zero_price,
        ),
    }
    padded = conform(daily, DAILY_SCHEMA)
    market = F.col("symbol") == MARKET_SYMBOL
    return conform(
        padded.withColumns({c: F.when(market, v).otherwise(F.col(c)) for c, v in filler.items()}), DAILY_SCHEMA
    )


def monthly_table(closes: DataFrame) -> DataFrame:
    return conform(D.monthly_analysis(closes), MONTHLY_SCHEMA)
