"""Price series analytics: bars, VWAP, crosses, returns, volatility, distributions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.labels import direction_colour, signal_label
from tickforge.functions.numeric import ratio
from tickforge.operators.daily import by_day, strict_sma, strict_smas, to_date, with_changes
from tickforge.operators.snapshots import DAY_KEY
from tickforge.schemas import TRADING_DAYS


def ohlc_bars(history: DataFrame, volume_mode: str = "sum") -> DataFrame:
    """Daily bars from snapshots: first open, extremes, last close, volume.

    Null opens and closes are skipped.  ``volume_mode='max'`` suits cumulative
    snapshot volumes.
    """
    volume = {"sum": F.sum, "max": F.max}[volume_mode]("volume")
    moment = F.col("scrape_time")
    return history.groupBy(*DAY_KEY).agg(
        F.min_by("open", F.when(F.col("open").isNotNull(), moment)).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.when(F.col("close").isNotNull(), moment)).alias("close"),
        volume.alias("volume"),
    )


def _turnover():
    return F.col("close") * F.col("volume")


def _with_minute(history: DataFrame) -> DataFrame:
    minute = "timestampdiff(MINUTE, timestamp_ntz'1970-01-01 00:00:00', cast(scrape_time as timestamp_ntz))"
    return history.withColumn("_minute", F.expr(minute))


def running_vwap(history: DataFrame, keys: list[str] = DAY_KEY) -> DataFrame:
    """Cumulative VWAP inside each key, ordered by snapshot time.

    One symbol's day may be very large, so the running sums are built on two
    levels: totals per minute are carried forward over the minutes of a day
    (1,440 at most), and a second window adds up the rows inside one minute.
    ``history`` holds each (key, scrape_time) once.
    """
    slotted = _with_minute(history)
    before = Window.partitionBy(*keys).orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    carried = slotted.groupBy(*keys, "_minute").agg(
        F.sum(_turnover()).alias("_value"), F.sum("volume").alias("_volume")
    ).select(
        *keys, "_minute",
        F.coalesce(F.sum("_value").over(before), zero).alias("_value_before"),
        F.coalesce(F.sum("_volume").over(before), zero).alias("_volume_before"),
    )
    inside = Window.partitionBy(*keys, "_minute").orderBy("scrape_time").rowsBetween(Window.unboundedPreceding, 0)
    local = slotted.withColumns({
        "_value": F.sum(_turnover()).over(inside), "_volume": F.sum("volume").over(inside),
    })
    vwap = ratio(F.col("_value_before") + F.col("_value"), F.col("_volume_before") + F.col("_volume"))
    helpers = ["_minute", "_value", "_volume", "_value_before", "_volume_before"]
    return local.join(carried, [*keys, "_minute"]).withColumn("vwap", vwap).drop(*helpers)


def snapshot_increments(history: DataFrame) -> DataFrame:
    """Volume added since the previous snapshot of the same day.

    Built on two levels like ``running_vwap``: the first row of a minute takes
    the last volume of the minute before it.
    """
    slotted = _with_minute(history)
    minutes = Window.partitionBy(*DAY_KEY).orderBy("_minute")
    carried = slotted.groupBy(*DAY_KEY, "_minute").agg(F.max_by("volume", "scrape_time").alias("_volume")).select(
        *DAY_KEY, "_minute", F.lag("_volume").over(minutes).alias("_carried")
    )
    inside = Window.partitionBy(*DAY_KEY, "_minute").orderBy("scrape_time")
    local = slotted.withColumn("_previous", F.lag("volume").over(inside))
    previous = F.coalesce("_previous", "_carried", F.lit(0))
    joined = local.join(carried, [*DAY_KEY, "_minute"])
    return joined.withColumn("added_volume", F.col("volume") - previous).drop("_minute", "_previous", "_carried")


def period_vwap(closes: DataFrame) -> DataFrame:
    """Cumulative VWAP over the days of each symbol; one row per symbol and day."""
    return closes.withColumn("vwap", ratio(F.sum(_turnover()).over(to_date()), F.sum("volume").over(to_date())))


def volume_direction(bars: DataFrame) -> DataFrame:
    """Bars with the previous close and the colour of the move."""
    return with_changes(bars).withColumn("color", direction_colour(F.col("change"))).drop("change", "pct_change")


def candle_direction(bars: DataFrame) -> DataFrame:
    return bars.withColumn("direction", F.when(F.col("close") >= F.col("open"), "up").otherwise("down"))


def annual_volatility(closes: DataFrame) -> DataFrame:
    spread = F.stddev_samp("pct_change") * F.sqrt(F.lit(float(TRADING_DAYS))) * 100
    return with_changes(closes).groupBy("symbol").agg(spread.alias("volatility"))


def moving_average_gap(closes: DataFrame, short: int = 10, long: int = 20) -> DataFrame:
    if short >= long:
        raise ValueError("the short window must be shorter than the long one")
    averaged = closes.withColumns({"ma_short": strict_sma(short), "ma_long": strict_sma(long)})
    return averaged.withColumn("gap", F.col("ma_short") - F.col("ma_long"))


def moving_average_crosses(closes: DataFrame, short: int = 10, long: int = 20) -> DataFrame:
    """Days on which the short average passes the long one."""
    gaps = moving_average_gap(closes, short, long).withColumn("prev_gap", F.lag("gap").over(by_day()))
    golden = (F.col("gap") > 0) & (F.col("prev_gap") <= 0)
    death = (F.col("gap") < 0) & (F.col("prev_gap") >= 0)
    cross = F.when(golden, "golden").when(death, "death")
    return gaps.withColumn("cross", cross).filter(F.col("cross").isNotNull())


def current_signal(closes: DataFrame, short: int = 10, long: int = 20) -> DataFrame:
    """Newest day with both averages: their gap and its sign."""
    gaps = moving_average_gap(closes, short, long).filter(F.col("gap").isNotNull())
    newest = [F.max_by(c, "trading_date").alias(c) for c in ("close", "ma_short", "ma_long", "gap")]
    per_symbol = gaps.groupBy("symbol").agg(F.max("trading_date").alias("trading_date"), *newest)
    return per_symbol.withColumns({"signal": signal_label(F.col("gap")), "gap_size": F.abs("gap")})


def period_return(closes: DataFrame) -> DataFrame:
    """Last close over first close, in percent."""
    first, last = F.min_by("close", "trading_date"), F.max_by("close", "trading_date")
    return closes.groupBy("symbol").agg(((ratio(last, first) - 1) * 100).alias("return_pct"))


def base_hundred(closes: DataFrame) -> DataFrame:
    """Close scaled so that the first day is 100; unscaled if that day is not positive."""
    base = F.first("close").over(to_date())
    scaled = F.when(base > 0, ratio(F.col("close"), base) * 100).otherwise(F.col("close").cast("double"))
    return closes.withColumn("normalised", scaled)


def _earliest_best(value):
    """Ordering that prefers the larger value, then the earlier day."""
    return F.struct(value.alias("value"), (-F.unix_date("trading_date")).alias("earlier"))


def largest_move_day(closes: DataFrame) -> DataFrame:
    move = F.abs("pct_change")
    moved = with_changes(closes).filter(F.col("pct_change").isNotNull())
    best = moved.groupBy("symbol").agg(F.max(_earliest_best(move)).alias("best"))
    return best.select(
        "symbol", F.date_from_unix_date(-F.col("best.earlier")).alias("max_move_date"),
        F.col("best.value").alias("max_move"),
    )


def close_extremes(closes: DataFrame) -> DataFrame:
    return closes.groupBy("symbol").agg(
        F.max("close").alias("max_close"), F.min("close").alias("min_close"), F.max("volume").alias("max_volume")
    )


def symbol_statistics(closes: DataFrame) -> DataFrame:
    """All figures of the statistics card, for every symbol in one pass."""
    prepared = strict_smas(with_changes(closes), (20, 50))
    move = F.when(F.col("pct_change").isNotNull(), _earliest_best(F.abs("pct_change")))
    newest = lambda c: F.max_by(c, "trading_date")
    first = F.min_by("close", "trading_date")
    grouped = prepared.groupBy("symbol").agg(
        newest("close").alias("price"),
        newest("sma20").alias("sma20"),
        newest("sma50").alias("sma50"),
        ((ratio(newest("close"), first) - 1) * 100).alias("return_pct"),
        (F.stddev_samp("pct_change") * F.sqrt(F.lit(float(TRADING_DAYS))) * 100).alias("volatility"),
        F.max("close").alias("max_close"),
        F.min("close").alias("min_close"),
        F.max("volume").alias("max_volume"),
        F.max(_earliest_best(F.col("volume"))).alias("_volume"),
        F.max(move).alias("_move"),
    )
    return grouped.withColumns({
        "max_vol_date": F.date_from_unix_date(-F.col("_volume.earlier")),
        "max_var_date": F.date_from_unix_date(-F.col("_move.earlier")),
    }).drop("_volume", "_move")


def monthly_absolute_change(closes: DataFrame, months: int = 18) -> DataFrame:
    """Mean absolute percent change per symbol and month, newest months of the table.

    The first day of those months is found from the days alone; changes are then computed on
    the rows from there on and the last row of each symbol before.
    """
    # One row per calendar month at most, then at most ``months`` rows.
    firsts = closes.select(F.trunc("trading_date", "month").alias("first")).distinct().orderBy(F.desc("first")).limit(months)
    start = firsts.agg(F.min("first").alias("start")).scalar()
    recent = closes.filter(F.col("trading_date") >= start).select("symbol", "trading_date", "close")
    before = closes.filter(F.col("trading_date") < start).groupBy("symbol").agg(
        F.max("trading_date").alias("trading_date"), F.max_by("close", "trading_date").alias("close"))
    changed = with_changes(recent.unionByName(before)).filter(F.col("trading_date") >= start)
    return changed.groupBy("symbol", F.date_format("trading_date", "yyyy-MM").alias("month")).agg(
        (F.avg(F.abs("pct_change")) * 100).alias("mean_abs_pct")).select("month", "symbol", "mean_abs_pct")


def monthly_distribution(closes: DataFrame, period: str = "yyyy-MM") -> DataFrame:
    """Box-plot figures of the close per symbol and month.

    With one row per symbol and day a month holds 31 closes at most, so they are
    kept as an array and the fences are applied to it without a second pass.
    ``period`` is a date pattern; ``MM`` groups the same month of all years.
    """
    values = closes.filter(F.col("close").isNotNull()).select(
        "symbol", F.date_format("trading_date", period).alias("period"), F.col("close").cast("double").alias("close")
    )
    boxes = values.groupBy("symbol", "period").agg(
        F.percentile("close", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.sort_array(F.collect_list("close")).alias("_all"),
    ).withColumns({"q1": F.col("_q")[0], "median": F.col("_q")[1], "q3": F.col("_q")[2]})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fenced = boxes.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    inside = F.filter("_all", lambda x: (x >= F.col("_low")) & (x <= F.col("_high")))
    outside = F.filter("_all", lambda x: (x < F.col("_low")) | (x > F.col("_high")))
    return fenced.select(
        "symbol", "period",
        F.array_min("_all").alias("min_close"), "q1", "median", "q3", F.array_max("_all").alias("max_close"),
        F.array_min(inside).alias("whisker_low"), F.array_max(inside).alias("whisker_high"),
        outside.alias("outliers"), F.size("_all").alias("n"),
    )


def approximate_distribution(history: DataFrame, period: str = "yyyy-MM", accuracy: int = 10_000) -> DataFrame:
    """Quartiles straight from snapshots with a mergeable sketch, for groups of any size."""
    value = F.col("close").cast("double")
    quartiles = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
    return history.groupBy("symbol", F.date_format("trading_date", period).alias("period")).agg(
        F.min(value).alias("min_close"), quartiles.alias("quartiles"), F.max(value).alias("max_close")
    )


def yearly_volume(history: DataFrame, years: list[int] | int | None = None) -> DataFrame:
    """Traded volume per year and symbol, long form."""
    dated = history.withColumn("year", F.year("trading_date"))
    if years is not None:
        wanted = years if isinstance(years, list) else [years]
        dated = dated.filter(F.col("year").isin([int(y) for y in wanted]))
    return dated.groupBy("year", "symbol").agg(F.sum("volume").alias("volume"))


def pivot_volume(long: DataFrame, rows: str, columns: str, values: list, fill_zero: bool = False) -> DataFrame:
    """Pivot of ``yearly_volume``; column values are given, so the schema is fixed.

    A value outside ``values`` raises when the pivot runs: none is left out silently.
    """
    outside = F.concat(F.lit(f"value outside the columns of {columns}: "), F.col(columns).cast("string"))
    known = F.when(F.col(columns).isNull() | F.col(columns).isin(values), F.col(columns)).otherwise(F.raise_error(outside))
    wide = long.withColumn(columns, known).groupBy(rows).pivot(columns, values).agg(F.sum("volume"))
    return wide.fillna(0, subset=[str(v) for v in values]) if fill_zero else wide


def column_values(rows: DataFrame, column: str, most: int | None = None) -> list:
    """The different values of a column in order, to be the columns of a pivot; nulls are none.

    Only that column is read; its values are the names of a schema, which the driver holds in any
    case.  With ``most``, no more than one further value comes to the driver, and more raise.
    """
    different = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    values = [r[0] for r in (different if most is None else different.limit(most + 1)).collect()]
    if most is not None and len(values) > most:
        raise ValueError(f"{column} has more than {most} values; use the map form")
    return sorted(values)


def as_map(long: DataFrame, rows: str, columns: str, value: str, name: str) -> DataFrame:
    """One row per ``rows`` with a map from ``columns`` to ``value``; for pivots of any width.

    A map holds one entry per value of ``columns``: symbols of the catalogue, or months.
    """
    entry = F.when(F.col(columns).isNotNull(), F.struct(F.col(columns), F.col(value)))
    return long.groupBy(rows).agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def yearly_map(long: DataFrame) -> DataFrame:
    """Year, a map from symbol to its volume, and the total over all rows, those without a symbol included."""
    single = long.groupBy("year", "symbol").agg(F.sum("volume").alias("volume"))
    entry = F.when(F.col("symbol").isNotNull(), F.struct("symbol", "volume"))
    return single.groupBy("year").agg(F.map_from_entries(F.collect_list(entry)).alias("by_symbol"), F.sum("volume").alias("total"))


def yearly_matrix(long: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Year by symbol with a ``total`` over all rows; years without volume of a symbol show 0.

    Columns are the symbols of the data (see ``column_values``), or those given.
    """
    names = column_values(long, "symbol") if symbols is None else symbols
    totals = long.groupBy("year").agg(F.sum("volume").alias("total"))
    if not names:
        return totals.select("year", "total")
    # Every year gets an entry per name, so a column is a place in the year's list: no look-up, however wide.
    places = long.sparkSession.createDataFrame(list(enumerate(names)), "_place int, symbol string")
    entries = totals.select("year").crossJoin(places.select("_place")).withColumn("volume", F.lit(0)).unionByName(
        long.join(F.broadcast(places), "symbol").select("year", "_place", "volume"))
    summed = entries.groupBy("year", "_place").agg(F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"))
    listed = summed.groupBy(F.col("year").alias("_year")).agg(
        F.array_sort(F.collect_list(F.struct("_place", "volume"))).alias("_entries"))
    years = totals.join(listed, F.col("year").eqNullSafe(F.col("_year"))).select(
        "year", F.col("_entries.volume").alias("volumes"), "total")
    return years.mapInArrow(_spread, T.StructType([
        years.schema["year"], *[T.StructField(n, T.LongType()) for n in names], T.StructField("total", T.LongType())]))


def _spread(batches):
    """(year, list, total) rows with a column per entry of the lists, which are equally long.

    As Spark expressions, thousands of columns take minutes to plan.
    """
    for batch in batches:
        for year, volumes, total in zip(*batch.columns):
            row = [year.as_py(), *volumes.as_py(), total.as_py()]
            kinds = [batch.schema.field(0).type, *[pa.int64()] * (len(row) - 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip(row, kinds)], [f"c{i}" for i in range(len(row))])


def monthly_change_matrix(closes: DataFrame, months: int = 18) -> DataFrame:
    """Symbol by month: mean absolute percent change over the newest months of the table, as columns ``yyyy-MM``.

    A symbol without a change in a month shows null there; one without any in these months has no row.
    """
    newest = closes.select(F.date_format("trading_date", "yyyy-MM").alias("month")).distinct().orderBy(F.desc("month")).limit(months)
    names = column_values(newest, "month", months)
    wide = as_map(monthly_absolute_change(closes, months), "symbol", "month", "mean_abs_pct", "by_month")
    return wide.select("symbol", *[F.col("by_month")[n].alias(n) for n in names])


def yearly_totals(long: DataFrame) -> DataFrame:
    return long.groupBy("year").agg(F.sum("volume").alias("total_volume"))
