"""Ordered output: sorted frames, newest rows, pages.

A global ``orderBy().limit(n)`` gathers ``n`` rows per task in one place, which
is fine for small ``n`` only.  ``slice_rows`` serves any slice by counting rows
per leading sort value, level by level, and then ranks only the groups that
touch the slice.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.numeric import exact_mean
from tickforge.operators.snapshots import top_ranked
from tickforge.schemas import PAGE_SIZE

MINUTE_SLOT = "timestampdiff(MINUTE, timestamp_ntz'1970-01-01 00:00:00', cast(scrape_time as timestamp_ntz))"


def sorted_output(df: DataFrame, *columns: str) -> DataFrame:
    """Total order for a sink that asks for it."""
    return df.orderBy(*columns)


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on level values, where null equals null; the columns of ``right`` that are no levels are added."""
    renamed = right.withColumnsRenamed({n: f"{n}_r" for n in names})
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"{n}_r")) for n in names])
    return left.join(renamed, same).drop(*[f"{n}_r" for n in names])


def slice_rows(df: DataFrame, levels: dict[str, tuple[Column, bool]], order: list[Column], start, stop) -> DataFrame:
    """Rows at positions ``start`` (included) to ``stop`` (excluded) of a total order.

    ``levels`` names the leading sort expressions, each with True for descending;
    ``order`` sorts inside the last level.  Null level values come last where the order is descending and
    first where it is ascending.  ``start`` and ``stop`` are numbers or scalar columns.  The result has
    the 0-based ``position``.
    """
    names = [f"_l{i}" for i in range(len(levels))]
    keyed = df.withColumns({n: c for n, (c, _) in zip(names, levels.values())})
    start, stop = (x if isinstance(x, Column) else F.lit(x) for x in (start, stop))

    found: DataFrame | None = None
    for depth, (name, (_, descending)) in enumerate(zip(names, levels.values())):
        upper, here = names[:depth], names[: depth + 1]
        # At the top this window runs over the distinct leading values (calendar days);
        # below it is partitioned by the groups that touch the slice.
        window = Window.partitionBy(*upper) if upper else Window.partitionBy()
        window = window.orderBy(F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_first())
        ahead = F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        if found is None:
            counts = keyed.select(*here).groupBy(*here).agg(F.count(F.lit(1)).alias("_n"))
            placed = counts.withColumn("_start", ahead)
        else:
            above = found.withColumnRenamed("_start", "_above")
            counts = _same(keyed.select(*here), above, upper).groupBy(*here, "_above").agg(F.count(F.lit(1)).alias("_n"))
            placed = counts.withColumn("_start", F.col("_above") + ahead)
        touches = (F.col("_start") < stop) & (F.col("_start") + F.col("_n") > start)
        found = placed.filter(touches).select(*here, "_start")

    rank = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    ranked = _same(keyed, found, names).withColumn("position", F.col("_start") + rank - 1)
    return ranked.filter((F.col("position") >= start) & (F.col("position") < stop)).drop(*names, "_start")


def _newest_first(day: str) -> dict[str, tuple[Column, bool]]:
    return {"day": (F.col(day), True), "symbol": (F.col("symbol"), False)}


def newest_in_group() -> list[Column]:
    """Order of the snapshots of one symbol and day; minutes are a coarser form of the time."""
    return [F.col("scrape_time").desc(), F.col("close").desc(), F.col("volume").desc(), F.col("source").asc()]


def newest_levels() -> dict[str, tuple[Column, bool]]:
    """Levels of the newest-first order of a history: day, symbol, minute."""
    return {**_newest_first("trading_date"), "minute": (F.expr(MINUTE_SLOT), True)}


def newest_rows(history: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest snapshots: day descending, then symbol, then time descending."""
    levels = {**_newest_first("trading_date"), "minute": (F.expr(MINUTE_SLOT), True)}
    order = [F.col("scrape_time").desc(), F.col("close").desc(), F.col("volume").desc(), F.col("source").asc()]
    return slice_rows(history, levels, order, 0, n).drop("position")


def page(
    df: DataFrame, number: int, levels: dict[str, tuple[Column, bool]], order: list[Column], size: int = PAGE_SIZE,
    deep: bool = False,
) -> DataFrame:
    """Page ``number`` with its clamped number and the page count.

    A page near the front is cut from the first ``number * size`` rows, which every task
    narrows down before they are gathered: two passes with the count.  ``deep`` is for
    pages so far back that those rows would not fit a task; it locates the page level by level.
    """
    total = df.agg(F.count(F.lit(1)).alias("n"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("n") / size)).cast("bigint")
    limits = total.select(pages.alias("pages"))
    page_count = limits.scalar()
    clamped = F.greatest(F.lit(1), F.least(F.lit(number), page_count)).cast("bigint")
    start = (clamped - 1) * size
    if deep:
        rows = slice_rows(df, levels, order, start, start + size)
    else:
        first = [c.desc_nulls_last() if down else c.asc_nulls_first() for c, down in levels.values()]
        front = df.orderBy(*first, *order).limit(max(1, number) * size)
        # At most ``number * size`` rows, the caller's choice of page.
        place = F.row_number().over(Window.partitionBy().orderBy(*first, *order)) - 1
        rows = front.withColumn("position", place.cast("bigint"))
        rows = rows.filter((F.col("position") >= start) & (F.col("position") < start + size))
    return rows.withColumns({"page": clamped, "page_count": page_count})


def history_page(history: DataFrame, number: int, size: int = PAGE_SIZE, deep: bool = False) -> DataFrame:
    levels = {**_newest_first("trading_date"), "minute": (F.expr(MINUTE_SLOT), True)}
    order = [F.col("scrape_time").desc(), F.col("close").desc(), F.col("volume").desc(), F.col("source").asc()]
    return page(history, number, levels, order, size, deep)


def daily_page(daily: DataFrame, number: int, size: int = PAGE_SIZE, deep: bool = False) -> DataFrame:
    return page(daily, number, _newest_first("calc_date"), [F.col("symbol")], size, deep)


def monthly_page(monthly: DataFrame, number: int, size: int = PAGE_SIZE, deep: bool = False) -> DataFrame:
    levels = {
        "year": (F.col("calc_year"), True), "month": (F.col("calc_month"), True), "symbol": (F.col("symbol"), False),
    }
    return page(monthly, number, levels, [F.col("symbol")], size, deep)


def last_sessions(closes: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` trading days of every symbol."""
    return top_ranked(closes, ["symbol"], [F.col("trading_date").desc()], n)


def top_by_average_close(closes: DataFrame, n: int = 10) -> DataFrame:
    means = closes.groupBy("symbol").agg(exact_mean(F.col("close")).alias("avg_close"))
    return means.orderBy(F.desc("avg_close"), "symbol").limit(n)


def newest_days(history: DataFrame, n: int = 30) -> DataFrame:
    return history.select("trading_date").distinct().orderBy(F.desc("trading_date")).limit(n)


def distinct_years(history: DataFrame) -> DataFrame:
    return history.select(F.year("trading_date").alias("year")).distinct().orderBy(F.desc("year"))


def distinct_months(history: DataFrame) -> DataFrame:
    """Months with their sort key and label."""
    return history.select(
        F.date_format("trading_date", "yyyy-MM").alias("sort_key"), F.date_format("trading_date", "MM/yyyy").alias("period")
    ).distinct().orderBy("sort_key")
