"""Row filters of the read path."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.schemas import LOOK_BACK_DAYS, MONTH


def as_day(value: date | str) -> date:
    """A day given as date or as text, padded or not, with or without a time."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    year, month, day = value.strip().split("T")[0].split(" ")[0].split("-")
    return date(int(year), int(month), int(day))


def in_days(df: DataFrame, first: date | None, last: date | None, day: str = "trading_date") -> Column:
    """Condition for an inclusive range of days, each end on its own.

    The ends are literals, so they reach the scan; where the rows still carry the month they
    are stored under, only its folders are listed.
    """
    hit = F.lit(True)
    for end, compare in ((first, "__ge__"), (last, "__le__")):
        if end is not None:
            hit = hit & getattr(F.col(day), compare)(F.lit(end))
            if MONTH in df.columns:
                hit = hit & getattr(F.col(MONTH), compare)(F.lit(end.strftime("%Y-%m")))
    return hit


def for_symbols(df: DataFrame, symbols: list[str] | None) -> DataFrame:
    """Rows of the listed symbols; no list means no filter."""
    return df.filter(F.col("symbol").isin(list(symbols))) if symbols else df


def between_days(df: DataFrame, start: date | str | None, end: date | str | None, day: str = "trading_date") -> DataFrame:
    """Inclusive range, applied only when both ends are given."""
    if start is None or end is None:
        return df
    return within_days(df, start, end, day)


def within_days(df: DataFrame, start: date | str | None, end: date | str | None, day: str = "trading_date") -> DataFrame:
    """Inclusive range whose ends count each on its own."""
    first, last = (None if x is None else as_day(x) for x in (start, end))
    return df if first is None and last is None else df.filter(in_days(df, first, last, day))


def look_back(df: DataFrame, name: str, end: date | str, day: str = "trading_date") -> DataFrame:
    """Rows of the named period before ``end``, both ends included."""
    last = as_day(end)
    return df.filter(in_days(df, last - timedelta(days=LOOK_BACK_DAYS[name]), last, day))


def one_day(df: DataFrame, symbol: str, day: date | str) -> DataFrame:
    """Snapshots of one symbol and day."""
    return df.filter((F.col("symbol") == symbol) & in_days(df, as_day(day), as_day(day)))


def search(df: DataFrame, text: str, columns: list[str] | None = None, regex: bool = False) -> DataFrame:
    """Rows with the text in any column, ignoring case; literal unless ``regex``."""
    wanted = text.strip()
    if not wanted:
        return df
    hit: Column = F.lit(False)
    for name in columns or df.columns:
        value = F.col(name).cast("string")
        found = value.rlike("(?i)" + wanted) if regex else F.contains(F.lower(value), F.lit(wanted.lower()))
        hit = hit | F.coalesce(found, F.lit(False))
    return df.filter(hit)


def in_years(df: DataFrame, years: list[int] | int | None, day: str = "trading_date") -> DataFrame:
    """Rows of one year or several; None keeps all."""
    if years is None:
        return df
    hit = F.lit(False)
    for year in years if isinstance(years, (list, tuple)) else [years]:
        hit = hit | in_days(df, date(int(year), 1, 1), date(int(year), 12, 31), day)
    return df.filter(hit)


def between_months(
    df: DataFrame, start: tuple[int, int], end: tuple[int, int], day: str = "trading_date"
) -> DataFrame:
    """From the first day of one (year, month) to the last day of another."""
    last = date(end[0], end[1], calendar.monthrange(end[0], end[1])[1])
    return df.filter(in_days(df, date(start[0], start[1], 1), last, day))


def with_status(catalogue: DataFrame, status: int) -> DataFrame:
    return catalogue.filter(F.col("status") == status)


def pick_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([c for c in wanted if c in df.columns])
