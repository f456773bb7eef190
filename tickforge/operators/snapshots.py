"""Choice of one snapshot per key, and closing values per trading day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.numeric import clamp_at_zero
from tickforge.schemas import SNAPSHOT_KEY

DAY_KEY = ["symbol", "trading_date"]
#: Stands for a missing time: earlier than any time a file can hold.
BEFORE_ALL = "-100000-01-01 00:00:00"


def snapshot_order(columns: list[str]) -> list[Column]:
    """Newest first, with every other column as tie-break so the winner is unique."""
    ranked = [c for c in ("scrape_time", "close", "volume", "open") if c in columns]
    rest = [c for c in ("source", "high", "low") if c in columns]
    return [F.col(c).desc() for c in ranked] + [F.col(c).asc() for c in rest]


def top_ranked(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Written as row_number plus a rank filter: Spark then cuts every map task to
    ``n`` rows per key before the shuffle, so a key that holds a large share of
    the table still sends only a few rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def latest_snapshot(history: DataFrame, keys: list[str] = DAY_KEY) -> DataFrame:
    """Newest full row per symbol and trading day."""
    return top_ranked(history, keys, snapshot_order(history.columns))


def deduplicate(history: DataFrame, keys: list[str] = SNAPSHOT_KEY) -> DataFrame:
    """One row per key; equal keys are decided by the total tie-break."""
    return top_ranked(history, keys, snapshot_order(history.columns))


def closing_row(history: DataFrame, columns: tuple[str, ...]) -> Column:
    """Aggregate: values of the first row in ``snapshot_order``, all of the same row.

    The order is written as one struct whose least value is kept, so equal times and even
    equal keys give the same row whatever order rows come in.  Descending columns are negated
    with nulls last, as in ``snapshot_order``.
    """
    time = -F.expr("unix_micros(cast(scrape_time as timestamp))")
    down = [("time", time, "bigint"), *[(c, -F.col(c), t) for c, t in (("close", "decimal(18,4)"), ("volume", "bigint"),
                                                                    ("open", "decimal(18,4)")) if c in history.columns]]
    keys = [F.struct(v.isNull(), v.cast(t)).alias(f"by_{n}") for n, v, t in down]
    ties = [F.col(c).alias(f"by_{c}") for c in ("source", "high", "low") if c in history.columns]
    return F.min(F.struct(*keys, *ties, *[F.col(c).alias(c) for c in columns]))


def newest_value(history: DataFrame, column: str) -> Column:
    """Aggregate: a value of the newest row; rows without a time come before all others.

    All buffers have a fixed width, so Spark aggregates by hash and sorts nothing.  Rows of one
    group must differ in their time; otherwise any row of the newest time may give the value.
    """
    earliest = F.lit(BEFORE_ALL).cast(history.schema["scrape_time"].dataType)
    return F.max_by(column, F.coalesce(F.col("scrape_time"), earliest)).alias(column)


def _newest(history: DataFrame, columns: tuple[str, ...], unique: bool, *figures: Column) -> DataFrame:
    grouped = history.groupBy(*DAY_KEY)
    if unique:
        return grouped.agg(*figures, *[newest_value(history, c) for c in columns])
    picked = grouped.agg(*figures, closing_row(history, columns).alias("_last"))
    return picked.withColumns({c: F.col(f"_last.{c}") for c in columns}).drop("_last")


def closing_values(history: DataFrame, *columns: str, unique: bool = False) -> DataFrame:
    """Values of the newest snapshot per symbol and day, in one aggregation.

    A map task sends one row per symbol and day.  With ``unique`` the caller states that the
    snapshot key (symbol, day, time) occurs once, as in the output of ``deduplicate`` and in
    histories kept by ``append_new``; then nothing is sorted.  Without it, equal keys are decided
    by the total tie-break.
    """
    return _newest(history, columns, unique)


def shared(summary: DataFrame) -> DataFrame:
    """The same rows, dealt out by symbol once for all frames that are taken from them.

    All columns go through one generator, so each frame asks for the same shuffle, which Spark then
    makes once; columns a frame does not need would otherwise be left out of it, and every frame had a scan, an
    aggregation and a shuffle of its own.  Windows by symbol need no further one.  ``summary`` has one row per
    symbol and day.
    """
    rest = [c for c in summary.columns if c != "symbol"]
    return summary.repartition("symbol").select("symbol", F.inline(F.array(F.struct(*rest))))


def daily_summary(history: DataFrame, unique: bool = False) -> DataFrame:
    """Everything the daily indicators need from the snapshots, in one aggregation.

    Later steps work on one row per symbol and day, so a symbol never holds more rows than
    there are calendar days.  ``unique`` is as in ``closing_values``.
    """
    return _newest(
        history, ("close", "volume", "open", "high", "low"), unique,
        F.max("volume").alias("max_volume"),
        F.sum("volume").alias("sum_volume"),
        F.max(clamp_at_zero(F.col("open") - F.col("low"))).alias("max_drop"),
    )
