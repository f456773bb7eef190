"""Position index: pages of a stored history by one look-up and one pruned scan.

The index counts the rows per (month, day, symbol) of a history that is stored by month.  Its
prefix sums say at which position of the newest-first order each group starts, so a page
touches the groups around it and reads their months only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.ordering import newest_in_group, newest_levels, slice_rows
from tickforge.schemas import HISTORY_COLUMNS, HISTORY_SCHEMA, MONTH, PAGE_SIZE
from tickforge.sources.upsert import stored_months
from tickforge.sources.writers import append_new, read_if_exists, replace_partitions

COUNT_SCHEMA = T.StructType([
    T.StructField("trading_date", T.DateType()), T.StructField("symbol", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField(MONTH, T.StringType()),
])
BY_MONTH = T.StructType([*HISTORY_SCHEMA.fields, T.StructField(MONTH, T.StringType())])
NO_MONTH = "none"
#: Rows of a page's groups that one task may rank; more are located by minutes.
RANKED_ROWS = 1_000_000


@dataclass
class Place:
    """Where a page lies: its number, the page count, its first position, its (day, symbol)
    groups, the position of the first of these and the rows of all."""

    page: int
    page_count: int
    start: int
    groups: list[tuple]
    base: int = 0
    rows: int = 0


def update_positions(spark: SparkSession, history: str, index: str, months: list[str | None] | None = None) -> None:
    """Counts the rows of the months anew and replaces their part of the index; of all months if none are given.

    After an append only its months need it.  A repeated update changes nothing.
    """
    rows = spark.read.schema(BY_MONTH).parquet(history)
    if months is not None:
        wanted = F.col(MONTH).isin([m for m in months if m is not None])
        rows = rows.filter(wanted | F.col(MONTH).isNull() if None in months else wanted)
    counts = rows.groupBy(MONTH, "trading_date", "symbol").agg(F.count("*").alias("n"))
    counts = counts.withColumn(MONTH, F.coalesce(MONTH, F.lit(NO_MONTH))).select(*COUNT_SCHEMA.fieldNames())
    replace_partitions(counts, index, [MONTH])


def is_current(spark: SparkSession, history: str, index: str) -> bool:
    """Whether the index has all months the history is stored under."""
    return set(stored_months(spark, history)) <= set(stored_months(spark, index))


def locate(spark: SparkSession, index: str, number: int, size: int = PAGE_SIZE) -> Place:
    """Page ``number``, clamped to the pages there are, from the index alone.

    Days run newest first with null days last; symbols ascend with nulls first.  The
    window over days holds one row per calendar day, that within the days of the page one row
    per symbol; at most ``size`` groups come to the driver.
    """
    counts = read_if_exists(spark, index, COUNT_SCHEMA)
    if counts is None:
        return Place(1, 1, 0, [])
    days = counts.groupBy("trading_date").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy().orderBy(F.col("trading_date").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    total = days.agg(F.sum("n")).first()[0] or 0
    pages = max(1, -(-total // size))
    page = max(1, min(number, pages))
    start = (page - 1) * size
    touches = (F.col("first") < start + size) & (F.col("first") + F.col("n") > start)
    touched = days.filter(touches).select(F.col("trading_date").alias("day"), F.col("first").alias("day_first"))
    ahead = Window.partitionBy("trading_date").orderBy(F.col("symbol").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.join(touched, F.col("trading_date").eqNullSafe(F.col("day"))).groupBy("trading_date", "symbol", "day_first").agg(
        F.sum("n").alias("n")).withColumn("first", F.col("day_first") + F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    groups = [tuple(r) for r in placed.filter(touches).select("trading_date", "symbol", "first", "n").collect()]
    return Place(page, pages, start, [g[:2] for g in groups], min((g[2] for g in groups), default=0), sum(g[3] for g in groups))


def indexed_page(spark: SparkSession, history: str, index: str, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Rows of a page with position, page and page count, as ``ordering.history_page`` gives them.

    Only the months and, by pushed filters, only the row groups of the page's days and symbols
    are read.  The page's groups follow each other in the order, so positions count from the
    first of them; they are ranked at once, or minute by minute if they are large.
    """
    place = locate(spark, index, number, size)
    rows = spark.read.schema(BY_MONTH).parquet(history)
    chosen = F.lit(False)
    for day, symbol in place.groups:
        chosen = chosen | (F.col("symbol").eqNullSafe(F.lit(symbol).cast("string"))
                           & F.col("trading_date").eqNullSafe(F.lit(day).cast("date")))
    stored = F.col(MONTH).isin(sorted({f"{day:%Y-%m}" for day, _ in place.groups if day is not None}))
    if any(day is None for day, _ in place.groups):
        stored = stored | F.col(MONTH).isNull()
    rows = rows.filter(stored & chosen).select(*HISTORY_COLUMNS)
    start = place.start - place.base
    if place.rows <= RANKED_ROWS:
        order = [F.col("trading_date").desc_nulls_last(), F.col("symbol").asc_nulls_first(), *newest_in_group()]
        ranked = rows.withColumn("position", (F.row_number().over(Window.partitionBy().orderBy(*order)) - 1).cast("bigint"))
        found = ranked.filter((F.col("position") >= start) & (F.col("position") < start + size))
    else:
        found = slice_rows(rows, newest_levels(), newest_in_group(), start, start + size)
    return found.withColumns({
        "position": (F.col("position") + place.base).cast("bigint"),
        "page": F.lit(place.page).cast("bigint"), "page_count": F.lit(place.page_count).cast("bigint")})


def append_indexed(batch: DataFrame, history: str, index: str) -> None:
    """Appends what the history lacks and brings the index of the batch's months up to date."""
    spark = batch.sparkSession
    append_new(batch, history)
    # At most one value per calendar month.
    months = [r[0] for r in batch.select(F.date_format("trading_date", "yyyy-MM")).distinct().collect()]
    update_positions(spark, history, index, months)
