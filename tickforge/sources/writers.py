"""Writers.

Partitioned writes ask for a rebalance on the partition columns: adaptive
execution then splits partitions that are too large and joins small ones, so one
hot day neither lands in a single task nor scatters into many small files.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.labels import batch_label
from tickforge.operators.snapshots import deduplicate
from tickforge.schemas import MONTH, SNAPSHOT_KEY
from tickforge.sources.readers import CSV_TIME, is_missing_path


#: Parquet settings of a history: a Bloom filter on symbols, as large as their number asks for.
SYMBOL_FILTER = {"parquet.bloom.filter.enabled#symbol": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    return df.hint("rebalance", *columns)


def read_if_exists(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return None


def new_rows(batch: DataFrame, history: DataFrame, keys: list[str] = SNAPSHOT_KEY) -> DataFrame:
    """Rows of ``batch`` whose key the history does not hold yet; null equals null."""
    known = history.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return batch.join(known, same, "left_anti")


def by_symbol(df: DataFrame) -> DataFrame:
    """Rows of a file in the order of month, symbol and time.

    The month comes first, which a write by month sorts by anyway.  Each row group then holds a
    short range of symbols, so a filter on symbols skips the others by their statistics.
    """
    times = [c for c in ("trading_date", "scrape_time") if c in df.columns]
    return df.sortWithinPartitions(MONTH, "symbol", *times)


def append_history(batch: DataFrame, path: str) -> None:
    """Plain append by month, without any test for rows already present.

    Files are sorted by symbol.  Where a row group holds too many symbols for a dictionary, a
    Bloom filter of the size that fits them takes its place.
    """
    monthly = batch.withColumn(MONTH, F.date_format("trading_date", "yyyy-MM"))
    by_symbol(rebalanced(monthly, MONTH)).write.mode("append").options(**SYMBOL_FILTER).partitionBy(MONTH).parquet(path)


def append_new(batch: DataFrame, path: str) -> None:
    """Append what the history does not hold yet, so a repeated run adds nothing.

    Only the months of the batch are read back: at most one number per calendar
    month, which go into the scan as literals and prune its folders.  Keys with nulls are
    compared like others; rows without a day have a month folder of their own.
    """
    spark = batch.sparkSession
    unique = deduplicate(batch)
    stored = T.StructType([*batch.schema.fields, T.StructField(MONTH, T.StringType())])
    history = read_if_exists(spark, path, stored)
    if history is not None:
        found = [r[0] for r in batch.select(F.date_format("trading_date", "yyyy-MM")).distinct().collect()]
        months = F.col(MONTH).isin([m for m in found if m is not None])
        if None in found:
            months = months | F.col(MONTH).isNull()
        unique = new_rows(unique, history.filter(months))
    append_history(unique, path)


def export_text(history: DataFrame, path: str) -> None:
    """Delimited text without header; dates as text, rows without a day left out."""
    rows = history.filter(F.col("trading_date").isNotNull()).select(
        "symbol", F.col("trading_date").cast("string"), F.col("scrape_time").cast("string"),
        "source", "close", "volume", "open", "high", "low",
    )
    rows.write.mode("overwrite").option("header", False).option("nullValue", "\\N").csv(path)


def export_view(view: DataFrame, path: str) -> None:
    """User export of a filtered view: CSV with a header line."""
    view.write.mode("overwrite").options(header=True, timestampNTZFormat=CSV_TIME).csv(path)


def write_result(df: DataFrame, path: str) -> None:
    """JSON result set of one indicator."""
    df.write.mode("overwrite").json(path)


def replace_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace only the partitions that occur in ``df``."""
    rebalanced(df, *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *columns
    ).parquet(path)


def with_batch_partitions(history: DataFrame) -> DataFrame:
    """Partition columns of the batch layout, as zero-padded text."""
    return history.withColumns({
        "p_year": F.date_format("trading_date", "yyyy"),
        "p_month": F.date_format("trading_date", "MM"),
        "p_day": F.date_format("trading_date", "dd"),
        "p_batch": batch_label(F.col("scrape_time")),
    })


def write_json_batches(captured: DataFrame, root: str) -> None:
    """JSON lines under year=/month=/day=/batch=, labelled by capture time."""
    day = F.to_date("scrape_time")
    labelled = captured.withColumns({
        "year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd"),
        "batch": batch_label(F.col("scrape_time")),
        "trading_date": F.col("trading_date").cast("string"),
        "scrape_time": F.col("scrape_time").cast("string"),
    })
    rebalanced(labelled, "year", "month", "day", "batch").write.mode("append").partitionBy(
        "year", "month", "day", "batch"
    ).json(root)


def import_table(source: DataFrame, path: str) -> None:
    """Full re-import: the previous copy is replaced."""
    source.write.mode("overwrite").parquet(path)


def reset_table(spark: SparkSession, path: str, schema) -> None:
    """Empty the landing table and keep its schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def in_reset_window(moment):
    """True from 09:00 to 09:04, when the landing table is emptied."""
    return (F.hour(moment) == 9) & (F.minute(moment) < 5)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)
