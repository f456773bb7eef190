"""Readers: columnar, partitioned, JSON lines, delimited text, database tables."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions import parsing as P
from tickforge.operators.filters import between_days, for_symbols, within_days
from tickforge.schemas import DAILY_SCHEMA, HISTORY_COLUMNS, HISTORY_SCHEMA, MONTH, MONTHLY_SCHEMA, PRICE, RAW_SCHEMA

TEXT_FIELDS = 9
# Times keep their microseconds.
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# One raw batch as JSON lines: numbers are numbers, dates and times are text.
JSON_BATCH_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trading_date", T.StringType()),
    T.StructField("scrape_time", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("close_price", T.DecimalType(18, 4)),
    T.StructField("volume", T.LongType()),
    T.StructField("open_price", T.DecimalType(18, 4)),
    T.StructField("high_price", T.DecimalType(18, 4)),
    T.StructField("low_price", T.DecimalType(18, 4)),
])


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_history(
    spark: SparkSession, path: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Cleaned history with its declared schema, so no file is opened to infer one.

    Each end of a range counts on its own; a history stored by month lists only the
    months of the range.
    """
    return within_days(read_by_month(spark, path, HISTORY_SCHEMA), start, end).select(*HISTORY_COLUMNS)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with the month it is stored under, which the range filters turn into folders.

    A table that is not stored by month has its own columns only.
    """
    frame = spark.read.schema(schema).parquet(path)
    kept = [*schema.fieldNames(), *([MONTH] if MONTH in frame.columns else [])]
    return frame.select(*kept)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw landing table with text prices."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_partitioned(spark: SparkSession, path: str, day: date | str | None = None) -> DataFrame:
    """History laid out by p_year/p_month/p_day/p_batch.

    A day is matched on an expression of the partition columns alone, so only
    its directories are listed.
    """
    frame = spark.read.parquet(path)
    if day is not None:
        parts = P.date_from_parts(F.col("p_year"), F.col("p_month"), F.col("p_day"))
        frame = frame.filter(parts == F.lit(day).cast("date"))
    return frame


def with_partition_date(frame: DataFrame) -> DataFrame:
    return frame.withColumn("calc_date", P.date_from_parts(F.col("p_year"), F.col("p_month"), F.col("p_day")))


def read_json_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; an empty frame of the same schema if the path does not exist.

    Every other error is raised.
    """
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], schema)


def batch_path(root: str, year: int, month: int, day: int, batch: str) -> str:
    return f"{root}/year={year:04d}/month={month:02d}/day={day:02d}/batch={batch}"


def read_json_batch(spark: SparkSession, root: str, year: int, month: int, day: int, batch: str) -> DataFrame:
    """One capture batch; empty when the batch was not written."""
    return read_json_or_empty(spark, batch_path(root, year, month, day, batch), JSON_BATCH_SCHEMA)


def read_json_batches(spark: SparkSession, root: str) -> DataFrame:
    """All capture batches below ``root``, without the columns of their folders; empty when there is none."""
    return read_json_or_empty(spark, root, JSON_BATCH_SCHEMA).select(*JSON_BATCH_SCHEMA.fieldNames())


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text without header: nine columns by position, cast by name."""
    names = HISTORY_SCHEMA.fieldNames()
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    text = spark.read.schema(schema).option("header", False).option("nullValue", "\\N").csv(path)
    return text.select(
        "symbol",
        P.parse_day(F.col("trading_date")).alias("trading_date"),
        P.parse_moment(F.col("scrape_time")).alias("scrape_time"),
        "source",
        *[F.col(n).try_cast("bigint" if n == "volume" else PRICE).alias(n) for n in names[4:]],
    )


def read_tolerant(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """Text lines split on commas, skipping what cannot be a snapshot.

    Skipped: blank lines, header lines, lines with fewer than nine fields (with
    ``exact``: not exactly nine), lines whose numbers do not parse.
    """
    lines = spark.read.text(path).select(F.split(F.trim("value"), ",").alias("f"))
    size = F.size("f") == TEXT_FIELDS if exact else F.size("f") >= TEXT_FIELDS
    kept = lines.filter(size & (F.lower(F.col("f")[0]) != "symbol"))
    part = lambda i: F.trim(F.col("f")[i])
    typed = kept.select(
        part(0).alias("symbol"),
        P.parse_day(part(1)).alias("trading_date"),
        P.parse_moment(part(2)).alias("scrape_time"),
        P.text_or_null(part(3)).alias("source"),
        P.to_price(part(4)).alias("close"),
        part(5).try_cast("decimal(20,2)").try_cast("bigint").alias("volume"),
        P.to_price(part(6)).alias("open"),
        P.to_price(part(7)).alias("high"),
        P.to_price(part(8)).alias("low"),
    )
    return typed.dropna(subset=["trading_date", "close", "volume", "open", "high", "low"])


def read_buffered_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Captured rows buffered as CSV with a header line."""
    return spark.read.schema(schema).options(header=True, timestampNTZFormat=CSV_TIME).csv(path)


def read_database(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Database table; filters, sort and limit on the result are pushed down.

    ``options`` carries url, dbtable, user and password; nothing is stored here.
    Set partitionColumn, lowerBound, upperBound and numPartitions to read it in
    parallel.
    """
    return spark.read.format("jdbc").options(**options).load()


def read_newest(
    spark: SparkSession, options: dict[str, str], n: int, symbols: list[str] | None = None, start=None, end=None
) -> DataFrame:
    """The ``n`` newest rows of a database table; the database filters, sorts and cuts.

    Each end of the range counts on its own, and ties of a day are put in a fixed order.
    """
    rows = within_days(for_symbols(read_database(spark, options), symbols), start, end)
    ties = [F.col(c) for c in ("symbol", "scrape_time") if c in rows.columns]
    return rows.orderBy(F.desc("trading_date"), *ties).limit(n)


def read_daily(
    spark: SparkSession, path: str, symbols: list[str] | None = None, start=None, end=None
) -> DataFrame:
    """Serving table of daily figures, with the display alias of the highest close."""
    table = between_days(for_symbols(read_by_month(spark, path, DAILY_SCHEMA), symbols), start, end, "calc_date")
    return with_display_alias(table.select(*DAILY_SCHEMA.fieldNames()))


def with_display_alias(daily: DataFrame) -> DataFrame:
    """``avg_close_price`` shows the highest close; it is not an average."""
    return daily.withColumn("avg_close_price", F.col("max_close_price"))


def read_monthly(spark: SparkSession, path: str, symbols: list[str] | None = None) -> DataFrame:
    return for_symbols(read_by_month(spark, path, MONTHLY_SCHEMA).select(*MONTHLY_SCHEMA.fieldNames()), symbols)
