"""Market-shaped views over the given tables.

Stored two-digit columns become exact numbers first and are only combined with
``+``, ``-`` and ``*``, so every engine computes the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators.clean import sane_bars
from tickforge.schemas import HISTORY_COLUMNS, PRICE


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _code(prefix: str, number: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(number).cast("string"), 6, "0"))


# Prices are first built as whole numbers of 1/10000, where arithmetic and
# comparisons are cheap, and become DECIMAL(18,4) in the last projection.
PRICES = ["close", "open", "high", "low"]


def _hundredths(number: str) -> Column:
    """A stored two-digit number times 100, exactly."""
    return F.floor(F.col(number) * 100 + 0.5)


def _with_prices(units: DataFrame) -> DataFrame:
    step = F.lit("0.0001").cast("decimal(4,4)")
    return units.withColumns({c: (F.col(c).cast("decimal(18,0)") * step).cast(PRICE) for c in PRICES})


def _line_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = _hundredths("l_extendedprice")
    shaped = read_table(spark, sf_dir, "lineitem").select(
        _code("S", "l_suppkey").alias("symbol"),
        F.to_date("l_shipdate").alias("trading_date"),
        F.expr("timestampadd(MILLISECOND, l_orderkey * 10 + l_linenumber, l_shipdate)").alias("scrape_time"),
        F.col("l_returnflag").alias("source"),
        (price * 100).alias("close"),
        (F.col("l_quantity") * 250000).cast("bigint").alias("volume"),
        (price * (_hundredths("l_discount") - _hundredths("l_tax") + 100)).alias("open"),
        (price * 3).alias("_slip"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
    )
    return shaped.withColumns({"high": F.greatest("open", "close"), "low": F.col("open") - F.col("_slip")})


def bars_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot history of several years: one row per line item."""
    return _with_prices(_line_units(spark, sf_dir).select(*HISTORY_COLUMNS))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars_raw`` after the price sanity test (which no unit changes): the cleaned history."""
    return _with_prices(sane_bars(_line_units(spark, sf_dir).select(*HISTORY_COLUMNS)))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense intraday snapshots of one month: one row per event."""
    price = _hundredths("value") + 1000
    swing = (F.col("event_id") % 11) - 5
    shaped = read_table(spark, sf_dir, "events").select(
        _code("U", "user_id").alias("symbol"),
        F.to_date("ts").alias("trading_date"),
        F.col("ts").alias("scrape_time"),
        F.col("event_type").alias("source"),
        (price * 100).alias("close"),
        ((F.get_json_object("props", "$.k").cast("bigint") + 1) * 120000).alias("volume"),
        (price * 100 + price * swing).alias("open"),
    )
    units = shaped.withColumns({"high": F.greatest("open", "close"), "low": F.least("open", "close")})
    return _with_prices(units.select(*HISTORY_COLUMNS))


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol catalogue: one row per supplier."""
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("source"))
    return read_table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("id"),
        _code("S", "s_suppkey").alias("symbol"),
        F.col("s_name").alias("bank_name"),
        "source",
        F.when(F.col("s_acctbal") >= 0, 1).otherwise(0).alias("status"),
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw landing rows with the defects cleaning has to deal with.

    Symbols in mixed spelling, four date notations, unreadable and missing
    dates, price sentinels, and a second copy of every first line of an order
    that differs in source and price.
    """
    millis = lambda c: f"cast(timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', {c}) as string)"
    line, order, part = F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_partkey")
    copies = F.expr("explode(sequence(0, case when l_linenumber = 1 then 1 else 0 end))")
    units = _line_units(spark, sf_dir).withColumn("copy", copies)
    rows = _with_prices(units.withColumn("close", F.col("close") + F.col("copy") * 10_000))
    day = (
        F.when(order % 97 == 0, F.lit(None))
        .when(order % 89 == 0, "junk")
        .when(order % 4 == 0, F.expr(millis("l_shipdate")))
        .when(order % 4 == 1, F.date_format("trading_date", "yyyy-MM-dd"))
        .when(order % 4 == 2, F.date_format("trading_date", "dd/MM/yyyy"))
        .otherwise(F.date_format("trading_date", "dd-MM-yyyy"))
    )
    price = (
        F.when(part % 50 == 0, "").when(part % 50 == 1, "NULL").when(part % 50 == 2, "null")
        .when(part % 50 == 3, "\\N").when(part % 50 == 4, "abc").when(part % 50 == 5, F.lit(None))
        .otherwise(F.col("close").cast("string"))
    )
    return rows.select(
        F.when(line % 3 == 0, F.concat(F.lit(" "), F.lower("symbol")))
        .when(line % 3 == 1, F.concat("symbol", F.lit(" "))).otherwise(F.col("symbol")).alias("symbol"),
        day.alias("trading_date"),
        F.when(line % 2 == 0, F.expr(millis("scrape_time")))
        .otherwise(F.date_format("scrape_time", "yyyy-MM-dd HH:mm:ss.SSS")).alias("scrape_time"),
        F.when(F.col("copy") == 1, "Z").otherwise(F.col("source")).alias("source"),
        price.alias("close_price"),
        "volume",
        *[F.col(c).cast("string").alias(f"{c}_price") for c in ("open", "high", "low")],
    )
