"""Schemas, key lists and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = "decimal(18,4)"

# Cleaned history, the canonical row of this package.
HISTORY_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trading_date", T.DateType()),
    T.StructField("scrape_time", T.TimestampNTZType()),
    T.StructField("source", T.StringType()),
    T.StructField("close", T.DecimalType(18, 4)),
    T.StructField("volume", T.LongType()),
    T.StructField("open", T.DecimalType(18, 4)),
    T.StructField("high", T.DecimalType(18, 4)),
    T.StructField("low", T.DecimalType(18, 4)),
])
HISTORY_COLUMNS = HISTORY_SCHEMA.fieldNames()

# Raw landing table: prices, dates and times are still text.
RAW_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trading_date", T.StringType()),
    T.StructField("scrape_time", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("close_price", T.StringType()),
    T.StructField("volume", T.LongType()),
    T.StructField("open_price", T.StringType()),
    T.StructField("high_price", T.StringType()),
    T.StructField("low_price", T.StringType()),
])

DAILY_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("calc_date", T.DateType()),
    T.StructField("total_volume", T.LongType()),
    T.StructField("max_close_price", T.DecimalType(18, 2)),
    T.StructField("min_close_price", T.DecimalType(18, 2)),
    T.StructField("up_days_count", T.IntegerType()),
    T.StructField("down_days_count", T.IntegerType()),
    T.StructField("max_volume_date", T.DateType()),
    T.StructField("max_volume_value", T.LongType()),
    T.StructField("max_intraday_volatility", T.DecimalType(18, 2)),
    T.StructField("liquidity_status", T.StringType()),
    T.StructField("max_intraday_drop", T.DecimalType(18, 2)),
    T.StructField("sma_price", T.DecimalType(18, 2)),
])

MONTHLY_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("calc_year", T.IntegerType()),
    T.StructField("calc_month", T.IntegerType()),
    T.StructField("monthly_avg_close", T.DecimalType(18, 2)),
    T.StructField("monthly_total_volume", T.LongType()),
])

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("bank_name", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("status", T.IntegerType()),
])

# Partition column of stored histories and serving tables: the calendar month.
MONTH = "history_month"

SNAPSHOT_KEY = ["symbol", "trading_date", "scrape_time"]
DAILY_KEY = ["symbol", "calc_date"]
MONTHLY_KEY = ["symbol", "calc_year", "calc_month"]
DAILY_VALUES = [c for c in DAILY_SCHEMA.fieldNames() if c not in DAILY_KEY]
MONTHLY_VALUES = [c for c in MONTHLY_SCHEMA.fieldNames() if c not in MONTHLY_KEY]

# Names used by other layers for the canonical columns.
CANONICAL_NAMES = {
    "close_price": "close",
    "open_price": "open",
    "high_price": "high",
    "low_price": "low",
    "ticker": "symbol",
    "date": "trading_date",
}

# The text forms of "no value" found in raw prices.
PRICE_SENTINELS = ["", "NULL", "null"]
TEXT_NULL = "\\N"

# Market row key, liquidity limits and labels.
MARKET_SYMBOL = "MARKET"
HIGH_LIQUIDITY = 10_000_000
MEDIUM_LIQUIDITY = 5_000_000
LIQUIDITY_LABELS = ("High", "Medium", "Low")
MARKET_LIQUIDITY_FILLER = "STABLE"

# Look-back names and their length in days.
LOOK_BACK_DAYS = {
    "1 month": 30,
    "3 months": 90,
    "6 months": 180,
    "1 year": 365,
    "2 years": 730,
    "5 years": 1825,
}

# Trading days per year, page size, default source.
TRADING_DAYS = 252
PAGE_SIZE = 25
DEFAULT_SOURCE = "CafeF"

# Capture list used when no catalogue can be read.
FALLBACK_SYMBOLS = {
    "CafeF": ["VCB", "BID", "CTG", "MBB", "TCB", "VPB", "ACB", "STB"],
    "TCBS": ["SHB", "HDB", "VIB", "TPB", "EIB", "MSB", "SSB", "LPB"],
    "FireAnt": ["OCB", "NAB", "KLB", "BVB"],
}
