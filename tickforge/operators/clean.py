"""From raw text snapshots to the cleaned history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions import parsing as P
from tickforge.operators.snapshots import deduplicate, top_ranked, snapshot_order
from tickforge.schemas import CANONICAL_NAMES, HISTORY_COLUMNS, PRICE, SNAPSHOT_KEY

NUMERIC = ["close", "volume", "open", "high", "low"]


def is_sane_bar() -> Column:
    """All five values positive and the price inside its range; the open is not bounded."""
    positive = (
        (F.col("volume") > 0) & (F.col("close") > 0) & (F.col("open") > 0) & (F.col("high") > 0) & (F.col("low") > 0)
    )
    ordered = (F.col("high") >= F.col("low")) & (F.col("high") >= F.col("close")) & (F.col("low") <= F.col("close"))
    return positive & ordered


def sane_bars(history: DataFrame) -> DataFrame:
    return history.filter(is_sane_bar())


def reject_missing(raw: DataFrame) -> DataFrame:
    """Rows that carry a symbol, a day and a price text."""
    return raw.filter(
        F.col("symbol").isNotNull() & F.col("trading_date").isNotNull() & P.has_price_text(F.col("close_price"))
    )


def _typed_columns(price_type: str) -> list[Column]:
    return [
        P.normalise_symbol(F.col("symbol")).alias("symbol"),
        P.parse_day(F.col("trading_date")).alias("trading_date"),
        P.parse_moment(F.col("scrape_time")).alias("scrape_time"),
        F.col("source"),
        P.to_price(F.col("close_price"), price_type).alias("close"),
        F.col("volume").cast("bigint").alias("volume"),
        P.to_price(F.col("open_price"), price_type).alias("open"),
        P.to_price(F.col("high_price"), price_type).alias("high"),
        P.to_price(F.col("low_price"), price_type).alias("low"),
    ]


def with_usable_day(frame: DataFrame, day: Column) -> DataFrame:
    """Rows with a usable ``day``, which stands beside them as ``_usable_day``.

    The day comes out of a generator.  A filter on a plain computed column would be moved below the
    column, where every text is parsed and built a second time.
    """
    return frame.select("*", F.explode(F.array(day)).alias("_usable_day")).filter(F.col("_usable_day").isNotNull())


def type_raw(raw: DataFrame, price_type: str = PRICE) -> DataFrame:
    """Raw text columns to canonical typed columns."""
    return raw.select(*_typed_columns(price_type))


def clean(raw: DataFrame, strict: bool = True, price_type: str = PRICE) -> DataFrame:
    """Typed, deduplicated history.

    strict: reject missing values, keep one row per normalised key, then test
    the kept row (a bad winner removes its key).  Otherwise keep one row per
    key as written in the raw text and test nothing.
    """
    if strict:
        rows = with_usable_day(reject_missing(raw), P.parse_day(F.col("trading_date")))
        columns = [F.col("_usable_day").alias(n) if n == "trading_date" else c for n, c in zip(HISTORY_COLUMNS, _typed_columns(price_type))]
        return sane_bars(deduplicate(rows.select(*columns)))
    keys = [f"_raw_{c}" for c in SNAPSHOT_KEY]
    typed = raw.select(*[F.col(c).alias(k) for c, k in zip(SNAPSHOT_KEY, keys)], *_typed_columns(price_type))
    return top_ranked(typed, keys, snapshot_order(typed.columns)).select(*HISTORY_COLUMNS)


def canonicalise(frame: DataFrame, price_type: str = PRICE) -> DataFrame:
    """Rename to canonical names, coerce values, drop rows without a usable day."""
    present = set(frame.columns)
    renamed = frame.withColumnsRenamed({old: new for old, new in CANONICAL_NAMES.items() if old in present and new not in present})
    kinds = dict(renamed.dtypes)
    typed = {"trading_date": F.col("_usable_day")}
    if "scrape_time" in renamed.columns:
        typed["scrape_time"] = P.parse_moment(F.col("scrape_time").cast("string"))
    for name in NUMERIC:
        if name in renamed.columns:
            target = "bigint" if name == "volume" else price_type
            if kinds[name] != target:
                typed[name] = P.to_number(F.col(name).cast("string"), target)
    rows = with_usable_day(renamed, P.parse_day(F.col("trading_date").cast("string")))
    return rows.withColumns(typed).drop("_usable_day")
