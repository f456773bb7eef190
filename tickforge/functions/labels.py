"""Classes, labels and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickforge.schemas import HIGH_LIQUIDITY, LIQUIDITY_LABELS, MEDIUM_LIQUIDITY

# Colours, arrows, signal names and batch labels.
UP_COLOUR, DOWN_COLOUR = "green", "red"
UP_ARROW, DOWN_ARROW = "▲", "▼"
BULLISH, BEARISH = "BULLISH", "BEARISH"
MORNING_BATCH, AFTERNOON_BATCH = "1145", "1515"
CURRENCY = "₫"


def liquidity_class(volume: Column) -> Column:
    high, medium, low = LIQUIDITY_LABELS
    return F.when(volume >= HIGH_LIQUIDITY, high).when(volume >= MEDIUM_LIQUIDITY, medium).otherwise(low)


def batch_label(moment: Column) -> Column:
    return F.when(F.hour(moment) < 13, MORNING_BATCH).otherwise(AFTERNOON_BATCH)


def direction_colour(change: Column) -> Column:
    """Rise or no change is the up colour; a missing change counts as no change."""
    return F.when(F.coalesce(change, F.lit(0)) >= 0, UP_COLOUR).otherwise(DOWN_COLOUR)


def direction_arrow(change: Column) -> Column:
    return F.when(change >= 0, UP_ARROW).otherwise(DOWN_ARROW)


def signal_label(gap: Column) -> Column:
    return F.when(gap > 0, BULLISH).otherwise(BEARISH)


def month_label(month: Column) -> Column:
    return F.concat(F.lit("Th."), month.cast("string"))


def price_text(price: Column) -> Column:
    return F.concat(F.format_number(price, 0), F.lit(CURRENCY))


def percent_text(value: Column) -> Column:
    sign = F.when(value >= 0, "+").otherwise("")
    return F.concat(sign, F.format_string("%.2f%%", value.cast("double")))


def volume_text(volume: Column) -> Column:
    amount = volume.cast("decimal(20,0)")
    return (
        F.when(volume >= 1_000_000, F.concat(F.round(amount / 1_000_000, 1).cast("decimal(20,1)").cast("string"), F.lit("M")))
        .when(volume >= 1_000, F.concat(F.round(amount / 1_000, 0).cast("decimal(20,0)").cast("string"), F.lit("K")))
        .otherwise(volume.cast("bigint").cast("string"))
    )
