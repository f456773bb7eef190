"""Text to typed values; bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickforge.schemas import PRICE, PRICE_SENTINELS, TEXT_NULL

# Accepted day formats, each with the shape of its text.
DAY_FORMATS = [
    ("yyyy-M-d", "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("d/M/yyyy", "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
    ("d-M-yyyy", "^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"),
]


def normalise_symbol(symbol: Column) -> Column:
    return F.upper(F.trim(symbol))


# Milliseconds of the years 1 to 9999; anything else is not a moment.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def millis_to_timestamp(text: Column) -> Column:
    """Epoch milliseconds as text, read in the session time zone.

    Only digits reach the cast: a cast that fails costs about 20 times a good one.
    """
    millis = F.when(text.rlike("^-?[0-9]{1,18}$"), text.try_cast("bigint"))
    in_range = F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis)
    return F.timestamp_millis(in_range).cast("timestamp_ntz")


def millis_to_date(text: Column) -> Column:
    return millis_to_timestamp(text).cast("date")


def parse_day_text(text: Column) -> Column:
    """The accepted day format that fits; a time of day after it is left out.

    A failed parse costs far more than a good one, so the shape of the text decides
    which format is tried at all.
    """
    day = F.substring_index(F.substring_index(F.trim(text), " ", 1), "T", 1)
    return F.coalesce(*[F.when(day.rlike(shape), F.try_to_date(day, fmt)) for fmt, shape in DAY_FORMATS])


def parse_day(text: Column) -> Column:
    """Epoch milliseconds or any accepted day format."""
    return F.coalesce(millis_to_date(F.trim(text)), parse_day_text(text))


def parse_moment(text: Column) -> Column:
    """Epoch milliseconds or timestamp text."""
    trimmed = F.trim(text)
    return F.coalesce(millis_to_timestamp(trimmed), trimmed.try_cast("timestamp_ntz"))


def to_number(text: Column, kind: str) -> Column:
    """A number of this type; text without any digit never reaches the cast, whose failure is dear."""
    return F.when(text.rlike(r"\p{Nd}"), text.try_cast(kind))


def to_price(text: Column, price_type: str = PRICE) -> Column:
    return to_number(F.trim(text), price_type)


def has_price_text(text: Column) -> Column:
    """False for null and for the sentinels that stand for a missing price."""
    return text.isNotNull() & ~text.isin(PRICE_SENTINELS)


def text_or_null(text: Column) -> Column:
    """Every known spelling of a missing value becomes null."""
    return F.when(~text.isin([*PRICE_SENTINELS, TEXT_NULL]), text)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def repair_epoch_day(raw: Column) -> Column:
    """Day of an epoch number: nanoseconds, unless that reads as 1970, then milliseconds."""
    micros = F.floor(raw.cast("decimal(20,0)") / 1000).cast("bigint")
    as_nanos = F.timestamp_micros(micros).cast("date")
    millis = F.when(raw.between(FIRST_MILLIS, LAST_MILLIS), raw)
    return F.when(F.year(as_nanos) == 1970, F.timestamp_millis(millis).cast("date")).otherwise(as_nanos)
