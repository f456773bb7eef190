"""JSON messages: encoding, keyed payloads, topics, decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.consolidate import conform
from tickforge.schemas import DAILY_SCHEMA, MONTHLY_SCHEMA

# Topic names.
DAILY_TOPIC = "stock_daily_topic"
MONTHLY_TOPIC = "stock_monthly_topic"
CORRUPT = "_corrupt"

# Columns of a topic, as the Kafka source names them.
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


# Times keep their microseconds.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_json(df: DataFrame, keep_nulls: bool = False) -> Column:
    """The whole row as one JSON object."""
    options = {**JSON_OPTIONS, "ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), options)


def as_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row; null fields are left out."""
    return df.select(row_json(df).alias("value"))


def as_keyed_messages(df: DataFrame, schema: T.StructType = DAILY_SCHEMA) -> DataFrame:
    """Messages keyed by symbol, always with every field of ``schema``."""
    padded = conform(df, schema)
    return padded.select(F.col("symbol").alias("key"), row_json(padded, keep_nulls=True).alias("value"))


def publish(messages: DataFrame, topic: str, target: dict[str, str]) -> None:
    """Send messages from the executors.

    ``target`` holds writer options.  With ``path`` the topic is a folder of
    files; otherwise they go to the Kafka sink, whose connector must be on the
    class path.
    """
    options = dict(target)
    if "path" in options:
        messages.withColumn("topic", F.lit(topic)).write.mode("append").parquet(options["path"])
        return
    messages.withColumn("topic", F.lit(topic)).write.format("kafka").options(**options).save()


def _parsed(schema: T.StructType) -> Column:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _rejected(parsed: str, required: tuple[str, ...]) -> Column:
    """Text of a message that is none of its topic; null for a good one."""
    corrupt = F.when(F.col(parsed).isNull(), F.coalesce("value", F.lit(""))).otherwise(F.col(f"{parsed}.{CORRUPT}"))
    for name in required:
        corrupt = F.when(F.col(f"{parsed}.{name}").isNull(), F.coalesce(corrupt, F.col("value"))).otherwise(corrupt)
    return corrupt.alias(CORRUPT)


def _opened(messages: DataFrame, columns: list[str], parsed: str, schema: T.StructType, corrupt: Column | str) -> DataFrame:
    return messages.select(*columns, *[F.col(f"{parsed}.{f.name}").alias(f.name) for f in schema.fields], corrupt)


def decode(messages: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Fields of each message; what is not a JSON object of this shape keeps its text in ``_corrupt``.

    So does a message without one of the ``required`` fields: it belongs to no row.
    """
    columns = [c for c in messages.columns if c != "value"]
    return _opened(messages.withColumn("_m", _parsed(schema)), columns, "_m", schema, _rejected("_m", required))


#: What a message of each topic holds, and the fields it must have.  Messages without a year are
#: decoded like others; the upsert skips them.
TOPICS = {
    DAILY_TOPIC: (DAILY_SCHEMA, ("symbol", "calc_date")),
    MONTHLY_TOPIC: (MONTHLY_SCHEMA, ("symbol", "calc_month")),
}


def decode_topics(messages: DataFrame) -> DataFrame:
    """All topics in one pass: per topic a struct column of its name, and one ``_corrupt`` as ``decode`` gives it.

    Written down, no message is parsed again; ``of_topic`` reads one topic from it.
    """
    columns = [c for c in messages.columns if c != "value"]
    known = messages.filter(F.col("topic").isin(list(TOPICS)))
    parsed = known.withColumns({t: F.when(F.col("topic") == t, _parsed(schema)) for t, (schema, _) in TOPICS.items()})
    corrupt = F.lit(None).cast("string")
    for topic, (_, required) in TOPICS.items():
        corrupt = F.when(F.col("topic") == topic, _rejected(topic, required)).otherwise(corrupt)
    return parsed.select(*columns, *TOPICS, corrupt.alias(CORRUPT))


def of_topic(decoded: DataFrame, topic: str) -> DataFrame:
    """Messages of a topic from ``decode_topics``, as ``decode`` gives them."""
    columns = [c for c in decoded.columns if c not in TOPICS and c != CORRUPT]
    return _opened(decoded.filter(F.col("topic") == topic), columns, topic, TOPICS[topic][0], CORRUPT)


def daily_messages(messages: DataFrame) -> DataFrame:
    return decode(messages.filter(F.col("topic") == DAILY_TOPIC), *TOPICS[DAILY_TOPIC])


def monthly_messages(messages: DataFrame) -> DataFrame:
    return decode(messages.filter(F.col("topic") == MONTHLY_TOPIC), *TOPICS[MONTHLY_TOPIC])
