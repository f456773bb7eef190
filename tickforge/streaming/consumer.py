"""Topics to serving tables, and snapshot files to the history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import types as T

from tickforge.schemas import SNAPSHOT_KEY
from tickforge.session import sparing
from tickforge.sources import messages as M
from tickforge.sources.marks import append_marked
from tickforge.sources.upsert import drop_applied, drop_stage, upsert_daily, upsert_monthly
from tickforge.sources.writers import append_new, read_if_exists

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField(M.CORRUPT, T.StringType()),
])


def read_topics(spark: SparkSession, source: dict[str, str]) -> DataFrame:
    """Message stream with key, value, topic and offset.

    With ``path`` the topics are a folder of Parquet files; otherwise the options
    go to the Kafka source, read from the earliest offset by default.
    """
    options = dict(source)
    if "path" in options:
        return spark.readStream.schema(M.TOPIC_SCHEMA).options(
            **{k: v for k, v in options.items() if k != "path"}
        ).parquet(options["path"])
    options.setdefault("startingOffsets", "earliest")
    options.setdefault("subscribe", f"{M.DAILY_TOPIC},{M.MONTHLY_TOPIC}")
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def _sequence(decoded: DataFrame) -> DataFrame:
    """Order of messages: by time, and within a partition by offset.

    Offsets of different partitions say nothing about each other, so time comes first.
    """
    return decoded.withColumn("seq", F.struct("timestamp", "partition", F.col("offset").cast("bigint").alias("offset")))


def _quarantine(bad: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Bad messages of one batch; a repeated batch replaces its own folder.

    Batches of a new checkpoint are numbered from 0 again, so the run's identity is part of the
    folder: what earlier runs rejected stays.
    """
    rows = bad.select(*QUARANTINE_SCHEMA.fieldNames()).withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(path)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Rejected messages; empty when none was ever rejected."""
    found = read_if_exists(spark, f"{root}/quarantine", QUARANTINE_SCHEMA)
    return spark.createDataFrame([], QUARANTINE_SCHEMA) if found is None else found.select(*QUARANTINE_SCHEMA.fieldNames())


def run_identity(spark: SparkSession, checkpoint: str) -> str:
    """Identity the checkpoint gave its query; a new checkpoint gives a new one."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def evaluated(rows: DataFrame, path: str) -> DataFrame:
    """The rows of a batch as written to ``path``: one evaluation, whose columns every later step reads from files."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def consume(
    stream: DataFrame, root: str, mode: str = "replace", zero_for_missing: bool = True, available_now: bool = True,
) -> StreamingQuery:
    """Route messages by topic and upsert them below ``root``.

    Tables: ``root/daily`` and ``root/monthly``; unreadable messages go to
    ``root/quarantine``, as do messages without a key.  Batches are numbered by the checkpoint and
    staged under its identity and their number: a batch repeated after a failure gives the
    same tables, and a stream started with a new checkpoint never meets an old stage.  A stage goes as soon as
    its rows are in the tables: to apply them again changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = run_identity(batch.sparkSession, f"{root}/checkpoint")
        stage = f"{root}/stage/{run}/{batch_id}"
        # Every message is parsed once.
        with sparing(batch.sparkSession):
            decoded = evaluated(M.decode_topics(batch), f"{stage}/decoded")
        daily, monthly = (_sequence(M.of_topic(decoded, topic)) for topic in (M.DAILY_TOPIC, M.MONTHLY_TOPIC))
        good, bad = F.col(M.CORRUPT).isNull(), F.col(M.CORRUPT).isNotNull()
        upsert_daily(daily.filter(good).drop(M.CORRUPT), f"{root}/daily", f"{stage}/daily", mode, durable=True)
        drop_applied(batch.sparkSession, f"{stage}/daily")
        upsert_monthly(
            monthly.filter(good).drop(M.CORRUPT), f"{root}/monthly", f"{stage}/monthly", mode, zero_for_missing, durable=True
        )
        drop_applied(batch.sparkSession, f"{stage}/monthly")
        names = QUARANTINE_SCHEMA.fieldNames()
        rejected = daily.filter(bad).select(*names).unionByName(monthly.filter(bad).select(*names))
        _quarantine(rejected, f"{root}/quarantine", run, batch_id)
        drop_stage(batch.sparkSession, stage)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def intake(
    stream: DataFrame, history: str, checkpoint: str, available_now: bool = True, marks: str | None = None
) -> StreamingQuery:
    """Append new snapshots to the history, each key once.

    The test runs against the stored history of the batch's days, so nothing is
    dropped for being late and a repeated batch adds nothing.  With ``marks``, the folder of
    the history's high-water marks, only late rows are looked up.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        if marks is None:
            append_new(batch, history)
        else:
            append_marked(batch, history, marks)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def intake_within(
    stream: DataFrame, history: str, checkpoint: str, delay: str = "10 minutes", available_now: bool = True
) -> StreamingQuery:
    """Append with duplicates removed from stream state that lives for ``delay``.

    For feeds that deliver in time order: repeats are dropped from memory before the history is
    asked, but rows older than the watermark are not kept.  The history is appended to as by
    ``intake``, so a repeated batch adds nothing and other writers' rows stay visible.
    """
    timed = stream.withColumn("scrape_time", F.col("scrape_time").cast("timestamp"))
    unique = timed.withWatermark("scrape_time", delay).dropDuplicatesWithinWatermark(SNAPSHOT_KEY)

    def apply(batch: DataFrame, batch_id: int) -> None:
        append_new(batch.withColumn("scrape_time", F.col("scrape_time").cast("timestamp_ntz")), history)

    writer = unique.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
