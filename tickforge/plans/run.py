"""One run of the pipeline: a raw batch into the history, then refreshed serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators import consolidate as C
from tickforge.operators.clean import clean
from tickforge.operators.snapshots import daily_summary
from tickforge.plans.incremental import DailyTable, Scratch
from tickforge.schemas import DAILY_SCHEMA, HISTORY_COLUMNS, HISTORY_SCHEMA, MONTH, MONTHLY_SCHEMA
from tickforge.session import scratch_path, sparing
from tickforge.sources import messages as M
from tickforge.sources.readers import read_by_month
from tickforge.sources.upsert import drop_applied, upsert_daily, upsert_monthly
from tickforge.sources.writers import append_new, read_if_exists, replace_partitions

PRICE = T.DecimalType(18, 4)
#: One row per symbol and day: all that the daily and monthly tables need of the history.
SUMMARY_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("trading_date", T.DateType()),
    T.StructField("max_volume", T.LongType()), T.StructField("sum_volume", T.LongType()), T.StructField("max_drop", T.DecimalType(19, 4)),
    T.StructField("close", PRICE), T.StructField("volume", T.LongType()),
    T.StructField("open", PRICE), T.StructField("high", PRICE), T.StructField("low", PRICE),
])


def run_batch(raw: DataFrame, root: str, number: int, target: dict[str, str] | None = None) -> list[str]:
    """Takes in a raw batch; see ``run_cleaned``."""
    return run_cleaned(clean(raw), root, number, target)


def run_cleaned(batch: DataFrame, root: str, number: int, target: dict[str, str] | None = None) -> list[str]:
    """Takes in cleaned snapshots and refreshes what they change below ``root``; returns the months they touch.

    Tables: ``history`` and ``summary`` (by month), ``daily`` and ``monthly`` (serving), ``states``
    and ``records`` (what later days need of earlier ones, see ``incremental``).  Only the
    months of the batch are read from the history and summarised again.  The daily table is
    computed from the summaries of these months and the state before them, and of later months
    for symbols whose state changed; the serving tables get the rows that differ, under the
    run's ``number``.  With ``target`` these rows are also published as messages.  A repeated
    run changes nothing.
    """
    spark = batch.sparkSession
    with sparing(spark):
        scratch = Scratch(spark)
        batch = scratch.staged(C.conform(batch, HISTORY_SCHEMA), "cleaned")
        # At most one value per calendar month.
        months = [r[0] for r in batch.select(F.date_format("trading_date", "yyyy-MM")).distinct().collect()]
        if months:
            append_new(batch, f"{root}/history")
            scratch.drop("cleaned")
            _refresh(spark, scratch, root, months, number, target)
        scratch.drop()
        return sorted(months)


def _refresh(spark: SparkSession, scratch: Scratch, root: str, months: list[str], number: int, target: dict[str, str] | None) -> None:
    """Summaries of these months of the history, and the serving tables that follow from them."""
    touched = read_by_month(spark, f"{root}/history", HISTORY_SCHEMA).filter(F.col(MONTH).isin(months)).select(*HISTORY_COLUMNS)
    summaries = C.conform(daily_summary(touched, unique=True), SUMMARY_SCHEMA).withColumn(MONTH, F.date_format("trading_date", "yyyy-MM"))
    replace_partitions(summaries, f"{root}/summary", [MONTH])
    summary = read_by_month(spark, f"{root}/summary", SUMMARY_SCHEMA)
    monthly = C.monthly_table(summary.filter(F.col(MONTH).isin(months)))
    table = DailyTable(spark, root, SUMMARY_SCHEMA, scratch)
    daily, states = table.refresh(months)
    monthly = _changed(scratch, monthly, f"{root}/monthly", MONTHLY_SCHEMA, months)
    for changed, name, schema, upsert, topic in (
        (daily, "daily", DAILY_SCHEMA, upsert_daily, M.DAILY_TOPIC), (monthly, "monthly", MONTHLY_SCHEMA, upsert_monthly, M.MONTHLY_TOPIC),
    ):
        if target is not None:
            M.publish(M.as_keyed_messages(changed, schema), topic, target)
        # The rows are in files of their own already.
        stage = scratch_path(spark, f"stage-{name}")
        upsert(changed.withColumn("seq", F.lit(number).cast("bigint")), f"{root}/{name}", stage, durable=True)
        drop_applied(spark, stage)
        # A first run gives the daily rows as its steps wrote them.
        scratch.drop(f"changed-{name}", f"{name}-rows")
    table.store(states)


def _changed(scratch: Scratch, rows: DataFrame, table: str, schema: T.StructType, months: list[str]) -> DataFrame:
    """Rows that these months of the stored table do not hold exactly so, written down before the table changes."""
    old = read_if_exists(scratch.spark, table, T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())]))
    different = C.conform(rows, schema)
    if old is not None:
        different = different.exceptAll(old.filter(F.col(MONTH).isin(months)).select(*schema.fieldNames()))
    return scratch.staged(different, "changed-monthly")
