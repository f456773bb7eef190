"""Minute totals and the VWAP of the day from a snapshot stream, with late rows kept.

Totals per symbol and minute are watermark state, written in update mode.  A snapshot whose
minute lies before the watermark can no longer be added to them; it goes to a side table, so
totals and side table together hold every snapshot, whatever order files come in.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickforge.functions.numeric import ratio
from tickforge.schemas import HISTORY_COLUMNS, HISTORY_SCHEMA, MONTH
from tickforge.sources.upsert import drop_stage, read_serving, upsert
from tickforge.sources.writers import read_if_exists
from tickforge.streaming.consumer import evaluated, run_identity

VALUE = T.DecimalType(38, 4)
TOTAL_KEY = ["symbol", "trading_date", "minute"]
TOTAL_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("trading_date", T.DateType()), T.StructField("minute", T.LongType()),
    T.StructField("value", VALUE), T.StructField("volume", T.LongType()), T.StructField("n", T.LongType()),
])
#: Parts that minutes are dealt out to.  Python is called once per part and batch, whatever the number of
#: symbols and days, and a busy symbol's minutes lie in many parts.
SLOTS = 1024
RESULT_SCHEMA = T.StructType([
    *TOTAL_SCHEMA.fields, T.StructField("late", T.BooleanType()),
    T.StructField("moment", T.TimestampType()), T.StructField("source", T.StringType()),
    *[T.StructField(c, HISTORY_SCHEMA[c].dataType) for c in ("close", "open", "high", "low")],
])
#: Open minutes as a task holds them; ``changed`` ones have got rows in this batch.
OPEN = pa.schema([("symbol", pa.string()), ("trading_date", pa.date32()), ("minute", pa.int64()), ("value", pa.decimal128(38, 4)),
                  ("volume", pa.int64()), ("n", pa.int64()), ("changed", pa.bool_())])
LATE = ["moment", "source", "close", "open", "high", "low"]


def minute_of(column: str):
    """Minutes since 1970."""
    return F.floor(F.unix_seconds(F.col(column).cast("timestamp")) / 60).cast("bigint")


def minute_totals(history: DataFrame) -> DataFrame:
    """Turnover, volume and number of snapshots per symbol, day and minute of a table."""
    return history.groupBy("symbol", "trading_date", minute_of("scrape_time").alias("minute")).agg(
        F.sum((F.col("close") * F.col("volume")).cast(VALUE)).cast(VALUE).alias("value"), F.sum("volume").alias("volume"), F.count("*").alias("n"))


def _summed(totals: pa.Table) -> pa.Table:
    """One row per minute; a missing value or volume adds nothing."""
    figures = [c for c in totals.column_names if c not in TOTAL_KEY]
    summed = totals.group_by(TOTAL_KEY).aggregate([(c, "max" if c == "changed" else "sum") for c in figures])
    return summed.rename_columns([*TOTAL_KEY, *figures]).cast(OPEN)


def _arrived(rows: pd.DataFrame) -> pa.Table:
    rows = rows[[*TOTAL_KEY, "value", "volume"]].assign(n=1, changed=True)
    rows = rows.fillna({"value": Decimal(0), "volume": 0})
    return _summed(pa.Table.from_pandas(rows, OPEN, preserve_index=False))


def _update(key, frames, state):
    """Adds the rows of a slot to its open minutes; yields changed totals, and rows of closed minutes as late.

    A minute is closed once its end is not after the watermark, and leaves the state then.  The
    state is an Arrow stream of the slot's open minutes.
    """
    watermark = state.getCurrentWatermarkMs()
    held = [pa.ipc.open_stream(state.get[0]).read_all()] if state.exists else []
    for rows in frames:
        closed = (rows["minute"] + 1) * 60_000 <= watermark
        if closed.any():
            yield rows[closed].assign(late=True, n=1)[RESULT_SCHEMA.fieldNames()]
        if not closed.all():
            held.append(_arrived(rows[~closed]))
    totals = _summed(pa.concat_tables(held)) if held else OPEN.empty_table()
    changed = totals.filter(totals["changed"]).drop_columns("changed").to_pandas()
    if len(changed):
        changed = changed.assign(late=False, moment=pd.NaT, **dict.fromkeys(LATE[1:]))
        yield changed[RESULT_SCHEMA.fieldNames()].astype({"moment": "datetime64[ns]"})
    still_open = totals.filter((pc.field("minute") + 1) * 60_000 > watermark)
    if len(still_open):
        unchanged = still_open.set_column(len(OPEN) - 1, OPEN.field("changed"), pa.array(np.zeros(len(still_open), bool)))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, OPEN) as writer:
            writer.write_table(unchanged)
        state.update((sink.getvalue().to_pybytes(),))
    elif state.exists:
        state.remove()


def stream_minutes(stream: DataFrame, root: str, delay: str = "10 minutes", available_now: bool = True) -> StreamingQuery:
    """Keeps ``root/minutes`` and ``root/late`` up to date from a stream of cleaned snapshots.

    The state holds the minutes that the watermark, ``delay`` behind the newest snapshot, has
    not passed.  A repeated batch writes the same totals and replaces its own late rows.
    Snapshots without a symbol, day or time have no minute and are left out.
    """
    timed = stream.dropna(subset=["symbol", "trading_date", "scrape_time"]).select(
        "symbol", "trading_date", minute_of("scrape_time").alias("minute"), (F.col("close") * F.col("volume")).cast(VALUE).alias("value"),
        "volume", F.col("scrape_time").cast("timestamp").alias("moment"), "source", "close", "open", "high", "low")
    keyed = timed.withWatermark("moment", delay).withColumn(
        "slot", F.pmod(F.xxhash64(*TOTAL_KEY), F.lit(SLOTS)))
    results = keyed.groupBy("slot").applyInPandasWithState(_update, RESULT_SCHEMA, "open binary", "update", "NoTimeout")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_identity(spark, f"{root}/checkpoint")
        stage = f"{root}/stage/{run}/{batch_id}"
        # Totals and late rows come from one evaluation of the state.
        found = evaluated(batch, f"{stage}/found")
        late = found.filter("late").select("symbol", "trading_date", "volume", *LATE)
        late.withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id)}).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(f"{root}/late")
        totals = found.filter("NOT late").select(*TOTAL_SCHEMA.fieldNames()).withColumn("seq", F.lit(batch_id).cast("bigint"))
        upsert(totals, f"{root}/minutes", stage, TOTAL_KEY, TOTAL_SCHEMA, F.date_format("trading_date", "yyyy-MM"), durable=True)
        if batch_id > 0:
            drop_stage(spark, f"{root}/stage/{run}/{batch_id - 1}")

    writer = results.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    return read_serving(spark, f"{root}/minutes", TOTAL_SCHEMA)


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """Snapshots that came after the watermark had passed their minute, as history rows."""
    fields = [f if f.name != "scrape_time" else T.StructField("moment", T.TimestampType()) for f in HISTORY_SCHEMA.fields]
    found = read_if_exists(spark, f"{root}/late", T.StructType(fields))
    if found is None:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return found.withColumn("scrape_time", F.col("moment").cast("timestamp_ntz")).select(*HISTORY_COLUMNS)


def complete_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals with the late rows added: what a batch over all snapshots gives."""
    both = read_totals(spark, root).unionByName(minute_totals(read_late(spark, root)))
    return both.groupBy(*TOTAL_KEY).agg(
        F.sum("value").cast(VALUE).alias("value"), F.sum("volume").alias("volume"), F.sum("n").alias("n"))


def day_vwap(totals: DataFrame) -> DataFrame:
    """Running VWAP of the day at the end of every minute with snapshots; a symbol's day has 1,440 minutes at most."""
    until = Window.partitionBy("symbol", "trading_date").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return totals.withColumn("vwap", ratio(F.sum("value").over(until), F.sum("volume").over(until)))
