"""High-water marks: the newest capture time per symbol and month, kept beside a history.

A snapshot later than its symbol's mark cannot be in the history, so a fresh batch is appended
without reading any old data file; only rows at or below a mark are looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.snapshots import deduplicate
from tickforge.schemas import HISTORY_SCHEMA, MONTH
from tickforge.session import scratch_path
from tickforge.sources.upsert import drop_stage, stored_months
from tickforge.sources.writers import append_history, new_rows, read_if_exists, replace_partitions

MARK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("newest", T.TimestampNTZType()),
    T.StructField(MONTH, T.StringType()),
])
BY_MONTH = T.StructType([*HISTORY_SCHEMA.fields, T.StructField(MONTH, T.StringType())])


def _marks_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol", MONTH).agg(F.max("scrape_time").alias("newest")).select(*MARK_SCHEMA.fieldNames())


def update_marks(spark: SparkSession, history: str, marks: str, months: list[str] | None = None) -> None:
    """Takes the marks of the months, all if none are given, from the history itself.

    Needed once for a history that was written without marks, and after appends that did not
    keep them.  It also leaves one row per symbol and month, where appends add rows.
    """
    months = stored_months(spark, history) if months is None else months
    if months:
        rows = spark.read.schema(BY_MONTH).parquet(history).filter(F.col(MONTH).isin(months))
        replace_partitions(_marks_of(rows), marks, [MONTH])


def read_marks(spark: SparkSession, marks: str, months: list[str]) -> DataFrame:
    """The newest time per symbol in each of the months."""
    found = read_if_exists(spark, marks, MARK_SCHEMA)
    found = spark.createDataFrame([], MARK_SCHEMA) if found is None else found.filter(F.col(MONTH).isin(months))
    return found.groupBy("symbol", MONTH).agg(F.max("newest").alias("newest"))


def append_marked(batch: DataFrame, history: str, marks: str) -> list[str | None]:
    """Appends what the history does not hold yet; returns the months whose data files were looked up.

    Result as by ``append_new``.  Rows later than the mark of their symbol and month are new.  All
    others are looked up in the months they belong to: rows at or below the mark, without a
    time or without a day (which have no marks).  Months that are stored but have no marks get
    theirs from the history first.

    Marks are written before the rows.  If a run is lost in between, they are ahead of the
    history, and the rows of the repeated run are looked up, not found and appended.
    """
    spark = batch.sparkSession
    stage = scratch_path(spark, "marked")
    staged = T.StructType([*batch.schema.fields, T.StructField(MONTH, T.StringType()), T.StructField("late", T.BooleanType())])
    unique = deduplicate(batch).withColumn(MONTH, F.date_format("trading_date", "yyyy-MM"))
    # At most one value per calendar month.
    found = [r[0] for r in batch.select(F.date_format("trading_date", "yyyy-MM").alias(MONTH)).distinct().collect()]
    dated = sorted(m for m in found if m is not None)
    stored = set(stored_months(spark, history))
    update_marks(spark, history, marks, sorted(stored.intersection(dated).difference(stored_months(spark, marks))))

    known = read_marks(spark, marks, dated).select(F.col("symbol").alias("_symbol"), F.col(MONTH).alias("_month"), "newest")
    joined = unique.join(known, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col(MONTH) == F.col("_month")), "left")
    late = F.col(MONTH).isNull() | F.col("scrape_time").isNull() | (F.col("scrape_time") <= F.col("newest"))
    joined.select(*batch.columns, MONTH, F.coalesce(late, F.lit(False)).alias("late")).write.option("compression", "zstd").parquet(stage)
    split = spark.read.schema(staged).parquet(stage)

    fresh = split.filter("NOT late")
    looked_up = [r[0] for r in split.filter("late").select(MONTH).distinct().collect()]
    rows = fresh.select(*batch.columns)
    if looked_up:
        rows = rows.unionByName(_not_stored(split.filter("late"), history, looked_up).select(*batch.columns))
    _marks_of(fresh.filter(F.col(MONTH).isNotNull())).write.mode("append").partitionBy(MONTH).parquet(marks)
    append_history(rows, history)
    drop_stage(spark, stage)
    return sorted(looked_up, key=str)


def _not_stored(late: DataFrame, history: str, months: list[str | None]) -> DataFrame:
    old = read_if_exists(late.sparkSession, history, BY_MONTH)
    if old is None:
        return late
    read = F.col(MONTH).isin([m for m in months if m is not None])
    return new_rows(late, old.filter(read | F.col(MONTH).isNull() if None in months else read))
