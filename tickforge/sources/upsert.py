"""Keyed upserts into partitioned Parquet serving tables.

A table is partitioned by a calendar month.  An upsert touches only the months
of its rows:

1. the incoming rows are written to a stage folder and read back, so the rest
   works on durable data (unless the caller has written them already);
2. old and new rows of these months are merged and written to a second stage;
3. the merged months replace the old ones by dynamic partition overwrite.

When a batch is repeated after a failure, a finished stage 2 is used as it is.
The old months may be half replaced by then and are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.consolidate import conform, merge_sparse
from tickforge.operators.snapshots import top_ranked
from tickforge.schemas import DAILY_KEY, DAILY_SCHEMA, MONTH, MONTHLY_KEY, MONTHLY_SCHEMA
from tickforge.session import sparing
from tickforge.sources.writers import read_if_exists, replace_partitions

# What stored rows count as: older than any message, whether those are numbered or ordered by time and offset.
OLD_SEQUENCE = -1
OLD_TIME = "1900-01-01 00:00:00"


def merge_rows(
    existing: DataFrame | None, incoming: DataFrame, keys: list[str], schema: T.StructType,
    mode: str = "replace", sequence: str = "seq",
) -> DataFrame:
    """Existing rows with the incoming ones applied.

    replace: the newest row of a key counts, its nulls included.
    coalesce: the newest non-null value of each column counts.
    """
    ordered_by = incoming.schema[sequence].dataType
    if not isinstance(ordered_by, T.StructType):
        ordered_by = T.LongType()
    rows = conform(incoming, T.StructType([*schema.fields, T.StructField(sequence, ordered_by)]))
    if existing is not None:
        old = conform(existing, schema).withColumn(sequence, _oldest(ordered_by))
        rows = old.unionByName(rows)
    if mode == "coalesce":
        return conform(merge_sparse(rows, keys, sequence), schema)
    if mode == "replace":
        tie_break = [F.col(c).desc_nulls_last() for c in schema.fieldNames() if c not in keys]
        return top_ranked(rows, keys, [F.col(sequence).desc(), *tie_break]).drop(sequence)
    raise ValueError(f"unknown merge mode: {mode}")


def _oldest(kind: T.DataType) -> Column:
    if not isinstance(kind, T.StructType):
        return F.lit(OLD_SEQUENCE).cast(kind)
    values = [F.lit(OLD_TIME if isinstance(f.dataType, T.TimestampType) else OLD_SEQUENCE).cast(f.dataType).alias(f.name)
              for f in kind.fields]
    return F.struct(*values)


def located(spark: SparkSession, path: str):
    """File system and path object of ``path``, wherever it is stored."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed, as its success marker tells."""
    files, marker = located(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def stored_months(spark: SparkSession, table: str) -> list[str]:
    """Months a table is stored under, in order, from the names of its folders: no file is opened."""
    files, place = located(spark, table)
    names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{MONTH}=") and n[-1].isdigit())


def drop_stage(spark: SparkSession, stage: str) -> None:
    """Remove the stage of a batch that cannot be repeated any more."""
    files, place = located(spark, stage)
    files.delete(place, True)


def drop_applied(spark: SparkSession, stage: str) -> None:
    """Remove the stage of an upsert whose rows are all in the table.

    Its success marker goes first: a repetition that meets a half removed stage merges anew, into a table
    that holds the rows already, and changes nothing.
    """
    files, marker = located(spark, f"{stage}/merged/_SUCCESS")
    files.delete(marker, False)
    drop_stage(spark, stage)


def upsert(
    incoming: DataFrame, table: str, stage: str, keys: list[str], schema: T.StructType, month: Column,
    mode: str = "replace", fill: dict[str, Column] | None = None, durable: bool = False,
) -> None:
    """Apply ``incoming`` (with its ``seq``) to ``table``; ``stage`` is unique to this batch.

    ``fill`` has values for what is missing in a column after the merge.  With ``durable`` the
    caller states that ``incoming`` only reads files of its own, which need not be staged again.
    """
    spark = incoming.sparkSession
    with sparing(spark):
        merged_path = f"{stage}/merged"
        stored = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
        if not is_complete(spark, merged_path):
            staged = incoming.withColumn(MONTH, month)
            if not durable:
                staged.write.mode("overwrite").parquet(f"{stage}/incoming")
                staged = spark.read.parquet(f"{stage}/incoming")
            # At most one row per calendar month; literal months prune the table's folders.
            months = [r[0] for r in staged.select(MONTH).distinct().collect()]
            existing = read_if_exists(spark, table, stored)
            if existing is not None:
                existing = existing.filter(F.col(MONTH).isin(months)).drop(MONTH)
            merged = merge_rows(existing, staged, keys, schema, mode)
            merged = merged.withColumns({c: F.coalesce(F.col(c), v) for c, v in (fill or {}).items()})
            merged.withColumn(MONTH, month).write.mode("overwrite").parquet(merged_path)
        replace_partitions(spark.read.schema(stored).parquet(merged_path), table, [MONTH])


def upsert_daily(incoming: DataFrame, table: str, stage: str, mode: str = "replace", durable: bool = False) -> None:
    """Key (symbol, calc_date); rows without a key are no rows of this table."""
    keyed = incoming.filter(F.col("symbol").isNotNull() & F.col("calc_date").isNotNull())
    upsert(keyed, table, stage, DAILY_KEY, DAILY_SCHEMA, F.date_format("calc_date", "yyyy-MM"), mode, durable=durable)


def upsert_monthly(
    incoming: DataFrame, table: str, stage: str, mode: str = "replace", zero_for_missing: bool = True, durable: bool = False,
) -> None:
    """Key (symbol, calc_year, calc_month); rows without a year are skipped.

    ``zero_for_missing`` stores 0 where no average is known; in coalesce mode a stored average stays.
    """
    keyed = incoming.filter(
        F.col("symbol").isNotNull() & F.col("calc_year").isNotNull() & F.col("calc_month").isNotNull()
    )
    fill = {"monthly_avg_close": F.lit(0).cast("decimal(18,2)")} if zero_for_missing else None
    month = F.format_string("%04d-%02d", F.col("calc_year"), F.col("calc_month"))
    upsert(keyed, table, stage, MONTHLY_KEY, MONTHLY_SCHEMA, month, mode, fill, durable)


def read_serving(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    return spark.read.schema(stored).parquet(table).select(*schema.fieldNames())
