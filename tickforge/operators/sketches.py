"""Box plots of any size from stored quantile sketches.

A KLL sketch per symbol and month is kept beside the history and renewed for the months of an
append.  Sketches merge, so the same month of all years, a year or the whole history needs no
snapshot again.  Whiskers and outliers come from a second pass, over the months of the groups
that have values beyond their fences only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.schemas import HISTORY_SCHEMA, MONTH
from tickforge.session import scratch_path
from tickforge.sources.writers import read_if_exists, replace_partitions

#: Size of a sketch; up to so many values its quantiles are exact.
K = 2000
SKETCH_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("n", T.LongType()), T.StructField("min_close", T.DoubleType()),
    T.StructField("max_close", T.DoubleType()), T.StructField("sketch", T.BinaryType()), T.StructField(MONTH, T.StringType()),
])
REACH = 1.5


def rank_error(k: int = K) -> float:
    """Error of a quantile's rank, as a share of all values, that 99 in 100 sketches keep to."""
    return 2.296 / k ** 0.9723


def sketch_closes(history: DataFrame, k: int = K) -> DataFrame:
    """One sketch of the closes per symbol and month of the day; rows without symbol, close or day count nothing."""
    value = F.col("close").cast("double")
    rows = history.dropna(subset=["symbol", "close", "trading_date"])
    return rows.groupBy("symbol", F.date_format("trading_date", "yyyy-MM").alias(MONTH)).agg(
        F.count("*").alias("n"), F.min(value).alias("min_close"), F.max(value).alias("max_close"),
        F.kll_sketch_agg_double(value, k).alias("sketch")).select(*SKETCH_SCHEMA.fieldNames())


def update_sketches(spark: SparkSession, history: str, sketches: str, months: list[str] | None = None, k: int = K) -> None:
    """Renews the sketches of the months, of all if none are given; a repeated update changes nothing of note."""
    rows = spark.read.schema(T.StructType([*HISTORY_SCHEMA.fields, T.StructField(MONTH, T.StringType())])).parquet(history)
    if months is not None:
        rows = rows.filter(F.col(MONTH).isin(months))
    replace_partitions(sketch_closes(rows, k), sketches, [MONTH])


def read_sketches(spark: SparkSession, sketches: str) -> DataFrame:
    found = read_if_exists(spark, sketches, SKETCH_SCHEMA)
    return spark.createDataFrame([], SKETCH_SCHEMA) if found is None else found


def _period(month: Column, pattern: str) -> Column:
    return F.date_format(F.to_date(F.concat(month, F.lit("-01"))), pattern)


def quartiles(sketches: DataFrame, period: str = "yyyy-MM") -> DataFrame:
    """Count, extremes, quartiles and fences per symbol and period from the sketches alone.

    ``period`` is a date pattern of months or coarser: ``MM`` is the same month of all years.
    """
    merged = sketches.groupBy("symbol", _period(F.col(MONTH), period).alias("period")).agg(
        F.sum("n").alias("n"), F.min("min_close").alias("min_close"), F.max("max_close").alias("max_close"),
        F.kll_merge_agg_double("sketch").alias("_all"))
    cuts = F.kll_sketch_get_quantile_double("_all", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    boxes = merged.withColumn("_q", cuts).select(
        "symbol", "period", "n", "min_close", "max_close",
        *[F.col("_q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))])
    reach = (F.col("q3") - F.col("q1")) * REACH
    return boxes.withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})


def box_plots(spark: SparkSession, history: str, sketches: str, period: str = "yyyy-MM") -> DataFrame:
    """All box fields per symbol and period: quartiles, whiskers, number and sum of outliers.

    Groups within their fences are done with the sketches.  Of the others the history is read
    again, in the months that hold extremes beyond the fences or that such a group spans.
    """
    stored = read_sketches(spark, sketches)
    # Sketches are merged once; what follows reads the boxes four times.
    merged, place = quartiles(stored, period), scratch_path(spark, "boxes")
    merged.write.parquet(place)
    boxes = spark.read.schema(merged.schema).parquet(place)
    wide = boxes.filter((F.col("min_close") < F.col("low_fence")) | (F.col("max_close") > F.col("high_fence")))
    fenced = wide.select("symbol", "period", "low_fence", "high_fence")
    spans = stored.select("symbol", MONTH, "min_close", "max_close", _period(F.col(MONTH), period).alias("period"))
    # A month within the fences adds no outlier; it can still hold a whisker's end, which its extremes give.
    held = spans.join(fenced, ["symbol", "period"])
    beyond = (F.col("min_close") < F.col("low_fence")) | (F.col("max_close") > F.col("high_fence"))
    # At most one value per calendar month.
    months = sorted(r[0] for r in held.filter(beyond).select(MONTH).distinct().collect())
    value = F.col("close").cast("double")
    rows = spark.read.schema(T.StructType([*HISTORY_SCHEMA.fields, T.StructField(MONTH, T.StringType())])).parquet(history)
    rows = rows.filter(F.col(MONTH).isin(months) & F.col("close").isNotNull()).select(
        "symbol", _period(F.col(MONTH), period).alias("period"), MONTH, value.alias("low"), value.alias("high"))
    rows = rows.join(held.filter(beyond).select("symbol", "period", MONTH, "low_fence", "high_fence"), ["symbol", "period", MONTH])
    inner = held.filter(~beyond).select("symbol", "period", F.col("min_close").alias("low"), F.col("max_close").alias("high"))
    inside = (F.col("low") >= F.col("low_fence")) & (F.col("high") <= F.col("high_fence"))
    ends = rows.withColumn("_in", inside).select("symbol", "period", "low", "high", "_in").unionByName(inner.withColumn("_in", F.lit(True)))
    outer = ends.groupBy("symbol", "period").agg(
        F.min(F.when(F.col("_in"), F.col("low"))).alias("_low"), F.max(F.when(F.col("_in"), F.col("high"))).alias("_high"),
        F.sum(F.when(F.col("_in"), 0).otherwise(1)).alias("_number"),
        F.sum(F.when(F.col("_in"), 0.0).otherwise(F.col("low"))).alias("_sum"))
    reached = F.col("_number").isNotNull()
    return boxes.join(outer, ["symbol", "period"], "left").select(
        "symbol", "period", "n", "min_close", "q1", "median", "q3", "max_close",
        F.when(reached, F.col("_low")).otherwise(F.col("min_close")).alias("whisker_low"),
        F.when(reached, F.col("_high")).otherwise(F.col("max_close")).alias("whisker_high"),
        F.coalesce("_number", F.lit(0)).cast("bigint").alias("n_outliers"), F.coalesce("_sum", F.lit(0.0)).alias("outlier_sum"))


def outliers(history: DataFrame, boxes: DataFrame, period: str = "yyyy-MM") -> DataFrame:
    """The snapshots beyond the fences of their group, as rows, so that a group may have any number of them."""
    fenced = boxes.select(F.col("symbol").alias("_symbol"), F.col("period").alias("_period"), "low_fence", "high_fence")
    value = F.col("close").cast("double")
    near = (F.col("symbol").eqNullSafe(F.col("_symbol"))) & (F.date_format("trading_date", period) == F.col("_period"))
    return history.join(fenced, near).filter((value < F.col("low_fence")) | (value > F.col("high_fence"))).select(*history.columns)
