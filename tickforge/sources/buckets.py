"""Indicator tables stored side by side: bucketed by their join key, so joins move no row.

All tables of a set have the same buckets, one file each.  A set also holds its ``keys``, every
key that occurs in any table: left joins from there keep the bucketing, which chained full
outer joins lose after the first.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = "keys"


def table_name(group: str, part: str) -> str:
    return f"{group}_{part}"


def _store(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    # Dealt out by the same hash as the buckets, so every bucket is one task and one file.
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def store_together(frames: dict[str, DataFrame], group: str, root: str, keys: list[str], buckets: int) -> None:
    """Stores frames as tables ``group_<part>`` below ``root``; stored ones of these names are replaced.

    The whole join key is hashed, so a symbol with a large share of the rows fills no bucket.
    Choose ``buckets`` for the largest table, so that a bucket fits a task.
    """
    spark = next(iter(frames.values())).sparkSession
    for part, df in frames.items():
        _store(df, table_name(group, part), f"{root}/{part}", keys, buckets)
    every = reduce(DataFrame.union, [_part(spark, group, part).filter(_complete(keys)).select(*keys) for part in frames])
    _store(every.distinct(), table_name(group, KEYS), f"{root}/{KEYS}", keys, buckets)


def open_together(spark: SparkSession, parts: list[str], group: str, root: str, keys: list[str], buckets: int) -> None:
    """Names the tables of a stored set again, in an application whose catalogue does not know them."""
    hashed = ", ".join(f"`{k}`" for k in keys)
    for part in [*parts, KEYS]:
        columns = spark.read.parquet(f"{root}/{part}").schema.toDDL()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table_name(group, part)} ({columns}) USING parquet "
                  f"CLUSTERED BY ({hashed}) SORTED BY ({hashed}) INTO {buckets} BUCKETS LOCATION '{root}/{part}'")


def _complete(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _part(spark: SparkSession, group: str, part: str) -> DataFrame:
    return spark.table(table_name(group, part))


def outer_join_stored(spark: SparkSession, parts: list[str], group: str, keys: list[str]) -> DataFrame:
    """Full outer join of the stored tables; value columns must be disjoint.

    Rows whose key holds a null match nothing in a full outer join and are added as they are;
    their scan is skipped by the statistics where there are none.
    """
    joined = reduce(lambda left, part: left.join(_part(spark, group, part), keys, "left"), parts, _part(spark, group, KEYS))
    without = reduce(or_, [F.col(k).isNull() for k in keys])
    rest = [_part(spark, group, part).filter(without) for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rest, joined)
