"""Search by stored values: distinct symbols and sources per month, searched before the history.

The values of a month are few where its snapshots are many.  What matches there filters the
history by month folders and by lists, which skip files and row groups.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.filters import search
from tickforge.schemas import HISTORY_COLUMNS, HISTORY_SCHEMA, MONTH
from tickforge.sources.upsert import stored_months
from tickforge.sources.writers import read_if_exists, replace_partitions

VALUE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("value", T.StringType()), T.StructField(MONTH, T.StringType()),
])
BY_MONTH = T.StructType([*HISTORY_SCHEMA.fields, T.StructField(MONTH, T.StringType())])
COLUMNS = ("symbol", "source")
#: Values that a filter lists; where more match, the months still prune and the text is searched in their rows.
LISTED = 2_000


def update_values(spark: SparkSession, history: str, values: str, months: list[str] | None = None) -> None:
    """Distinct values of ``COLUMNS`` in the months, all if none are given, replacing what is stored of these.

    To be called for the months of an append; months without stored values are searched row by row.
    """
    months = stored_months(spark, history) if months is None else months
    if not months:
        return
    rows = spark.read.schema(BY_MONTH).parquet(history).filter(F.col(MONTH).isin(months))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in COLUMNS]))
    distinct = rows.select(MONTH, pairs.alias("pair")).select("pair.name", "pair.value", MONTH).distinct()
    replace_partitions(distinct, values, [MONTH])


def search_stored(spark: SparkSession, history: str, values: str, text: str, regex: bool = False) -> DataFrame:
    """Rows of a stored history with the text in their symbol or source; as ``search`` on these columns.

    Months are read only where a stored value matches, or where no values are stored; rows without
    a day are always searched.  At most ``LISTED`` values and one name per month come to the driver.
    """
    rows = spark.read.schema(BY_MONTH).parquet(history)
    stored = read_if_exists(spark, values, VALUE_SCHEMA)
    if stored is None or not text.strip():
        return search(rows, text, list(COLUMNS), regex).select(*HISTORY_COLUMNS)
    hits = search(stored, text, ["value"], regex)
    months = sorted(r[0] for r in hits.select(MONTH).distinct().collect())
    found = hits.select("name", "value").distinct().limit(LISTED + 1).collect()
    unknown = sorted(set(stored_months(spark, history)) - set(stored_months(spark, values)))
    rows = rows.filter(F.col(MONTH).isin(months + unknown) | F.col(MONTH).isNull())
    if len(found) > LISTED:
        return search(rows, text, list(COLUMNS), regex).select(*HISTORY_COLUMNS)
    listed = F.col(MONTH).isin(months) & _any_of(found)
    apart = search(rows.filter(F.col(MONTH).isin(unknown) | F.col(MONTH).isNull()), text, list(COLUMNS), regex)
    return rows.filter(listed).unionByName(apart).select(*HISTORY_COLUMNS)


def _any_of(found: list) -> Column:
    lists = {c: sorted(r["value"] for r in found if r["name"] == c) for c in COLUMNS}
    return reduce(or_, [F.col(c).isin(v) for c, v in lists.items() if v], F.lit(False))
