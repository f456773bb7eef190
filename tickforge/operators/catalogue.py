"""The symbol catalogue: lookups, membership, edits and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.functions.parsing import normalise_symbol
from tickforge.schemas import CATALOGUE_SCHEMA, DEFAULT_SOURCE, FALLBACK_SYMBOLS


def active_symbols(catalogue: DataFrame) -> DataFrame:
    return catalogue.filter(F.col("status") == 1).select("symbol", "source")


def fallback_symbols(spark: SparkSession) -> DataFrame:
    """Capture list used when no catalogue can be read."""
    rows = [(symbol, source) for source, symbols in FALLBACK_SYMBOLS.items() for symbol in symbols]
    return spark.createDataFrame(rows, "symbol string, source string")


def with_catalogue(df: DataFrame, catalogue: DataFrame, default_source: str = DEFAULT_SOURCE) -> DataFrame:
    """Name and source of each symbol.

    No broadcast is forced: the catalogue has no fixed size, so the planner
    broadcasts it only while its measured size is below the threshold.
    """
    names = catalogue.select("symbol", "bank_name", F.col("source").alias("listed_source"))
    joined = df.join(names, "symbol", "left")
    return joined.withColumn("listed_source", F.coalesce("listed_source", F.lit(default_source)))


def new_symbols(candidates: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Candidates that are not listed yet."""
    return candidates.join(catalogue.select("symbol"), "symbol", "left_anti")


def listed_symbols(candidates: DataFrame, catalogue: DataFrame) -> DataFrame:
    return candidates.join(catalogue.select("symbol"), "symbol", "left_semi")


def apply_changes(catalogue: DataFrame, changes: DataFrame) -> DataFrame:
    """The catalogue after edits, applied per symbol in the order of ``seq``.

    ``changes`` has columns op, symbol, bank_name, source, status, id and ``seq`` (without it
    there is one edit per symbol).  insert adds an unlisted symbol with status 1 and leaves a listed one as it
    is; update sets the given values of a listed symbol; status sets only the status; delete
    removes the symbol, which a later insert lists anew.  Symbols are normalised on both sides.

    The catalogue's own row counts as a first insert.  Of a symbol's rows only those after its last delete and from
    the first insert on have an effect; each column then takes its last given value.
    """
    changes = changes if "seq" in changes.columns else changes.withColumn("seq", F.lit(0))
    columns = ["symbol", "op", "seq", "id", "bank_name", "source", "status"]
    listed = catalogue.withColumns({
        "symbol": normalise_symbol(F.col("symbol")), "op": F.lit("insert"), "seq": F.lit(None).cast("bigint")})
    edits = changes.withColumns({
        "symbol": normalise_symbol(F.col("symbol")), "seq": F.col("seq").cast("bigint"),
        "status": F.when(F.col("op") == "insert", F.lit(1)).otherwise(F.col("status")).cast("int")})
    by_symbol = Window.partitionBy("symbol")
    # The catalogue's row has no number and comes first.
    upto = by_symbol.orderBy(F.col("seq").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    deletes = F.count_if(F.col("op") == "delete")
    rows = listed.select(*columns).unionByName(edits.select(*columns)).withColumns({
        "_place": F.row_number().over(by_symbol.orderBy(F.col("seq").asc_nulls_first())),
        "_gone": deletes.over(upto), "_deletes": deletes.over(by_symbol)})
    live = rows.filter((F.col("_gone") == F.col("_deletes")) & (F.col("op") != "delete"))
    base = F.min(F.when(F.col("op") == "insert", F.col("_place"))).over(by_symbol)
    live = live.withColumn("_base", base).filter(
        (F.col("_place") == F.col("_base")) | ((F.col("_place") > F.col("_base")) & (F.col("op") != "insert")))

    def last(name: str, *ops: str):
        given = F.col(name).isNotNull() & ((F.col("_place") == F.col("_base")) | F.col("op").isin(*ops))
        return F.max_by(name, F.when(given, F.col("_place"))).alias(name)

    return live.groupBy("symbol").agg(
        F.min_by("id", "_place").alias("id"), last("bank_name", "update"), last("source", "update"), last("status", "update", "status"),
    ).select("id", "symbol", "bank_name", "source", F.col("status").cast("int").alias("status"))


def symbols_to_capture(catalogue: DataFrame) -> DataFrame:
    """Active symbols, or the fixed capture list when the catalogue lists none."""
    return first_non_empty(active_symbols(catalogue), fallback_symbols(catalogue.sparkSession))


def first_non_empty(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``fallback`` when ``primary`` has no rows; probes for a single row."""
    return fallback if primary.isEmpty() else primary


def source_shares(catalogue: DataFrame) -> DataFrame:
    """Number of symbols per source and percent of all symbols."""
    total = catalogue.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = catalogue.groupBy("source").agg(F.count(F.lit(1)).alias("members"))
    return counted.withColumn("share_pct", F.col("members").cast("double") * 100 / total)


def source_members(catalogue: DataFrame) -> DataFrame:
    """Members of each source with the size of their source, one row per member.

    Kept in long form: one source may hold a large share of the catalogue, so no
    member array is collected.  Sort by (source, id) where it is displayed.
    """
    sizes = catalogue.groupBy("source").agg(F.count(F.lit(1)).alias("members"))
    return catalogue.select("source", "id", "symbol").join(sizes, "source")


def catalogue_kpis(catalogue: DataFrame) -> DataFrame:
    return catalogue.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == 1).alias("active"),
        F.count_if(F.col("status") == 0).alias("paused"),
        F.count_distinct("source").alias("sources"),
    )


def first_listed(catalogue: DataFrame, n: int) -> DataFrame:
    return catalogue.orderBy("id").limit(n)


def empty_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CATALOGUE_SCHEMA)
