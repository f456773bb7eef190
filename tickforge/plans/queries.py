"""Registered queries: one or more per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import tables as T
from tickforge.functions import labels as L
from tickforge.functions import parsing as X
from tickforge.functions.numeric import clamp_at_zero, ratio, two_digits
from tickforge.operators import catalogue as K
from tickforge.operators import clean as Q
from tickforge.operators import consolidate as C
from tickforge.operators import daily as D
from tickforge.operators import dictionary as A
from tickforge.operators import filters as R
from tickforge.operators import ordering as O
from tickforge.operators import positions as N
from tickforge.operators import prices as P
from tickforge.operators import sketches as H
from tickforge.operators import snapshots as S
from tickforge.plans import views as V
from tickforge.plans.run import run_cleaned
from tickforge.schemas import (
    DAILY_KEY, DAILY_SCHEMA, HISTORY_COLUMNS, HISTORY_SCHEMA, MONTHLY_KEY, MONTHLY_SCHEMA, RAW_SCHEMA,
)
from tickforge.session import scratch_path, sparing
from tickforge.sources import buckets as B
from tickforge.sources import compaction as G
from tickforge.sources import messages as M
from tickforge.sources import readers as I
from tickforge.sources import upsert as U
from tickforge.sources import writers as W
from tickforge.sources.marks import append_marked
from tickforge.streaming import consumer as Z
from tickforge.streaming import minutes as Y

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; decimal results are shown as doubles."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shown(fn(spark, sf_dir))

        QUERIES[name] = run
        return fn

    return register


def shown(df: DataFrame) -> DataFrame:
    decimals = {n: F.col(n).cast("double") for n, kind in df.dtypes if kind.startswith("decimal")}
    return df.withColumns(decimals) if decimals else df


def six(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a derived data set, written once per application and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def staged_once(spark: SparkSession, sf_dir: str, name: str, frame: Callable[[], DataFrame]) -> DataFrame:
    """Rows written once per application and source folder, and read from there."""
    rows = frame()
    path = written(spark, sf_dir, name, lambda p: rows.write.parquet(p))
    return spark.read.schema(rows.schema).parquet(path)


# Only queries about sources, sinks and streams store anything; all others work on these views.
bars, ticks, landing = T.bars, T.ticks, T.raw_text


def stored_bars(spark: SparkSession, sf_dir: str) -> str:
    """Path of the cleaned history of several years, stored by month."""
    return written(spark, sf_dir, "bars", lambda p: W.append_history(T.bars(spark, sf_dir), p))


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest snapshot per symbol and day of the cleaned history."""
    return S.closing_values(bars(spark, sf_dir), "close", "volume", "open", "high", "low")


# Sources -----------------------------------------------------------------------

@query("s01_history_scan")
def _(s, d):
    return I.read_history(s, stored_bars(s, d))


@query("s01_history_range")
def _(s, d):
    return I.read_history(s, stored_bars(s, d), start="1996-3-5", end="1998-02-28 00:00:00")


@query("s02_raw_text_scan")
def _(s, d):
    return I.read_raw(s, written(s, d, "raw", lambda p: landing(s, d).write.parquet(p)))


def _partitioned(s, d) -> str:
    columns = ["p_year", "p_month", "p_day", "p_batch"]
    return written(s, d, "partitioned", lambda p: W.replace_partitions(W.with_batch_partitions(ticks(s, d)), p, columns))


@query("s03_partitioned_scan")
def _(s, d):
    return I.read_partitioned(s, _partitioned(s, d)).select(*HISTORY_COLUMNS, "p_year", "p_month", "p_day", "p_batch")


def _json_batches(s, d) -> str:
    def write(path: str) -> None:
        raw = ticks(s, d).withColumnsRenamed({c: f"{c}_price" for c in ("close", "open", "high", "low")})
        W.write_json_batches(raw, path)

    return written(s, d, "json-batches", write)


@query("s04_json_batch_scan")
def _(s, d):
    return I.read_json_batches(s, _json_batches(s, d))


@query("s05_json_or_empty")
def _(s, d):
    schema = D.daily_volume_max(bars(s, d)).schema
    path = written(s, d, "volume-json", lambda p: W.write_result(D.daily_volume_max(bars(s, d)), p))
    present, absent = I.read_json_or_empty(s, path, schema), I.read_json_or_empty(s, f"{path}-absent", schema)
    return present.unionByName(absent)


def _text_export(s, d) -> str:
    return written(s, d, "text", lambda p: W.export_text(bars(s, d), p))


@query("s06_positional_scan")
def _(s, d):
    return I.read_positional(s, _text_export(s, d))


@query("s07_tolerant_scan")
def _(s, d):
    def write(path: str) -> None:
        rows = landing(s, d)
        line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in rows.columns])
        short = F.concat_ws(",", "symbol", F.coalesce("trading_date", F.lit("")))
        header = F.lit(",".join(RAW_SCHEMA.fieldNames()))
        text = F.when(F.col("source") == "Z", F.concat(line, F.lit(",extra"))).when(
            F.col("volume") % 13 == 0, short).when(F.col("volume") % 11 == 0, header).otherwise(line)
        rows.select(text.alias("value")).write.text(path)

    return I.read_tolerant(s, written(s, d, "lines", write))


@query("s08_newest_rows_pushed")
def _(s, d):
    listed = K.active_symbols(T.symbols(s, d)).select("symbol")
    rows = I.read_history(s, stored_bars(s, d), start="1998-01-01")
    return O.newest_rows(rows.join(listed, "symbol", "left_semi"), 1000)


@query("s09_table_import")
def _(s, d):
    path = scratch_path(s, "import")
    W.import_table(bars(s, d), path)
    W.import_table(T.bars_raw(s, d), path)
    return s.read.schema(HISTORY_SCHEMA).parquet(path)


def _daily_table(s, d) -> str:
    """A serving table as the upsert leaves it: stored by month."""
    def write(path: str) -> None:
        U.upsert_daily(V.daily_analysis(bars(s, d)).withColumn("seq", F.lit(1)), f"{path}/daily", f"{path}/stage")

    return f"{written(s, d, 'daily', write)}/daily"


@query("s10_serving_scan")
def _(s, d):
    return I.read_daily(s, _daily_table(s, d), start="1996-01-01", end="1999-12-31")


@query("s11_fallback_scan")
def _(s, d):
    missing = bars(s, d).filter(F.col("volume") < 0)
    return D.daily_volume_max(K.first_non_empty(missing, bars(s, d)))


@query("s12_active_symbols")
def _(s, d):
    return K.symbols_to_capture(T.symbols(s, d))


@query("s12_fallback_symbols")
def _(s, d):
    return K.symbols_to_capture(R.with_status(T.symbols(s, d), -1))


@query("s13_buffered_csv")
def _(s, d):
    path = written(s, d, "csv", lambda p: W.export_view(ticks(s, d), p))
    return I.read_buffered_csv(s, path, ticks(s, d).schema)


@query("s15_catalogue_scan")
def _(s, d):
    return T.symbols(s, d).orderBy("id")


# Sinks -------------------------------------------------------------------------

@query("k01_history_append")
def _(s, d):
    path, rows, cut = scratch_path(s, "append"), bars(s, d), F.lit("1998-07-01").cast("date")
    W.append_history(rows.filter(F.col("trading_date") < cut), path)
    W.append_history(rows.filter(F.col("trading_date") >= cut), path)
    return I.read_history(s, path)


@query("k02_text_export")
def _(s, d):
    schema = ", ".join(f"{c} string" for c in HISTORY_COLUMNS)
    return s.read.schema(schema).option("nullValue", "\\N").csv(_text_export(s, d))


@query("k03_json_result")
def _(s, d):
    drops = D.max_intraday_drop(bars(s, d))
    return I.read_json_or_empty(s, written(s, d, "drop-json", lambda p: W.write_result(drops, p)), drops.schema)


@query("k04_partition_overwrite")
def _(s, d):
    path, columns = scratch_path(s, "overwrite"), ["p_year", "p_month", "p_day"]
    rows = W.with_batch_partitions(ticks(s, d)).drop("p_batch")
    W.replace_partitions(rows.withColumn("volume", F.lit(0).cast("bigint")), path, columns)
    W.replace_partitions(rows.filter(F.col("trading_date") >= F.lit("2024-01-15").cast("date")), path, columns)
    return s.read.parquet(path).select(*HISTORY_COLUMNS)


@query("k04_compacted_history")
def _(s, d):
    """Three appends a month; early years swept, later ones committed only, the last as appended."""
    path, rows = scratch_path(s, "compacted"), bars(s, d)
    for i in range(3):
        W.append_history(rows.filter(F.pmod(F.xxhash64("symbol", "scrape_time"), F.lit(3)) == i), path)
    G.compact(s, path, G.closed_months(s, path, "1995-01"))
    G.sweep(s, path)
    G.compact(s, path, G.closed_months(s, path, "1998-01"))
    return G.read_compacted(s, path)


@query("k05_daily_messages")
def _(s, d):
    return M.as_messages(C.with_market_rows(D.daily_volume_max(bars(s, d)), D.market_volume(bars(s, d))))


@query("k06_keyed_messages")
def _(s, d):
    return M.as_keyed_messages(D.max_intraday_drop(bars(s, d)))


@query("k07_snapshot_messages")
def _(s, d):
    return M.as_messages(ticks(s, d))


@query("k11_raw_append")
def _(s, d):
    path, rows = scratch_path(s, "raw-append"), landing(s, d)
    rows.filter(F.col("source") != "Z").write.mode("append").parquet(path)
    rows.filter(F.col("source") == "Z").write.mode("append").parquet(path)
    return I.read_raw(s, path)


@query("k12_json_batches")
def _(s, d):
    rows = s.read.schema(I.JSON_BATCH_SCHEMA).json(_json_batches(s, d))
    keys = [F.col(c).cast("int").alias(c) for c in ("year", "month", "day", "batch")]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


@query("k13_landing_reset")
def _(s, d):
    path, rows = scratch_path(s, "landing"), T.bars_raw(s, d)
    rows.write.parquet(path)
    W.reset_table(s, path, rows.schema)
    bars(s, d).write.mode("append").parquet(path)
    kept = s.read.schema(rows.schema).parquet(path)
    return kept.groupBy("trading_date").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


@query("k14_view_export")
def _(s, d):
    view = D.monthly_volume(closes(s, d))
    path = written(s, d, "view-csv", lambda p: W.export_view(view, p))
    return s.read.schema(view.schema).option("header", True).csv(path)


@query("k15_preview")
def _(s, d):
    return W.preview(O.sorted_output(D.running_close_range(closes(s, d)), *DAILY_KEY))


@query("k16_catalogue_changes")
def _(s, d):
    listed = T.symbols(s, d)
    op = F.when(F.col("id") % 5 == 0, "update").when(F.col("id") % 5 == 1, "status").when(
        F.col("id") % 5 == 2, "delete").otherwise("insert")
    known = listed.filter(F.col("id") % 5 < 4).select(
        op.alias("op"), F.lower("symbol").alias("symbol"), F.concat("bank_name", F.lit(" new")).alias("bank_name"),
        F.lit("Other").alias("source"), (1 - F.col("status")).alias("status"), "id",
    )
    fresh = T.read_table(s, d, "customer").select(
        F.lit("insert").alias("op"), T._code("C", "c_custkey").alias("symbol"), F.col("c_name").alias("bank_name"),
        F.col("c_mktsegment").alias("source"), F.lit(None).cast("int").alias("status"),
        (F.col("c_custkey") + 1_000_000_000).alias("id"),
    )
    # Every other deleted symbol is listed anew, and updated ones get one value more.
    again = listed.filter((F.col("id") % 5 == 2) & (F.col("id") % 2 == 0)).select(
        F.lit("insert").alias("op"), "symbol", F.concat("bank_name", F.lit(" again")).alias("bank_name"),
        F.lit("Again").alias("source"), F.lit(0).alias("status"), "id")
    more = listed.filter(F.col("id") % 5 == 0).select(
        F.lit("update").alias("op"), "symbol", F.lit(None).cast("string").alias("bank_name"), F.lit("More").alias("source"),
        F.lit(None).cast("int").alias("status"), "id")
    edits = known.unionByName(fresh).withColumn("seq", F.lit(1)).unionByName(again.unionByName(more).withColumn("seq", F.lit(2)))
    return K.apply_changes(listed, edits)


# Projections -------------------------------------------------------------------

@query("p01_symbol_normalised")
def _(s, d):
    return landing(s, d).groupBy(X.normalise_symbol(F.col("symbol")).alias("symbol")).agg(F.count(F.lit(1)).alias("n"))


@query("p02_epoch_millis")
def _(s, d):
    return landing(s, d).select(
        "scrape_time",
        X.millis_to_timestamp(F.col("scrape_time")).alias("moment"),
        X.millis_to_date(F.col("trading_date")).alias("day"),
    )


@query("p03_typed_columns")
def _(s, d):
    return Q.type_raw(landing(s, d))


@query("p04_partition_date")
def _(s, d):
    dated = I.with_partition_date(I.read_partitioned(s, _partitioned(s, d)))
    return D.daily_volume_sum(dated, "calc_date")


@query("p05_market_key")
def _(s, d):
    per_day = bars(s, d).groupBy(F.col("trading_date").alias("calc_date")).agg(F.sum("volume").alias("total_volume"))
    return D.with_market_key(per_day)


@query("p06_renamed_columns")
def _(s, d):
    return bars(s, d).withColumnsRenamed({"trading_date": "calc_date", "close": "close_price"}).select(
        "symbol", "calc_date", "close_price", F.col("volume").alias("traded")
    )


@query("p07_disjoint_join")
def _(s, d):
    records = D.record_volume_day(D.daily_volume_max(bars(s, d))).withColumn("calc_date", F.col("max_volume_date"))
    return C.attach_record_day(D.daily_volume_max(bars(s, d)), records)


@query("p08_canonical_frame")
def _(s, d):
    raw = landing(s, d).withColumnsRenamed({"symbol": "ticker", "trading_date": "date"})
    return Q.canonicalise(raw)


@query("p09_display_alias")
def _(s, d):
    return I.with_display_alias(D.running_close_range(closes(s, d)))


@query("p10_optional_columns")
def _(s, d):
    return R.pick_columns(bars(s, d), ["symbol", "trading_date", "close", "not_there", "volume"])


@query("p11_date_text")
def _(s, d):
    return D.intraday_volatility(closes(s, d)).withColumn("calc_date", F.col("calc_date").cast("string"))


@query("p12_row_json")
def _(s, d):
    return M.as_messages(D.monthly_volume(closes(s, d)))


@query("p13_batch_label")
def _(s, d):
    return ticks(s, d).select("symbol", "scrape_time", L.batch_label(F.col("scrape_time")).alias("batch"))


# Filters -----------------------------------------------------------------------

@query("f01_missing_rejected")
def _(s, d):
    return Q.reject_missing(landing(s, d))


@query("f02_sane_bars")
def _(s, d):
    return Q.sane_bars(T.bars_raw(s, d))


@query("f03_clean_history")
def _(s, d):
    return Q.clean(landing(s, d))


@query("f04_clean_raw_keys")
def _(s, d):
    return Q.clean(landing(s, d), strict=False)


@query("f05_weekdays")
def _(s, d):
    return D.weekdays(bars(s, d))


@query("f06_parsable_dates")
def _(s, d):
    rows = landing(s, d).withColumn("day", X.parse_day(F.col("trading_date")))
    return rows.filter(F.col("day").isNotNull()).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("f07_symbol_list")
def _(s, d):
    return R.for_symbols(bars(s, d), ["S000001", "S000003", "S000007"])


@query("f07_stored_symbols")
def _(s, d):
    return R.for_symbols(I.read_history(s, stored_bars(s, d)), ["S000001", "S000003", "S000007"])


@query("f08_date_range")
def _(s, d):
    return R.between_days(bars(s, d), "1996-03-01", "1998-02-28")


@query("f09_look_back")
def _(s, d):
    return R.look_back(bars(s, d), "2 years", "2000-06-30")


@query("f10_day_formats")
def _(s, d):
    return landing(s, d).select("trading_date", X.parse_day_text(F.col("trading_date")).alias("day"))


@query("f11_intraday_slice")
def _(s, d):
    return R.one_day(ticks(s, d), "U000001", "2024-01-05").orderBy("scrape_time")


@query("f12_search")
def _(s, d):
    return R.search(ticks(s, d), " ClicK ")


@query("f12_search_regex")
def _(s, d):
    return R.search(ticks(s, d), "^(click|VIEW)$", regex=True)


def _values(s, d) -> str:
    return written(s, d, "values", lambda p: A.update_values(s, stored_bars(s, d), p))


@query("f12_stored_search")
def _(s, d):
    return A.search_stored(s, stored_bars(s, d), _values(s, d), " s00000")


@query("f12_stored_search_regex")
def _(s, d):
    return A.search_stored(s, stored_bars(s, d), _values(s, d), "^(r|S0+7)$", regex=True)


@query("f13_years")
def _(s, d):
    return R.in_years(bars(s, d), [1996, 1999])


@query("f14_month_range")
def _(s, d):
    return R.between_months(bars(s, d), (1996, 11), (1997, 2))


@query("f15_rank_one")
def _(s, d):
    return S.top_ranked(bars(s, d), ["source", "trading_date"], [F.col("volume").desc(), *S.snapshot_order(HISTORY_COLUMNS), F.col("symbol")])


@query("f16_status")
def _(s, d):
    return R.with_status(T.symbols(s, d), 0)


@query("f17_candle_split")
def _(s, d):
    return P.candle_direction(bars(s, d)).groupBy("symbol", "direction").agg(F.count(F.lit(1)).alias("n"))


# Joins -------------------------------------------------------------------------

@query("j01_daily_outer_join")
def _(s, d):
    return C.outer_join_daily(V.indicator_frames(S.daily_summary(bars(s, d))))


def _together(s, d, name, frames, keys) -> str:
    """Name of a set of bucketed tables, stored once."""
    group = lambda path: f"{name}_{path.rsplit('-', 1)[1]}"
    return group(written(s, d, name, lambda p: B.store_together(frames, group(p), p, keys, 8)))


@query("j01_stored_outer_join")
def _(s, d):
    # Each table is a job of its own, so the figures they share are written down first.
    summary = staged_once(s, d, "daily-summary", lambda: S.daily_summary(bars(s, d)))
    frames = {f"part{i}": f for i, f in enumerate(V.indicator_frames(summary))}
    return B.outer_join_stored(s, list(frames), _together(s, d, "indicators", frames, DAILY_KEY), DAILY_KEY)


@query("j02_record_day_join")
def _(s, d):
    volumes = D.daily_volume_max(bars(s, d))
    return C.attach_record_day(C.with_market_rows(volumes, D.market_volume(bars(s, d))), D.record_volume_day(volumes))


@query("j03_monthly_outer_join")
def _(s, d):
    averages = D.monthly_average_close(closes(s, d))
    volumes = D.monthly_volume(S.closing_values(T.bars_raw(s, d), "volume"))
    return C.outer_join_monthly(averages, volumes)


@query("j03_stored_outer_join")
def _(s, d):
    volumes = D.monthly_volume(S.closing_values(T.bars_raw(s, d), "volume"))
    frames = {"averages": D.monthly_average_close(closes(s, d)), "volumes": volumes}
    return B.outer_join_stored(s, list(frames), _together(s, d, "months", frames, MONTHLY_KEY), MONTHLY_KEY)


@query("j04_catalogue_lookup")
def _(s, d):
    listed = T.symbols(s, d).filter(F.col("id") % 7 != 0)
    return K.with_catalogue(D.daily_volume_max(bars(s, d)), listed)


def _candidates(s, d) -> DataFrame:
    return bars(s, d).select("symbol").distinct()


@query("j05_unlisted_symbols")
def _(s, d):
    return K.new_symbols(_candidates(s, d), R.with_status(T.symbols(s, d), 1))


@query("j05_listed_symbols")
def _(s, d):
    return K.listed_symbols(_candidates(s, d), R.with_status(T.symbols(s, d), 1))


@query("j06_rerun_guard")
def _(s, d):
    path, rows, cut = scratch_path(s, "rerun"), bars(s, d), F.lit("1999-01-01").cast("date")
    W.append_new(rows.filter(F.col("trading_date") < cut), path)
    W.append_new(rows, path)
    W.append_new(rows, path)
    return I.read_history(s, path)


@query("j06_marked_append")
def _(s, d):
    """Years in turn, then all of them again, and late rows among them."""
    path, marks, rows = scratch_path(s, "marked-history"), scratch_path(s, "marks"), bars(s, d)
    early = F.col("trading_date") < F.lit("1996-01-01").cast("date")
    late = F.pmod(F.xxhash64("symbol", "scrape_time"), F.lit(3)) == 0
    for part in (rows.filter(early & ~late), rows.filter(~early), rows):
        append_marked(part, path, marks)
    return I.read_history(s, path)


# Aggregations ------------------------------------------------------------------

@query("a01_daily_volume_max")
def _(s, d):
    return D.daily_volume_max(bars(s, d))


@query("a02_daily_volume_sum")
def _(s, d):
    return D.daily_volume_sum(bars(s, d))


@query("a03_max_intraday_drop")
def _(s, d):
    return D.max_intraday_drop(bars(s, d))


@query("a04_market_volume")
def _(s, d):
    return D.market_volume(bars(s, d))


@query("a05_monthly_volume")
def _(s, d):
    return D.monthly_volume(S.closing_values(bars(s, d), "volume"))


@query("a06_monthly_average_close")
def _(s, d):
    return D.monthly_average_close(S.closing_values(bars(s, d), "close"))


@query("a07_daily_close_range")
def _(s, d):
    return D.close_range_by_day(closes(s, d))


@query("a08_record_volume_day")
def _(s, d):
    return D.record_volume_day(D.daily_volume_max(bars(s, d)))


@query("a09_ohlc_bars")
def _(s, d):
    return P.ohlc_bars(ticks(s, d))


@query("a09_ohlc_bars_max_volume")
def _(s, d):
    return P.ohlc_bars(ticks(s, d), volume_mode="max")


@query("a10_yearly_volume")
def _(s, d):
    return P.yearly_volume(bars(s, d))


def _by_year(s, d, fill_zero: bool) -> DataFrame:
    long = P.yearly_volume(bars(s, d))
    return P.pivot_volume(long, "symbol", "year", P.column_values(long, "year"), fill_zero)


@query("a10_yearly_volume_pivot")
def _(s, d):
    return _by_year(s, d, False)


@query("a10_yearly_volume_pivot_zero")
def _(s, d):
    return _by_year(s, d, True)


@query("a10_yearly_matrix")
def _(s, d):
    return P.yearly_matrix(P.yearly_volume(bars(s, d)))


@query("a10_yearly_map")
def _(s, d):
    return P.yearly_map(P.yearly_volume(bars(s, d))).select(
        "year", "total", F.explode("by_symbol").alias("symbol", "volume"))


@query("a11_yearly_totals")
def _(s, d):
    return P.yearly_totals(P.yearly_volume(bars(s, d)))


@query("a12_monthly_absolute_change")
def _(s, d):
    return P.monthly_absolute_change(closes(s, d)).withColumn("mean_abs_pct", six("mean_abs_pct"))


@query("a12_monthly_change_matrix")
def _(s, d):
    wide = P.monthly_change_matrix(closes(s, d))
    return wide.select("symbol", *[six(F.col(f"`{c}`")).alias(c) for c in wide.columns[1:]])


_BOX = ["min_close", "q1", "median", "q3", "max_close", "whisker_low", "whisker_high"]


def _boxes(boxes: DataFrame) -> DataFrame:
    rounded = boxes.withColumns({c: F.round(c, 4) for c in _BOX})
    return rounded.withColumns({"n_outliers": F.size("outliers"), "outlier_sum": F.round(
        F.aggregate("outliers", F.lit(0.0), lambda total, x: total + x), 4)}).drop("outliers")


@query("a13_monthly_distribution")
def _(s, d):
    return _boxes(P.monthly_distribution(closes(s, d)))


@query("a13_month_of_year_distribution")
def _(s, d):
    return _boxes(P.monthly_distribution(closes(s, d), "MM"))


@query("a13_approximate_distribution")
def _(s, d):
    sketched = P.approximate_distribution(bars(s, d))
    return sketched.select("symbol", "period", "min_close", "max_close", *[
        F.col("quartiles")[i].alias(f"q{i + 1}") for i in range(3)])


def _sketched(s, d, pattern: str) -> DataFrame:
    stored = stored_bars(s, d)
    sketches = written(s, d, "sketches", lambda p: H.update_sketches(s, stored, p))
    boxes = H.box_plots(s, stored, sketches, pattern)
    return boxes.withColumns({c: F.round(c, 4) for c in [*_BOX, "outlier_sum"]})


@query("s01_sketched_distribution")
def _(s, d):
    return _sketched(s, d, "yyyy-MM")


@query("s01_sketched_month_of_year")
def _(s, d):
    return _sketched(s, d, "MM")


@query("a14_symbol_statistics")
def _(s, d):
    stats = P.symbol_statistics(closes(s, d))
    return stats.withColumns({c: six(c) for c in ("sma20", "sma50", "return_pct", "volatility")})


@query("a15_source_shares")
def _(s, d):
    return K.source_shares(T.symbols(s, d)).withColumn("share_pct", six("share_pct"))


@query("a15_source_members")
def _(s, d):
    return K.source_members(T.symbols(s, d))


@query("a16_sparse_rows_merged")
def _(s, d):
    summary = S.shared(S.daily_summary(bars(s, d)))
    rows = C.union_sparse([*V.indicator_frames(summary), D.sma(summary)])
    return C.conform(C.merge_sparse(rows, DAILY_KEY, "seq", few=True), DAILY_SCHEMA)


@query("a17_catalogue_kpis")
def _(s, d):
    return K.catalogue_kpis(T.symbols(s, d))


@query("a18_newest_days")
def _(s, d):
    return O.newest_days(ticks(s, d))


@query("a18_distinct_years")
def _(s, d):
    return O.distinct_years(bars(s, d))


@query("a19_distinct_months")
def _(s, d):
    return O.distinct_months(bars(s, d))


@query("a20_close_extremes")
def _(s, d):
    return P.close_extremes(R.between_days(bars(s, d), "1996-01-01", "1996-12-31"))


@query("a21_row_counts")
def _(s, d):
    return D.weekdays(bars(s, d)).groupBy("trading_date").agg(F.count(F.lit(1)).alias("n"))


# Windows -----------------------------------------------------------------------

@query("w01_latest_snapshot")
def _(s, d):
    return S.latest_snapshot(T.bars_raw(s, d))


@query("w02_deduplicated")
def _(s, d):
    twice = T.bars_raw(s, d).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(1))))
    copies = twice.withColumn("close", (F.col("close") + F.col("_copy")).cast("decimal(18,4)")).drop("_copy")
    return S.deduplicate(copies)


@query("w03_running_close_range")
def _(s, d):
    return D.running_close_range(closes(s, d))


@query("w04_close_streaks")
def _(s, d):
    return D.close_streaks(closes(s, d))


@query("w05_candle_streaks")
def _(s, d):
    return D.candle_streaks(closes(s, d))


@query("w06_partial_sma")
def _(s, d):
    return D.sma(closes(s, d))


@query("w07_strict_smas")
def _(s, d):
    averaged = D.strict_smas(closes(s, d)).select("symbol", "trading_date", "close", "sma20", "sma50", "sma200")
    return averaged.withColumns({c: six(c) for c in ("sma20", "sma50", "sma200")})


@query("w08_intraday_vwap")
def _(s, d):
    return P.running_vwap(ticks(s, d)).withColumn("vwap", six("vwap"))


@query("w08_period_vwap")
def _(s, d):
    return P.period_vwap(closes(s, d)).withColumn("vwap", six("vwap"))


@query("w08_snapshot_increments")
def _(s, d):
    return P.snapshot_increments(ticks(s, d)).select("symbol", "scrape_time", "volume", "added_volume")


@query("w09_changes")
def _(s, d):
    changed = D.with_changes(closes(s, d)).withColumn("color", L.direction_colour(F.col("change")))
    return changed.withColumn("pct_change", six("pct_change")).select(
        "symbol", "trading_date", "close", "prev_close", "change", "pct_change", "color")


@query("w10_annual_volatility")
def _(s, d):
    return P.annual_volatility(closes(s, d)).withColumn("volatility", six("volatility"))


@query("w11_moving_average_crosses")
def _(s, d):
    return P.moving_average_crosses(closes(s, d)).select("symbol", "trading_date", "cross", six("gap").alias("gap"))


@query("w12_current_signal")
def _(s, d):
    signals = P.current_signal(closes(s, d))
    return signals.withColumns({c: six(c) for c in ("ma_short", "ma_long", "gap", "gap_size")})


@query("w13_period_return")
def _(s, d):
    return P.period_return(closes(s, d)).withColumn("return_pct", six("return_pct"))


@query("w14_base_hundred")
def _(s, d):
    scaled = P.base_hundred(closes(s, d))
    return scaled.select("symbol", "trading_date", six("normalised").alias("normalised"))


@query("w15_largest_move_day")
def _(s, d):
    return P.largest_move_day(closes(s, d)).withColumn("max_move", six("max_move"))


@query("w16_last_quote")
def _(s, d):
    return S.latest_snapshot(ticks(s, d), ["symbol"])


@query("w17_intraday_volatility")
def _(s, d):
    return D.intraday_volatility(closes(s, d))


# Sorting, limits, pages ----------------------------------------------------------

@query("t01_sorted_output")
def _(s, d):
    return O.sorted_output(D.monthly_volume(closes(s, d)), "symbol", "calc_year", "calc_month")


@query("t02_newest_rows")
def _(s, d):
    return O.newest_rows(bars(s, d), 2500)


@query("t03_last_sessions")
def _(s, d):
    return O.last_sessions(closes(s, d))


@query("t04_top_average_close")
def _(s, d):
    return O.top_by_average_close(closes(s, d)).withColumn("avg_close", six("avg_close"))


@query("t05_page")
def _(s, d):
    return O.history_page(bars(s, d), 40)


@query("t05_last_page")
def _(s, d):
    return O.history_page(bars(s, d), 10**9, deep=True)


def _positions(s, d) -> str:
    return written(s, d, "positions", lambda p: N.update_positions(s, stored_bars(s, d), p))


@query("s01_indexed_page")
def _(s, d):
    return N.indexed_page(s, stored_bars(s, d), _positions(s, d), 40)


@query("s01_indexed_last_page")
def _(s, d):
    return N.indexed_page(s, stored_bars(s, d), _positions(s, d), 10**9)


@query("t06_first_listed")
def _(s, d):
    return K.first_listed(T.symbols(s, d), 6)


@query("t07_limit")
def _(s, d):
    return bars(s, d).orderBy("symbol", "scrape_time", "close").limit(5)


# Set operations ----------------------------------------------------------------

@query("u01_market_union")
def _(s, d):
    return C.with_market_rows(
        D.running_close_range(closes(s, d)), D.market_volume(bars(s, d))
    )


@query("u02_symbols_together")
def _(s, d):
    averaged = D.strict_smas(closes(s, d), (20, 50)).select("symbol", "trading_date", "sma20", "sma50")
    return averaged.withColumns({c: six(c) for c in ("sma20", "sma50")})


# Scalar functions ----------------------------------------------------------------

def _typed(name: str, table: Query, *columns: Column | str):
    """A query that only projects expressions."""
    query(name)(lambda s, d: table(s, d).select(*[c() if callable(c) else c for c in columns]))


_typed("x01_upper_trim", landing, lambda: X.normalise_symbol(F.col("symbol")).alias("symbol"),
       lambda: F.length("symbol").alias("raw_length"))
_typed("x02_casts", landing, lambda: X.to_price(F.col("close_price")).alias("price"),
       lambda: F.col("volume").cast("string").try_cast("bigint").alias("whole"),
       lambda: F.col("volume").cast("string").alias("volume_text"))
_typed("x03_from_millis", landing, lambda: X.millis_to_timestamp(F.col("scrape_time")).alias("moment"))
_typed("x04_day_formats", landing, lambda: X.parse_day(F.col("trading_date")).alias("day"))
_typed("x05_weekday_number", bars, "symbol", "trading_date",
       lambda: F.dayofweek("trading_date").alias("dow"), lambda: F.weekday("trading_date").alias("wd"))
_typed("x06_year_month", bars, "symbol", "scrape_time",
       lambda: F.year("trading_date").alias("y"), lambda: F.month("trading_date").alias("m"))
_typed("x07_joined_text", bars, "scrape_time",
       lambda: F.concat_ws("-", F.year("trading_date"), F.month("trading_date"), F.dayofmonth("trading_date")).alias("ymd"))
_typed("x08_round_half_up", bars, "symbol", "scrape_time", lambda: two_digits(F.col("open")).alias("open2"))
_typed("x09_clamped", T.bars_raw, "symbol", "scrape_time",
       lambda: clamp_at_zero(F.col("open") - F.col("close")).alias("fall"))


@query("x10_liquidity")
def _(s, d):
    return D.liquidity(S.closing_values(bars(s, d), "volume"))


_typed("x11_coalesce", landing, "symbol", "scrape_time",
       lambda: F.coalesce(X.to_price(F.col("close_price")), X.to_price(F.col("open_price"))).alias("price"),
       lambda: F.coalesce(X.to_price(F.col("close_price")), F.lit(0)).alias("price_or_zero"))
_typed("x12_date_text", bars, "scrape_time", lambda: F.date_format("trading_date", "MM/yyyy").alias("period"),
       lambda: F.date_format("trading_date", "yyyy-MM").alias("sort_key"),
       lambda: F.date_format("trading_date", "dd/MM/yyyy").alias("day"))
_typed("x13_month_end", bars, "scrape_time", lambda: F.last_day("trading_date").alias("month_end"))
_typed("x14_month_label", bars, "scrape_time", lambda: L.month_label(F.month("trading_date")).alias("label"))


@query("x15_epoch_repair")
def _(s, d):
    millis = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    scaled = F.when(F.col("event_id") % 2 == 0, millis).otherwise(millis * 1_000_000)
    rows = T.read_table(s, d, "events").select("event_id", scaled.alias("raw_date"))
    return rows.withColumn("day", X.repair_epoch_day(F.col("raw_date")))


_typed("x16_day_without_zone", ticks, "symbol", "scrape_time",
       lambda: F.col("scrape_time").cast("timestamp").cast("timestamp_ntz").cast("date").alias("day"))
_typed("x17_display_text", ticks, "symbol", "scrape_time",
       lambda: L.volume_text(F.col("volume")).alias("volume_text"),
       lambda: L.volume_text((F.col("volume") / 1000).cast("bigint")).alias("small_volume_text"),
       lambda: L.price_text(F.col("close") * 1000).alias("price_text"),
       lambda: L.percent_text(two_digits(F.col("open") - F.col("close"))).alias("percent_text"))


@query("x18_text_match")
def _(s, d):
    rows = ticks(s, d).filter(F.col("source").rlike("(?i)^C") | F.contains("source", F.lit("err")))
    return rows.filter(F.startswith(F.col("trading_date").cast("string"), F.lit("2024-01")))


_typed("x19_arithmetic", bars, "symbol", "scrape_time",
       lambda: F.abs(F.col("open") - F.col("close")).alias("gap"),
       lambda: six(F.sqrt(F.col("volume").cast("double"))).alias("root"),
       lambda: six(ratio(F.col("high") - F.col("close"), F.col("open") - F.col("close"))).alias("share"))


@query("x20_json_round_trip")
def _(s, d):
    encoded = M.as_messages(D.daily_volume_max(bars(s, d))).withColumn("topic", F.lit(M.DAILY_TOPIC))
    return M.daily_messages(encoded).select("symbol", "calc_date", "total_volume")


_typed("x21_time_parts", ticks, "symbol", "scrape_time", lambda: F.hour("scrape_time").alias("h"),
       lambda: F.minute("scrape_time").alias("mi"), lambda: F.date_format("scrape_time", "yyyyMMdd_HHmm").alias("label"),
       lambda: W.in_reset_window(F.col("scrape_time")).cast("int").alias("in_reset"))


@query("x22_sign_labels")
def _(s, d):
    return D.with_changes(closes(s, d)).select(
        "symbol", "trading_date", L.direction_arrow(F.coalesce("change", F.lit(0))).alias("arrow"),
        L.signal_label(F.coalesce("change", F.lit(0))).alias("signal"),
    )


# Streams -----------------------------------------------------------------------

def _topic(s, d) -> str:
    """A topic folder with a morning and an afternoon run of the daily figures.

    The morning run sees the first half of each day's volume only.  Months come
    in two runs as well; some messages are not JSON, some monthly ones have no
    year or no average.
    """
    def kept(path: str, rows: DataFrame) -> DataFrame:
        """Figures that several messages are made of, computed once."""
        rows.write.parquet(path)
        return s.read.schema(rows.schema).parquet(path)

    def write(path: str) -> None:
        parts = {name: scratch_path(s, f"topic-{name}") for name in ("summary", "daily", "months")}
        with sparing(s):
            summary = kept(parts["summary"], S.daily_summary(bars(s, d)))
            final = kept(parts["daily"], V.without_market(C.without_market_rows(C.daily_figures(summary), weekdays_only=True)))
            months = kept(parts["months"], C.monthly_table(summary))
            U.drop_stage(s, parts["summary"])
            publish(path, final, months)
        for name in ("daily", "months"):
            U.drop_stage(s, parts[name])

    def publish(path: str, final: DataFrame, months: DataFrame) -> None:
        morning = final.select("symbol", "calc_date", (F.col("total_volume") / 2).cast("bigint").alias("total_volume"),
                               "sma_price")
        month_number = F.col("calc_month")
        spoiled = months.withColumns({
            "calc_year": F.when(month_number != 3, F.col("calc_year")),
            "monthly_avg_close": F.when(month_number != 5, F.col("monthly_avg_close")),
        })
        sent = [
            (M.as_keyed_messages(morning), M.DAILY_TOPIC, 1),
            (M.as_keyed_messages(final.drop("sma_price")), M.DAILY_TOPIC, 2),
            (M.as_keyed_messages(months.withColumn("monthly_total_volume", F.lit(0)), MONTHLY_SCHEMA), M.MONTHLY_TOPIC, 1),
            (M.as_keyed_messages(spoiled, MONTHLY_SCHEMA), M.MONTHLY_TOPIC, 2),
            (T.symbols(s, d).select(F.col("symbol").alias("key"), F.concat(F.lit("{not json "), "symbol").alias("value")),
             M.DAILY_TOPIC, 3),
            (T.symbols(s, d).select(
                F.lit(None).cast("string").alias("key"), F.concat(F.lit('{"symbol":"'), "symbol", F.lit('"}')).alias("value")),
             M.DAILY_TOPIC, 4),
        ]
        for messages, topic, run in sent:
            # Two partitions: the later run has the lower offsets in the second one.
            part = F.pmod(F.xxhash64("key"), F.lit(2)).cast("int")
            numbered = messages.withColumns({
                "partition": part, "offset": F.when(part == 0, run).otherwise(10 - run).cast("bigint"),
                "timestamp": F.timestamp_seconds(F.lit(1_704_067_200 + 3600 * run)),
            })
            M.publish(numbered, topic, {"path": path})

    return written(s, d, "topic", write)


def _consumed(s, d, mode: str = "replace") -> str:
    def run(path: str) -> None:
        # One file per micro-batch would be slow here; batch order is tested separately.
        Z.consume(Z.read_topics(s, {"path": _topic(s, d)}), path, mode).awaitTermination()

    return written(s, d, f"serving-{mode}", run)


@query("s14_topic_messages")
def _(s, d):
    out = scratch_path(s, "decoded")
    stream = Z.read_topics(s, {"path": _topic(s, d)})
    M.daily_messages(stream).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    good = s.read.parquet(out).filter(F.col(M.CORRUPT).isNull())
    return good.groupBy(F.when(F.col("partition") == 0, F.col("offset")).otherwise(10 - F.col("offset")).alias("offset"), "symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("total_volume").alias("volume"))


@query("k08_daily_upsert")
def _(s, d):
    return U.read_serving(s, f"{_consumed(s, d)}/daily", DAILY_SCHEMA)


@query("k09_monthly_upsert")
def _(s, d):
    return U.read_serving(s, f"{_consumed(s, d)}/monthly", MONTHLY_SCHEMA)


@query("k10_quarantine")
def _(s, d):
    return Z.read_quarantine(s, _consumed(s, d)).select("topic", F.col(M.CORRUPT).alias("text"))


@query("m01_daily_stream_coalesced")
def _(s, d):
    return U.read_serving(s, f"{_consumed(s, d, 'coalesce')}/daily", DAILY_SCHEMA)


@query("m02_monthly_stream_coalesced")
def _(s, d):
    return U.read_serving(s, f"{_consumed(s, d, 'coalesce')}/monthly", MONTHLY_SCHEMA)


@query("m03_routed_counts")
def _(s, d):
    root = _consumed(s, d)
    tables = [("daily", DAILY_SCHEMA), ("monthly", MONTHLY_SCHEMA)]
    counts = [U.read_serving(s, f"{root}/{name}", schema).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "routed_to", F.lit(name)) for name, schema in tables]
    return counts[0].unionByName(counts[1])


@query("m04_same_day_refresh")
def _(s, d):
    table = scratch_path(s, "refresh")
    volumes = D.daily_volume_max(bars(s, d))
    half = volumes.withColumns({"total_volume": (F.col("total_volume") / 2).cast("bigint"), "seq": F.lit(1)})
    U.upsert_daily(half, f"{table}/daily", f"{table}/stage/1")
    afternoon = volumes.filter(F.year("calc_date") >= 1998).withColumn("seq", F.lit(2))
    U.upsert_daily(afternoon, f"{table}/daily", f"{table}/stage/2")
    U.upsert_daily(afternoon, f"{table}/daily", f"{table}/stage/2")
    return U.read_serving(s, f"{table}/daily", DAILY_SCHEMA).select("symbol", "calc_date", "total_volume")


@query("m05_snapshot_intake")
def _(s, d):
    landing, path = scratch_path(s, "landing-stream"), scratch_path(s, "intake")
    rows = ticks(s, d)
    rows.write.parquet(landing)
    for _ in range(2):
        stream = s.readStream.schema(rows.schema).parquet(landing)
        Z.intake(stream, path, f"{path}-checkpoint").awaitTermination()
        rows.filter(F.col("trading_date") >= F.lit("2024-01-15").cast("date")).write.mode("append").parquet(landing)
    Z.intake(s.readStream.schema(rows.schema).parquet(landing), path, f"{path}-checkpoint").awaitTermination()
    return I.read_history(s, path)


@query("m05_streamed_vwap")
def _(s, d):
    """Days arrive in three files, the middle one last; late rows are added to the totals."""
    landing, root = scratch_path(s, "landing-minutes"), scratch_path(s, "minutes")
    rows = ticks(s, d)
    part = F.when(F.dayofmonth("trading_date") <= 10, 0).when(F.dayofmonth("trading_date") <= 20, 2).otherwise(1)
    for turn in range(3):
        rows.filter(part == turn).write.mode("append").parquet(landing)
        Y.stream_minutes(s.readStream.schema(rows.schema).parquet(landing), root).awaitTermination()
    return Y.day_vwap(Y.complete_totals(s, root)).select(
        "symbol", "trading_date", "minute", "volume", "n", six("vwap").alias("vwap"))


# Composite views -----------------------------------------------------------------

@query("v01_daily_analysis")
def _(s, d):
    return V.daily_analysis(bars(s, d))


@query("m04_daily_refreshed")
def _(s, d):
    """Two runs: all but a few months and late rows, then these."""
    rows, root = bars(s, d), scratch_path(s, "refreshed")
    late = (F.date_format("trading_date", "yyyy-MM") == "1996-05") | (F.expr("pmod(xxhash64(symbol, scrape_time), 50) = 0"))
    run_cleaned(rows.filter(~late), root, 1)
    run_cleaned(rows.filter(late), root, 2)
    return U.read_serving(s, f"{root}/daily", DAILY_SCHEMA)


@query("v02_monthly_analysis")
def _(s, d):
    return V.monthly_analysis(bars(s, d))


@query("v03_increment_daily_analysis")
def _(s, d):
    return V.increment_daily_analysis(bars(s, d), market_filler=False)


@query("v03_increment_daily_merged")
def _(s, d):
    rows = C.union_sparse(V.increment_daily_parts(bars(s, d)))
    return C.conform(C.merge_sparse(rows, DAILY_KEY, "seq", few=True), DAILY_SCHEMA)


@query("v04_market_filler")
def _(s, d):
    return C.market_filler(D.market_volume(bars(s, d)))


@query("v05_candlesticks")
def _(s, d):
    return V.candlesticks(bars(s, d))


@query("v06_intraday")
def _(s, d):
    return V.intraday(ticks(s, d)).withColumn("vwap", six("vwap"))


@query("v07_moving_averages")
def _(s, d):
    frame = V.moving_averages(bars(s, d)).select("symbol", "trading_date", "close", "ma_short", "ma_long", "cross")
    return frame.withColumns({c: six(c) for c in ("ma_short", "ma_long")})


@query("v08_volume_direction")
def _(s, d):
    return V.volume_direction(bars(s, d))


@query("v09_market_overview")
def _(s, d):
    overview = V.market_overview(bars(s, d), T.symbols(s, d))
    return overview.withColumns({c: six(c) for c in ("pct_change", "return_pct")})


@query("v10_history_view")
def _(s, d):
    return V.history_view(ticks(s, d), 2, start="2024-01-05", end="2024-01-25", text="click", all_columns=True)


@query("v10_daily_view")
def _(s, d):
    return V.daily_view(V.daily_analysis(bars(s, d)), 3, start="1996-01-01", end="1999-12-31")


@query("v10_monthly_view")
def _(s, d):
    return V.monthly_view(V.monthly_analysis(bars(s, d)), 2, year=1997)
