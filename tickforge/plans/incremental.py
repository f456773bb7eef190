"""The daily table kept up to date from month-end states.

A state row per symbol and month end holds what the indicators of later days need of earlier
ones: running extremes, both streaks, the last weekday's close and the last four closes.  A
refresh starts at the first touched month from the state before it and goes on through later
months only for symbols whose state changed, until it agrees with the stored one.  The record
day, which every row of a symbol shows, is kept in a table of its own; rows of other months
change only when it does.

Order of writing: daily rows, then a note of the months whose states follow, then states and
records, then the note goes.  A run that failed in between is made good by the next one, which
takes noted months as touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.numeric import two_digits
from tickforge.operators import consolidate as C
from tickforge.operators import daily as D
from tickforge.schemas import DAILY_KEY, DAILY_SCHEMA, MARKET_SYMBOL, MONTH
from tickforge.session import scratch_path
from tickforge.sources.readers import read_by_month
from tickforge.sources.upsert import drop_stage, is_complete, stored_months
from tickforge.sources.writers import read_if_exists, replace_partitions

PRICE = T.DecimalType(18, 4)
RECENT = T.StructType([T.StructField("trading_date", T.DateType()), T.StructField("close", PRICE)])
STATE = T.StructType([
    T.StructField("max_close", PRICE), T.StructField("min_close", PRICE), T.StructField("up", T.IntegerType()),
    T.StructField("down", T.IntegerType()), T.StructField("weekday_close", PRICE), T.StructField("recent", T.ArrayType(RECENT)),
])
STATE_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("state", STATE)])
STORED_STATE = T.StructType([*STATE_SCHEMA.fields, T.StructField(MONTH, T.StringType())])
RECORD_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("max_volume_date", T.DateType()), T.StructField("max_volume_value", T.LongType()),
])
STORED_DAILY = T.StructType([*DAILY_SCHEMA.fields, T.StructField(MONTH, T.StringType())])
#: Rows before the current one that a five-day mean needs.
REMEMBERED = 4


class Scratch:
    """Rows one run writes to the shared folder, so that later steps neither recompute nor change them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append((name, path))
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes rows of these names that no later step reads; all without a name."""
        for name, path in self.paths:
            if name in names or not names:
                drop_stage(self.spark, path)
        self.paths = [x for x in self.paths if names and x[0] not in names]


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def with_indicators(summary: DataFrame, before: DataFrame) -> DataFrame:
    """Daily indicators and the ``state`` after each row of ``daily_summary`` rows that follow the states ``before``.

    The remembered closes of a symbol take part in the windows as rows of their own and leave
    again afterwards.
    """
    carried = before.select("symbol", F.col("state").alias("_carry"))
    remembered = carried.select("symbol", F.explode("_carry.recent").alias("r")).select(
        "symbol", "r.trading_date", "r.close", F.lit(True).alias("_old"))
    rows = summary.withColumn("_old", F.lit(False)).unionByName(remembered, allowMissingColumns=True)
    rows = rows.join(carried, "symbol", "left")
    weekday = ~F.col("_old") & ~F.dayofweek("trading_date").isin(1, 7)
    seen = F.when(weekday, F.col("close"))
    until = D.by_day().rowsBetween(Window.unboundedPreceding, -1)
    last_close = F.coalesce(F.last(seen, ignorenulls=True).over(until), F.col("_carry.weekday_close"))
    step = F.signum(F.col("close") - last_close).cast("int")
    rows = rows.withColumns({
        "_weekday": weekday,
        "_step": F.when(weekday, F.coalesce(step, F.lit(0))),
        "_row": F.sum(F.when(weekday, 1).otherwise(0)).over(D.to_date()).cast("int"),
        "_max": F.greatest("_carry.max_close", F.max("close").over(D.to_date())),
        "_min": F.least("_carry.min_close", F.min("close").over(D.to_date())),
        "_seen": F.coalesce(F.last(seen, ignorenulls=True).over(D.to_date()), F.col("_carry.weekday_close")),
        "sma_price": D.rounded_partial_sma(REMEMBERED + 1).cast("decimal(18,2)"),
        "_recent": F.collect_list(F.struct("trading_date", "close")).over(D.by_day().rowsBetween(1 - REMEMBERED, 0)),
    })
    streaks = {}
    for name, broken in (("up", F.col("_step") <= 0), ("down", F.col("_step") >= 0)):
        end = F.max(F.when(broken, F.col("_row"))).over(D.to_date())
        streaks[f"_{name}"] = F.col("_row") - F.coalesce(end, -F.coalesce(f"_carry.{name}", F.lit(0)))
    state = F.struct(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(
        ("_max", "_min", "_up", "_down", "_seen", "_recent"), STATE.fields)])
    return rows.withColumns(streaks).filter(~F.col("_old")).select(
        *summary.columns,
        F.col("trading_date").alias("calc_date"),
        F.col("max_volume").alias("total_volume"),
        two_digits(F.col("_max")).alias("max_close_price"),
        two_digits(F.col("_min")).alias("min_close_price"),
        F.when(F.col("_weekday"), F.col("_up")).alias("up_days_count"),
        F.when(F.col("_weekday"), F.col("_down")).alias("down_days_count"),
        two_digits(F.col("high") - F.col("low")).alias("max_intraday_volatility"),
        two_digits(F.col("max_drop")).alias("max_intraday_drop"),
        "sma_price", state.alias("state"),
    )


def month_end_states(rows: DataFrame, before: DataFrame, months: list[str]) -> DataFrame:
    """(symbol, state, month) for every symbol known by then and each of the months, in order.

    A symbol without rows in a month keeps its state.
    """
    month = month_of("trading_date")
    ends = rows.withColumn(MONTH, month).withColumn(
        "_next", F.lead(month).over(D.by_day())).filter(F.coalesce(F.col("_next") != F.col(MONTH), F.lit(True)))
    ends = ends.select("symbol", MONTH, "state")
    start = before.select("symbol", F.lit("").alias(MONTH), "state")
    every = start.unionByName(ends)
    grid = every.select("symbol").distinct().select(
        "symbol", F.explode(F.array(*[F.lit(m) for m in ["", *months]])).alias(MONTH))
    held = F.last("state", ignorenulls=True).over(Window.partitionBy("symbol").orderBy(MONTH))
    filled = grid.join(every, ["symbol", MONTH], "left").withColumn("state", held)
    return filled.filter((F.col(MONTH) != "") & F.col("state").isNotNull()).select("symbol", "state", MONTH)


def newest_records(volumes: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Record day per symbol from further daily volumes and the records so far.

    The volume of a day never falls, as a history only gains rows; so the better of both is
    the record of all rows.  The earliest day wins ties.
    """
    rows = volumes.select("symbol", F.col("trading_date").alias("calc_date"), F.col("max_volume").alias("total_volume"))
    if stored is not None:
        rows = rows.unionByName(stored.select(
            "symbol", F.col("max_volume_date").alias("calc_date"), F.col("max_volume_value").alias("total_volume")))
    return C.conform(D.record_volume_day(rows.filter(F.col("total_volume").isNotNull())), RECORD_SCHEMA)


def different(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """Symbols of ``new`` whose state is not that of ``old``."""
    if old is None:
        return new.select("symbol")
    same = old.select("symbol", F.col("state").alias("_state"))
    return new.join(same, "symbol", "left").filter(~F.col("state").eqNullSafe(F.col("_state"))).select("symbol")


class DailyTable:
    """State, records and serving rows below ``root``, and the summaries they come from."""

    def __init__(self, spark: SparkSession, root: str, summary_schema: T.StructType, scratch: Scratch):
        self.spark, self.root, self.scratch = spark, root, scratch
        self.summary = read_by_month(spark, f"{root}/summary", summary_schema)
        self.daily = read_if_exists(spark, f"{root}/daily", STORED_DAILY)
        self.states = read_if_exists(spark, f"{root}/states", STORED_STATE)
        self.records = read_if_exists(spark, f"{root}/records", RECORD_SCHEMA) if is_complete(spark, f"{root}/records") else None
        self.state_months = stored_months(spark, f"{root}/states")
        #: Months whose states this refresh computes, with the rows of all symbols.
        self.fresh: dict[str, DataFrame] = {}

    def noted(self) -> list[str]:
        """Months an earlier run left unfinished."""
        note = read_if_exists(self.spark, f"{self.root}/unfinished", T.StructType([T.StructField("month", T.StringType())]))
        return [] if note is None else [r[0] for r in note.collect()]

    def state_at(self, month: str | None) -> DataFrame:
        """State of all symbols at the end of a month; none before the first."""
        if month in self.fresh:
            return self.fresh[month].filter(F.col(MONTH) == month).select("symbol", "state")
        if month is None or self.states is None:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.states.filter(F.col(MONTH) == month).select("symbol", "state")

    def state_until(self, month: str) -> DataFrame | None:
        """Stored state as of the end of a month, which need not have rows."""
        known = [m for m in self.state_months if m <= month]
        return self.stored_states(known[-1:]) if known else None

    def stored_states(self, months: list[str]) -> DataFrame | None:
        return None if self.states is None else self.states.filter(F.col(MONTH).isin(months)).select("symbol", "state", MONTH)

    def refresh(self, touched: list[str]) -> tuple[DataFrame, list[DataFrame]]:
        """(daily rows of what may have changed, states to store), all written down.

        Reads the summaries of the touched months, and of later ones only for symbols whose
        state before them changed; later months are taken 1, 2, 4 ... at a time.
        """
        months = stored_months(self.spark, f"{self.root}/summary")
        if self.states is None or self.records is None:
            touched = months
        touched = sorted({*touched, *self.noted()})
        volumes = self.summary.filter(F.col(MONTH).isin(touched))
        records = self.scratch.staged(newest_records(volumes, self.records), "records")
        results, kept, place, active, width = [], [], 0, None, 1
        while place < len(months):
            if months[place] in touched:
                size = next((i for i, m in enumerate(months[place:]) if m not in touched), len(months) - place)
                chosen, symbols, width = months[place: place + size], None, 1
            elif active is not None:
                until = next((i for i, m in enumerate(months[place:]) if m in touched), len(months) - place)
                chosen, symbols = months[place: place + min(width, until)], active
                width *= 2
            else:
                place += 1
                continue
            rows, states = self.step(chosen, symbols, months[place - 1] if place else None, records)
            results.append(rows)
            kept.append(states)
            self.fresh.update(dict.fromkeys(chosen, states))
            place += len(chosen)
            if place < len(months):
                old = self.state_until(chosen[-1])
                changed = self.scratch.staged(different(self.state_at(chosen[-1]), old), "changed-states")
                active = changed if changed.head(1) else None
        self.new_records = records
        daily = results[0]
        for more in results[1:]:
            daily = daily.unionByName(more)
        return self.only_changed(daily, sorted(self.fresh)), kept

    def step(self, months: list[str], symbols: DataFrame | None, previous: str | None, records: DataFrame):
        """Serving rows and complete states of some months in a row; of ``symbols`` only, if given."""
        before = self.state_at(previous)
        rows = self.summary.filter(F.col(MONTH).isin(months)).drop(MONTH)
        if symbols is not None:
            rows, before = rows.join(symbols, "symbol", "left_semi"), before.join(symbols, "symbol", "left_semi")
        # The state goes through the windows once; rows and month ends are read from what they gave.
        computed = self.scratch.staged(with_indicators(rows, before), "indicators")
        states = month_end_states(computed, before, months)
        daily = C.beside_market_rows(C.attach_record_day(computed, records), computed, weekdays_only=True)
        if symbols is not None:
            daily = daily.filter(F.col("symbol") != MARKET_SYMBOL)
            others = self.stored_states(months)
            if others is not None:
                states = states.unionByName(others.join(symbols, "symbol", "left_anti"))
        written = self.scratch.staged(daily, "daily-rows"), self.scratch.staged(states, "states")
        self.scratch.drop("indicators")
        return written

    def only_changed(self, daily: DataFrame, months: list[str]) -> DataFrame:
        """Rows the serving table does not hold exactly so, with those of other months whose record day changed."""
        if self.daily is None:
            return daily
        stored = self.daily.filter(F.col(MONTH).isin(months)).select(*DAILY_SCHEMA.fieldNames())
        changed = daily.exceptAll(stored)
        if self.records is not None:
            broken = self.scratch.staged(self.new_records.join(self.records, self.new_records.columns, "left_anti"), "broken-records")
            if broken.head(1):
                names = DAILY_SCHEMA.fieldNames()
                elsewhere = self.daily.drop("max_volume_date", "max_volume_value").join(broken, "symbol").select(*names)
                changed = changed.unionByName(elsewhere.join(daily.select(*DAILY_KEY), DAILY_KEY, "left_anti"))
        written = self.scratch.staged(changed, "changed-daily")
        self.scratch.drop("daily-rows")
        return written

    def store(self, states: list[DataFrame]) -> None:
        """States and records of a refresh; the note says which months to take again if this fails halfway."""
        months = sorted(self.fresh)
        note = f"{self.root}/unfinished"
        self.spark.createDataFrame([(m,) for m in months], "month string").write.mode("overwrite").parquet(note)
        for part in states:
            replace_partitions(part, f"{self.root}/states", [MONTH])
        self.new_records.write.mode("overwrite").parquet(f"{self.root}/records")
        drop_stage(self.spark, note)
