"""The pipeline as one callable: several runs give what one computation over all rows gives."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickforge import tables
from tickforge.operators.clean import clean
from tickforge.plans import incremental
from tickforge.plans import views as V
from tickforge.plans.run import run_batch
from tickforge.schemas import DAILY_SCHEMA, MONTH, MONTHLY_SCHEMA, RAW_SCHEMA
from tickforge.sources.messages import TOPIC_SCHEMA
from tickforge.sources.upsert import read_serving


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_runs_equal_one_computation(spark, sf_dir, tmp_path):
    raw = tables.raw_text(spark, sf_dir).filter("source <> 'Z' AND length(symbol) > 0").filter(F.expr("pmod(xxhash64(symbol, scrape_time), 7) = 0"))
    history = clean(raw)
    morning = raw.filter(F.expr("pmod(xxhash64(scrape_time), 3) > 0"))
    root, topic = str(tmp_path / "root"), str(tmp_path / "topic")
    assert run_batch(morning, root, 1)
    run_batch(raw, root, 2, {"path": topic})
    want = V.daily_analysis(history)
    assert same(read_serving(spark, f"{root}/daily", DAILY_SCHEMA), want)
    assert same(read_serving(spark, f"{root}/monthly", MONTHLY_SCHEMA), V.monthly_analysis(history))
    sent = spark.read.parquet(topic).count()
    assert 0 < sent <= want.count() + V.monthly_analysis(history).count()
    run_batch(raw, root, 3, {"path": topic})
    assert spark.read.parquet(topic).count() == sent and TOPIC_SCHEMA
    assert same(read_serving(spark, f"{root}/daily", DAILY_SCHEMA), want)
    assert run_batch(raw.filter("false"), root, 4) == []


def as_raw(history):
    """Cleaned rows as the text they could have come from."""
    names = {"close": "close_price", "open": "open_price", "high": "high_price", "low": "low_price"}
    text = history.withColumnsRenamed(names)
    return text.select([F.col(f.name).cast("string").cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


@pytest.fixture(scope="module")
def few(bars):
    """Two years of three symbols."""
    return bars.filter("symbol IN ('S000001', 'S000002', 'S000003') AND year(trading_date) IN (1995, 1996)").cache()


def month(rows, *months):
    return rows.filter(F.date_format("trading_date", "yyyy-MM").isin(*months))


def daily_of(spark, root):
    return read_serving(spark, f"{root}/daily", DAILY_SCHEMA)


def stored_daily(spark, root, *months):
    stored = spark.read.schema(incremental.STORED_DAILY).parquet(f"{root}/daily")
    return stored.filter(F.col(MONTH).isin(*months)).drop(MONTH)


def spoil(root, *kept):
    """Replace the data files of all other months by text; whoever opens one fails."""
    for file in Path(root).rglob("*.parquet"):
        if "states" not in file.parts and "records" not in file.parts and not any(m in str(file) for m in kept):
            file.write_text("not to be read")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_late_rows_change_what_follows(spark, few, history, tmp_path):
    """A month between others, extremes and a record volume that come late, a symbol seen for the first time."""
    root = str(tmp_path)
    late = history([
        ("S000001", "1995-01-03 10:00", 999999, 10**12, 999999, 999999, 999999), ("S000002", "1995-02-07 23:59:59", 2, 5, 2, 3, 1),
        ("S000009", "1995-11-11 10:00", 7), ("S000009", "1995-11-13 10:00", 8),
    ])
    first = few.join(month(few, "1995-05", "1996-12").select("symbol", "scrape_time"), ["symbol", "scrape_time"], "left_anti").select(few.columns)
    seen = None
    for number, batch in enumerate([first, month(few, "1996-12"), month(few, "1995-05").unionByName(late)]):
        seen = batch if seen is None else seen.unionByName(batch)
        assert run_batch(as_raw(batch), root, number)
        assert same(daily_of(spark, root), V.daily_analysis(seen))


def test_a_run_reads_its_month_and_the_state_before(spark, few, history, tmp_path):
    root = str(tmp_path)
    old = few.filter("trading_date < '1996-10-01'")
    new = month(few, "1996-10").withColumn("volume", F.lit(1).cast("long"))
    run_batch(as_raw(old), root, 1)
    spoil(root, "1996-10")
    run_batch(as_raw(new), root, 2)
    want = V.daily_analysis(old.unionByName(new)).filter("calc_date >= '1996-10-01'")
    assert want.count() and same(stored_daily(spark, root, "1996-10"), want)


def test_later_months_are_read_until_the_state_agrees(spark, few, history, tmp_path):
    """A late snapshot that changes one day's close but neither extremes nor record: two months on nothing is read."""
    root = str(tmp_path)
    run_batch(as_raw(few), root, 1)
    spoil(root, "1995-04", "1995-05")
    middle = few.filter("symbol = 'S000002'").agg(F.percentile_approx("close", 0.5)).first()[0]
    late = history([("S000002", "1995-04-12 23:59:59", middle, 1, middle, middle, middle)])
    run_batch(as_raw(late), root, 2)
    want = V.daily_analysis(few.unionByName(late)).filter("calc_date BETWEEN '1995-04-01' AND '1995-05-31'")
    assert same(stored_daily(spark, root, "1995-04", "1995-05"), want)


def test_an_interrupted_run_is_made_good_by_the_next(spark, few, history, tmp_path, monkeypatch):
    root = str(tmp_path)
    start = few.filter("trading_date < '1996-06-01'")
    run_batch(as_raw(start), root, 1)
    right = incremental.replace_partitions
    monkeypatch.setattr(incremental, "replace_partitions", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    late = history([("S000003", "1995-03-03 12:00", 888888)])
    with pytest.raises(OSError):
        run_batch(as_raw(late), root, 2)
    monkeypatch.setattr(incremental, "replace_partitions", right)
    rest = few.filter("trading_date >= '1996-06-01'")
    run_batch(as_raw(rest), root, 3)
    assert same(daily_of(spark, root), V.daily_analysis(few.unionByName(late)))
    assert not Path(root, "unfinished").exists()
