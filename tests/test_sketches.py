"""Stored sketches: merged quartiles against exact ones, and the second pass."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickforge.operators import sketches as H
from tickforge.schemas import MONTH
from tickforge.sources.writers import append_history


def lists(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def one_symbol(bars):
    """All snapshots as those of two symbols, with values far outside."""
    rows = bars.withColumn("symbol", F.when(F.col("symbol") < "S000003", "A").otherwise("B"))
    far = rows.filter("trading_date BETWEEN '1996-03-01' AND '1996-03-10'").withColumn("close", (F.col("close") * 50).cast("decimal(18,4)"))
    return rows.unionByName(far).cache()


@pytest.mark.parametrize("k", [200, 2000])
def test_rank_error(one_symbol, k):
    """A year of a symbol from merged months: ranks of the quartiles are off by the stated share at most."""
    boxes = H.quartiles(H.sketch_closes(one_symbol, k), "yyyy").collect()
    values = {}
    for r in one_symbol.select("symbol", F.year("trading_date").alias("y"), F.col("close").cast("double").alias("c")).collect():
        values.setdefault((r["symbol"], str(r["y"])), []).append(r["c"])
    assert len(boxes) == len(values) and max(map(len, values.values())) > 500
    for b in boxes:
        held = sorted(values[b["symbol"], b["period"]])
        assert b["n"] == len(held) and (b["min_close"], b["max_close"]) == (held[0], held[-1])
        for share, q in ((0.25, b["q1"]), (0.5, b["median"]), (0.75, b["q3"])):
            low, high = sum(v < q for v in held) / len(held), sum(v <= q for v in held) / len(held)
            assert low - 1.5 * H.rank_error(k) <= share <= high + 1.5 * H.rank_error(k)


def test_second_pass_reads_months_with_outliers_only(spark, one_symbol, tmp_path):
    history, sketches = str(tmp_path / "history"), str(tmp_path / "sketches")
    rows = one_symbol.filter("symbol = 'A' AND trading_date BETWEEN '1996-01-01' AND '1996-06-30'")
    append_history(rows, history)
    H.update_sketches(spark, history, sketches)
    want = H.box_plots(spark, history, sketches, "yyyy").collect()
    fence = H.quartiles(H.read_sketches(spark, sketches), "yyyy").first()
    closes = [float(r[0]) for r in rows.select("close").collect()]
    outside = [c for c in closes if not fence["low_fence"] <= c <= fence["high_fence"]]
    inside = [c for c in closes if fence["low_fence"] <= c <= fence["high_fence"]]
    assert outside and [(r["n_outliers"], round(r["outlier_sum"], 4)) for r in want] == [(len(outside), round(sum(outside), 4))]
    assert (want[0]["whisker_low"], want[0]["whisker_high"]) == (min(inside), max(inside))
    assert H.outliers(rows, H.quartiles(H.read_sketches(spark, sketches), "yyyy"), "yyyy").count() == len(outside)
    spoilt = 0
    for file in Path(history).rglob("*.parquet"):
        if f"{MONTH}=1996-03" not in str(file):
            file.write_text("not to be read")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    assert spoilt >= 5 and lists(H.box_plots(spark, history, sketches, "yyyy")) == lists(spark.createDataFrame(want))


def test_an_update_renews_its_months_only(spark, one_symbol, tmp_path):
    history, sketches = str(tmp_path / "history"), str(tmp_path / "sketches")
    rows = one_symbol.filter("trading_date BETWEEN '1996-01-01' AND '1996-03-31'")
    append_history(rows.filter("trading_date < '1996-03-20'"), history)
    H.update_sketches(spark, history, sketches)
    before = {f.name for f in Path(sketches).rglob("*.parquet") if "1996-03" not in str(f)}
    append_history(rows.filter("trading_date >= '1996-03-20'"), history)
    H.update_sketches(spark, history, sketches, ["1996-03"])
    assert {f.name for f in Path(sketches).rglob("*.parquet") if "1996-03" not in str(f)} == before
    fields = ["symbol", "period", "n", "min_close", "q1", "median", "q3", "max_close"]
    assert lists(H.quartiles(H.read_sketches(spark, sketches), "MM").select(fields)) == lists(H.quartiles(H.sketch_closes(rows), "MM").select(fields))


def test_no_rows_and_nulls(spark, one_symbol, history, tmp_path):
    rows = history([("A", "2026-01-02 10:00", None), ("A", "2026-01-02 11:00", 5), ("B", "2026-01-02 11:00", None)])
    boxes = H.quartiles(H.sketch_closes(rows)).collect()
    assert [(b["symbol"], b["n"], b["q1"], b["q3"]) for b in boxes] == [("A", 1, 5.0, 5.0)]
    path = str(tmp_path / "history")
    append_history(rows.filter("false"), path)
    assert H.box_plots(spark, path, str(tmp_path / "none")).count() == 0


def test_sketches_are_merged_once(spark, history, tmp_path):
    """What is joined to the boxes reads them as written down."""
    path, sketches = str(tmp_path / "history"), str(tmp_path / "sketches")
    append_history(history([("A", f"2024-01-0{i} 10:00", i) for i in range(1, 9)]), path)
    H.update_sketches(spark, path, sketches)
    boxes = H.box_plots(spark, path, sketches)
    assert "kll_merge" not in boxes._jdf.queryExecution().executedPlan().toString()
    assert boxes.count() == 1
