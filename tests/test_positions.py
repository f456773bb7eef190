"""Pages by the position index against pages by a full sort."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickforge.operators import ordering as O
from tickforge.operators import positions as N
from tickforge.schemas import MONTH
from tickforge.sources.readers import read_history
from tickforge.sources.writers import append_history


@pytest.fixture(scope="module")
def some(bars):
    """A few months, with a row without a day, one without a symbol, and equal rows."""
    rows = bars.filter("trading_date BETWEEN '1996-03-01' AND '1996-05-31'")
    odd = rows.limit(2).withColumn("trading_date", F.lit(None).cast("date"))
    nameless = rows.filter("trading_date = '1996-04-02'").limit(3).withColumn("symbol", F.lit(None).cast("string"))
    return rows.unionByName(odd).unionByName(nameless).unionByName(nameless).unionByName(rows.limit(40)).cache()


@pytest.fixture(scope="module")
def stored(spark, some, tmp_path_factory):
    folder = tmp_path_factory.mktemp("positions")
    append_history(some, f"{folder}/history")
    N.update_positions(spark, f"{folder}/history", f"{folder}/index")
    return f"{folder}/history", f"{folder}/index"


def lists(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("number", [-3, 1, 2, 5, 7, 10**9])
@pytest.mark.parametrize("ranked", [N.RANKED_ROWS, 0])
def test_pages_equal_a_full_sort(spark, stored, some, number, ranked, monkeypatch):
    monkeypatch.setattr(N, "RANKED_ROWS", ranked)
    page = N.indexed_page(spark, *stored, number, 25)
    want = O.history_page(some, number, 25, deep=True)
    assert lists(page.select(want.columns)) == lists(want) and page.count() > 0


def test_a_page_is_one_look_up_and_one_pruned_scan(spark, some, tmp_path):
    history, index = str(tmp_path / "history"), str(tmp_path / "index")
    append_history(some, history)
    N.update_positions(spark, history, index)
    want = lists(O.history_page(some, 1, 10))
    for file in Path(history).rglob("*.parquet"):
        if f"{MONTH}=1996-05" not in str(file):
            file.write_text("not to be read")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    page = N.indexed_page(spark, history, index, 1, 10)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "In(trading_date" not in plan.split("PartitionFilters")[0]
    assert lists(page.select(O.history_page(some, 1, 10).columns)) == want


def test_an_append_touches_its_months_only(spark, some, tmp_path):
    history, index = str(tmp_path / "history"), str(tmp_path / "index")
    plain = some.filter("symbol IS NOT NULL AND trading_date IS NOT NULL").distinct()
    append_history(plain.filter("trading_date < '1996-05-10'"), history)
    N.update_positions(spark, history, index)
    before = {f.name for f in Path(index).rglob("*.parquet") if "1996-05" not in str(f)}
    for _ in range(2):
        N.append_indexed(plain.filter("trading_date >= '1996-05-10'"), history, index)
    assert {f.name for f in Path(index).rglob("*.parquet") if "1996-05" not in str(f)} == before
    assert N.is_current(spark, history, index)
    for number in (1, 4, 10**9):
        want = O.history_page(read_history(spark, history), number, 25, deep=True)
        assert lists(N.indexed_page(spark, history, index, number, 25).select(want.columns)) == lists(want)


def test_no_rows(spark, some, tmp_path):
    history, index = str(tmp_path / "history"), str(tmp_path / "index")
    append_history(some.filter("false"), history)
    assert N.locate(spark, index, 3) == N.Place(1, 1, 0, [])
    N.update_positions(spark, history, index)
    assert N.locate(spark, index, 3).page == 1
