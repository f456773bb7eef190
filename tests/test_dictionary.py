"""Search by stored values against a search of every row."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickforge.operators import dictionary as A
from tickforge.operators.filters import search
from tickforge.sources.readers import read_history
from tickforge.sources.writers import append_history


@pytest.fixture
def stored(spark, history, tmp_path):
    """Symbols in one month, in all months and without a month; values of August are not stored."""
    rows = history([("ABC", "2026-06-01 09:00", 1), ("ABD", "2026-07-01 09:00", 2), ("xyz", "2026-07-01 09:00", 3),
                    ("X%_.", "2026-06-02 09:00", 4)])
    odd = rows.limit(2).withColumn("trading_date", F.lit(None).cast("date"))
    nameless = rows.limit(1).withColumn("symbol", F.lit(None).cast("string")).withColumn("source", F.lit("Feed ab"))
    places = [str(tmp_path / n) for n in ("history", "values")]
    append_history(rows.unionByName(odd).unionByName(nameless), places[0])
    A.update_values(spark, *places)
    append_history(history([("ABE", "2026-08-01 09:00", 5), ("W", "2026-08-01 09:00", 6)]), places[0])
    return places


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("listed", [A.LISTED, 0])
@pytest.mark.parametrize("text, regex", [
    ("ab", False), (" AbC ", False), ("src", False), ("%_.", False), ("absent", False), (" ", False), ("^ab[cd]$", True), ("z$|^w$", True),
])
def test_equal_to_searching_every_row(spark, stored, text, regex, listed, monkeypatch):
    monkeypatch.setattr(A, "LISTED", listed)
    want = search(read_history(spark, stored[0]), text, list(A.COLUMNS), regex)
    assert same(A.search_stored(spark, *stored, text, regex), want)


def test_months_without_a_match_are_not_opened(spark, stored):
    A.update_values(spark, *stored, ["2026-08"])
    want = search(read_history(spark, stored[0]), "xyz", ["symbol"]).collect()
    for file in Path(stored[0]).rglob("*.parquet"):
        if "2026-06" in str(file) or "2026-08" in str(file):
            file.write_text("not to be read")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert len(want) == 1 and A.search_stored(spark, *stored, "xyz").collect() == want


def test_an_updated_month_is_replaced(spark, stored, history):
    append_history(history([("NEW", "2026-06-03 09:00", 1)]), stored[0])
    A.update_values(spark, *stored, ["2026-06"])
    assert A.search_stored(spark, *stored, "new").count() == 1
