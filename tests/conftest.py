import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tickforge.session import build_session

    session = build_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def bars(spark, sf_dir):
    """The cleaned history, stored once so tests read columns instead of computing them."""
    from tickforge import tables
    from tickforge.session import scratch_path
    from tickforge.sources.readers import read_history

    path = scratch_path(spark, "test-history")
    tables.bars(spark, sf_dir).write.parquet(path)
    return read_history(spark, path)


@pytest.fixture(scope="session")
def history(spark):
    """Builds history rows from (symbol, 'date time', close, volume, open, high, low)."""
    from datetime import datetime
    from decimal import Decimal

    from tickforge.schemas import HISTORY_SCHEMA

    def build(rows):
        def price(x):
            return None if x is None else Decimal(str(x))

        full = []
        for symbol, moment, close, *rest in rows:
            volume, open_, high, low = [*rest, *[close] * 4][:4] if rest else (1, close, close, close)
            when = datetime.fromisoformat(moment)
            full.append((symbol, when.date(), when, "src", price(close), volume, price(open_), price(high), price(low)))
        return spark.createDataFrame(full, HISTORY_SCHEMA)

    return build


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
