"""Row-set comparison of a Spark result with the oracle SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_by_name(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when both agree on column names and rows, else what differs."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    got = rows_by_name(spark_df.columns, spark_df.collect())
    want = rows_by_name(names, expected)
    if got == want:
        return None if want else "no rows"
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; columns {sorted(names)}; "
        f"only Spark {list(extra)[:2]}; only oracle {list(missing)[:2]}"
    )
