import json
from datetime import datetime

import pytest
from conftest import values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickforge.operators import catalogue as K
from tickforge.operators.consolidate import conform
from tickforge.schemas import DAILY_SCHEMA, HISTORY_SCHEMA, MONTHLY_SCHEMA
from tickforge.sources import messages as M
from tickforge.sources import readers as I
from tickforge.sources import upsert as U
from tickforge.sources import writers as W
from tickforge.streaming import consumer as Z


def test_missing_path_gives_the_schema(spark, tmp_path):
    frame = I.read_json_or_empty(spark, str(tmp_path / "absent"), DAILY_SCHEMA)
    assert frame.isEmpty() and frame.schema == DAILY_SCHEMA


def test_other_read_errors_are_raised(spark):
    with pytest.raises(PySparkException):
        I.read_json_or_empty(spark, "nosuchscheme-%%%:", DAILY_SCHEMA).count()


def test_one_json_batch(spark, tmp_path, history):
    rows = history([("A", "2026-06-12 11:00:00", 10), ("A", "2026-06-12 15:00:00", 11), ("A", "2026-06-13 11:00:00", 12)])
    root = str(tmp_path / "raw")
    W.write_json_batches(rows.withColumnsRenamed({c: f"{c}_price" for c in ("close", "open", "high", "low")}), root)
    assert int(I.read_json_batch(spark, root, 2026, 6, 12, "1145").first().close_price) == 10
    assert int(I.read_json_batch(spark, root, 2026, 6, 12, "1515").first().close_price) == 11
    assert I.read_json_batch(spark, root, 2026, 6, 14, "1145").isEmpty()


def test_partition_pruning(spark, tmp_path, history):
    path = str(tmp_path / "t")
    rows = history([("A", "2026-06-12 09:00:00", 10), ("A", "2026-06-13 09:00:00", 10)])
    W.replace_partitions(W.with_batch_partitions(rows), path, ["p_year", "p_month", "p_day", "p_batch"])
    frame = I.read_partitioned(spark, path, "2026-06-13")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == 1
    assert "PartitionFilters: [(make_date" in plan or "make_date(p_year" in plan.split("PartitionFilters")[1]


def test_text_lines(spark, tmp_path):
    good = "A,2026-06-12,2026-06-12 09:00:00,x,1.5,100,1,2,1"
    lines = ["Symbol,a,b,c,d,e,f,g,h", good, "", "A,short", good + ",more", good.replace("1.5", "abc"),
             good.replace("100", "\\N"), good.replace("100", "12.0")]
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(lines))
    assert sorted(values(I.read_tolerant(spark, str(path)), "volume")) == [(12,), (100,), (100,)]
    assert I.read_tolerant(spark, str(path), exact=True).count() == 2


def test_append_twice_changes_nothing(spark, tmp_path, history):
    path = str(tmp_path / "h")
    first = history([("A", "2026-06-12 09:00:00", 10), ("B", "2026-06-12 09:00:00", 10)])
    more = history([("A", "2026-06-12 09:00:00", 10), ("A", "2026-07-01 09:00:00", 11)])
    for batch in (first, more, more, first, first.limit(0)):
        W.append_new(batch, path)
    assert I.read_history(spark, path).count() == 3


def test_reset_keeps_the_schema(spark, tmp_path, history):
    path = str(tmp_path / "landing")
    history([("A", "2026-06-12 09:00:00", 10)]).write.parquet(path)
    W.reset_table(spark, path, HISTORY_SCHEMA)
    assert spark.read.parquet(path).isEmpty() and spark.read.parquet(path).columns == HISTORY_SCHEMA.fieldNames()


def daily(spark, *rows):
    frame = spark.createDataFrame(
        [(s, d, v, st) for s, d, v, st, _ in rows], "symbol string, d string, total_volume long, liquidity_status string"
    ).withColumn("calc_date", F.to_date("d"))
    numbered = conform(frame, DAILY_SCHEMA).join(
        spark.createDataFrame([(s, d, q) for s, d, _, _, q in rows], "symbol string, d string, seq long").withColumn(
            "calc_date", F.to_date("d")).drop("d"), ["symbol", "calc_date"])
    return numbered


def stored(spark, table, *columns):
    return sorted(values(U.read_serving(spark, table, DAILY_SCHEMA), "symbol", F.col("calc_date").cast("string"), *columns))


def test_upsert_modes_and_replay(spark, tmp_path):
    for mode, status in (("replace", None), ("coalesce", "High")):
        table, stage = str(tmp_path / mode / "t"), str(tmp_path / mode / "s")
        U.upsert_daily(daily(spark, ("A", "2026-06-12", 5, "High", 1), ("B", "2026-05-12", 6, "Low", 1)), table, f"{stage}/1", mode)
        for _ in range(2):
            U.upsert_daily(daily(spark, ("A", "2026-06-12", 9, None, 2)), table, f"{stage}/2", mode)
        assert stored(spark, table, "total_volume", "liquidity_status") == [
            ("A", "2026-06-12", 9, status), ("B", "2026-05-12", 6, "Low")]


def test_upsert_repeats_after_a_lost_commit(spark, tmp_path):
    """The merged stage is complete, the table lost its month: the repeat restores old and new rows."""
    table, stage = str(tmp_path / "t"), str(tmp_path / "s")
    U.upsert_daily(daily(spark, ("A", "2026-06-12", 5, "High", 1)), table, f"{stage}/1")
    batch = daily(spark, ("B", "2026-06-12", 6, "Low", 2))
    U.upsert_daily(batch, table, f"{stage}/2")
    spark.createDataFrame([], spark.read.parquet(table).schema).write.mode("overwrite").parquet(table)
    U.upsert_daily(batch, table, f"{stage}/2")
    assert stored(spark, table, "total_volume") == [("A", "2026-06-12", 5), ("B", "2026-06-12", 6)]


def test_monthly_rows_without_year_or_average(spark, tmp_path):
    rows = spark.createDataFrame(
        [("A", None, 1, None, 5, 1), ("A", 2026, 1, None, 6, 1)],
        "symbol string, calc_year int, calc_month int, monthly_avg_close double, monthly_total_volume long, seq long")
    for zero, expected in ((True, 0), (False, None)):
        table = str(tmp_path / f"m{zero}")
        U.upsert_monthly(rows, table, f"{table}-stage", zero_for_missing=zero)
        got = U.read_serving(spark, table, MONTHLY_SCHEMA).collect()
        assert [(r.calc_year, r.monthly_avg_close, r.monthly_total_volume) for r in got] == [(2026, expected, 6)]


def topic_rows(spark, *rows):
    return spark.createDataFrame(
        [(None, value, topic, 0, offset, datetime(2026, 6, 12)) for topic, offset, value in rows], M.TOPIC_SCHEMA)


def test_consumer_restart_and_bad_messages(spark, tmp_path):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "root")

    def message(volume):
        return json.dumps({"symbol": "A", "calc_date": "2026-06-12", "total_volume": volume})

    def run():
        Z.consume(Z.read_topics(spark, {"path": topic}), root).awaitTermination()

    topic_rows(spark, (M.DAILY_TOPIC, 1, message(5)), (M.DAILY_TOPIC, 2, "{oops"), (M.MONTHLY_TOPIC, 1, "[]x")).write.parquet(topic)
    run()
    run()
    topic_rows(spark, (M.DAILY_TOPIC, 3, message(7))).write.mode("append").parquet(topic)
    run()
    assert stored(spark, f"{root}/daily", "total_volume") == [("A", "2026-06-12", 7)]
    bad = spark.read.parquet(f"{root}/quarantine")
    assert sorted(values(bad, "topic", M.CORRUPT)) == [(M.DAILY_TOPIC, "{oops"), (M.MONTHLY_TOPIC, "[]x")]


def test_watermarked_intake(spark, tmp_path, history):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "history")
    rows = history([("A", "2026-06-12 09:00:00", 10), ("A", "2026-06-12 09:05:00", 11)])
    rows.unionByName(rows).write.parquet(landing)
    stream = spark.readStream.schema(rows.schema).parquet(landing).withColumn("scrape_time", F.col("scrape_time").cast("timestamp"))
    Z.intake_within(stream, path, f"{path}-checkpoint").awaitTermination()
    assert spark.read.parquet(path).count() == 2


def test_keyed_payload_has_every_field(spark):
    frame = spark.createDataFrame([("A", 5)], "symbol string, total_volume long")
    payload = json.loads(M.as_keyed_messages(frame).first().value)
    assert list(payload) == DAILY_SCHEMA.fieldNames() and payload["total_volume"] == 5 and payload["sma_price"] is None


def test_catalogue_edits(spark):
    listed = spark.createDataFrame([(1, "A", "a", "x", 1), (2, "B", "b", "x", 1), (3, "C", "c", "y", 0)],
                                   "id long, symbol string, bank_name string, source string, status int")
    edits = spark.createDataFrame(
        [("insert", " d ", "d", "z", None, 4, 1), ("insert", "A", "other", "z", 0, 9, 1), ("delete", "b", None, None, None, None, 1),
         ("update", "C", "cc", None, None, None, 1), ("status", "C", "no", None, 1, None, 2), ("update", "X", "x", "x", 1, 7, 1)],
        "op string, symbol string, bank_name string, source string, status int, id long, seq int")
    got = sorted(values(K.apply_changes(listed, edits), "id", "symbol", "bank_name", "source", "status"))
    assert got == [(1, "A", "a", "x", 1), (3, "C", "cc", "y", 1), (4, "D", "d", "z", 1)]


def test_catalogue_edits_are_applied_in_order(spark):
    listed = spark.createDataFrame([(1, " a", "a", "x", 1), (2, "B", "b", "x", 1)],
                                   "id long, symbol string, bank_name string, source string, status int")
    edits = spark.createDataFrame(
        [("insert", "D", "d", "z", None, 4, 1), ("status", "D", None, None, 0, None, 2), ("update", "E", "no", None, 5, None, 1),
         ("insert", "E", "e", "z", 7, 5, 2), ("update", "E", None, "zz", None, None, 3), ("delete", "B", None, None, None, None, 1),
         ("update", "B", "lost", None, None, None, 2), ("insert", "B", "again", "y", 0, 8, 3), ("update", "A", "aa", None, None, None, 1),
         ("delete", "A", None, None, None, None, 2)],
        "op string, symbol string, bank_name string, source string, status int, id long, seq int")
    got = sorted(values(K.apply_changes(listed, edits), "id", "symbol", "bank_name", "source", "status"))
    assert got == [(4, "D", "d", "z", 0), (5, "E", "e", "zz", 1), (8, "B", "again", "y", 1)]


def test_fallbacks(spark):
    assert K.fallback_symbols(spark).count() == 20
    empty = K.empty_catalogue(spark)
    full = spark.createDataFrame([(1, "A", "a", "x", 1)], empty.schema)
    assert K.first_non_empty(empty, full).count() == 1
    assert K.symbols_to_capture(empty).count() == 20 and K.symbols_to_capture(full).count() == 1
