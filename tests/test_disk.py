"""What a job leaves on disk while and after it runs."""
import json
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickforge.plans import queries as Q
from tickforge.plans.run import run_cleaned
from tickforge.schemas import DAILY_SCHEMA, MONTHLY_SCHEMA
from tickforge.session import SPARING, shared_folder, sparing
from tickforge.sources import messages as M
from tickforge.sources import upsert as U
from tickforge.streaming import consumer as Z


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(p) for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*.data")}


def new_shuffle_files(spark, before):
    """Spark removes them in the background."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def scratch(spark, *names):
    return [p.name for p in Path(shared_folder(spark)).iterdir() if p.name.rsplit("-", 1)[0] in names]


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(5000).selectExpr("concat('S', id % 70) AS symbol", "date_add(date'2026-01-01', cast(id div 70 AS int)) AS calc_date",
                                        "id AS total_volume", "1 AS seq")
    U.upsert_daily(rows, str(tmp_path / "daily"), str(tmp_path / "stage"))
    assert new_shuffle_files(spark, before) == set()
    assert U.read_serving(spark, str(tmp_path / "daily"), DAILY_SCHEMA).count() == 5000


def test_settings_come_back(spark):
    before = {k: spark.conf.get(k, None) for k in SPARING}
    with pytest.raises(ValueError), sparing(spark):
        assert {k: spark.conf.get(k) for k in SPARING} == SPARING
        raise ValueError
    assert {k: spark.conf.get(k, None) for k in SPARING} == before


@pytest.mark.parametrize("mode", ["replace", "coalesce"])
def test_an_applied_batch_has_no_stage_and_can_be_repeated(spark, tmp_path, mode):
    topic, root = str(tmp_path / "topic"), str(tmp_path / "root")

    def message(**values):
        return json.dumps({"symbol": "A", "calc_date": "2026-06-12", "calc_month": 6, "calc_year": 2026, **values})

    def run():
        Z.consume(Z.read_topics(spark, {"path": topic}), root, mode).awaitTermination()
        tables = U.read_serving(spark, f"{root}/daily", DAILY_SCHEMA), U.read_serving(spark, f"{root}/monthly", MONTHLY_SCHEMA), Z.read_quarantine(spark, root)
        return [sorted(map(str, t.collect())) for t in tables]

    def send(*rows):
        spark.createDataFrame([(None, v, t, 0, o, datetime(2026, 6, 12)) for t, o, v in rows], M.TOPIC_SCHEMA).write.mode("append").parquet(topic)

    send((M.DAILY_TOPIC, 1, message(total_volume=5, liquidity_status="High")), (M.MONTHLY_TOPIC, 1, message(monthly_avg_close=1.5)))
    run()
    send((M.DAILY_TOPIC, 2, message(total_volume=7)), (M.MONTHLY_TOPIC, 2, message(monthly_total_volume=3)), (M.DAILY_TOPIC, 3, "{oops"))
    tables = run()
    assert not list(Path(root, "stage").rglob("*.parquet"))
    for file in Path(root, "checkpoint", "commits").glob("*1*"):
        file.unlink()
    assert run() == tables and [len(t) for t in tables] == [1, 1, 1] and "total_volume=7" in tables[0][0]


def test_parts_of_the_topic_go_when_it_is_written(spark, sf_dir):
    Q._topic(spark, sf_dir)
    assert scratch(spark, "topic-summary", "topic-daily", "topic-months") == []


def test_a_run_leaves_its_tables_only(spark, bars, tmp_path):
    names = ("cleaned", "records", "indicators", "daily-rows", "states", "changed", "changed-states", "changed-daily", "changed-monthly",
             "broken-records", "stage-daily", "stage-monthly")
    left, before = scratch(spark, *names), shuffle_files(spark)
    rows = bars.filter("symbol = 'S000001' AND year(trading_date) = 1996")
    late = F.month("trading_date") == 5
    for number, batch in enumerate([rows.filter(~late), rows.filter(late), rows]):
        run_cleaned(batch, str(tmp_path), number)
    assert scratch(spark, *names) == left
    assert new_shuffle_files(spark, before) == set()
