import hashlib
from collections import Counter

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from tickforge.llm import warc
from tickforge.llm.queries import ORACLE, QUERIES
from tickforge.session import scratch_path

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<html>" + "copy " * 400 + "</html>"
    return spark.createDataFrame([
        (1, "http://a/1", big), (2, "http://a/2", big), (3, "http://a/3\r\nX: y", big), (3, "http://a/0", big), (4, None, "small"),
        (5, "http://a/5", "small"), (6, "http://a/6", None), (7, "u", ""), (None, "http://a/n", big), (8, "u", "é" * 600),
        (9, "u", "é" * 600), (10, "u", "x" * 3_000_000),
    ], SCHEMA)


def test_query_equals_sql(spark, sf_dir):
    assert compare(QUERIES["op1_warc"](spark, sf_dir), connect(sf_dir), ORACLE["op1_warc"]) is None


def test_odd_pages(spark, pages):
    rows = warc.archive_pages(pages).collect()
    assert len(rows) == 12
    got = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in rows)
    assert got == Counter([
        (1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (3, "revisit", 3), (4, "response", None), (5, "response", None),
        (6, "response", None), (7, "response", None), (None, "revisit", 3), (8, "revisit", 9), (9, "response", None), (10, "response", None)])
    by_id = {r["page_id"]: r for r in rows}
    assert by_id[6]["payload_bytes"] == 0 and by_id[8]["payload_bytes"] == 1200
    assert by_id[8]["payload_digest"] == hashlib.sha1(("é" * 600).encode()).hexdigest()


def test_round_trip_and_dictionary_frame(spark, pages):
    folder = scratch_path(spark, "warc-test")
    listed = warc.write_archives(warc.plan_records(pages), folder, archive_bytes=4096)
    rows = {(r["page_id"], r["record_type"]): r for r in warc.read_archives(listed).collect()}
    assert bytes(rows[(9, "response")]["payload"]) == ("é" * 600).encode()
    assert rows[(1, "revisit")]["payload"] is None
    assert rows[(3, "response")]["url"] in ("http://a/0", "http://a/3%0D%0AX:%20y")
    path = listed.first()["path"]
    with open(path, "rb") as file:
        assert file.read(4) == b"\x5d\x2a\x4d\x18"


def test_dictionary_pays_off(spark, sf_dir):
    import zstandard

    from tickforge.llm.common import table

    plan = warc.plan_records(table(spark, sf_dir, "pages"))
    listed = warc.write_archives(plan.coalesce(1), scratch_path(spark, "warc-size")).collect()
    alone = sum(len(zstandard.compress(warc.record_bytes(r.asDict()), 3)) for r in plan.collect())
    assert sum(r["stored_bytes"] for r in listed) < alone


def test_damaged_payload_is_noticed():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "payload_bytes": 3, "payload_digest": "00" * 20, "record_type": "response",
           "refers_to": None}
    with pytest.raises(ValueError, match="differ"):
        warc.parse_record(warc.record_bytes(row))


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_clashing_columns(spark, pages):
    from pyspark.sql import functions as F

    more = pages.withColumns({"payload": F.lit("x"), "salt": F.lit(1), "keeper": F.lit(2)})
    assert warc.archive_pages(more).count() == 12


def test_a_small_payload_of_many_pages_is_spread(spark):
    """Empty pages, a third of all, are dealt evenly and stay responses."""
    pages = spark.range(6000).selectExpr(
        "id page_id", "concat('u', id) url", "if(id % 3 = 0, null, if(id % 3 = 1, repeat('x', 1200), concat(id, 'y'))) html")
    plan = warc.plan_records(pages)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = plan.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count_if(F.col("payload_bytes") == 0).alias("small"))
    sizes = [r["small"] for r in dealt.collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 4
    assert sum(sizes) == 2000 and max(sizes) < 3 * 2000 / len(sizes) + 50
    kinds = {(r["payload_bytes"] >= 1000, r["record_type"]): r["n"] for r in plan.groupBy("payload_bytes", "record_type").agg(
        F.count("*").alias("n")).filter("payload_bytes IN (0, 1200)").collect()}
    assert kinds == {(False, "response"): 2000, (True, "response"): 1, (True, "revisit"): 1999}
