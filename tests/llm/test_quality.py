from collections import Counter

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from tickforge.llm import quality
from tickforge.llm.queries import ORACLE, QUERIES


def test_query_equals_sql(spark, sf_dir):
    assert compare(QUERIES["op3_quality"](spark, sf_dir), connect(sf_dir), ORACLE["op3_quality"]) is None


@pytest.mark.parametrize("text, want", [
    (None, (0, 0, 0, 0, 0, 0)), ("", (0, 0, 0, 0, 0, 0)), (" \n\t", (0, 0, 0, 0, 0, 0)),
    ("a b c a b c", (6, 6, 0, 0, 6, 1)), ("a b a b a", (5, 5, 0, 0, 5, 1)), ("é # a\né # a\n\n", (6, 6, 2, 1, 6, 2)),
    ("a\xa0b c", (2, 4, 0, 0, 0, 1)),
])
def test_statistics(text, want):
    assert quality.text_statistics(text) == want


def test_repeats_against_marking():
    words = [bytes([97 + (i * i) % 5]) for i in range(200)]
    windows = [tuple(words[i:i + 3]) for i in range(198)]
    n = Counter(windows)
    marked = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    assert quality._repeated(words, 200) == len(marked)


def test_sketches_merge_and_bound_the_error(spark):
    stats = spark.range(20_000).select(
        F.lit("en").alias("lang"), (F.col("id") % 2).cast("string").alias("source"), F.lit(1000).cast("long").alias("n_words"),
        F.col("id").alias("word_chars"), F.lit(0).cast("long").alias("n_symbols"), F.lit(0).cast("long").alias("n_dup_lines"),
        F.lit(0).cast("long").alias("n_repeat_words"), F.lit(1).cast("long").alias("n_lines"))
    fine = quality.sketches(stats, ["lang", "source"])
    merged = quality.merge(fine, ["lang"]).filter("metric = 'word_length'").orderBy("bin").collect()
    direct = quality.sketches(stats, ["lang"]).filter("metric = 'word_length'").orderBy("bin").collect()
    assert merged == direct
    assert quality.sketches(stats.repartition(7), ["lang"]).filter("metric = 'word_length'").orderBy("bin").collect() == direct
    q = quality.quantiles(quality.merge(fine, ["lang"]), ["lang"], {"m": 0.5}).filter("metric = 'word_length'").first()
    assert abs(q["m"] - 10_000) <= 10_000 / 32


def test_thresholds_adapt_to_the_group(spark):
    def docs(source, symbols, n):
        return [(i, ("word " * 3 + "and # " * symbols + " ".join(f"w{i}x{j}" for j in range(200))), "en", source, 0) for i in range(n)]

    rows = docs("code", 20, 200) + docs("news", 0, 200) + [(999, docs("news", 20, 1)[0][1], "en", "news", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r["source"], r["doc_id"]): r["kept"] for r in quality.quality_report(df).collect()}
    assert got[("code", 5)] and got[("news", 5)]
    dense = spark.createDataFrame(
        rows[:400] + [(999, "a # # # # " * 3 + rows[399][1].replace("w", "#"), "en", "news", 0)], df.schema)
    assert not [r["kept"] for r in quality.quality_report(dense).collect() if r["doc_id"] == 999][0]


def test_many_groups_are_joined_without_a_broadcast(documents, monkeypatch):
    want = sorted((r["doc_id"], r["kept"]) for r in quality.quality_report(documents).collect())
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", 0)
    assert sorted((r["doc_id"], r["kept"]) for r in quality.quality_report(documents).collect()) == want


def test_odd_rows(odd_docs, empty_docs, clashing_docs):
    rows = quality.quality_report(odd_docs).collect()
    assert len(rows) == 13
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["doc_id"] in (1, 2, 3, 8, 9, 10))
    assert quality.quality_report(empty_docs).count() == 0 and quality.keep_good(empty_docs).count() == 0
    kept = quality.keep_good(clashing_docs)
    assert kept.columns == clashing_docs.columns
    want = {r["doc_id"] for r in quality.quality_report(clashing_docs).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == want
