import re
from collections import Counter

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from tickforge.llm import phrases
from tickforge.llm.queries import ORACLE, QUERIES


def plain_collocations(rows, least, longest):
    """{(lang, phrase): (a, l, r, n, score)} from all spans of all pieces."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    covered = {(lang, w[i:i + k]) for (lang, w), c in found.items() for k in range(2, len(w))
               for i in range(len(w) - k + 1) if c >= f[lang, w[i:i + k]]}
    result = {}
    for (lang, w), a in found.items():
        if (lang, w) not in covered:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                        for k in range(1, len(w)))
            result[lang, " ".join(w)] = (a, left, right, n[lang], score)
    return result


def rows_of(df):
    return {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(QUERIES["op12_phrases"](spark, sf), connect(sf), ORACLE["op12_phrases"]) is None


@pytest.mark.parametrize("least, longest", [(3, 5), (2, 2), (8, 4)])
def test_equals_plain_counts(spark, documents, least, longest):
    docs = documents.filter("doc_id < 60")
    want = plain_collocations([(r["text"], r["lang"]) for r in docs.collect()], least, longest)
    assert want and rows_of(phrases.collocations(docs, least, longest)) == want


def test_joins_by_shuffle_give_the_same(spark, documents, monkeypatch):
    docs = documents.filter("doc_id < 40").withColumn("lang", F.lit("x"))
    few = rows_of(phrases.collocations(docs, 4))
    monkeypatch.setattr(phrases, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(phrases, "FILTER_WORDS", 0)
    monkeypatch.setattr(phrases, "BUCKET_ROWS", 500)
    assert rows_of(phrases.collocations(docs, 4)) == few


def test_shared_numbers_are_drawn_anew(spark, monkeypatch):
    """A hash that gives all words one number for the first salt only."""
    docs = spark.createDataFrame([("a b c. a b c", "x"), ("b c a b", "y")], "text string, lang string")
    right = phrases.word_counts
    tried = []

    def poor(texts, salt):
        tried.append(salt)
        return right(texts, salt).withColumn("number", F.lit(1).cast("long")) if salt == 0 else right(texts, salt)

    monkeypatch.setattr(phrases, "word_counts", poor)
    assert rows_of(phrases.collocations(docs, 2)) == plain_collocations([("a b c. a b c", "x"), ("b c a b", "y")], 2, 5)
    assert tried == [0, 1]


def test_join_by_piece_moves_no_rows(spark, documents):
    with phrases.Relations(spark, 4) as tables:
        rows = phrases.pair_occurrences(documents.select("text", "lang"), 0, None).withColumnRenamed("left", "id")
        pairs = phrases.at_next(tables.keep(rows.repartition(4, "piece")))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = pairs._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith("occurrences_")]


def test_groups_of_texts_give_the_same(spark, documents, monkeypatch):
    docs = documents.filter("doc_id < 30").select("text", "lang").toPandas()
    batch = phrases.pa.RecordBatch.from_pandas(docs, preserve_index=False)

    def all_pairs():
        found, base = [], 0
        for pieces, piece, at, left, right, numbers in phrases.neighbours(batch, 0, None):
            found += zip((piece + base).tolist(), at.tolist(), numbers[left].tolist(), numbers[right].tolist())
            base += pieces
        return found

    whole = all_pairs()
    monkeypatch.setattr(phrases, "GROUP_WORDS", 50)
    assert whole and all_pairs() == whole


def test_exact_beyond_64_bits(spark):
    """Scores by whole numbers also where a * n exceeds 64 bits."""
    big = spark.createDataFrame([(9 * 10**14, 10**15, 10**15, 10**17)], "a long, l long, r long, n long")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    product = (F.lit(1000).cast("decimal(4,0)") * exact["a"]).cast("decimal(19,0)") * exact["n"]
    got = big.select(product.alias("over"), (exact["l"] * exact["r"]).alias("under")).select(F.expr("over div under")).first()[0]
    assert got == 1000 * 9 * 10**14 * 10**17 // 10**30


def test_odd_rows(odd_docs, empty_docs, clashing_docs):
    want = plain_collocations([(r["text"], r["lang"]) for r in odd_docs.collect()], 3, 5)
    assert rows_of(phrases.collocations(odd_docs, 3)) == want
    assert rows_of(phrases.collocations(clashing_docs, 3)) == want
    assert phrases.collocations(empty_docs).count() == 0
    ranked = phrases.top_collocations(phrases.collocations(odd_docs, 3), 2).collect()
    assert ranked and {r["rank"] for r in ranked} == {1, 2}
