import corpus_pipeline
from pyspark.sql import functions as F

from tickforge.llm import quality
from tickforge.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(spark, sf_dir, n):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("lang = 'en' AND length(text) BETWEEN 800 AND 4000")
    return [r["text"] for r in docs.orderBy("doc_id").limit(n).collect()]


def test_stages_on_the_given_table(spark, sf_dir, documents):
    """Each stage against the plain form of its decision on the stage's own input."""
    from tickforge.llm import decontaminate

    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir), name)
        assert kept.columns == documents.columns and kept.exceptAll(docs).count() == 0
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = {r["doc_id"] for r in kept.collect()}
        if name == "language":
            assert {i for i, t in before.items() if not (t or "").strip()}.isdisjoint(after)
        if name == "quality":
            assert after == {r["doc_id"] for r in quality.quality_report(docs).filter("kept").collect()}
        if name == "near_copies":
            from llm.test_similar import plain_components

            assert after == plain_components({i: t or "" for i, t in before.items()})
        if name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            gone = {i for i, t in before.items() if any(decontaminate.plain(x) in decontaminate.plain(t) for x in items)}
            assert gone and gone.isdisjoint(after)
        docs = kept
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in docs.collect()}
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect()) == sorted(last.collect())


def test_planted_cases(spark, sf_dir, benchmark):
    """A clean document, exact and near copies, a leak, junk and text without letters."""
    texts = prose(spark, sf_dir, 12)
    leak = benchmark.first()["text"]
    spoilt = " ".join(w if i % 3 else w[:1] + "q" + w[2:] for i, w in enumerate(leak.split(" ")))
    near = texts[1] + " End."
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [
        (100, texts[0], "en", "s", 0), (101, texts[0], "en", "t", 0), (102, near, "en", "s", 0), (103, texts[2] + "\n" + leak, "en", "s", 0),
        (107, texts[5] + "\n" + spoilt + "\n" + texts[6], "en", "s", 0),
        (104, "*** ### $$$ " * 80, "en", "s", 0), (105, "0123 4567 " * 60, None, "s", 0), (106, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "decontamination":
            assert docs.filter("doc_id = 107").count() == 1
        docs = stored(stage(spark, docs, sf_dir), name)
    left = {r["doc_id"] for r in docs.collect()}
    assert not left & {100, 101, 102, 103, 104, 105, 106, 107}
    # Two of the texts consist of repeated words and fail the base rule; all others are clean.
    stats = [quality.text_statistics(t) for t in texts]
    assert {i for i, (n, _, _, _, repeated, _) in enumerate(stats) if n >= 50 and 2 * repeated <= n} <= left


def test_empty_and_clashing_input(spark, sf_dir, empty_docs, clashing_docs):
    for docs in (empty_docs, clashing_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, sf_dir), name)
            if name != "encoding":
                assert out.columns == docs.columns
                docs = out
        assert out.count() == docs.count()


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")].__len__() == 13 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
    assert F is not None
