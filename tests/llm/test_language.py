import numpy as np
from pyspark.sql import functions as F

from tickforge.llm import language
from tickforge.llm.common import out_of_fold
from tickforge.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir, documents):
    rows = QUERIES["op5_language"](spark, sf_dir).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 20 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_nothing_is_learnt_from_the_held_out_fold(documents):
    train = documents.filter(out_of_fold("doc_id", 4, 2))
    spoilt = documents.withColumn("lang", F.when(out_of_fold("doc_id", 4, 2), F.col("lang")).otherwise("zz"))
    a = language.train_languages(train)
    b = language.train_languages(spoilt.filter(out_of_fold("doc_id", 4, 2)))
    assert a.langs == b.langs and np.array_equal(a.logs, b.logs)


def test_mixture_shares(documents):
    model = language.train_languages(documents)
    by_lang = {}
    for r in documents.filter("length(text) > 2000").collect():
        by_lang.setdefault(r["lang"], r["text"][:2000])
    de, fr = by_lang["de"], by_lang["fr"]
    (main, share, parts), (_, _, single) = model.predict([de + "\n" + fr[:1000], de])
    assert main == "de" and {p[0] for p in parts} == {"de", "fr"} and 0.55 < share < 0.78
    assert len(single) == 1


def test_four_languages_and_unknown_text(spark, documents):
    from tickforge.llm.common import stored

    model = language.train_languages(documents)
    by_lang = {}
    for r in documents.filter("length(text) > 1500 AND lang IS NOT NULL").orderBy("doc_id").collect():
        by_lang.setdefault(r["lang"], r["text"][:1500])
    assert len(by_lang) >= 4
    rng = np.random.default_rng(3)
    noise = " ".join("".join(rng.choice(list("qwxzjkvpfgybm"), 7)) for _ in range(200))
    greek = "Ολοι οι ανθρωποι γεννιουνται ελευθεροι και ισοι στην αξιοπρεπεια και τα δικαιωματα. " * 12
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem. " * 12
    texts = ["\n".join(by_lang.values()), noise, greek, polish, *by_lang.values()]
    found = model.predict(texts)
    assert len(found[0][2]) == len(by_lang) and abs(found[0][1] - 1 / len(by_lang)) < 0.05
    assert all(name in model.langs and score < 0.34 for name, score, _ in found[1:4]), found[1:4]
    assert all(score > 0.95 for _, score, _ in found[4:])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = stored(language.keep_known(docs, model), "kept")
    assert {r["doc_id"] for r in kept.collect()} == set(range(4, 4 + len(by_lang)))


def test_choice_equals_plain_em():
    """Block likelihoods of one document, chosen by a direct search over all language sets."""
    from itertools import combinations

    rng = np.random.default_rng(0)
    ll = rng.normal(0, 1, (40, 3)) - 30
    ll[:25, 0] += 20
    ll[25:, 2] += 20
    got = language.choose_languages(ll, np.array([0]))[0]
    best = None
    for k in (1, 2, 3):
        for s in combinations(range(3), k):
            share = np.full(k, 1 / k)
            for _ in range(200):
                part = np.exp(ll[:, s] - ll[:, s].max(1, keepdims=True)) * share
                part /= part.sum(1, keepdims=True)
                share = part.mean(0)
            value = np.log((np.exp(ll[:, s] + 30) * share).sum(1)).sum() - language.PENALTY * (k - 1) * np.log(1 + 40 * language.BLOCK)
            if best is None or value > best[0]:
                best = (value, s, share)
    assert best[1] == (0, 2) and np.allclose(got[[0, 2]], best[2], atol=1e-3) and got[1] == 0


def test_long_text_in_pieces(monkeypatch):
    counts = np.ones((2, language.BUCKETS))
    counts[0, language.gram_codes(language.plain_bytes("abcabcabc"))] = 50
    model = language.LanguageModel(["a", "b"], counts)
    text = "abc xyz " * 500
    whole = model.predict([text, "abc"])
    monkeypatch.setattr(language, "PIECE_BYTES", 256)
    assert model.predict([text, "abc"]) == whole


def test_odd_rows(odd_docs, empty_docs, clashing_docs, documents):
    model = language.train_languages(documents)
    found = language.identify(odd_docs, model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 3, 8, 10)} == dict.fromkeys((1, 2, 3, 8, 10), "und")
    assert all(r["lang_pred"] != "und" for r in found if r["doc_id"] in (4, 5, 6, 7, 9))
    assert language.identify(empty_docs, model).count() == 0
    none = language.train_languages(empty_docs)
    assert {r["lang_pred"] for r in language.identify(odd_docs, none).collect()} == {"und"}
    more = language.identify(clashing_docs, model)
    assert more.columns == [*clashing_docs.columns, "lang_pred__", "score_", "langs_"] and more.count() == 13
    kept = language.keep_known(clashing_docs, model)
    assert kept.columns == clashing_docs.columns and kept.filter("doc_id IN (1, 2, 3, 8, 10)").count() == 0
