import random

import numpy as np
import pytest

from tickforge.llm import toxicity as tox
from tickforge.llm.common import out_of_fold, table
from tickforge.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lexicon():
    terms = ["idiot", "scum", "clown", "clowns", "bad*", "disgusting"]
    return tox.Lexicon(terms, frozenset(["idiot", "clown", "clowns", "disgusting"]))


def test_automaton_equals_edit_distance():
    """Every word's output against distances to all terms, on words near the lexicon."""
    lex = lexicon()
    rng = random.Random(2)
    words = []
    for _ in range(4000):
        w = list(rng.choice(["idiot", "scum", "clown", "clowns", "badly", "bad", "disgusting", "other"]))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w) + 1)
            kind = rng.random()
            if kind < 0.4 and i < len(w):
                del w[i]
            elif kind < 0.7:
                w.insert(i, rng.choice("abidtx0é"))
            elif i < len(w):
                w[i] = rng.choice("abidtx0é")
        if w:
            words.append("".join(w))
    codes = np.concatenate([np.minimum(np.frombuffer(w.encode("utf-32-le"), np.uint32), tox.CODES) for w in words]).astype(np.int64)
    lengths = np.array([len(w) for w in words])
    got = lex.run(lex.classes[codes], np.cumsum(lengths) - lengths, lengths)
    for w, out in zip(words, got.tolist()):
        best = []
        for i, t in enumerate(lex.terms):
            if t.endswith("*"):
                e = 0 if w.startswith(t[:-1]) else 9
            else:
                e = distance(w, t)
            if e == 0 or (e == 1 and t in lex.clear):
                best.append((e, -len(t), i))
        assert out == (-1 if not best else 2 * min(best)[2] + (tox.FUZZY if min(best)[0] else tox.EXACT)), w


def test_context_separates_quotation():
    lex = lexicon()
    open_, quote = tox.features(lex, "you idiot go"), tox.features(lex, 'he wrote "you idiot" there')
    assert open_[0] > 0 and open_[2] == 0 and quote[0] == 0 and quote[2] > 0
    far = tox.features(lex, '"a" b c d e f g h i j k idiot l m n o p q r s t "u"')
    assert far[0] > 0 and far[2] == 0
    assert tox.features(lex, "idiot clown")[3] > tox.features(lex, "idiot " + "x " * 20 + "clown")[3]


def test_misspelled_terms_count():
    lex = lexicon()
    model = tox.ToxicityModel(lex, tox.PRIOR)
    assert model.score("such an idi0t and a cl*own") > 0.5 > model.score("a crown for the king")
    assert model.score(None) == model.score("") < 0.5


def test_words_end_at_marks_but_hold_some():
    lex = lexicon()
    for text in ("clown/clown", "clown,you", "(clown)", "a|clown|b", "clown.clown"):
        assert tox.features(lex, text)[0] > 0, text
    assert tox.features(lex, "cl*wn cl-own")[1] == 2 * tox.MISSPELLED
    wide = tox.Lexicon(["\u611a\u304b\u3082\u306e"])
    assert tox.features(wide, "a \u611a\u304b\u3082\u306e b")[0] > 0


def one_edit(rng, word):
    i, letter = rng.randrange(1, len(word)), rng.choice("bcdfghjkmpqvwxz")
    return rng.choice([word[:i] + word[i + 1:], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1:]])


def test_misspelled_terms_of_the_trained_model(spark):
    """One misspelled term turns a clean text; ordinary words and unrelated ones do not."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = tox.train_toxicity(docs, labels.filter(out_of_fold("doc_id", 5, 0)))
    rng = random.Random(5)
    clean = [r["text"] for r in docs.join(labels.filter("toxic = 0"), "doc_id").filter("length(text) BETWEEN 300 AND 2000")
             .orderBy("doc_id").limit(60).collect()]
    clean = [t for t in clean if model.score(t) < 0.5]

    def with_word(word):
        text = rng.choice(clean)
        cut = text.index(" ", rng.randrange(len(text) // 2))
        return model.score(text[:cut] + " " + word + text[cut:]) >= 0.5

    terms = sorted(model.lexicon.clear)
    assert len(terms) >= 8 and all(len(t) >= 5 for t in terms)
    tries = [with_word(one_edit(rng, t)) for t in terms for _ in range(10)]
    assert sum(tries) >= 0.9 * len(tries)
    assert all(with_word(t + mark) for t in terms for mark in ("/" + t, ",you", ""))
    assert not any(with_word(w) for w in sorted(model.lexicon.ordinary)) and not any(with_word(w) for w in ("ordinary", "weather"))
    quoted = [with_word(f'"{t}"') for t in terms]
    assert not any(quoted)


def test_rare_words_near_a_term_lower_its_misspellings(spark):
    """Clean documents with ever new words near one term, none near the other."""
    letters = "bcdfghjkmpqvwxz"
    rows = [(i, "such a zarkel here", 1) for i in range(40)] + [(40 + i, "such a plimond here", 1) for i in range(40)] \
        + [(100 + i, f"kind words zark{letters[i]}el and more {i}", 0) for i in range(15)] + [(200 + i, f"kind words {i}", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    docs = docs.withColumn("text", tox.F.concat("text", tox.F.lit(" "), tox.F.col("doc_id").cast("string")))
    model = tox.train_toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    weights = dict(zip(model.lexicon.terms, model.lexicon.weights.tolist()))
    assert weights["plimond"][1] == weights["plimond"][0] > 3 and weights["zarkel"][1] < 0.5 < weights["zarkel"][0]


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op4_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.9
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    pairs = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert pairs / (len(toxic) * len(clean)) > 0.85


@pytest.fixture(scope="module")
def small_labels(spark):
    return spark.createDataFrame(
        [(5, 1, 0), (6, 1, 0), (7, 1, 1), (None, 1, 1), (4, None, None), (6, 0, 1)], "doc_id long, quality int, toxic int")


def test_odd_rows(spark, odd_docs, empty_docs, clashing_docs, small_labels):
    model = tox.train_toxicity(odd_docs, small_labels.filter(out_of_fold("doc_id", 5, 0)))
    rows = tox.score_toxicity(odd_docs, model).collect()
    assert len(rows) == 13 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert tox.score_toxicity(empty_docs, model).count() == 0
    for labels in (small_labels.filter("false"), small_labels.filter("toxic = 0")):
        assert not tox.train_toxicity(odd_docs, labels).lexicon.terms
    assert not tox.train_toxicity(empty_docs, small_labels).lexicon.terms
    more = tox.score_toxicity(clashing_docs, model)
    assert more.columns == [*clashing_docs.columns, "score_", "predicted_"] and more.count() == 13
