import random
import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickforge.llm import personal
from tickforge.llm.queries import QUERIES

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_base(text):
    return [(k, m.start(), m.end()) for k, (kind, form) in enumerate(FORMS.items())
            for m in re.finditer(form, text or "") if passes(kind, m[0])]


def as_text(spans):
    return ",".join(f"{list(FORMS)[k]}:{a}:{b}" for k, a, b in spans)


def test_query_equals_plain_base(spark, sf_dir, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    df = QUERIES["op11_personal"](spark, sf_dir)
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in FORMS] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r["base_sha256"] == sha256(as_text(base).encode()).hexdigest()
        assert set(filter(None, as_text(base).split(","))) <= set(r["spans"].split(","))
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows) > 10


@settings(max_examples=400, deadline=None)
@given(st.text("aZ0195.@-+%_ ()\n9é", max_size=60))
def test_exact_forms(text):
    assert personal.base_spans(text) == plain_base(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111111111111112", "+1 (212) 555-0100", "10.2.3.4", "1.2.3.400", "a.b@c.de",
                                 "x@y", " ", ".", "\n", "1", "-", "007.1.1.1.1.1.1.1", "@", "+", "49927398716", "é"]), max_size=12))
def test_exact_forms_side_by_side(parts):
    text = "".join(parts)
    assert personal.base_spans(text) == plain_base(text)
    spans = personal.base_spans(text)
    found = personal.slots(text, spans)
    for _, a, b, known, _ in found:
        assert known or not any(a < y and x < b for _, x, y in spans)


def test_long_runs_of_one_class_are_linear():
    for c in ("1", "a", "1.", "1 ", "+1", "a@", "-", "(", "1:", "@"):
        text = c * 200_000
        personal.slots(text, personal.base_spans(text))


def test_keys_of_patterns_meet_those_of_texts(spark):
    docs = spark.createDataFrame([("My phone, number is: Blue now. my phone number is 7",), ("phone number is green now",), (None,)], "text string")
    patterns = ["number is _", "phone number is _", "number is _ now", "is _ now", "is _ x", "phone number _"]
    keys = personal.pattern_keys(patterns)
    got = {r["key"]: r["c"] for r in personal.ordinary_fills(docs, keys, "text").collect()}
    assert [got.get(int(k), 0) for k in keys.view(np.int64)] == [2, 2, 2, 2, 0, 3]


def corpus(spark, rng, prefix="my phone number is", noise=0):
    words = [f"{a}{b}" for a in "bcdfghklm" for b in ("al", "en", "ir", "os", "um", "ast", "eld")]

    def say(*middle):
        return " ".join([*rng.choices(words, k=rng.randint(5, 30)), *middle, *rng.choices(words, k=rng.randint(5, 30))])

    rows = [(i, say(prefix, f"+1 ({rng.randint(200, 999)}) 555-{i:04d}")) for i in range(30)]
    rows += [(100 + i, say(prefix, f"0{rng.randint(20, 99)} 555 {i:04d}")) for i in range(10)]
    rows += [(200 + i, say("order", f"{rng.randint(10**8, 10**9)}")) for i in range(20)]
    rows += [(300 + i, say(prefix, rng.choice(words))) for i in range(noise)]
    rows += [(1000 + i, say()) for i in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_patterns_reveal_unseen_identifiers(spark):
    found = {r["doc_id"]: r for r in personal.find_personal(corpus(spark, random.Random(3)), ("doc_id", "text")).collect()}
    for i, r in found.items():
        marked = [r["text"][s["start"]:s["stop"]] for s in r["spans"]]
        if i < 30:
            assert len(marked) == 1 and marked[0].startswith("+1") and r["n_phone"] == 1
        elif 100 <= i < 200:
            assert len(marked) == 1 and re.fullmatch(r"0\d\d 555 \d{4}", marked[0]) and r["n_phone"] == 0 and r["base"] == []
        else:
            assert marked == []


def test_patterns_that_ordinary_words_fill_reveal_nothing(spark):
    rows = personal.find_personal(corpus(spark, random.Random(5), "it is", noise=200)).collect()
    assert all(r["spans"] == r["base"] for r in rows)


def test_a_found_value_is_marked_wherever_it_stands(spark):
    docs = corpus(spark, random.Random(3))
    value = re.search(r"0\d\d 555 \d{4}", docs.filter("doc_id = 104").first()["text"])[0]
    docs = docs.union(spark.createDataFrame([(9999, f"quite another place for {value} here")], docs.schema))
    r = personal.find_personal(docs, ("doc_id", "text")).filter("doc_id = 9999").first()
    assert [r["text"][s["start"]:s["stop"]] for s in r["spans"]] == [value]


@pytest.mark.parametrize("block", [1, 2])
def test_patterns_in_blocks_give_the_same(spark, monkeypatch, block):
    docs = corpus(spark, random.Random(3))
    want = sorted((r["doc_id"], r["spans"]) for r in personal.find_personal(docs).collect())
    monkeypatch.setattr(personal, "BLOCK", block)
    assert sorted((r["doc_id"], r["spans"]) for r in personal.find_personal(docs).collect()) == want


def test_odd_rows(odd_docs, empty_docs, clashing_docs):
    rows = personal.find_personal(odd_docs).collect()
    assert len(rows) == 13 and all(r["spans"] == r["base"] for r in rows)
    assert all(r["base"] == [] for r in rows if r["doc_id"] in (1, 2, 3))
    assert personal.find_personal(empty_docs).count() == 0
    clash = clashing_docs.withColumns({"spans": F.lit(1), "base": F.lit(2), "slots": F.lit(3), "N_email": F.lit(4)})
    kept = personal.find_personal(clash, tuple(clash.columns))
    assert kept.columns == [*clash.columns, "n_email_", "n_ip", "n_card", "n_phone", "base_", "spans_"] and kept.count() == 13
