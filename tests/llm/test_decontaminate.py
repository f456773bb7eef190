import random

import pytest

from tickforge.llm import decontaminate as dec
from tickforge.llm.queries import QUERIES


def slow_edits(pattern, text):
    """Edits between the pattern and any stretch of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


def test_edit_verification():
    rng = random.Random(1)
    for _ in range(200):
        p = bytes(rng.choice(b"abc ") for _ in range(rng.randint(1, 90)))
        t = bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, 120)))
        assert dec.least_edits(p, t) == slow_edits(p, t)


def test_query_finds_what_brute_force_finds(spark, sf_dir, documents, benchmark):
    items = {r["item_id"]: dec.plain(r["text"]) for r in benchmark.collect()}
    want = set()
    for r in documents.collect():
        data = dec.plain(r["text"])
        want |= {(r["doc_id"], k, 0) for k, item in items.items() if item in data}
    rows = {tuple(r) for r in QUERIES["op9_decontamination"](spark, sf_dir).collect()}
    assert want and want <= rows
    for doc, item, edits in rows - want:
        text = next(r["text"] for r in documents.filter(f"doc_id = {doc}").collect())
        assert 0 < edits <= dec.MOST_EDITS * len(items[item]) and slow_edits(items[item], dec.plain(text)) <= edits


def random_edits(rng, text, rate):
    p = list(text)
    for _ in range(int(rate * len(p))):
        i, kind = rng.randrange(len(p)), rng.random()
        if kind < 0.34:
            p[i] = rng.choice("abcdefgh ")
        elif kind < 0.67:
            del p[i]
        else:
            p.insert(i, rng.choice("abcdefgh "))
    return "".join(p)


def every_third_word(rng, text, rate):
    words = text.split(" ")
    for n in range(0, len(words), 3):
        if words[n]:
            i = rng.randrange(len(words[n]))
            words[n] = words[n][:i] + "q" + words[n][i + 1:]
    return " ".join(words)


@pytest.mark.parametrize("edit, rate, least", [
    (random_edits, 0.0, 1.0), (random_edits, 0.02, 0.99), (random_edits, 0.05, 0.99), (random_edits, 0.1, 0.97),
    (random_edits, 0.15, 0.95), (random_edits, 0.2, 0.95), (every_third_word, None, 0.95)])
def test_recall_on_edited_passages(documents, benchmark, edit, rate, least):
    rng = random.Random(6)
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    search = dec.Items(items)
    hosts = [r["text"] for r in documents.collect() if r["text"] and len(r["text"]) > 300]
    clean = [t for t, m in zip(hosts, search.matches(hosts)) if not m]
    tried = found = 0
    for n in range(150):
        key, text = items[n % len(items)]
        host = clean[n % len(clean)]
        cut = rng.randrange(len(host))
        passage = edit(rng, text, rate)
        if slow_edits(dec.plain(text), dec.plain(passage)) > dec.MOST_EDITS * len(dec.plain(text)):
            continue
        tried += 1
        found += key in [k for k, _ in search.matches([host[:cut] + " " + passage + " " + host[cut:]])[0]]
    assert tried > 100 and found / tried >= least


def test_short_items_stand_unchanged():
    search = dec.Items([(1, "two words"), (2, "Mississippi"), (3, ""), (4, "a"), (5, "two  WORDS")])
    found = search.matches(["these Two\nwords", "mississippian", "the MISSISSIPPI a", None, "", "two words more"])
    assert found == [[(1, 0), (5, 0)], [], [(4, 0), (2, 0)], [], [], [(1, 0), (5, 0)]]


def test_tables_reach_the_target():
    n = dec.tables_needed(0.95, 0.4, 4)
    assert 1 - (1 - 0.6 ** 4) ** n >= 0.95 > 1 - (1 - 0.6 ** 4) ** (n - 1)


def test_pieces_and_blocks_change_nothing(spark, documents, benchmark, monkeypatch):
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    texts = [r["text"] for r in documents.collect()]
    whole = dec.Items(items).matches(texts)
    monkeypatch.setattr(dec, "PIECE_BYTES", 700)
    assert dec.Items(items).matches(texts) == whole
    monkeypatch.undo()
    key = lambda r: (r["doc_id"], r["item_id"])
    one = sorted(dec.find_passages(documents, benchmark).collect(), key=key)
    assert sorted(dec.find_passages(documents, benchmark, block_items=7).collect(), key=key) == one


def test_odd_rows(spark, odd_docs, empty_docs, clashing_docs, benchmark):
    from llm.conftest import WORDY

    items = spark.createDataFrame([(1, WORDY), (2, None), (3, ""), (4, "two words"), (None, WORDY.upper())], "item_id long, text string")
    rows = dec.find_passages(odd_docs, items).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in rows} == {(d, i, 0) for d in (5, 6, None) for i in (1, None)}
    assert len(rows) == 8  # the repeated row gives its rows again
    kept = dec.keep_clean(clashing_docs, items)
    assert kept.columns == clashing_docs.columns and kept.count() == 9
    assert dec.find_passages(empty_docs, items).count() == 0 and dec.keep_clean(empty_docs, items).count() == 0
    none = items.filter("false")
    assert dec.find_passages(odd_docs, none).count() == 0 and dec.keep_clean(odd_docs, none).count() == 13
