import random
from itertools import combinations

import numpy as np
import xxhash

from tickforge.llm import simhash
from tickforge.llm.components import components
from tickforge.llm.queries import QUERIES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(prints):
    """Smallest id of each component by comparing all pairs."""
    parent = {i: i for i in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {i: top(i) for i in prints}


def test_query_equals_brute_force(spark, sf_dir, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    rows = QUERIES["op6_simhash"](spark, sf_dir).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in rows} == prints
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute(prints)


def test_positions_miss_no_triple():
    assert len(simhash.POSITIONS) == 14
    assert all(any(not set(t) & set(s) for s in simhash.POSITIONS) for t in combinations(range(8), 3))


def test_long_lists_lose_no_link(spark):
    """Chains of near fingerprints, with every list split as if it were hot."""
    rng = random.Random(4)
    prints = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(12):
            prints.add(x)
            for b in rng.sample(range(64), rng.choice((1, 2, 3, 3, 4))):
                x ^= 1 << b
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = brute(dict(enumerate(prints)))
    ids = {s: i for i, s in enumerate(signed)}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for hot in (0, 3, 4096):
        got = {}
        for r in simhash.classes(df, hot).collect():
            got.setdefault(r["class"], set()).add(want[ids[r["fp"]]])
        assert len(got) == len(set(want.values())) and all(len(v) == 1 for v in got.values())


def test_spanning_links_are_few():
    base = np.uint64(0xABCDEF0123456789)
    prints = np.array([base ^ np.uint64(i) for i in range(8)], np.uint64)
    assert len(simhash.spanning_links(prints)) == 7


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 102), (100, 102)]
    df = spark.createDataFrame([(-a, -b) for a, b in links], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {-i: -50 for i in range(51)} | {-100: -102, -101: -102, -102: -102}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chunks_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(f"w{i * i % 91}" for i in range(500))
    whole = simhash.fingerprint(text)
    assert whole == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole


def test_odd_rows(odd_docs, empty_docs, clashing_docs):
    rows = simhash.near_copies(odd_docs).collect()
    assert len(rows) == 13
    wordless = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert {(r["fingerprint"], r["component_id"]) for r in wordless} == {("0" * 16, 1)}
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}
    assert simhash.near_copies(empty_docs).count() == 0 and simhash.keep_one(empty_docs).count() == 0
    kept = simhash.keep_one(clashing_docs)
    assert kept.columns == clashing_docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 5, 7, 8, 9, 10]
