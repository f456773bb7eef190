import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickforge.llm import runs
from tickforge.llm.queries import QUERIES


def plain_runs(words, shortest=24, times=3):
    """All runs by trying every period, smallest first."""
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(shortest, times * q) and not any(
                s <= i and i + length <= s + m and p < q for s, m, p in found
            ):
                found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    best = None
    for s, m, q in found:
        if best is None or m * best[2] > best[1] * q:
            best = (s, m, q)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha256(listed.encode()).hexdigest(), sha256(collapsed(words, found).encode()).hexdigest())


def test_query_equals_brute_force(spark, sf_dir, documents):
    want = sorted(plain_row(r["doc_id"], r["text"]) for r in documents.collect())
    df = QUERIES["op13_runs"](spark, sf_dir)
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == want and sum(r[1] > 0 for r in got) > 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 14)), max_size=8),
       st.sampled_from([(24, 3), (6, 3), (1, 3), (10, 4)]))
def test_words_of_repeated_parts(parts, limits):
    words = [w for block, n in parts for w in block * n]
    text = " ".join(words)
    (found, n, rest), = runs.texts_runs([text], *limits)
    assert found == plain_runs(words, *limits) and n == len(words)
    assert rest == collapsed(words, found)


def test_many_texts_share_a_group():
    rng = random.Random(7)
    texts = []
    for _ in range(60):
        block = [rng.choice("abcd") for _ in range(rng.randint(1, 40))]
        body = [str(rng.randint(0, 5)) for _ in range(rng.randint(0, 30))]
        texts.append(" ".join(body + block * rng.randint(1, 6) + block[: rng.randint(0, 9)] + body[::-1]))
    assert [r[0] for r in runs.texts_runs(texts, 24, 3)] == [plain_runs(t.split()) for t in texts]
    assert [r for g in runs.groups(texts) for r in g] == texts


def test_runs_need_no_boundary_between_texts():
    assert [r[0] for r in runs.texts_runs(["a " * 20, "a " * 20], 24, 3)] == [[], []]


def test_long_texts_stay_fast():
    """One word, a long period, and a block with repeats of its own, 300,000 words each."""
    block = " ".join("abc"[i * i % 3] for i in range(20)) + " x "
    for text, period in (("a " * 300_000, 1), (" ".join(f"w{i % 90_000}" for i in range(300_000)), 90_000),
                         (block * 14_286, 21)):
        (found, n, _), = runs.texts_runs([text], 24, 3)
        assert (0, n, period) in found


def test_factor_lengths():
    assert runs.lowest_length(24, 3) == 16 and runs.lowest_length(1, 3) == 1
    for shortest in range(1, 40):
        for times in (3, 4, 5):
            low = runs.lowest_length(shortest, times)
            assert all(low + q <= max(shortest, times * q) or low == 1 for q in range(1, 50))
    with pytest.raises(ValueError):
        runs.mark_runs(None, times=2)


def test_odd_rows(spark, odd_docs, empty_docs, clashing_docs):
    rows = runs.mark_runs(odd_docs).collect()
    assert len(rows) == 13
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert all(by_id[i]["runs"] == [] and by_id[i]["collapsed"] == "" for i in (1, 2, 3))
    assert [tuple(r) for r in by_id[5]["runs"]] == [(0, 60, 20)]
    assert by_id[5]["collapsed"].split() == odd_docs.filter("doc_id = 5").first()["text"].split()[:20]
    assert [tuple(r) for r in by_id[4]["runs"]] == [tuple(r) for r in plain_runs_long()]
    assert runs.mark_runs(empty_docs).count() == 0
    marked = runs.mark_runs(clashing_docs.withColumn("runs", clashing_docs.doc_id))
    assert marked.columns[-3:] == ["n_words_", "runs_", "collapsed"] and marked.count() == 13


def plain_runs_long():
    words = np.array([f"word{i % 977} and{i % 13}" for i in range(60_000)])
    assert (words[12701:] == words[:-12701]).all()
    return [(0, 120_000, 2 * 977 * 13)]
