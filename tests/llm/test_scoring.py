import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from tickforge.llm import attention, scoring
from tickforge.llm.common import in_fold, out_of_fold, stored
from tickforge.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_words(text):
    return (text or "").encode().lower().split()


def test_base_equals_brute_force(spark, sf_dir, documents):
    rows = QUERIES["op7_attention"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, t in texts.items() if not held[i] for w in plain_words(t))
    ends = sum(not h for h in held.values())
    n, v = sum(c.values()) + ends, len(c) + 1
    for r in rows:
        words = plain_words(texts[r["doc_id"]])
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        assert r["held_out"] == held[r["doc_id"]] and r["n_tokens"] == len(words) + 1 and r["train_tokens"] == n
        assert r["n_known"] == sum(c[w] > 0 for w in words) + 1
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    model = attention.Model({k: w.astype(np.float64) for k, w in attention.Model.start(9, 6).weights.items()})
    model.weights["distance"] += rng.normal(0, 0.3, model.weights["distance"].shape)
    ids, follows = attention.blocks_of([rng.integers(0, 9, n) for n in (40, 5, 17)], 1)
    targets = rng.integers(-1, 6, ids.shape)
    _, n, g = attention.gradients(model, ids, follows, targets)
    for name, w in model.weights.items():
        flat, slope = w.reshape(-1), np.asarray(g[name], float).reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            keep = flat[i]
            flat[i] = keep + 1e-5
            up = attention.gradients(model, ids, follows, targets)[0]
            flat[i] = keep - 1e-5
            down = attention.gradients(model, ids, follows, targets)[0]
            flat[i] = keep
            assert abs((up - down) / 2e-5 / n - slope[i]) < 1e-4, name


def test_no_position_sees_the_future_and_batches_agree():
    rng = np.random.default_rng(3)
    model = attention.Model.start(20, 10)
    seq = rng.integers(0, 20, 70)
    ids, follows = attention.blocks_of([seq], 1)
    targets = rng.integers(0, 10, ids.shape)
    whole = attention.class_log10(model, ids, follows, targets)
    other = seq.copy()
    other[50:] = (other[50:] + 1) % 20
    changed = attention.class_log10(model, attention.blocks_of([other], 1)[0], follows, targets)
    assert np.allclose(whole.ravel()[:50], changed.ravel()[:50]) and not np.allclose(whole.ravel()[50:70], changed.ravel()[50:70])
    assert np.allclose(whole, attention.class_log10(model, ids, follows, targets, at_once=1))
    both, f2 = attention.blocks_of([rng.integers(0, 20, 33), seq], 1)
    t2 = np.concatenate([np.full((len(both) - len(ids), attention.BLOCK), -1), targets])
    assert np.allclose(attention.class_log10(model, both, f2, t2)[-len(ids):], whole)


def test_probabilities_sum_to_one(spark, documents):
    """Over the classes, and within a class over its words and the unknown one."""
    train = documents.select("text")
    counts = scoring.word_counts(train)
    v = scoring.learn_vocabulary(counts, train.count(), PATH, frequent=50)
    coder = scoring.Coder(v)
    sums = np.zeros(scoring.CLASSES)
    for r in counts.collect():
        k = v.coded(coder.lead(bytes(r["word"])))[1]
        sums[k] += (r["c"] + 1) / 10 ** coder.norms[k]
    present = v.class_distinct[:-1] > 0
    assert np.allclose(sums[:-1][present] + 1 / 10 ** coder.norms[:-1][present], 1)


def test_frequent_table_does_not_change_scores(spark, documents):
    def scores(frequent):
        rows = scoring.score_texts(documents, out_of_fold("doc_id", 7, 2), in_fold("doc_id", 7, 2), PATH, frequent=frequent)
        return {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in rows.collect()}

    assert scores(5) == scores(100_000)


def test_odd_rows(odd_docs, empty_docs, clashing_docs):
    def run(docs, trains=F.lit(True)):
        return scoring.score_texts(docs, trains, F.lit(False), PATH).collect()

    rows = run(odd_docs)
    assert len(rows) == 13 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    none = run(odd_docs, F.lit(False))
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in none} == {(0, 0, 0.0)}
    assert run(empty_docs) == [] and len(run(clashing_docs)) == 13


def test_words_are_split_as_bytes_are():
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "　", "\x00", "a", "AB", "É", "İ", "語", "x."]
    texts = [None, "", " ", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(2000))]
    words, lengths = scoring.split_words(pa.array(texts))
    assert lengths.tolist() == [len(plain_words(t)) for t in texts]
    assert words.to_pylist() == [w for t in texts for w in plain_words(t)]


def test_slices_hold_all_rows(monkeypatch):
    monkeypatch.setattr(scoring, "GROUP_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array([None, "abc", "x" * 30, "", "abcdef", "abcdef", None])], ["text"])
    slices = list(scoring.groups_of(batch, 0))
    assert [len(s) for s in slices] == [2, 1, 2, 2] and pa.Table.from_batches(slices).equals(pa.Table.from_batches([batch]))


def test_texts_are_coded_once_and_parts_train_alike(spark, documents):
    """The stored pairs are those of every word, and the model is the same however tasks read the parts."""
    rows = documents.select("doc_id", F.lit(False).alias("held_out"), F.lit(True).alias("trains"), "text").repartition(5)
    v = scoring.learn_vocabulary(scoring.word_counts(rows.select("text")), rows.count(), PATH, frequent=50)
    coded = stored(scoring.code_texts(rows, v), "coded-test")
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    lead = scoring.lead_of(PATH)
    for r in coded.collect():
        want = [scoring.pair(*v.coded(lead(w))) for w in plain_words(texts[r["doc_id"]])]
        assert np.frombuffer(r["pairs"], scoring.PAIR).tolist() == want and r["n_tokens"] == len(want) + 1
    assert coded.select("part").distinct().count() == 5
    one = scoring.train_model(coded.coalesce(1), v).flat()
    assert np.allclose(one, scoring.train_model(coded.repartition(5, "part").sortWithinPartitions("row"), v).flat(), rtol=1e-5, atol=1e-6)


def test_blocks_of_pairs():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, scoring.INPUTS * scoring.CLASSES, n) for n in (0, 1, 15, 16, 17, 40, 0)]
    ids, follows, classes, counts = scoring.coded_blocks(texts)
    want, before = attention.blocks_of([np.r_[scoring.BEGIN, t // scoring.CLASSES] for t in texts], scoring.OTHER)
    ends, _ = attention.blocks_of([np.r_[t % scoring.CLASSES, scoring.END_CLASS] for t in texts], -1)
    assert np.array_equal(ids, want) and np.array_equal(follows, before) and np.array_equal(classes, ends)
    assert counts.tolist() == [1, 1, 1, 2, 2, 3, 1]
