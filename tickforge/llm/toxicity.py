"""Toxic language: Levenshtein automata intersected with a lexicon trie, judged in context."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import fresh, stored

# Learning.
SAMPLE = 10_000
HASHES = 1 << 24
LEXICON = 200
STEM = (4, 8)
LONGEST_TERM = 24
LEAST_SUPPORT = 3
LEAST_RATIO = 20.0
# Matching.
FUZZY_FROM = 5
#: Share of toxic documents from which a term is matched with an edit.
CLEAR_SHARE = 0.03
#: Share of a term's toxic documents taken to hold it misspelled, until misspellings were seen.
MISSPELLED_SHARE = 0.05
#: Weight of a misspelled term in a lexicon given without weights: one alone does not make a text toxic.
MISSPELLED = 2.5
#: Largest weight of a term; a term in a tenth of the toxic and in no clean document of a full sample reaches 7.6.
HEAVIEST = 8.0
WINDOW = 6
LETTERS = re.compile(r"[^\W\d_]+")
CODES = 0x110000
QUOTES = "\"“”„«»‹›"
# These end a word like white space; other marks inside a word belong to its spelling.
BREAKS = " \t\n\x0b\x0c\r/|,;:.!?()[]{}<>" + QUOTES
PIECE_CHARS = 1 << 20

EXACT, FUZZY = 0, 1


@dataclass
class Lexicon:
    """Terms with weights; a term ending in ``*`` is a stem that matches any word it begins."""

    terms: list[str]
    clear: frozenset = frozenset()  # terms that are matched with an edit, too
    weights: np.ndarray = field(default=None)  # terms x (EXACT, FUZZY)
    ordinary: frozenset = frozenset()

    def __post_init__(self):
        if self.weights is None:
            self.weights = np.tile([6.0, MISSPELLED], (len(self.terms), 1))
        self.build()

    def build(self) -> None:
        """Determinises the product of the lexicon trie and an automaton of at most one edit.

        A state is the set of (trie node, edits) a read prefix can stand for; the same prefix
        reaches a node with fewest edits only.  Reading a word costs one table step per letter,
        whatever the lexicon's size.
        """
        children: list[dict[str, int]] = [{}]
        ends: list[list[int]] = [[]]
        loose: list[bool] = [False]
        for i, term in enumerate(self.terms):
            node = 0
            stem = term.removesuffix("*")
            for letter in stem:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    ends.append([])
                    loose.append(False)
                node = children[node][letter]
                loose[node] |= term in self.clear
            ends[node].append(i)
        letters = sorted({c for k in children for c in k})
        self.letters = {c: i + 1 for i, c in enumerate(letters)}
        self.classes = np.zeros(CODES + 1, np.int32)
        for c, i in self.letters.items():
            if ord(c) < CODES:
                self.classes[ord(c)] = i

        def closed(found: dict[int, int]) -> frozenset:
            """Adds nodes reached by leaving out letters of the term."""
            todo = list(found.items())
            while todo:
                node, e = todo.pop()
                if e < 1:
                    for child in children[node].values():
                        if loose[child] and found.get(child, 9) > e + 1:
                            found[child] = e + 1
                            todo.append((child, e + 1))
            return frozenset(found.items())

        def step(state: frozenset, letter: str | None) -> frozenset:
            out: dict[int, int] = {}
            for node, e in state:
                exact = children[node].get(letter)
                if exact is not None:
                    out[exact] = min(e, out.get(exact, 9))
                if e < 1:
                    if node == 0 or loose[node]:
                        out[node] = min(e + 1, out.get(node, 9))
                    for child in children[node].values():
                        if loose[child]:
                            out[child] = min(e + 1, out.get(child, 9))
            return closed(out)

        def stem_of(state: frozenset):
            """The stem a prefix holds, best first: exact, then longest."""
            held = [(e, -len(self.terms[i]), i) for node, e in state for i in ends[node]
                    if self.terms[i].endswith("*") and not e]
            return min(held, default=None)

        def word_of(state: frozenset):
            held = [(e, -len(self.terms[i]), i) for node, e in state for i in ends[node]
                    if not self.terms[i].endswith("*") and (not e or self.terms[i] in self.clear)]
            return min(held, default=None)

        # A state is an automaton set with the best stem seen on the way.
        begin = (closed({0: 0}), None)
        number = {(frozenset(), None): 0, begin: 1}
        table, output, todo = {}, {}, [(frozenset(), None), begin]
        while todo:
            state = todo.pop()
            inner, stem = state
            word = word_of(inner)
            best = min([x for x in (stem, word) if x is not None], default=None)
            output[number[state]] = -1 if best is None else 2 * best[2] + (FUZZY if best[0] else EXACT)
            row = []
            for letter in [None, *letters]:
                after = step(inner, letter) if inner else inner
                found = min([x for x in (stem, stem_of(after)) if x is not None], default=None)
                nxt = (after, found)
                if nxt not in number:
                    number[nxt] = len(number)
                    todo.append(nxt)
                row.append(number[nxt])
            table[number[state]] = row
        self.table = np.array([table[i] for i in range(len(number))], np.int32)
        self.output = np.array([output[i] for i in range(len(number))], np.int32)
        # States in which nothing further can change.
        self.final = (self.table == np.arange(len(number))[:, None]).all(1)

    def run(self, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Output per word: -1 or 2 * term + kind."""
        state = np.ones(len(starts), np.int32)
        active = np.arange(len(starts))
        for i in range(int(lengths.max(initial=0))):
            active = active[lengths[active] > i]
            if not len(active):
                break
            after = self.table[state[active], classes[starts[active] + i]]
            state[active] = after
            active = active[~self.final[after]]
        return self.output[state]


_alnum = None


def alnum_table() -> np.ndarray:
    global _alnum
    if _alnum is None:
        _alnum = np.array([chr(c).isalnum() for c in range(CODES)] + [True])
    return _alnum


_breaks = None


def break_table() -> np.ndarray:
    global _breaks
    if _breaks is None:
        _breaks = np.zeros(CODES + 1, bool)
        _breaks[[ord(c) for c in BREAKS]] = True
    return _breaks


def find_terms(lexicon: Lexicon, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, list[str]]:
    """Word numbers, outputs and quotation flags of matches, the number of words, and fuzzy surfaces.

    A word is what stands between ``BREAKS`` without other punctuation at its ends, so ``a/b`` and
    ``a,b`` are two words and ``a*b`` is one.
    """
    none = np.zeros(0, np.int64)
    low = text.lower()
    raw = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.minimum(raw, CODES).astype(np.int64)
    solid = np.flatnonzero(alnum_table()[codes])
    if not len(solid):
        return none, none, none.astype(bool), 0, []
    space = np.cumsum(break_table()[codes])
    piece = space[solid]
    edge = np.flatnonzero(piece[1:] != piece[:-1])
    starts = solid[np.r_[0, edge + 1]]
    ends = solid[np.r_[edge, len(solid) - 1]] + 1
    out = lexicon.run(lexicon.classes[codes], starts, ends - starts)
    hit = np.flatnonzero(out >= 0)
    surfaces = [low[starts[w]:ends[w]] if out[w] % 2 == FUZZY else "" for w in hit.tolist()]
    keep = np.array([s not in lexicon.ordinary for s in surfaces], bool) if len(hit) else np.zeros(0, bool)
    hit = hit[keep]
    surfaces = [s for s, k in zip(surfaces, keep) if k]
    return hit, out[hit], quoted(raw, starts, ends, hit), len(starts), surfaces


def quoted(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """True where quotation marks stand on both sides within the window and open before the word."""
    marks = np.flatnonzero(np.isin(raw, [ord(c) for c in QUOTES]))
    if not len(marks) or not len(hit):
        return np.zeros(len(hit), bool)
    before = np.searchsorted(marks, starts[hit], "right")
    left = starts[np.maximum(hit - WINDOW, 0)]
    right = ends[np.minimum(hit + WINDOW, len(ends) - 1)]
    opened = (before % 2 == 1) & (marks[np.maximum(before - 1, 0)] >= left - 1)
    closed = (before < len(marks)) & (marks[np.minimum(before, len(marks) - 1)] <= right)
    return opened & closed


FEATURES = ["exact", "fuzzy", "quoted", "dense"]
#: What the fit starts from and is drawn to: intercept, then one weight per feature.
PRIOR = np.array([-4.0, 1.0, 1.0, 0.2, 0.5])
PULL = 5.0
MOST = 12.0


def features(lexicon: Lexicon, text: str | None) -> np.ndarray:
    """Context-window scores of one whole text.

    Each match has its term's weight.  A match inside quotation marks counts as quoted; the others
    as abuse, exact or misspelled.  ``dense`` is the largest summed weight of unquoted matches
    in a window beyond its strongest one: abuse comes in clusters.
    """
    sums = np.zeros(3)
    dense = 0.0
    for i in range(0, len(text or ""), PIECE_CHARS):
        word, out, quote, _, _ = find_terms(lexicon, text[i: i + PIECE_CHARS])
        if not len(word):
            continue
        weight = lexicon.weights[out // 2, out % 2]
        fuzzy = out % 2 == FUZZY
        sums += [weight[~fuzzy & ~quote].sum(), weight[fuzzy & ~quote].sum(), weight[quote].sum()]
        open_word, open_weight = word[~quote], weight[~quote]
        if len(open_word):
            total = np.r_[0, np.cumsum(open_weight)]
            last = np.searchsorted(open_word, open_word + WINDOW, "right")
            dense = max(dense, float((total[last] - total[:-1] - open_weight).max()))
    return np.minimum(np.r_[sums, dense], MOST)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    theta: np.ndarray

    def score(self, text: str | None) -> float:
        x = self.theta[0] + self.theta[1:] @ features(self.lexicon, text)
        return float(1 / (1 + np.exp(-x)))


def sample_labels(labels: DataFrame, key: str, toxic: str, most: int) -> DataFrame:
    """About nine tenths of ``most`` labelled keys of either class, or all if there are no more, by a hash of the key.

    A key with several labels is toxic if one of them says so; null keys and labels are left out.
    """
    one = labels.filter(F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(F.col(key).alias("key")) \
        .agg(F.max(F.col(toxic).cast("int")).alias("y"))
    one = stored(one, "labels")
    sizes = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("key"), F.lit(HASHES))
    kept = F.lit(False)
    for y, n in sizes.items():
        # The tenth left free is many times the spread of a hash sample, so the bound holds.
        share = HASHES if n <= most else int(0.9 * most / n * HASHES)
        kept = kept | ((F.col("y") == y) & (place < share))
    return stored(one.filter(kept), "label-sample")


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, n1, n0): documents of either class that hold a word or a word's stem."""
    def count(batches):
        n = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                terms = set()
                for w in set(LETTERS.findall((text.as_py() or "").lower())):
                    if len(w) <= LONGEST_TERM:
                        terms.add(w)
                    for k in range(STEM[0], min(STEM[1], len(w)) + 1):
                        terms.add(w[:k] + "*")
                n[y].update(terms)
                if len(n[0]) + len(n[1]) > 300_000:
                    yield _counts(n)
                    n = (Counter(), Counter())
        yield _counts(n)

    return rows.mapInArrow(count, "term string, n1 long, n0 long").groupBy("term").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _counts(n: tuple[Counter, Counter]) -> pa.RecordBatch:
    terms = list(n[0].keys() | n[1].keys())
    return pa.RecordBatch.from_arrays([
        pa.array(terms, pa.string()), pa.array([n[1][t] for t in terms], pa.int64()),
        pa.array([n[0][t] for t in terms], pa.int64())], ["term", "n1", "n0"])


def choose_terms(counts: list[tuple[str, int, int, float]], most: int = LEXICON) -> list[str]:
    """Terms by evidence; of a word and its stems that occur in the same documents the longest.

    ``counts`` holds (term, n1, n0, evidence).
    """
    n1 = {t: n for t, n, _, _ in counts}
    below: dict[str, list[str]] = {}
    for t in n1:
        stem = t.removesuffix("*")
        for k in range(1, len(stem) + (not t.endswith("*"))):
            below.setdefault(stem[:k] + "*", []).append(t)
    chosen: list[str] = []
    for term, n, _, _ in sorted(counts, key=lambda c: (-c[3], c[0])):
        if len(chosen) == most:
            break
        stem = term.removesuffix("*")
        if any(stem.startswith(c.removesuffix("*")) if c.endswith("*") else stem == c for c in chosen):
            continue
        if any(c.startswith(stem) for c in chosen) and term.endswith("*"):
            continue
        same = [t for t in below.get(term, ()) if n1[t] >= 0.95 * n]
        best = max([term, *same], key=lambda t: (len(t.removesuffix("*")), not t.endswith("*"), t))
        if best not in chosen:
            chosen.append(best)
    return chosen


def train_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_key: str = "doc_id",
    toxic: str = "toxic", sample: int = SAMPLE,
) -> ToxicityModel:
    """Lexicon and weights from at most ``sample`` labelled documents of either class.

    The sample is the one bounded part; its keys are broadcast, so texts are not shuffled.
    Without a label of both classes the model has an empty lexicon and scores all alike.
    """
    chosen = sample_labels(labels, label_key, toxic, sample)
    sizes = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count("*").alias("n")).collect()}
    t1, t0 = sizes.get(1, 0), sizes.get(0, 0)
    all_sizes = {r["y"]: r["n"] for r in labels.filter(F.col(toxic).isNotNull()).groupBy(F.col(toxic).cast("int").alias("y"))
                 .agg(F.count("*").alias("n")).collect()}
    if not t1 or not t0:
        return ToxicityModel(Lexicon([]), PRIOR.copy())
    # At most 2 * sample keys: a proven bound for the broadcast.
    rows = docs.join(F.broadcast(chosen), docs[key] == chosen["key"]).select(F.col(text).cast("string").alias("text"), "y")
    # Copies of a text say the same once; otherwise chance words of a large group would look like terms.
    rows = stored(rows.dropDuplicates(["text", "y"]), "labelled")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    t1, t0 = sizes.get(1, 0), sizes.get(0, 0)
    if not t1 or not t0:
        return ToxicityModel(Lexicon([]), PRIOR.copy())
    a, b = F.col("n1"), F.col("n0")
    share = (a + b) / (t1 + t0)
    g2 = 2 * (a * F.log(a / (share * t1)) + F.when(b > 0, b * F.log(b / (share * t0))).otherwise(0))
    candidates = stored(term_counts(rows).filter(a >= LEAST_SUPPORT), "terms")
    # With so many terms tried, this much evidence is rarely reached by chance.
    least = 2 * math.log(max(2, candidates.count()))
    counts = candidates.withColumn("g2", g2).filter((F.col("g2") >= least) & (a / t1 >= LEAST_RATIO * (b + 0.5) / t0)) \
        .orderBy(F.desc("g2"), "term").limit(100 * LEXICON)
    evidence = [tuple(r) for r in counts.select("term", "n1", "n0", "g2").collect()]
    terms = choose_terms(evidence)
    clear = {t for t, n1, _, _ in evidence if n1 >= CLEAR_SHARE * t1 and len(t) >= FUZZY_FROM and not t.endswith("*")}
    lexicon = Lexicon(terms, frozenset(clear & set(terms)))
    lexicon = calibrate(rows, lexicon, t1, t0)
    found = _featured(rows, lexicon).collect()
    x = np.array([r[1:] for r in found], float).reshape(-1, len(FEATURES))
    y = np.array([r[0] for r in found], float)
    # Each class counts as often as it is labelled, not as often as it was sampled.
    weight = np.where(y > 0, all_sizes[1] / t1, all_sizes[0] / t0)
    return ToxicityModel(lexicon, fit(x, y, weight / weight.mean()))


def calibrate(rows: DataFrame, lexicon: Lexicon, t1: int, t0: int) -> Lexicon:
    """Weights by term and kind, after words that clean documents use are taken from the misspellings.

    A misspelling not seen yet weighs as much as its term, but no more than the log ratio of two rates: toxic documents
    that misspell the term, and clean ones that hold a word near it which the sample lacks.  The number of near
    words held by one clean document estimates the latter, so a term amid many rare words counts for little.
    """
    def surfaces(batches):
        n = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                _, out, _, _, words = find_terms(lexicon, text.as_py() or "")
                n[y].update({(int(o), w) for o, w in zip(out, words)})
        keys = list(n[0].keys() | n[1].keys())
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
            pa.array([n[1][k] for k in keys], pa.int64()), pa.array([n[0][k] for k in keys], pa.int64())],
            ["out", "surface", "n1", "n0"])

    found = stored(rows.mapInArrow(surfaces, "out int, surface string, n1 long, n0 long").groupBy("out", "surface").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "surfaces")
    usual = (F.col("surface") != "") & (F.col("n0") > 0) & (F.col("n0") * t1 >= F.col("n1") * t0 / LEAST_RATIO)
    # Spellings seen in the labelled sample, whose size bounds them.
    ordinary = {r[0] for r in found.filter(usual).select("surface").distinct().collect()}
    total = np.zeros((2 * len(lexicon.terms), 2))
    for r in found.filter(~usual).groupBy("out").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).collect():
        total[r["out"]] = [r["n1"], r["n0"]]
    seen = np.log((total[:, 0] + 0.5) / (t1 + 1)) - np.log((total[:, 1] + 0.5) / (t0 + 1))
    weights = np.clip(seen, 0, HEAVIEST).reshape(-1, 2)
    rare = np.zeros(len(lexicon.terms))
    for r in found.filter(usual & (F.col("n0") == 1)).groupBy("out").agg(F.count("*").alias("n")).collect():
        rare[r["out"] // 2] = r["n"]
    with np.errstate(divide="ignore"):
        unseen = np.log(MISSPELLED_SHARE * (total[::2, 0] + 0.5) / (t1 + 1)) - np.log(rare / t0)
    expected = np.clip(np.minimum(unseen, weights[:, EXACT]), 0, None)
    weights[:, FUZZY] = np.maximum(np.where(total.sum(1)[1::2] > 0, weights[:, FUZZY], 0), expected)
    lexicon.weights, lexicon.ordinary = weights, frozenset(ordinary)
    return lexicon


def _featured(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = [features(lexicon, t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(c, pa.float64()) for c in np.array(x).reshape(-1, len(FEATURES)).T)], ["y", *FEATURES])

    return rows.mapInArrow(run, "y int, " + ", ".join(f"{c} double" for c in FEATURES))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weighted logistic regression drawn to ``PRIOR``, by Newton steps."""
    z = np.c_[np.ones(len(x)), x]
    theta = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + PULL * (theta - PRIOR)
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + PULL * np.eye(len(theta))
        theta = theta - np.clip(np.linalg.solve(hessian, gradient), -1, 1)
    return theta


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from 0.5) to all columns; null and empty texts hold no term.

    If a name is taken the new column gets underscores at its end.
    """
    names = [fresh(docs, "score"), fresh(docs, "predicted")]
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
