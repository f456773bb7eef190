"""Personal data: exact forms, and identifiers found by patterns that known ones induce.

Exact e-mail, address, card and phone forms are the seeds.  The words around them become
lexical patterns; patterns and the identifier-like values in their slots form a bipartite
graph whose scores Spark iterates; patterns that nearly always hold one kind mark further
values of a loose form of that kind.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import fresh, stored

KINDS = ("email", "ip", "card", "phone")
#: Different known values of a kind in a pattern's slot before the pattern can count.
LEAST_SEEDS = 5
#: Share of a pattern's slots that hold values of its kind, from which it speaks for others.
LEAST_CONFIDENCE = 0.5
#: Score from which a value that is no seed counts as found.
LEAST_SCORE = 0.8
ROUNDS = 4
#: Pattern keys sent to tasks at a time (8 bytes each); more take another pass over the texts.
BLOCK = 1_000_000
#: Characters a loose value has at most; exact forms have no bound.
LOOSE_CHARS = 80

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Loose forms: what a value of the kind may look like when its exact form does not match.
LOOSE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+(?:@|\(at\)|\[at\]|\{at\})[A-Za-z0-9-]+(?:(?:\.|\(dot\)|\[dot\]|\{dot\})[A-Za-z0-9-]+)*", re.I)),
    ("ip", re.compile(r"[0-9]+(?:(?:\.|\[\.\])[0-9]+){3}|[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}")),
    ("card", re.compile(r"(?:[0-9Xx*]{4}[ .-]?){3}[0-9]{1,7}|[0-9]{12,19}")),
    ("phone", re.compile(r"\(?[0-9][0-9 ()./-]*[0-9]")),
)
#: Words that may be (part of) a loose value.
CANDIDATE = re.compile(r"[0-9@]|\(at\)|\[at\]|\{at\}", re.I)
SPAN = "struct<kind:int,start:bigint,stop:bigint>"
SLOTS = "array<struct<kind:int,start:bigint,stop:bigint,known:boolean,value:string,patterns:array<string>>>"
EDGES = ".,;:!?\"'<>|&%$#*="
DIGITS = re.compile(r"[(+]?[0-9][0-9().-]*[0-9.,;:!?)]*")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Every ``@`` takes all local characters before it and needs a domain after it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        local = text[free:at]
        start = free + len(local.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of all exact forms by kind, then start."""
    spans = [(0, a, b) for a, b in emails(text)]
    spans += [(1, m.start(), m.end()) for m in ADDRESS.finditer(text) if all(
        len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


def loose_value(text: str, start: int, end: int) -> tuple[int, int, int] | None:
    """(kind number, start, end) of the loose value that fills a slot but for punctuation at its ends."""
    if end - start > LOOSE_CHARS:
        return None
    inner = text[start:end]
    cut = inner.strip(EDGES)
    start += len(inner) - len(inner.lstrip(EDGES))
    for number, (_, form) in enumerate(LOOSE):
        m = form.fullmatch(cut)
        if m and (number != 3 or 7 <= sum(c.isdigit() for c in cut) <= 15):
            return number, start, start + len(cut)
    return None


def plain(word: str) -> str:
    """A context word: lower-cased, without punctuation at its ends."""
    return word.strip(EDGES + "()[]{}").lower()


def contexts(left: list[str], right: str | None) -> list[str]:
    """The patterns of a slot by kind of context; words are joined by spaces, the slot is ``_``.

    Every pattern has two words at least, and words only: a text's ends match nothing.
    """
    found = []
    if len(left) >= 2 and left[-1] and left[-2]:
        found.append(f"{left[-2]} {left[-1]} _")
        if len(left) >= 3 and left[-3]:
            found.append(f"{left[-3]} {left[-2]} {left[-1]} _")
        if right:
            found.append(f"{left[-2]} {left[-1]} _ {right}")
    if left and left[-1] and right:
        found.append(f"{left[-1]} _ {right}")
    return found


def slots(text: str, spans: list) -> list[tuple[int, int, int, bool, list[str]]]:
    """(kind number, start, end, known, patterns) of exact forms and of loose values beside them.

    A loose value is one word, or several words of digits in a row; the words around a slot
    are its context.
    """
    if not spans and not CANDIDATE.search(text):
        return []
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    starts = [w[0] for w in words]
    taken: dict[int, tuple] = {}
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        first = bisect_right(starts, a) - 1
        last = bisect_right(starts, b - 1) - 1
        for i in range(first, last + 1):
            taken.setdefault(i, (first, last, kind, a, b, True))
    i = 0
    while i < len(words):
        if i in taken:
            i = taken[i][1] + 1
            continue
        if not CANDIDATE.search(text, *words[i]):
            i += 1
            continue
        last = i
        while last + 1 < len(words) and last - i < 4 and last + 1 not in taken and DIGITS.fullmatch(text, *words[i]) \
                and DIGITS.fullmatch(text, *words[last + 1]) and words[last + 1][0] == words[last][1] + 1:
            last += 1
        value = None
        while last >= i and value is None:
            value = loose_value(text, words[i][0], words[last][1])
            last -= value is None
        if value is None:
            i += 1
            continue
        for j in range(i, last + 1):
            taken[j] = (i, last, *value, False)
        i = last + 1
    found = []
    for first, last, kind, a, b, known in dict.fromkeys(taken.values()):
        before = [plain(text[x:y]) for x, y in words[max(first - 3, 0):first]]
        after = plain(text[words[last + 1][0]:words[last + 1][1]]) if last + 1 < len(words) else None
        found.append((kind, a, b, known, contexts(before, after)))
    return sorted(found, key=lambda s: (s[0], s[1]))


def scan(docs: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, list[str]]:
    """``kept`` columns, a row number, counts and spans of the exact forms, and all slots with their patterns."""
    names = [fresh(docs, n) for n in ("row", "n_email", "n_ip", "n_card", "n_phone", "base", "slots")]
    kinds = ["long"] * 5 + [f"array<{SPAN}>", SLOTS]
    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(n, T._parse_datatype_string(k)) for n, k in zip(names, kinds)]])
    span = [("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]
    slot = pa.struct([*span, ("known", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
    places, at = [docs.columns.index(c) for c in kept], docs.columns.index(text)

    def find(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        row = (task.partitionId() if task else 0) << 40
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            base, around = [], []
            for t in batch.column(at).to_pylist():
                spans = base_spans(t or "")
                for k in range(4):
                    counts[k].append(sum(s[0] == k for s in spans))
                base.append([{"kind": k, "start": a, "stop": b} for k, a, b in spans])
                around.append([{"kind": k, "start": a, "stop": b, "known": known, "value": t[a:b].lower(), "patterns": patterns}
                               for k, a, b, known, patterns in slots(t or "", spans)])
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in places), pa.array(np.arange(row, row + len(base))),
                *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.list_(pa.struct(span))), pa.array(around, pa.list_(slot)),
            ], schema.names)
            row += len(base)

    return docs.mapInArrow(find, schema), names


MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mixed(parts: list, kind: int) -> np.ndarray:
    """Keys of patterns from the hashes of their words, one array per word."""
    key = np.full(len(parts[0]), kind + 1, np.uint64)
    for h, factor in zip(parts, MIX):
        key = (key ^ h) * factor
        key ^= key >> np.uint64(29)
    return key


def pattern_keys(patterns: list[str]) -> np.ndarray:
    """The keys ``ordinary_fills`` finds these patterns by."""
    keys = np.empty(len(patterns), np.uint64)
    for i, pattern in enumerate(patterns):
        words = pattern.split(" ")
        gap = words.index("_", 1)
        kind = 4 * gap + len(words) - gap
        keys[i] = mixed([np.array([word_hash(w)], np.uint64) for j, w in enumerate(words) if j != gap], kind)[0]
    return keys


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode())


class Hashes(dict):
    """Hash of a word's plain form; emptied when it gets large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = word_hash(plain(word.decode()))
        return h


def ordinary_fills(docs: DataFrame, keys: np.ndarray, text: str) -> DataFrame:
    """(key, c): how often a pattern's slot holds one word that cannot be an identifier, over all texts."""
    keys = np.sort(keys)

    def tally(batches):
        hashes = Hashes()
        for batch in batches:
            hits = []
            for t in batch.column(0).to_pylist():
                words = t.encode().split() if t else []
                h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                for before, after in ((2, 0), (3, 0), (2, 1), (1, 1)):
                    n = len(h) - before - max(after, 1) + (0 if after else 1)
                    if n <= 0:
                        continue
                    parts = [h[j:j + n] for j in range(before)] + [h[before + 1:before + 1 + n]] * after
                    found = mixed(parts, 4 * before + after + 1)
                    place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                    where = np.flatnonzero(keys[place] == found)
                    hits += [found[i] for i in where.tolist() if not CANDIDATE.search(words[i + before].decode())]
            key, c = np.unique(np.array(hits, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c)], ["key", "c"])

    return docs.select(text).mapInArrow(tally, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def with_ordinary(patterns: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Adds ``ordinary``: ordinary fills of each pattern; ``BLOCK`` patterns take one pass over the texts."""
    def key(batches):
        for batch in batches:
            keys = pattern_keys(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys.view(np.int64))], ["pattern", "key"])

    keyed = stored(patterns.select("pattern").distinct().mapInArrow(key, "pattern string, key long"), "pattern-keys")
    number = keyed.count()
    blocks = -(-number // BLOCK)
    fills = None
    for b in range(blocks):
        block = keyed.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).select("key")
        own = np.array([r[0] for r in block.collect()], np.int64).view(np.uint64)
        if len(own):
            found = stored(ordinary_fills(docs, own, text), "fills")
            fills = found if fills is None else fills.union(found)
    counted = keyed.join(fills, "key", "left") if fills is not None else keyed.withColumn("c", F.lit(0).cast("long"))
    return patterns.join(counted.select("pattern", F.coalesce("c", F.lit(0)).alias("ordinary")), "pattern")


def bootstrap(slots: DataFrame, docs: DataFrame, text: str) -> DataFrame | None:
    """(kind, value) of values that high-confidence patterns reveal; None if no pattern can.

    ``slots`` has kind, value, known and patterns.  A pattern of a kind needs ``LEAST_SEEDS``
    different known values and a further loose value of the kind.  Its confidence is the sum of
    the scores of its different values of the kind over all its fills: different values of all
    kinds, and every ordinary word.  Known values score 1, others 1 - product(1 - confidence)
    over their patterns of ``LEAST_CONFIDENCE`` or more, 0 at first; each round scores the
    patterns by the values and the values by the patterns.
    """
    edges = slots.select("kind", "value", "known", F.explode("patterns").alias("pattern")).groupBy("pattern", "kind", "value").agg(
        F.max("known").alias("known"))
    seeds = F.sum(F.col("known").cast("long"))
    strong = edges.groupBy("pattern", "kind").agg(seeds.alias("seeds"), F.count("*").alias("values")).filter(
        (F.col("seeds") >= LEAST_SEEDS) & (F.col("values") > F.col("seeds")))
    strong = stored(strong, "patterns")
    if not strong.head(1):
        return None
    edges = stored(edges.join(strong.select("pattern").distinct(), "pattern"), "edges")
    fills = edges.groupBy("pattern").agg(F.count("*").alias("filled"))
    graph = with_ordinary(strong, docs, text).join(fills, "pattern").select(
        "pattern", "kind", (F.col("filled") + F.col("ordinary")).alias("total"))
    graph = stored(graph, "graph")
    scores = edges.select("kind", "value", "known").groupBy("kind", "value").agg(F.max("known").alias("known")).select(
        "kind", "value", "known", F.col("known").cast("double").alias("score"))
    for _ in range(ROUNDS):
        confidence = edges.join(scores.select("kind", "value", "score"), ["kind", "value"]).groupBy("pattern", "kind").agg(
            F.sum("score").alias("s")).join(graph, ["pattern", "kind"]).select(
            "pattern", "kind", (F.col("s") / F.col("total")).alias("confidence"))
        strong_now = confidence.filter(F.col("confidence") >= LEAST_CONFIDENCE)
        doubt = F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999999)))))
        told = edges.join(strong_now, ["pattern", "kind"]).groupBy("kind", "value").agg((1 - doubt).alias("told"))
        scores = stored(scores.select("kind", "value", "known").join(told, ["kind", "value"], "left").select(
            "kind", "value", "known", F.when(F.col("known"), 1.0).otherwise(F.coalesce("told", F.lit(0.0))).alias("score")), "scores")
    return scores.filter((F.col("score") >= LEAST_SCORE) & ~F.col("known")).select("kind", "value")


def find_personal(docs: DataFrame, kept: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``kept`` columns, n_email, n_ip, n_card, n_phone, ``base`` and ``spans``.

    The counts and ``base`` are of the exact forms.  ``spans`` lists base spans and those the
    bootstrap adds, both as (kind, start, stop) in code points by kind, then start; a kind is a
    place in ``KINDS``.  Every slot with a found value is marked, wherever it stands.  An added
    span shares no word with a base one.  Null and empty texts have no spans; without known
    values nothing is added.  Keys pass as they are, also null or repeated; taken names get
    underscores; an empty table gives no rows.
    """
    found, names = scan(docs, list(kept), text)
    found = stored(found, "personal")
    row, *counts, base, around = names
    slots_ = found.select(F.col(row).alias("row"), F.explode(around).alias("s")).select("row", "s.*")
    values = bootstrap(slots_, docs, text)
    added, spans = fresh(found, "added"), fresh(docs, "spans")
    rest = found.drop(around)
    if values is None:
        return rest.withColumn(spans, F.col(base)).drop(row)
    marked = slots_.filter(~F.col("known")).join(values, ["kind", "value"], "left_semi").groupBy(F.col("row").alias(row)).agg(
        F.collect_list(F.struct("kind", "start", "stop")).alias(added))
    every = F.array_sort(F.concat(base, F.coalesce(F.col(added), F.array().cast(f"array<{SPAN}>"))))
    return rest.join(marked, row, "left").withColumn(spans, every).drop(row, added)


def listed(spans: str):
    """Column: the spans as text, kind:start:end by kind and start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")
