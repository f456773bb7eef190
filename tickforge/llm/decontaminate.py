"""Benchmark passages in documents, found through a CGK embedding and bit sampling, verified by edits."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that must agree at the start of a window, the window's length, and the stride of an item's windows.
GRAM = 8
WINDOW = 24
STRIDE = 4
MOST_EDITS = 0.2
COORDINATES = 4
EMBEDDINGS = 2
TARGET_RECALL = 0.95
#: Share of coordinates in which two embeddings of a window may differ and still be found.
DIFFERENCE = 0.4
#: Bytes of an item around a window that are compared before the whole item is, and the edits they may have.
AROUND = 64
MOST_AROUND = 0.33
PIECE_BYTES = 1 << 20
HITS = 1 << 16
BLOCK_ITEMS = 5_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SEED = 9
#: Stands between texts searched together: a word no item holds, longer than any window's walk.
BETWEEN = b" " + b"\n" * (2 * WINDOW) + b" "


def plain(text: str | None) -> bytes:
    """Lower case, words one space apart."""
    return b" ".join(text.lower().encode().split()) if text else b""


def tables_needed(target: float = TARGET_RECALL, difference: float = DIFFERENCE, coordinates: int = COORDINATES) -> int:
    """Repetitions of bit sampling after which a window is found with the target probability."""
    return math.ceil(math.log(1 - target) / math.log(1 - (1 - difference) ** coordinates))


@dataclass(frozen=True)
class Walk:
    """A CGK embedding: at step j the pointer moves on if the bit of (j, character) is set."""

    moves: np.ndarray
    samples: np.ndarray  # (tables, COORDINATES) steps

    @staticmethod
    def make(seed: int, tables: int) -> Walk:
        rng = np.random.default_rng(seed)
        moves = rng.integers(0, 2, (2 * WINDOW, 256), dtype=np.int64)
        # The first steps repeat the gram; after 2 * WINDOW steps the walk is at the window's end.
        samples = np.stack([rng.choice(np.arange(2 * GRAM, 2 * WINDOW), COORDINATES, replace=False) for _ in range(tables)])
        return Walk(moves, samples)

    def keys(self, data: np.ndarray, starts: np.ndarray, grams: np.ndarray, salt: int) -> np.ndarray:
        """(tables, windows): a key holds the table, the window's gram and the characters at the sampled steps."""
        wanted: dict[int, list[int]] = {}
        for t, row in enumerate(self.samples.tolist()):
            for j in row:
                wanted.setdefault(j, []).append(t)
        places = np.arange(salt, salt + len(self.samples), dtype=np.uint64)
        keys = (grams[None, :] ^ places[:, None]) * MULTIPLIER
        at, end = starts.copy(), len(data) - 1
        for j, moves in enumerate(self.moves):
            c = data[np.minimum(at, end)]
            for t in wanted.get(j, ()):
                keys[t] = (keys[t] ^ (keys[t] >> np.uint64(31)) ^ (c + np.uint64(1))) * MULTIPLIER
            at += moves[c]
        return keys ^ (keys >> np.uint64(29))


def gram_at(data: np.ndarray) -> np.ndarray:
    """The GRAM bytes from every place on as one number."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(data) - GRAM + 1,), "<u8", buffer=data, strides=(1,)) * MULTIPLIER


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base = 0x5851F42D4C957F2D
    inverse = pow(base, -1, 1 << 64)
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n, np.uint64(x))], dtype=np.uint64) for x in (base, inverse))


class Spans:
    """Hashes of runs of words of one byte string."""

    def __init__(self, data: np.ndarray, power: tuple[np.ndarray, np.ndarray]):
        space = np.flatnonzero(data == 32)
        self.starts = np.r_[0, space + 1]
        self.ends = np.r_[space, len(data)]
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[0][:n], out=self.sums[1:])
        self.inverse = power[1]

    def runs(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every run of so many words."""
        if len(self.starts) < words:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first, last = self.starts[: len(self.starts) - words + 1], self.ends[words - 1:]
        h = (self.sums[last] - self.sums[first]) * self.inverse[first]
        return first, (h ^ (h >> np.uint64(31))) * MULTIPLIER


class Items:
    """Search structure over a block of benchmark items; equal texts are one entry."""

    def __init__(self, items: list[tuple[object, str]], seed: int = SEED):
        same: dict[bytes, list] = {}
        for key, text in items:
            data = plain(text)
            if data:
                same.setdefault(data, []).append(key)
        self.texts = sorted(same)
        self.ids = [same[t] for t in self.texts]
        self.reach = max(map(len, self.texts), default=0)
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.joined = np.frombuffer(b"".join(self.texts) + b"\n" * AROUND, np.uint8)
        self._short()
        long = np.flatnonzero(self.lengths >= WINDOW)
        per = (self.lengths[long] - WINDOW) // STRIDE + 1
        item = np.repeat(long, per)
        offset = (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)) * STRIDE
        starts = self.first[item] + offset
        grams = gram_at(self.joined)[starts] if len(starts) else np.zeros(0, np.uint64)
        tables = -(-tables_needed() // EMBEDDINGS)
        self.walks = [Walk.make(seed + e, tables) for e in range(EMBEDDINGS)]
        keys = np.concatenate([w.keys(self.joined, starts, grams, e * tables) for e, w in enumerate(self.walks)])
        keys = keys.ravel()
        order = np.argsort(keys, kind="stable")
        self.known = keys[order]
        self.entry = (order % max(1, len(starts))).astype(np.int32)
        self.item, self.offset = item.astype(np.int32), offset.astype(np.int32)
        self.gates, self.seen = Bitmap(grams), Bitmap(self.known)

    def _short(self) -> None:
        """Items shorter than a window are known by the hash of their words, per number of words."""
        self.short: dict[int, dict[int, list[int]]] = {}
        power = powers(WINDOW)
        for i, text in enumerate(self.texts):
            if len(text) < WINDOW:
                words = text.count(b" ") + 1
                _, h = Spans(np.frombuffer(text, np.uint8), power).runs(words)
                self.short.setdefault(words, {}).setdefault(int(h[0]), []).append(i)

    @cached_property
    def power(self) -> tuple[np.ndarray, np.ndarray]:
        return powers(2 * PIECE_BYTES + 4 * self.reach + 1024)

    def __getstate__(self) -> dict:
        """Powers are computed where they are used and not shipped."""
        return {k: v for k, v in self.__dict__.items() if k != "power"}

    def matches(self, texts: list[str | None]) -> list[list[tuple[object, int]]]:
        """Per text (item, edits) for every item it holds within the edits allowed.

        Texts are searched together, about ``PIECE_BYTES`` at a time; longer ones are cut into
        pieces that overlap by the longest item and its edits on either side.
        """
        best: list[dict[int, int]] = [{} for _ in texts]
        pieces, owners, size = [], [], 0
        overlap = int(self.reach * (1 + 2 * MOST_EDITS)) + 2 * WINDOW
        for i, text in enumerate(texts if self.texts else ()):
            data = plain(text)
            for a in range(0, len(data), PIECE_BYTES):
                pieces.append(data[max(0, a - overlap): a + PIECE_BYTES])
                owners.append(i)
                size += len(pieces[-1]) + len(BETWEEN)
                if size >= PIECE_BYTES:
                    self._search(pieces, owners, best)
                    pieces, owners, size = [], [], 0
        if pieces:
            self._search(pieces, owners, best)
        return [[(key, d) for i, d in sorted(b.items()) for key in self.ids[i]] for b in best]

    def _search(self, pieces: list[bytes], owners: list[int], best: list[dict[int, int]]) -> None:
        data = np.frombuffer(BETWEEN + BETWEEN.join([*pieces, b""]), np.uint8)
        lengths = np.array([len(p) + len(BETWEEN) for p in pieces])
        first = np.cumsum(lengths) - lengths + len(BETWEEN)
        if self.short:
            self._search_short(data, pieces, first, owners, best)
        grams = gram_at(data)
        hits = self.gates.holds(grams)
        for part in np.split(hits, range(HITS, len(hits), HITS)):
            item, begin, at = self._candidates(data, part, grams[part])
            close = self._close(data, item, begin, at)
            for i, b, a in zip(item[close].tolist(), begin[close].tolist(), at[close].tolist()):
                p = int(np.searchsorted(first, a, "right")) - 1
                found = best[owners[p]]
                if found.get(i) != 0:
                    self._verify(pieces[p], i, b - int(first[p]), found)

    def _search_short(self, data, pieces, first, owners, best) -> None:
        spans = Spans(data, self.power)
        for words, known in self.short.items():
            starts, h = spans.runs(words)
            for w in np.flatnonzero(np.isin(h, np.fromiter(known, np.uint64, len(known)))).tolist():
                p = int(np.searchsorted(first, starts[w], "right")) - 1
                a = int(starts[w] - first[p])
                for i in known[int(h[w])]:
                    if pieces[p][a: a + len(self.texts[i])] == self.texts[i]:
                        best[owners[p]][i] = 0

    def _candidates(self, data: np.ndarray, starts: np.ndarray, grams: np.ndarray):
        """(item, where the item would begin, a window's place) of windows that share a key, one for each begin."""
        entries, places = [], []
        tables = len(self.walks[0].samples)
        for e, walk in enumerate(self.walks):
            keys = walk.keys(data, starts, grams, e * tables).ravel()
            some = self.seen.holds(keys)
            lo, hi = (np.searchsorted(self.known, keys[some], side) for side in ("left", "right"))
            n = hi - lo
            entries.append(self.entry[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
            places.append(starts[np.repeat(some % max(1, len(starts)), n)])
        entry, at = np.concatenate(entries), np.concatenate(places)
        item = self.item[entry].astype(np.int64)
        begin = at - self.offset[entry]
        _, one = np.unique(item * (1 << 40) + begin + (1 << 39), return_index=True)
        return item[one], begin[one], at[one]

    def _close(self, data: np.ndarray, item: np.ndarray, begin: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Candidates whose surroundings of the window agree but for ``MOST_AROUND`` of ``AROUND`` bytes.

        The same bit-parallel columns as in ``least_edits``, for all candidates at once.
        """
        kept = []
        for rows in np.split(np.arange(len(item)), range(1 << 14, len(item), 1 << 14)):
            size = np.minimum(self.lengths[item[rows]], AROUND)
            a = np.clip(at[rows] - begin[rows] - (AROUND - WINDOW) // 2, 0, self.lengths[item[rows]] - size)
            pattern = self.joined[(self.first[item[rows]] + a)[:, None] + np.arange(AROUND)]
            top = np.uint64(1) << (size - 1).astype(np.uint64)
            up, down = np.full(len(rows), ~np.uint64(0)), np.zeros(len(rows), np.uint64)
            score = size.copy()
            least = size.copy()
            slack = AROUND // 4
            for j in range(-slack, AROUND + slack):
                c = data[np.clip(begin[rows] + a + j, 0, len(data) - 1)]
                eq = np.packbits(pattern == c[:, None], axis=1, bitorder="little").view("<u8").ravel()
                xv = eq | down
                xh = (((eq & up) + up) ^ up) | eq
                ph, mh = down | ~(xh | up), up & xh
                score += (ph & top != 0).astype(np.int64) - (mh & top != 0)
                ph, mh = ph << np.uint64(1), mh << np.uint64(1)
                up, down = mh | ~(xv | ph), ph & xv
                np.minimum(least, score, out=least)
            kept.append(rows[least <= MOST_AROUND * size])
        return np.concatenate(kept)

    def _verify(self, piece: bytes, item: int, begin: int, best: dict[int, int]) -> None:
        pattern = self.texts[item]
        most = int(MOST_EDITS * len(pattern))
        region = piece[max(0, begin - most): max(0, begin + len(pattern) + most)]
        edits = 0 if pattern in region else least_edits(pattern, region)
        if edits <= most and edits < best.get(item, most + 1):
            best[item] = edits


class Bitmap:
    """A first look at a set of hashes: never misses one, lets at most one in 32 others through."""

    def __init__(self, hashes: np.ndarray):
        self.shift = np.uint64(64 - max(16, len(hashes).bit_length() + 5))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[hashes >> self.shift] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.bits[hashes >> self.shift])


def least_edits(pattern: bytes, text: bytes) -> int:
    """Fewest edits between the pattern and any stretch of the text, by bit-parallel columns."""
    m = len(pattern)
    masks = [0] * 256
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    least = m
    for c in text:
        eq = masks[c]
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up, down = mh | (full & ~(xv | ph)), ph & xv
        if score < least:
            least = score
    return least


def find_passages(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(doc_id, item_id, edits): documents that hold an item within 20 % of its length in edits.

    Texts are compared in lower case with words one space apart.  Items are taken in blocks of
    about ``block_items``, so what a task holds is bounded whatever the benchmark's size;
    each block passes over all documents once and nothing is shuffled.

    An item gives a window of ``WINDOW`` bytes at every fourth byte, a document one wherever ``GRAM`` bytes occur
    in an item.  Each window is embedded by two CGK walks, which turn a few edits into a few differing
    coordinates; ``tables_needed`` samples of four coordinates are looked up.  Candidates are compared around
    the window first and then verified by their exact edit distance.  Items shorter than a window are
    found where their words stand unchanged; empty ones never.  Null and empty texts hold no item; a
    repeated row gives its rows again; a null key passes as it is; null item texts are skipped.
    """
    items = benchmark.select(F.col(item_key).alias("item_id"), F.col(item_text).cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    n_blocks = max(1, -(-items.count() // block_items))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], items.schema["item_id"], T.StructField("edits", T.LongType())])
    found = None
    for block in range(n_blocks):
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        search = Items([(r[0], r[1]) for r in some.collect()])
        part = _search(rows, search, schema)
        found = part if found is None else found.union(part)
    return found


def _search(rows: DataFrame, search: Items, schema: T.StructType) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(search)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            found = shared.value.matches(batch.column(1).to_pylist())
            out = [(k, item, edits) for k, held in zip(batch.column(0).to_pylist(), found) for item, edits in held]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 3, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
               block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Documents that hold no item, with all their columns."""
    items = benchmark.select(F.col(item_key).alias("item_id"), F.col(item_text).cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    n_blocks = max(1, -(-items.count() // block_items))
    at = docs.columns.index(text)
    for block in range(n_blocks):
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        shared = docs.sparkSession.sparkContext.broadcast(Items([(r[0], r[1]) for r in some.collect()]))

        def clean(batches, shared=shared):
            for batch in batches:
                found = shared.value.matches(batch.column(at).to_pylist())
                yield batch.filter(pa.array([not held for held in found], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
