"""Periodic runs of words, found through the dictionary of basic factors.

A run is a stretch of words with smallest period q that no neighbour extends, at least
``shortest`` words and ``times`` periods long.  Texts of a group share one array of word
numbers; the dictionary names equal factors of each power-of-two length in it, so equal names
are equal words and no hash decides anything.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import fresh

SHORTEST = 24
TIMES = 3
#: Bytes of text whose words are named together; a longer text is a group of its own.
GROUP_BYTES = 4 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def lowest_length(shortest: int, times: int) -> int:
    """Largest power of two such that every run holds two occurrences, one period apart, of a factor that long.

    A run of period q and length m holds them if the factor has at most m - q words, and m - q
    is ``shortest * (times - 1) / times`` at least, whatever q is.  A factor of q words or more
    recurs at multiples of q only, so the next occurrence gives q itself; with three periods
    the first power of two from q on is short enough for that.
    """
    return 1 << max(shortest * (times - 1) // times, 1).bit_length() - 1


def successors(key: np.ndarray, at: np.ndarray, text: np.ndarray):
    """(order, same): positions sorted by factor, and whether the next one in order is the next occurrence."""
    order = np.argsort(key, kind="stable")
    named, place = key[order], at[order]
    same = (named[1:] == named[:-1]) & (text[place[1:]] == text[place[:-1]])
    return named, place, same


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Number of leading equal elements, compared in growing steps."""
    done, step, most = 0, 16, min(len(a), len(b))
    while done < most:
        end = min(done + step, most)
        unequal = np.flatnonzero(a[done:end] != b[done:end])
        if len(unequal):
            return done + int(unequal[0])
        done, step = end, step * 2
    return done


def runs_in(words: np.ndarray, bounds: np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> set:
    """(text, start, length, period) of all runs; text ``t`` is ``words[bounds[t]:bounds[t + 1]]``.

    Per length L the next occurrence of a factor at most 2 L words on proposes its distance as
    a period.  Neighbouring positions with one distance form a progression, a single proposal,
    which is extended both ways to the whole run; proposals within a run already found are
    dropped.  The distance is the run's smallest period: a smaller one would divide it and put
    an occurrence nearer.  Positions whose factor is alone in its text leave the dictionary, so
    texts without repetitions cost two or three short sorts.
    """
    sizes = np.diff(bounds)
    found: set = set()
    if not len(words) or sizes.max() < shortest:
        return found
    text = np.repeat(np.arange(len(sizes)), sizes)
    name = words.astype(np.int64)
    at = np.arange(len(words))
    length, lowest = 1, lowest_length(shortest, times)
    most = int(sizes.max()) // times
    last: dict = {}
    while len(at):
        if length == 1:
            key = name
        else:
            half = length // 2
            at = at[at + half < len(words)]
            right = name[at + half]
            fits = (right >= 0) & (text[at] == text[np.minimum(at + half, len(words) - 1)])
            at, right = at[fits], right[fits]
            key = name[at] << 32 | right
        named, place, same = successors(key, at, text)
        if length >= lowest:
            for t, first, end, gap in progressions(place[:-1][same], np.diff(place)[same], text, length):
                s, e = last.get((t, gap), (0, 0))
                if s <= first and end <= e:
                    continue
                low, high = bounds[t], bounds[t + 1]
                s = first - agreeing(words[low:first][::-1], words[low + gap:first + gap][::-1])
                e = end + agreeing(words[end - gap:high - gap], words[end:high])
                last[t, gap] = (s, e)
                if e - s >= max(shortest, times * gap):
                    found.add((t, int(s - low), int(e - s), gap))
        if length >= max(most, lowest):
            break
        alive = np.zeros(len(place), bool)
        alive[:-1] |= same
        alive[1:] |= same
        numbers = np.cumsum(np.r_[False, named[1:] != named[:-1]])
        name = np.full(len(words), -1, np.int64)
        name[place[alive]] = numbers[alive]
        at = np.sort(place[alive])
        length *= 2
    return found


def progressions(at: np.ndarray, gap: np.ndarray, text: np.ndarray, length: int) -> list:
    """(text, first, end, gap) of maximal stretches of positions with one gap of at most twice the length."""
    near = gap <= 2 * length
    at, gap = at[near], gap[near]
    if not len(at):
        return []
    order = np.argsort(at)
    at, gap = at[order], gap[order]
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (gap[1:] != gap[:-1]) | (text[at[1:]] != text[at[:-1]])]
    first, gap = at[new], gap[new]
    end = at[np.r_[new[1:], True]] + gap + length
    return list(zip(text[first].tolist(), first.tolist(), end.tolist(), gap.tolist()))


def texts_runs(texts: list, shortest: int, times: int) -> list:
    """(runs by start and period, number of words, collapsed text) of every text of a group."""
    split = [t.encode().split() if t else [] for t in texts]
    numbers: defaultdict = defaultdict(count().__next__)
    bounds = np.cumsum([0, *map(len, split)])
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, bounds[-1])
    by_text: dict = {}
    for t, start, length, period in runs_in(words, bounds, shortest, times):
        by_text.setdefault(t, []).append((start, length, period))
    results = []
    for t, own in enumerate(split):
        runs = sorted(by_text.get(t, ()), key=lambda r: (r[0], r[2]))
        kept = own
        if runs:
            keep = np.ones(len(own), bool)
            for start, length, period in runs:
                keep[start + period: start + length] = False
            kept = [own[i] for i in np.flatnonzero(keep).tolist()]
        results.append((runs, len(own), b" ".join(kept).decode()))
    return results


def groups(texts: list):
    """The texts in order, as lists of at most ``GROUP_BYTES`` characters or a single text."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t or "") > GROUP_BYTES:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield held


def mark_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """Adds ``n_words``, ``runs`` and ``collapsed`` to all columns.

    Words are parts between ASCII white space.  ``runs`` lists start (word number from 0),
    length and period of every run by start, then period; runs may overlap.  ``collapsed`` is
    the text without the words that some run holds after its first period, joined by single
    spaces.  Null, empty and blank texts have no words, no runs and an empty collapsed text.
    Keys, repeated rows and other columns pass as they are; taken names get underscores; an empty
    table gives no rows.  A text is searched whole, however long, in n log n time, most of it
    only where words repeat; a task holds one group of texts or one long text.
    """
    if shortest < 1 or times < 3:
        raise ValueError("a run needs at least one word and three periods")
    names = [fresh(docs, n) for n in ("n_words", "runs", "collapsed")]
    at = docs.columns.index(text)
    kinds = [T.LongType(), T._parse_datatype_string(f"array<{RUN}>"), T.StringType()]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds)]])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def mark(batches):
        for batch in batches:
            rows = [r for g in groups(batch.column(at).to_pylist()) for r in texts_runs(g, shortest, times)]
            runs = [[dict(zip(("start", "length", "period"), x)) for x in r[0]] for r in rows]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([r[1] for r in rows], pa.int64()), pa.array(runs, arrow),
                pa.array([r[2] for r in rows], pa.string()),
            ], schema.names)

    return docs.mapInArrow(mark, schema)


def strongest(runs: str):
    """Run with the greatest exact length / period of a list by start and period, the first of equals; null for none."""
    return F.expr(f"""aggregate({runs}, cast(null as {RUN}),
        (best, r) -> CASE WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END)""")
