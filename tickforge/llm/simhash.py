"""SimHash near copies through a byte-position inverted index with count filtering."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import stored
from tickforge.llm.components import components

SEED = 42
SHINGLE = 3
MOST_BITS = 3
LEAST_BYTES = 8 - MOST_BITS
HOT = 4096
#: Sets of four byte positions such that any three positions miss one of them: those whose
#: numbers cancel under exclusive or.  Two fingerprints that differ in at most three bytes
#: agree on all four bytes of at least one set.
POSITIONS = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, repeats included, as an unsigned number."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    if len(words) > shingle:
        first = (ends - lengths + 1)[: len(words) - shingle + 1].tolist()
        last = ends[shingle - 1:].tolist()
    else:
        first, last = [0], [len(joined)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(first), CHUNK):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first[i: i + CHUNK], last[i: i + CHUNK])), np.uint64)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(first), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def with_fingerprints(docs: DataFrame, text: str, kept: list[str], out: str, row: str | None = None) -> DataFrame:
    """``kept`` columns plus the fingerprint as a signed long, and on demand a row number."""
    fields = [docs.schema[c] for c in kept] + [T.StructField(out, T.LongType())]
    fields += [T.StructField(row, T.LongType())] if row else []
    at, places = docs.columns.index(text), [docs.columns.index(c) for c in kept]

    def compute(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 40
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(at).to_pylist()], np.uint64).view(np.int64)
            columns = [*(batch.column(i) for i in places), pa.array(prints, pa.int64())]
            if row:
                columns.append(pa.array(np.arange(number, number + len(prints)), pa.int64()))
                number += len(prints)
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.mapInArrow(compute, T.StructType(fields))


def _byte(print_, position: int):
    return F.shiftrightunsigned(print_, 8 * position).bitwiseAND(F.lit(255).cast("long"))


def _key(print_, positions, tag: int):
    """The bytes at the positions as one number, with a tag that tells position sets apart."""
    key = F.lit(tag).cast("long")
    for p in positions:
        key = key * 256 + _byte(print_, p)
    return key


def postings(prints: DataFrame) -> DataFrame:
    """(list, fp): the inverted lists of four positional bytes a fingerprint stands in."""
    fp = F.col("fp")
    return prints.select(F.explode(F.array(*[_key(fp, s, i) for i, s in enumerate(POSITIONS)])).alias("list"), fp)


def longer_postings(hot: DataFrame) -> DataFrame:
    """Lists of five positional bytes for members of long lists.

    Two members that differ in at most three of the other four bytes share one of these.
    """
    fp = F.col("fp")
    tag = F.shiftrightunsigned("list", 32)
    choices = []
    for i, s in enumerate(POSITIONS):
        keys = [_key(fp, (*s, p), 8 * i + p + 8) for p in range(8) if p not in s]
        choices.append(F.when(tag == i, F.array(*keys)))
    return hot.select(F.explode(F.coalesce(*choices)).alias("list"), fp)


def links_of(lists: DataFrame) -> DataFrame:
    """A spanning set of links (a, b) within every list: same components as all its links.

    A list of five positional bytes has at most 2**24 different members, so it fits a task.
    """
    def link(batches):
        held_list, held = None, []
        found: list[np.ndarray] = []
        size = 0
        for batch in batches:
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(key):
                continue
            bounds = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if key[a] != held_list:
                    size += _close(held, found)
                    held_list, held = key[a], []
                held.append(fp[a:b])
            if size > 50_000:
                yield _links(found)
                found, size = [], 0
        _close(held, found)
        yield _links(found)

    return lists.repartition("list").sortWithinPartitions("list", "fp").mapInArrow(link, "a long, b long").distinct()


def _links(found: list[np.ndarray]) -> pa.RecordBatch:
    both = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    both = both.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _close(held: list[np.ndarray], found: list[np.ndarray]) -> int:
    if sum(map(len, held)) < 2:
        return 0
    links = spanning_links(np.concatenate(held))
    found.append(links)
    return len(links)


def near(prints: np.ndarray, one: np.uint64) -> np.ndarray:
    """Mask of fingerprints linked to ``one``: tally shared bytes, retain, verify bits."""
    x = prints ^ one
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    differing = np.bitwise_count((((x & low) + low) | x) & ~low)
    retained = differing <= 8 - LEAST_BYTES
    retained[retained] = np.bitwise_count(x[retained]) <= MOST_BITS
    return retained


def spanning_links(prints: np.ndarray) -> np.ndarray:
    """Links that connect what all links within ``prints`` connect, one fewer than members each.

    A component is grown member by member against what is not yet reached, so neither
    candidates nor links of a dense group are written out.
    """
    rest = np.unique(prints)
    links = []
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        frontier = [seed]
        while frontier and len(rest):
            one = frontier.pop()
            mask = near(rest, one)
            if mask.any():
                reached = rest[mask]
                rest = rest[~mask]
                frontier.extend(reached)
                links.append(np.stack([np.full(len(reached), seed), reached], 1))
    return np.concatenate(links) if links else np.zeros((0, 2), np.uint64)


def classes(prints: DataFrame, hot: int = HOT) -> DataFrame:
    """(fp, class) for distinct fingerprints: the class is one fingerprint of its component."""
    lists = postings(prints)
    long_lists = lists.groupBy("list").count().filter(F.col("count") > hot).select("list")
    long_lists = stored(long_lists, "long-lists")
    links = links_of(lists.join(long_lists, "list", "left_anti")).union(
        links_of(longer_postings(lists.join(long_lists, "list", "left_semi"))))
    roots = components(links)
    return prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("class"))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """Per document its fingerprint and the smallest key of its component.

    Fingerprints link at ``MOST_BITS`` or fewer differing bits.  Then at least five of the eight
    bytes are equal in place, so two linked fingerprints meet in an inverted list of four
    positional bytes; pairs with fewer than five shared bytes are dropped there and the others
    verified.  (Lists of a single byte would hold N / 256 fingerprints, too many pairs.)
    Documents with equal fingerprints are one entry of the index, lists of over ``hot`` entries
    are replaced by lists of five bytes, and only a spanning set of links is kept.

    Result: doc_id, fp (signed), class, fingerprint (hex), component_id.  Texts without a word, null ones
    too, have fingerprint zero and link like others.  Null keys are ignored in the
    smallest key; a component without keys has a null id.  Other columns are dropped, repeated
    rows stay, an empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = stored(with_fingerprints(rows, "text", ["doc_id"], "fp"), "fingerprints")
    return component_ids(marked, hot)


def component_ids(marked: DataFrame, hot: int = HOT) -> DataFrame:
    """Adds class, component_id and fingerprint to stored rows with doc_id and fp."""
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = stored(classes(prints.select("fp"), hot).join(prints, "fp"), "classes")
    ids = found.groupBy("class").agg(F.min("least").alias("component_id"))
    by_print = found.join(ids, "class").select("fp", "class", "component_id")
    return marked.join(by_print, "fp", "left").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One document of each component, that with the smallest key, with all its columns."""
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    at_text, at_key = f"c{columns.index(text)}", f"c{columns.index(key)}"
    rows = stored(with_fingerprints(plain, at_text, plain.columns, "fp", row="row"), "rows")
    found = component_ids(rows.select(F.col(at_key).alias("doc_id"), "fp", "row"), hot)
    # Keys are compared nulls last.
    chosen = found.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return rows.join(chosen.select(F.col("first.row").alias("row")), "row", "left_semi").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
