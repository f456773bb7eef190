"""Phrases of words that occur together often, mined by set-oriented joins.

Occurrence relations (piece, position, phrase) are kept as tables that are bucketed by piece
and sorted by (piece, position).  A relation of phrases of n + 1 words comes from a merge join
of that of n words with itself at the next position; its groups are counted, and only
occurrences of frequent groups are kept before the next length.  The relation of single words
lies in order within the task that reads a text, so its join is made there; all longer ones
are joined by Spark.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import stored
from tickforge.session import scratch_path

LEAST = 100
LONGEST = 5
FIRST = 2000
#: Occurrences a bucket holds on average, which sets the number of buckets.
BUCKET_ROWS = 1_000_000
#: Rows of groups that may be sent to every task (24 bytes each); more are joined by shuffle.
BROADCAST_GROUPS = 250_000
#: Frequent words that go to every task as a sorted array of their numbers (8 bytes each).
FILTER_WORDS = 2_000_000
#: Word occurrences a task joins at a time; a longer text is a group of its own.
GROUP_WORDS = 1_000_000

LOWER = bytes(c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))


def pieces_of(text: str | None) -> list[list[bytes]]:
    """Words of every piece that has any; A-Z are lower-cased."""
    if not text:
        return []
    return [words for piece in text.encode().translate(LOWER).split(b"\n") if (words := piece.split())]


def word_numbers(lang: str, words, salt: int) -> list[int]:
    """Signed 64-bit hashes of a language's words."""
    seed = xxhash.xxh64_intdigest(lang.encode(), salt)
    return [h - (1 << 64) if h >> 63 else h for h in (xxhash.xxh64_intdigest(w, seed) for w in words)]


def word_counts(texts: DataFrame, salt: int) -> DataFrame:
    """(lang, word, number, c): occurrences of every word per language; counted per batch, then by Spark."""
    def tally(batches):
        for batch in batches:
            counts: dict = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = counts.setdefault(lang, Counter())
                for words in pieces_of(text):
                    own.update(words)
            langs, words, numbers, found = [], [], [], []
            for lang, own in counts.items():
                langs += [lang] * len(own)
                words += [w.decode() for w in own]
                numbers += word_numbers(lang, own, salt)
                found += own.values()
            yield pa.RecordBatch.from_arrays([
                pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(numbers, pa.int64()), pa.array(found, pa.int64()),
            ], ["lang", "word", "number", "c"])

    return texts.mapInArrow(tally, "lang string, word string, number long, c long").groupBy("lang", "word", "number").agg(
        F.sum("c").alias("c"))


def clashes(counted: DataFrame) -> bool:
    """True if two words, or one word of two languages, share a number."""
    return bool(counted.groupBy("number").count().filter("count > 1").head(1))


def neighbours(batch: pa.RecordBatch, salt: int, common: np.ndarray | None):
    """(number of pieces, piece, at, left, right, ids) per group of texts: its words joined with their right neighbours.

    The words of a group lie in order of piece and position, so the merge join is one
    comparison of each row with the next.  left and right are places in ``ids``.  If ``common``
    is given, words outside it take no part and an id is the word's place in it.
    """
    places, sizes, known = [], [], {}

    def joined():
        length = np.array(sizes, np.int64)
        ends = np.cumsum(length)
        at = np.arange(len(places)) - np.repeat(ends - length, length)
        piece = np.repeat(np.arange(len(length)), length)
        word = np.array(places, np.int64)
        order = [np.array(list(own.values()), np.int64) for own in known.values()]
        named = [np.array(word_numbers(lang, own, salt), np.int64) for lang, own in known.items()]
        numbers = np.empty(sum(map(len, order)), np.int64)
        for where, values in zip(order, named):
            numbers[where] = values
        meets = (piece[1:] == piece[:-1]) & (at[1:] == at[:-1] + 1)
        if common is not None:
            numbers, known_word = ids_in(common, numbers)
            kept = known_word[word]
            meets &= kept[1:] & kept[:-1]
        left = np.flatnonzero(meets)
        return len(sizes), piece[left], at[left], word[left], word[left + 1], numbers

    number = count().__next__
    for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if lang not in known:
            known[lang] = defaultdict(number)
        for words in pieces_of(text):
            places.extend(map(known[lang].__getitem__, words))
            sizes.append(len(words))
        if len(places) > GROUP_WORDS:
            yield joined()
            places, sizes, known, number = [], [], {}, count().__next__
    if places:
        yield joined()


def ids_in(common: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of numbers in the sorted array, and whether they are there."""
    place = np.searchsorted(common, numbers)
    there = np.append(common, 0)[place] == numbers
    there[place == len(common)] = False
    return place, there


def with_ids(words: DataFrame, common: np.ndarray | None) -> DataFrame:
    """The words with ``id`` in place of their number."""
    if common is None:
        return words.withColumnRenamed("number", "id")

    def named(batches):
        for batch in batches:
            ids, _ = ids_in(common, batch.column("number").to_numpy())
            yield batch.set_column(batch.schema.get_field_index("number"), "id", pa.array(ids, pa.int64()))

    return words.mapInArrow(named, words.withColumnRenamed("number", "id").schema)


def pair_counts(texts: DataFrame, salt: int, common: np.ndarray | None) -> DataFrame:
    """(left, right, c): counts of neighbouring words per group of texts."""
    def tally(batches):
        for batch in batches:
            for _, _, _, left, right, numbers in neighbours(batch, salt, common):
                pair, c = np.unique(left * len(numbers) + right, return_counts=True)
                first, second = np.divmod(pair, max(len(numbers), 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[first]), pa.array(numbers[second]), pa.array(c)], ["left", "right", "c"])

    return texts.mapInArrow(tally, "`left` long, `right` long, c long")


def pair_occurrences(texts: DataFrame, salt: int, common: np.ndarray | None) -> DataFrame:
    """(piece, at, left, right) of neighbouring words; piece numbers differ between all pieces of the table."""
    def place(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 40
        for batch in batches:
            for pieces, piece, at, left, right, numbers in neighbours(batch, salt, common):
                yield pa.RecordBatch.from_arrays([
                    pa.array(piece + base), pa.array(at.astype(np.int32)), pa.array(numbers[left]), pa.array(numbers[right]),
                ], ["piece", "at", "left", "right"])
                base += pieces

    return texts.mapInArrow(place, "piece long, at int, `left` long, `right` long")


class Relations:
    """Occurrence tables of one run in a database of its own in the shared folder.

    Tables are bucketed by piece, so that a join by piece and position moves no rows.
    """

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = f"occurrences_{uuid.uuid4().hex}"
        self.count = 0
        # A join may use the buckets though it has the position as a second key.
        self.setting = "spark.sql.requireAllClusterKeysForCoPartition"
        self.before = spark.conf.get(self.setting)

    def __enter__(self) -> Relations:
        path = scratch_path(self.spark, "occurrences").replace("'", "\\'")
        self.spark.sql(f"CREATE DATABASE {self.name} LOCATION '{path}'")
        self.spark.conf.set(self.setting, "false")
        return self

    def keep(self, rows: DataFrame) -> DataFrame:
        """Writes (piece, at, id), sorted by piece and position within a bucket."""
        self.count += 1
        name = f"{self.name}.level{self.count}"
        rows.select("piece", "at", "id").write.format("parquet").bucketBy(self.buckets, "piece").sortBy("piece", "at").saveAsTable(name)
        return self.spark.table(name)

    def __exit__(self, *failure) -> None:
        """Removes the tables with their files."""
        self.spark.conf.set(self.setting, self.before)
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")


def join_groups(rows: DataFrame, groups: DataFrame, number: int, on: list[str]) -> DataFrame:
    """Rows of the groups; these go to every task only if they are few."""
    return rows.join(F.broadcast(groups) if number <= BROADCAST_GROUPS else groups, on)


def at_next(level: DataFrame) -> DataFrame:
    """(piece, at, left, right): occurrences joined with those at the next position of the piece."""
    return level.alias("x").join(
        level.withColumn("before", F.col("at") - 1).alias("y"),
        (F.col("x.piece") == F.col("y.piece")) & (F.col("x.at") == F.col("y.before")),
    ).select("x.piece", "x.at", F.col("x.id").alias("left"), F.col("y.id").alias("right"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang"):
    """(words, phrases): frequent words, and phrases of 2 to ``longest`` words, per language.

    words: lang, id, phrase, f, n, where n counts all word occurrences of the language.
    phrases: lang, id, phrase, f, n, size, left, right, where left and right are the ids of the
    phrase without its last and its first word.  f counts occurrences within pieces, overlaps
    included, and is ``least`` at least; every part of such a phrase is frequent, too, so the
    semi-joins lose nothing.  A null language is ``und``; null and empty texts have no words.

    Words travel as 64-bit numbers; should two words share one, all numbers are drawn anew.
    Frequent groups get an id of their own.  Up to ``FILTER_WORDS`` frequent words go to all
    tasks as a filter; with more the pairs are counted unfiltered.  The occurrence tables are removed at the end.
    """
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    spark = docs.sparkSession
    texts = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    salt = 0
    while clashes(counted := stored(word_counts(texts, salt), "words")):
        salt += 1
    totals = stored(counted.groupBy("lang").agg(F.sum("c").alias("n")), "totals")
    common = join_groups(counted.filter(F.col("c") >= least), totals, totals.count(), ["lang"])
    words = stored(common.select(
        "lang", "number", F.col("word").alias("phrase"), F.col("c").alias("f"), "n"), "frequent")
    number, total = words.agg(F.count("*"), F.sum("f")).first()
    # Without the filter more pairs are counted, with the same result.
    filtered = np.sort(np.array([r[0] for r in words.select("number").collect()], np.int64)) if number <= FILTER_WORDS else None
    words = with_ids(words, filtered)
    counts = pair_counts(texts, salt, filtered).groupBy("left", "right").agg(F.sum("c").alias("f"))
    pairs = pair_occurrences(texts, salt, filtered)
    known, found = words, []
    with Relations(spark, max(8, (total or 0) // BUCKET_ROWS + 1)) as tables:
        for size in range(2, longest + 1):
            groups = stored(counts.filter(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id()), "groups")
            number = groups.count()
            last_word = F.element_at(F.split("r.phrase", " "), -1)
            known = stored(
                groups.alias("g").join(known.alias("l"), F.col("g.left") == F.col("l.id"))
                .join(known.alias("r"), F.col("g.right") == F.col("r.id"))
                .select("l.lang", "g.id", F.concat_ws(" ", "l.phrase", last_word).alias("phrase"), "g.f",
                        "l.n", F.lit(size).alias("size"), "g.left", "g.right"), "phrases")
            found.append(known)
            if size == longest or not number:
                break
            level = join_groups(pairs, groups.select("left", "right", "id"), number, ["left", "right"])
            level = tables.keep(level.repartition(tables.buckets, "piece") if size == 2 else level)
            pairs = at_next(level)
            counts = pairs.groupBy("left", "right").agg(F.count("*").alias("f"))
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.union(more)
    return words, phrases


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, phrase, a, l, r, n, score of the frequent phrases that no longer one makes superfluous.

    a, l and r count the phrase, the words before the cut and those after it; the cut with the
    least floor(1000 a n / (l r)) counts, the first of equals.  A phrase goes if a longer one
    that contains it is as frequent; it is enough to look at phrases of one word more, as
    counts never rise with length.  An empty table and one without frequent phrases give no rows.
    """
    words, phrases = frequent_phrases(docs, least, longest, text, lang)
    covered = phrases.select("size", "f", F.explode(F.array("left", "right")).alias("id")).select(
        (F.col("size") - 1).alias("size"), "id", "f").distinct()
    kept = phrases.join(covered, ["size", "id", "f"], "left_anti")
    counts = words.select("lang", "phrase", "f").union(phrases.select("lang", "phrase", "f"))
    part = F.split("phrase", " ")
    cuts = kept.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), part.alias("w"), "n", "size"
    ).select("lang", "phrase", "a", "n", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
             F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("rest"))
    scored = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    product = (F.lit(1000).cast("decimal(4,0)") * exact["a"]).cast("decimal(19,0)") * exact["n"]
    scored = scored.withColumns({"over": product, "under": exact["l"] * exact["r"]}).withColumn("score", F.expr("over div under"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return scored.groupBy("lang", "phrase", "a", "n").agg(best).select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def top_collocations(found: DataFrame, first: int = FIRST) -> DataFrame:
    """The first phrases of each language with their rank; every task cuts its own rows to as many before the shuffle."""
    from pyspark.sql import Window

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first).withColumn("rank", F.col("rank").cast("long"))
