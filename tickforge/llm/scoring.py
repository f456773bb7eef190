"""Language-model scores of whole texts: word counts and a causal attention model on subword ids."""

from __future__ import annotations

from collections import Counter
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.attention import BLOCK, Adam, Model, class_log10
from tickforge.llm.common import stored
from tickforge.llm.subwords import Bounded, byte_letters

INPUTS = 1024
CLASSES = 128
SHARED_CLASSES = 16
END_CLASS = CLASSES - 1
OWN_CLASSES = CLASSES - 1 - SHARED_CLASSES
BEGIN, OTHER = 0, 1
FREQUENT = 100_000
BATCH_BLOCKS = 128
GROUP_TOKENS = 1 << 15
GROUP_BYTES = 1 << 23
COUNTER_WORDS = 300_000
LONGEST_LEAD = 16
SHIP = 1024

_leads: dict = {}


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def lead_of(path: str):
    """Function from a word to its leading subword id: the longest vocabulary entry that begins it."""
    if path not in _leads:
        import json

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        ids = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}

        # Length of the longest entry with the same first bytes: where the search starts.
        longest: dict[bytes, int] = {}
        for entry in ids:
            if len(entry) <= LONGEST_LEAD:
                longest[entry[:4]] = max(len(entry), longest.get(entry[:4], 0))

        def lead(word: bytes) -> int:
            spaced = b" " + word
            for n in range(min(len(spaced), longest.get(spaced[:4], 4)), 0, -1):
                found = ids.get(spaced[:n])
                if found is not None:
                    return found
            raise ValueError("the vocabulary lacks single bytes")

        _leads[path] = lead
    return _leads[path]


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over whole texts; counted per task first, so a frequent word sends a row per task."""
    def count(batches):
        n = Counter()
        for batch in batches:
            for t in batch.column(0):
                n.update(words_of(t.as_py()))
                if len(n) > COUNTER_WORDS:
                    yield _counted(n)
                    n = Counter()
        yield _counted(n)

    return rows.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(n: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["word", "c"])


@dataclass
class Vocabulary:
    """What the driver keeps of the counts: totals per leading id and the most frequent words."""

    path: str
    tokens: int  # training tokens, ends included
    distinct: int
    ends: int
    inputs: dict[int, int]  # leading id -> input of the model
    own: dict[int, int]  # leading id -> class of its own
    class_words: np.ndarray  # training tokens per class
    class_distinct: np.ndarray
    frequent: list[bytes]
    frequent_counts: np.ndarray
    identity: str = field(default_factory=lambda: uuid.uuid4().hex)

    def coded(self, lead: int) -> tuple[int, int]:
        """Input and class of a leading id; rare ids share some classes."""
        return self.inputs.get(lead, OTHER), self.own.get(lead, OWN_CLASSES + lead % SHARED_CLASSES)


def learn_vocabulary(counts: DataFrame, ends: int, path: str, frequent: int = FREQUENT) -> Vocabulary:
    """Totals over all counts; the driver gets at most one row per vocabulary id and ``frequent`` words."""
    def leads(batches):
        lead = lead_of(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lead(w) for w in batch.column(0).to_pylist()], pa.int32()), batch.column(1)], ["lead", "c"])

    rows = counts.mapInArrow(leads, "lead int, c long").groupBy("lead").agg(
        F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    order = sorted(rows, key=lambda r: (-r["c"], r["lead"]))
    top = most_frequent(counts, frequent)
    v = Vocabulary(
        path, sum(r["c"] for r in rows) + ends, sum(r["v"] for r in rows) + bool(ends), ends,
        {r["lead"]: i + 2 for i, r in enumerate(order[: INPUTS - 2])}, {r["lead"]: i for i, r in enumerate(order[:OWN_CLASSES])},
        np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64),
        [bytes(r["word"]) for r in top], np.array([r["c"] for r in top], np.int64))
    for r in rows:
        k = v.coded(r["lead"])[1]
        v.class_words[k] += r["c"]
        v.class_distinct[k] += r["v"]
    v.class_words[END_CLASS], v.class_distinct[END_CLASS] = ends, bool(ends)
    return v


def most_frequent(counts: DataFrame, most: int) -> list:
    """At most ``most`` of the most frequent words with their counts.

    The least count comes from a histogram over steps of an eighth of a power of two, so tasks
    send no more words than are kept.
    """
    step = F.floor(8 * F.log2(F.col("c")))
    sizes = sorted(((r["s"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, None
    for s, n in sizes:
        total += n
        if total > most:
            break
        least = s
    return [] if least is None else counts.filter(step >= least).collect()


_coders: dict = {}


def coder_of(vocabulary: Vocabulary) -> Coder:
    """The worker's coder of a vocabulary, which serves all tasks of the worker."""
    if vocabulary.identity not in _coders:
        _coders.clear()
        _coders[vocabulary.identity] = Coder(vocabulary)
    return _coders[vocabulary.identity]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, as ``words_of`` gives them, and their number per text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, lengths = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # White space at the ends of a text leaves an empty word there.
    some = pc.greater(pc.binary_length(words), 0)
    text = np.repeat(np.arange(len(lengths)), lengths)[some.to_numpy(zero_copy_only=False)]
    return words.filter(some).cast(pa.binary()), np.bincount(text, minlength=len(lengths))


def groups_of(batch: pa.RecordBatch, column: int):
    """Slices of a batch with ``GROUP_BYTES`` of text or a single longer one."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > GROUP_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def pair(i, k):
    """A model input and a target class as one number."""
    return i * CLASSES + k


class Coder:
    """Ranks of frequent words, and the model's input and class of every word."""

    def __init__(self, vocabulary: Vocabulary):
        self.lead = lead_of(vocabulary.path)
        self.of_lead = Bounded(lambda lead: pair(*vocabulary.coded(lead)))
        self.frequent = pa.array(vocabulary.frequent, pa.binary())
        self.pairs = np.array(self._pairs(vocabulary.frequent) or [0], np.int64)
        self.logs = np.r_[np.log10(vocabulary.frequent_counts + 1.0), 0]
        self.norms = np.log10(vocabulary.class_words + vocabulary.class_distinct + 1.0)

    def _pairs(self, words: list[bytes]) -> list[int]:
        return [self.of_lead[lead] for lead in map(self.lead, words)]

    def code(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ranks of words, -1 for rare ones, their pairs of input and class, and the rare ones."""
        ranks = pc.fill_null(pc.index_in(words, value_set=self.frequent), -1).to_numpy()
        pairs = self.pairs[np.maximum(ranks, 0)]
        none = ranks < 0
        rare = words.filter(pa.array(none)).to_pylist()
        pairs[none] = self._pairs(rare)
        return ranks, pairs, rare


def coded_blocks(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (begin first) and target classes (end last) of texts in pairs, dealt into blocks.

    Also per block whether a block of the same text precedes it, and the blocks of each text.
    """
    lengths = np.array([len(t) for t in texts])
    counts = lengths // BLOCK + 1
    ends = np.cumsum(counts)
    firsts = ends - counts
    pairs = np.concatenate(texts)
    places = np.arange(len(pairs)) + np.repeat(firsts * BLOCK - (np.cumsum(lengths) - lengths), lengths)
    ids, classes = np.full(int(ends[-1]) * BLOCK, OTHER, np.int64), np.full(int(ends[-1]) * BLOCK, -1, np.int64)
    ids[firsts * BLOCK] = BEGIN
    ids[places + 1] = pairs // CLASSES
    classes[places] = pairs % CLASSES
    classes[firsts * BLOCK + lengths] = END_CLASS
    follows = np.ones(int(ends[-1]), bool)
    follows[firsts] = False
    return ids.reshape(-1, BLOCK), follows, classes.reshape(-1, BLOCK), counts


CODED = (
    "row long, part int, doc_id {key}, held_out boolean, trains boolean, n_tokens long, log_counts double, known long, norms double, "
    "rare array<struct<word: binary, n: int>>, pairs binary"
)
PAIR = np.dtype("<i4")


def code_texts(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Texts as the model reads them, with what frequent words tell of them and their rare words with counts.

    ``part`` is the task that read the text; within a part rows keep their order.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    schema = CODED.format(key=rows.schema["doc_id"].dataType.simpleString())
    names = ["row", "part", "doc_id", "held_out", "trains", "n_tokens", "log_counts", "known", "norms", "rare", "pairs"]

    def code(batches):
        coder = coder_of(shared.value)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        number = part << 40
        for batch in (g for b in batches for g in groups_of(b, 3)):
            n = len(batch)
            words, lengths = split_words(batch.column(3))
            ranks, pairs, rare = coder.code(words)
            text = np.repeat(np.arange(n), lengths)
            sizes, found, at = np.bincount(text[ranks < 0], minlength=n), [], 0
            for m in sizes.tolist():
                found.append(Counter(rare[at: at + m]))
                at += m
            flat = pa.StructArray.from_arrays([
                pa.array([w for c in found for w in c], pa.binary()),
                pa.array([m for c in found for m in c.values()], pa.int32())], ["word", "n"])
            starts = pa.array(np.r_[0, np.cumsum([len(c) for c in found])].astype(np.int32))
            places = np.r_[0, np.cumsum(lengths * PAIR.itemsize)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(number, number + n), pa.int64()), pa.array(np.full(n, part, np.int32)), *batch.columns[:3],
                pa.array(lengths + 1, pa.int64()), pa.array(np.bincount(text, coder.logs[ranks], n), pa.float64()),
                pa.array(lengths - sizes, pa.int64()), pa.array(np.bincount(text, coder.norms[pairs % CLASSES], n), pa.float64()),
                pa.ListArray.from_arrays(starts, flat),
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(places), pa.py_buffer(pairs.astype(PAIR))])], names)
            number += n

    return rows.mapInArrow(code, schema)


def train_model(coded: DataFrame, vocabulary: Vocabulary) -> Model:
    """Trains on all rows: every part trains from the same start, the weights are averaged by tokens.

    A task may read several parts, one after the other.  Spark sums the weights, so the driver gets
    one number per weight however many parts there were.
    """
    start = Model.start(INPUTS, CLASSES)
    share = vocabulary.class_words + 1.0
    start.weights["bias"] = np.log(share / share.sum()).astype(np.float32)

    def train(batches):
        adam, now, texts, held, tokens = None, None, [], 0, 0
        for batch in batches:
            for part, pairs in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now:
                    if adam:
                        yield _weights(adam.model, tokens + _learn(adam, texts))
                    adam, now, texts, held, tokens = Adam(start.copy()), part, [], 0, 0
                texts.append(np.frombuffer(pairs.as_buffer(), PAIR))
                held += len(texts[-1]) + 1
                if held >= GROUP_TOKENS:
                    tokens += _learn(adam, texts)
                    texts, held = [], 0
        if adam:
            yield _weights(adam.model, tokens + _learn(adam, texts))

    sums = coded.select("part", "pairs").mapInArrow(train, "place int, weights array<double>, tokens long") \
        .select(F.col("place").alias("part"), "tokens", F.posexplode("weights").alias("place", "w")).groupBy("part", "place") \
        .agg(F.sum("w").alias("w"), F.sum("tokens").alias("n")).orderBy("part", "place").collect()
    return start.with_flat(np.array([r["w"] / r["n"] for r in sums])) if sums else start


def _weights(model: Model, tokens: int) -> pa.RecordBatch:
    """The weights times tokens, in pieces."""
    flat = model.flat().astype(np.float64) * tokens
    pieces = [flat[i: i + SHIP] for i in range(0, len(flat), SHIP)]
    return pa.RecordBatch.from_arrays([
        pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.list_(pa.float64())),
        pa.array([tokens] * len(pieces), pa.int64())], ["place", "weights", "tokens"])


def _learn(adam: Adam, texts: list[np.ndarray]) -> int:
    if not texts:
        return 0
    blocks, follows, targets, _ = coded_blocks(texts)
    return sum(adam.learn(blocks[i: i + BATCH_BLOCKS], follows[i: i + BATCH_BLOCKS], targets[i: i + BATCH_BLOCKS])[1]
               for i in range(0, len(blocks), BATCH_BLOCKS))


def attend_texts(coded: DataFrame, model: Model) -> DataFrame:
    """Replaces the pairs of a text by the model's log10 probability of its classes."""
    shared = coded.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in coded.columns if c != "pairs"]
    coded = coded.select(*kept, "pairs")

    def score(batches):
        for batch in batches:
            found, texts, held = [], [], 0
            for pairs in batch.column(len(kept)):
                texts.append(np.frombuffer(pairs.as_buffer(), PAIR))
                held += len(texts[-1]) + 1
                if held >= GROUP_TOKENS:
                    found.append(_attend(shared.value, texts))
                    texts, held = [], 0
            if texts:
                found.append(_attend(shared.value, texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.concatenate([np.zeros(0), *found]), pa.float64())], [*kept, "class_log10"])

    return coded.mapInArrow(score, T.StructType([*(coded.schema[c] for c in kept), T.StructField("class_log10", T.DoubleType())]))


def _attend(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """The model's part of each text's score."""
    blocks, follows, targets, counts = coded_blocks(texts)
    found = class_log10(model, blocks, follows, targets).sum(1)
    return np.add.reduceat(found, np.cumsum(counts) - counts)


def score_texts(
    docs: DataFrame, trains: Column, held_out: Column, vocabulary: str, key: str = "doc_id", text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Scores all whole texts after learning from those where ``trains`` is true.

    Result: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams with add-one
    smoothing), score.  The model predicts the class of the next word, which follows from its
    leading subword id; within a class words have add-one probabilities, and one is left for an
    unknown word.  Both scores are log10 probabilities with the end of the text included.

    The ``frequent`` words are broadcast with their counts, a bounded table that takes the skew out of what
    follows: counts of the other words are joined by word, where no key is hot.  Texts are coded once, into a
    shared table of numbers from which the model is trained and scores are computed.  A null text is empty
    and has one token, its end.  Null and repeated keys pass as they are, each row is scored on its own, other
    columns are dropped.  Without training texts counts are zero and the model is as it starts.
    """
    rows = docs.select(F.col(key).alias("doc_id"), held_out.alias("held_out"), F.coalesce(trains, F.lit(False)).alias("trains"),
                       F.col(text).cast("string").alias("text"))
    train = docs.filter(trains).select(F.col(text).cast("string").alias("text"))
    counts = stored(word_counts(train), "word-counts")
    learned = learn_vocabulary(counts, train.count(), vocabulary, frequent)
    coded = stored(code_texts(rows, learned), "coded-texts")
    model = train_model(coded.filter("trains"), learned)
    scored = stored(attend_texts(coded.drop("part", "trains", "rare"), model), "first-scores")
    rare = coded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n") \
        .join(counts, "word").groupBy("row").agg(
            F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_logs"), F.sum("n").alias("rare_known"))
    logs = F.col("log_counts") + F.coalesce("rare_logs", F.lit(0.0))
    end = float(np.log10(learned.ends + 1.0))
    each = float(np.log10(learned.tokens + learned.distinct + 1.0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + int(learned.ends > 0)).cast("long").alias("n_known"),
        F.lit(learned.tokens).cast("long").alias("train_tokens"),
        (logs + F.lit(end) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (logs - F.col("norms") + F.col("class_log10")).alias("score"),
    )
