"""Language identification by mixture inference over n-gram likelihoods."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.llm.common import fresh

BUCKETS = 1 << 15
SMOOTHING = 0.5
BLOCK = 64
ROUNDS = 10
PENALTY = 2.0
PIECE_BYTES = 1 << 20
NO_LANGUAGE = "und"
#: ASCII characters other than letters all count as a space.
LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text)))


def plain_bytes(text: str) -> bytes:
    return b" " + text.lower().encode().translate(LETTERS_ONLY) + b" "


def gram_codes(data: bytes) -> np.ndarray:
    """Bucket of each byte trigram; bucket 0 is kept for trigrams of spaces only."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    joined = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    codes = (joined * np.uint32(2654435761)) >> np.uint32(17)
    codes[(codes == 0)] = 1
    codes[joined == 0x202020] = 0
    return codes


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all given documents with a language."""
    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            waiting: dict[str, list[bytes]] = {}
            size = 0
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for piece in pieces(t):
                    waiting.setdefault(name, []).append(piece)
                    size += len(piece)
                if size > PIECE_BYTES:
                    _add(counts, waiting)
                    waiting, size = {}, 0
            _add(counts, waiting)
        for name, c in counts.items():
            gram = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(gram), pa.string()), pa.array(gram, pa.int32()), pa.array(c[gram], pa.int64())],
                ["lang", "gram", "n"])

    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    return rows.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _add(counts, waiting) -> None:
    for name, parts in waiting.items():
        found = np.bincount(gram_codes(b"".join(parts)), minlength=BUCKETS)
        counts[name] = counts.get(name, 0) + found


def pieces(text: str):
    """The whole text as byte strings of bounded size that overlap by two bytes."""
    data = plain_bytes(text)
    if len(data) <= PIECE_BYTES:
        return [data]
    step = PIECE_BYTES // BLOCK * BLOCK
    return [data[i: i + step + 2] for i in range(0, max(1, len(data) - 2), step)]


class LanguageModel:
    """Log probabilities of n-gram buckets per language, and in the last row those of the background.

    The background gives all buckets the same probability; it takes what no learned language explains better.
    """

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = np.vstack([counts + SMOOTHING, np.ones((1, BUCKETS))])
        self.logs = np.log(smooth / smooth.sum(1, keepdims=True)).astype(np.float32)
        self.logs[:, 0] = 0

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, float]]]]:
        """Per text the main language, its share, and the chosen set with shares.

        Shares leave out what the background holds; if it holds all, the likeliest language has the share 0.
        """
        out = [(NO_LANGUAGE, 0.0, [])] * len(texts)
        if not self.langs:
            return out
        segments, owners, size, blocks, docs = [], [], 0, [], []
        for i, t in enumerate(texts):
            if t and has_letter(t):
                for piece in pieces(t):
                    segments.append(piece)
                    owners.append(i)
                    size += len(piece)
                if size >= PIECE_BYTES:
                    self._score(segments, owners, blocks, docs)
                    segments, owners, size = [], [], 0
        if segments:
            self._score(segments, owners, blocks, docs)
        if not blocks:
            return out
        ll, doc = np.concatenate(blocks), np.concatenate(docs)
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        shares = choose_languages(ll, starts)[:, :-1]
        likeliest = np.add.reduceat(ll[:, :-1], starts).argmax(1)
        for i, share, main in zip(doc[starts].tolist(), shares, likeliest.tolist()):
            order = np.argsort(-share, kind="stable")
            named = [(self.langs[l], float(share[l])) for l in order if share[l] > 0]
            name, score = named[0] if named else (self.langs[main], 0.0)
            out[i] = (name, min(1.0, score), named)
        return out

    def _score(self, segments, owners, blocks, docs) -> None:
        """Log likelihood of each block of grams under each language."""
        lengths = np.array([len(s) - 2 for s in segments])
        codes = gram_codes(b"".join(segments))
        first = np.concatenate([[0], np.cumsum(lengths + 2)[:-1]])
        per = -(-lengths // BLOCK)
        segment = np.repeat(np.arange(len(segments)), per)
        inner = np.arange(len(segment)) - np.repeat(np.cumsum(per) - per, per)
        starts = first[segment] + inner * BLOCK
        # Two grams that span neighbouring texts end every segment; they are taken out.
        seams = (np.cumsum(lengths + 2)[:-1, None] + [-2, -1]).ravel()
        codes[seams[seams < len(codes)]] = 0
        blocks.append(np.stack([np.add.reduceat(row[codes], starts, dtype=np.float64) for row in self.logs], 1))
        docs.append(np.array(owners)[segment])


def choose_languages(ll: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Language shares per document from block log likelihoods ``ll`` (blocks x languages).

    Shares maximise the likelihood of a mixture in which each block is of one language.  For
    each set size, up to all languages, the most likely ones are refitted; a larger set is taken only if it
    raises the log likelihood by more than the penalty, which grows with the document.  A size is
    tried while the language it adds holds half a block or more of the mixture of all.
    """
    n_langs = ll.shape[1]
    sizes = np.diff(np.r_[starts, len(ll)])
    top = ll.max(1, keepdims=True)
    like = np.exp(np.maximum(ll - top, -60))
    base = np.add.reduceat(top[:, 0], starts)
    owner = np.repeat(np.arange(len(starts)), sizes)

    def fit(shares, some):
        """Shares and log likelihood of the documents ``some``."""
        n = sizes[some]
        rows = np.flatnonzero(np.isin(owner, some)) if len(some) < len(starts) else slice(None)
        part_of, first, held = np.repeat(np.arange(len(some)), n), np.cumsum(n) - n, like[rows]
        for _ in range(ROUNDS):
            part = held * shares[part_of]
            part /= part.sum(1, keepdims=True)
            shares = np.add.reduceat(part, first) / n[:, None]
        fitted = (held * shares[part_of]).sum(1)
        return shares, np.add.reduceat(np.log(np.maximum(fitted, 1e-300)), first) + base[some]

    rows = np.arange(len(starts))
    every, _ = fit(np.full((len(starts), n_langs), 1 / n_langs), rows)
    mass = -np.sort(-every * sizes[:, None], axis=1)
    # The single best language maximises the plain sum; it heads the order of candidates.
    single = np.add.reduceat(ll, starts)
    every[rows, single.argmax(1)] += 2
    order = np.argsort(-every, axis=1, kind="stable")
    best = np.zeros_like(every)
    best[rows, order[:, 0]] = 1
    score = single.max(1)
    for k in range(2, n_langs + 1):
        some = np.flatnonzero(mass[:, k - 1] >= 0.5)
        if not len(some):
            break
        mask = np.zeros((len(some), n_langs))
        np.put_along_axis(mask, order[some, :k], 1.0, axis=1)
        shares, value = fit(mask / k, some)
        value = value - PENALTY * (k - 1) * np.log(1 + sizes[some] * BLOCK)
        better = value > score[some]
        best[some[better]], score[some[better]] = shares[better], value[better]
    best[best < 1e-6] = 0
    return best / best.sum(1, keepdims=True)


def train_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Counts over all given documents; the model's size is languages times buckets."""
    rows = gram_counts(docs, text, lang).collect()
    langs = sorted({r[0] for r in rows})
    counts = np.zeros((len(langs), BUCKETS))
    place = {name: i for i, name in enumerate(langs)}
    for name, gram, n in rows:
        counts[place[name], gram] = n
    return LanguageModel(langs, counts)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``langs`` (array of lang and share) to all columns.

    ``lang_pred`` is the learned language with the largest share of the text, ``score`` that share; text
    that a background of equally likely n-grams explains better counts for no language.
    Null texts and texts without a letter get ``und``, score 0 and an empty set, and so does
    everything when the model knows no language.  If a column of such a name exists already,
    the new one gets underscores at its end.
    """
    names = {}
    for c in ("lang_pred", "score", "langs"):
        names[c] = fresh(docs, c)
    schema = T.StructType([*docs.schema.fields, T.StructField(names["lang_pred"], T.StringType()),
                           T.StructField(names["score"], T.DoubleType()), T.StructField(
        names["langs"], T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])))])
    at = docs.columns.index(text)
    set_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            found = shared.value.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                pa.array([[{"lang": name, "share": s} for name, s in f[2]] for f in found], set_type),
            ], [*batch.schema.names, *names.values()])

    return docs.mapInArrow(predict, schema)


def keep_known(docs: DataFrame, model: LanguageModel, text: str = "text", least_share: float = 0.34) -> DataFrame:
    """Documents with a language that makes up at least ``least_share`` of the text, all columns.

    A text half in one language and half in another is kept; one in equal pieces of three or more
    is not, nor one of which the background holds more than ``1 - least_share``.
    """
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    found = identify(plain, model, f"c{columns.index(text)}")
    return found.filter((F.col("lang_pred") != NO_LANGUAGE) & (F.col("score") >= least_share)) \
        .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
