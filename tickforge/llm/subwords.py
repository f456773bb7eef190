"""Encoders of public BPE vocabularies that reuse what they have already encoded."""

from __future__ import annotations

import hashlib
import os
import re
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_ENTRIES = 400_000
#: Characters on which all pattern engines agree: printable ASCII and Latin-1 letters.
PLAIN_CHUNK = re.compile("[!-~À-ÖØ-öø-ÿ]*")
# The same and the white space that ends chunks.
PLAIN_TEXT = re.compile("[!-~À-ÖØ-öø-ÿ\t-\r ]*")
# The split pattern of the vocabulary on lower-cased plain texts.
PLAIN_PIECE = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\\sa-z0-9ß-öø-ÿ]+")

_loaded: dict = {}


def load(path: str):
    """The library's tokenizer of a vocabulary file, without truncation and padding."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[path] = tokenizer
    return _loaded[path]


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Bounded(dict):
    """A cache that starts anew when it is full."""

    def __init__(self, compute, most: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class Generations(dict):
    """A cache in two generations: when the young one is full it becomes the old one.

    What is used again moves back to the young one, so frequent keys stay for good and the
    rest goes; both together hold ``most`` entries at most.
    """

    def __init__(self, compute, most: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.most = compute, most
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.compute(key)
        if 2 * len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBPE:
    """Ids of a lower-casing word vocabulary whose pre-tokens never span white space.

    ``encode`` equals the library's encoding of the whole text: each chunk between white space
    is encoded once, from its lower-case pieces where it consists of plain characters, by the library
    as a whole otherwise.  Texts of plain characters are lower-cased as a whole and need no other check.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = Generations(self._plain)
        self.chunks = Generations(self._chunk)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")

    def _plain(self, chunk: str) -> bytes:
        """Ids of a plain chunk or piece in lower case; a word and the same word before a comma share the word's."""
        if not chunk.isalpha():
            pieces = PLAIN_PIECE.findall(chunk)
            if len(pieces) > 1:
                return b"".join(map(self.plain.__getitem__, pieces))
        mapped = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(self.letters)
        return array(self.dtype.char, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _chunk(self, data: bytes) -> bytes:
        chunk = data.decode()
        if PLAIN_CHUNK.fullmatch(chunk) and not any(s in chunk for s in self.specials):
            return self.plain[chunk.lower()]
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> np.ndarray:
        # White space ends every pre-token, so texts can be encoded chunk by chunk.  Bytes are split at ASCII white space only.
        if PLAIN_TEXT.fullmatch(text) and not any(s in text for s in self.specials):
            found = map(self.plain.__getitem__, text.lower().split())
        else:
            found = map(self.chunks.__getitem__, text.encode().split())
        return np.frombuffer(b"".join(found), self.dtype)


class ChunkedBPE:
    """Byte-level BPE by content-defined chunks that are encoded once and joined again.

    A rolling hash over 16 bytes cuts a text into chunks; equal stretches of different documents
    give equal chunks, whose ids come from a cache.  Where two chunks meet, the bytes
    from the last safe point of the left chunk to the first one of the right chunk are encoded
    anew, and the stretch is widened until both chunks have a token boundary at its ends.  A
    safe point is a space before a visible ASCII character: there every pre-token ends, whatever stands
    around it, so agreement at both ends makes the ids those of the whole text.
    """

    MEAN_CHUNK = 1024
    LEAST_CHUNK = 128
    LONG_PIECE = 20_000
    #: About 8 MB of text with its ids, four times that in memory.
    CACHED_CHUNKS = 8_000
    RARE = re.compile("[^\x00-ɏ]")

    def __init__(self, path: str, ranks_pattern: str):
        import tiktoken

        self.tokenizer = load(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        ordinary = {token: i for token, i in vocabulary.items() if token not in self.special}
        self.bytes_of = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, i in ordinary.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of])
        self.plain = tiktoken.Encoding(
            "chunks", pat_str=ranks_pattern, special_tokens={},
            mergeable_ranks={self.bytes_of[i]: i for i in ordinary.values()})
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.chunks = Bounded(self._encode_piece, self.CACHED_CHUNKS)
        self.hits = self.made = 0
        rng = np.random.default_rng(10)
        self.gear = rng.integers(0, 1 << 32, 256, dtype=np.uint32)

    def _encode_piece(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a stretch on its own, and the byte position after each token."""
        text = data.decode()
        if self.RARE.search(text) or (len(data) > self.LONG_PIECE and max(map(len, re.split(r"\s", text))) > self.LONG_PIECE):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        else:
            ids = np.array(self.plain.encode_ordinary(text), np.int32)
        self.made += 1
        return ids, np.cumsum(self.lengths[ids], dtype=np.int64 if len(data) >> 31 else np.int32)

    def cuts(self, b: np.ndarray) -> list[int]:
        """Chunk starts after the first, where the rolling hash of 16 bytes says so."""
        if len(b) <= self.LEAST_CHUNK:
            return []
        h = self.gear[b]
        for shift in (1, 2, 4, 8):
            more = h.copy()
            more[shift:] += h[:-shift] << np.uint32(shift)
            h = more
        found = np.flatnonzero((h >> np.uint32(16)) % np.uint32(self.MEAN_CHUNK) == 0) + 1
        starts, last = [], 0
        for c in found.tolist():
            while c < len(b) and b[c] & 0xC0 == 0x80:
                c += 1
            if c - last >= self.LEAST_CHUNK and c < len(b):
                starts.append(c)
                last = c
        return starts

    def encode(self, text: str) -> np.ndarray:
        if self.split_special and any(s in text for s in self.special):
            return np.concatenate([
                np.array([self.special[p]]) if p in self.special else self._encode_plain(p)
                for p in self.split_special.split(text) if p] or [np.zeros(0, np.int64)])
        return self._encode_plain(text)

    def _encode_plain(self, text: str) -> np.ndarray:
        data = text.encode()
        b = np.frombuffer(data, np.uint8)
        edges = [0, *self.cuts(b), len(data)]
        if len(edges) == 2:
            return self._ids(data)[0] if data else np.zeros(0, np.int64)
        after = b[1:]
        safe = np.flatnonzero((b[:-1] == 32) & (after > 32) & (after < 127))
        safe = np.r_[0, safe[safe > 0], len(data)]
        # done: stretches (start, end, ids, ends) whose ids hold up to their end or the next join.
        done = []
        at = 0
        for left, right in zip(edges[:-1], edges[1:]):
            if right <= at:
                continue
            ids, ends = self._ids(data[left:right])
            if not left:
                done.append((0, right, ids, ends))
                at = right
                continue
            self._join(data, safe, done, left, right, ids, ends)
            at = done[-1][1]
        return np.concatenate([d[2] for d in done])

    def _ids(self, data: bytes):
        return self.chunks[data]

    def _join(self, data, safe, done, left, right, ids, ends) -> None:
        """Appends the chunk [left, right) to ``done``, repairing the join at ``left``."""
        left = done[-1][1] if done[-1][1] > left else left
        lo = int(np.searchsorted(safe, left, "right")) - 1
        hi = int(np.searchsorted(safe, left, "left"))
        base = right - int(ends[-1])
        while True:
            start = int(safe[lo])
            while done and done[-1][0] >= start and done[-1][0] > 0:
                done.pop()
            first, _, kept, kept_ends = done[-1]
            n = int(np.searchsorted(kept_ends, start - first))
            if start == first or (n < len(kept_ends) and kept_ends[n] == start - first):
                break
            lo -= 1
        n = 0 if start == first else n + 1
        while True:
            stop = int(safe[hi])
            if stop >= right:
                m = len(ids)
                break
            m = int(np.searchsorted(ends, stop - base))
            if stop == base or ends[m] == stop - base:
                m = 0 if stop == base else m + 1
                break
            hi += 1
        done[-1] = (first, start, kept[:n], kept_ends[:n])
        stop = max(stop, right) if m == len(ids) and stop > right else stop
        if stop > start:
            seam, seam_ends = self._ids(data[start:stop])
            done.append((start, stop, seam, seam_ends))
        if m < len(ids):
            done.append((stop, right, ids[m:], ends[m:] - (stop - base)))

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, special tokens included."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode(errors="replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        ids = self.encode(text)
        return (
            len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(self.decode(ids).encode()).hexdigest(),
        )
