import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickforge.llm import bpe, token_files
from tickforge.llm.queries import QUERIES
from tickforge.llm.subwords import ChunkedBPE, WordBPE
from tickforge.session import scratch_path

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "B", "é", "ß", "İ", "Σ", "σ", "'", "'s", "'ll", "1", "²", "½", " ", " ", "　", "語",
         "<|endoftext|>", "<|startoftext|>", "<|", ".", "!!", "##", "́", "\x1c", "\x85", "\x00", "aaaa", "the ", "ª", "µ", "×", "😀"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 120))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}


def test_word_encoder_equals_library(library):
    coder = WordBPE(WORDS)
    for t in odd_texts(1500):
        assert coder.encode(t).tolist() == library[WORDS].encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("mean, least", [(8, 2), (64, 16), (1024, 128)])
def test_chunked_encoder_equals_library(library, mean, least):
    coder = ChunkedBPE(BYTES, public_tokenizers.PATTERN)
    coder.MEAN_CHUNK, coder.LEAST_CHUNK = mean, least
    for t in odd_texts(1500, seed=mean):
        want = library[BYTES].encode(t, add_special_tokens=False).ids
        assert coder.encode(t).tolist() == want, t
        assert coder.decode(np.array(want, np.int64)) == library[BYTES].decode(want, skip_special_tokens=False)


def test_texts_without_safe_points(library):
    coder = ChunkedBPE(BYTES, public_tokenizers.PATTERN)
    coder.MEAN_CHUNK, coder.LEAST_CHUNK = 16, 4
    rng = random.Random(5)
    for t in ("".join(rng.choice("abcé") for _ in range(3000)), "\n" * 500 + "x", " " * 700, "a" * 30_000):
        assert coder.encode(t).tolist() == library[BYTES].encode(t, add_special_tokens=False).ids


def test_shared_chunks_are_encoded_once():
    coder = ChunkedBPE(BYTES, public_tokenizers.PATTERN)
    shared = " ".join(f"term{i} value{i * 7}" for i in range(2000))
    coder.encode(shared)
    before = coder.made
    coder.encode("Another beginning of some length. " + shared + " And another end.")
    assert coder.made - before <= 6


def test_op10_equals_library(spark, sf_dir, documents, library):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for r in QUERIES["op10_bpe"](spark, sf_dir).collect():
        ids = library[BYTES].encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = library[BYTES].decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_encode_and_decode_columns(odd_docs, empty_docs, clashing_docs):
    coded = bpe.decode_ids(bpe.encode_texts(odd_docs, BYTES), BYTES)
    assert all(r["decoded"] == (r["text"] or "") for r in coded.collect())
    assert bpe.encode_texts(empty_docs, BYTES).count() == 0 and bpe.encoding_digests(empty_docs, BYTES).count() == 0
    more = bpe.encode_texts(clashing_docs, BYTES)
    assert more.columns == [*clashing_docs.columns, "ids_"] and more.count() == 13
    rows = bpe.encoding_digests(clashing_docs, BYTES).collect()
    assert len(rows) == 13 and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}


def expected_stream(docs, tokenizer):
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    at, out = 0, {}
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        out[key] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return out


def test_op8_equals_library(spark, sf_dir, documents, library):
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op8_token_files"](spark, sf_dir).collect()}
    assert got == expected_stream(documents, library[WORDS])


def test_small_sequences_and_random_access(spark, documents, library):
    folder = scratch_path(spark, "tokens-test")
    files = token_files.write_tokens(documents, folder, WORDS, length=8, sequences=4)
    want = expected_stream(documents, library[WORDS])
    got = token_files.read_tokens(files, documents.schema["doc_id"].dataType).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want
    listed = files.orderBy("shard").collect()
    reader = token_files.SequenceReader(listed[0]["path"])
    n = listed[0]["tokens"]
    rows = [reader.sequence(i) for i in range(-(-n // 8))]
    assert [len(ids) for ids, _ in rows] == [8] * len(rows) and sum(int(m.sum()) for _, m in rows) == n
    flat = np.concatenate([ids[m] for ids, m in rows])
    assert np.array_equal(flat, reader.span(0, n))
    assert not rows[3][0].flags.owndata  # a view of the mapped file


def test_odd_rows_in_token_files(odd_docs, empty_docs, clashing_docs):
    rows = token_files.token_files(clashing_docs, WORDS).collect()
    assert len(rows) == 13
    order = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order][:2] == [None, None] and order[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(order, order[1:]))
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert token_files.token_files(empty_docs, WORDS).count() == 0


def test_frequent_keys_outlive_the_others():
    """A key that keeps coming is computed once, however many others pass."""
    from tickforge.llm.subwords import Generations

    asked = []
    cache = Generations(lambda k: asked.append(k) or k * 2, 10)
    for i in range(100):
        assert cache[-1] == -2 and cache[i] == 2 * i
        assert len(cache) + len(cache.old) <= 10
    assert asked.count(-1) == 1 and len(asked) == 101


def test_spellings_of_a_word_are_tokenized_once(library):
    """Case and punctuation around a word cost no further call of the merges."""
    class Counted:
        def __init__(self, model):
            self.model, self.asked = model, []

        def tokenize(self, piece):
            self.asked.append(piece)
            return self.model.tokenize(piece)

    coder = WordBPE(WORDS)
    coder.model = Counted(coder.model)
    text = "Unwonted, unwonted.\tUNWONTED! (unwonted)\n'unwonted' unwonted's unwonted7 Dürftig, DÜRFTIG"
    assert coder.encode(text).tolist() == library[WORDS].encode(text, add_special_tokens=False).ids
    assert len(coder.model.asked) == len(set(coder.model.asked)) and not coder.chunks
    odd = text + " 語 <|endoftext|> unwonted"
    assert coder.encode(odd).tolist() == library[WORDS].encode(odd, add_special_tokens=False).ids
    assert coder.model.asked.count("unwonted") == 1


def test_plain_texts_equal_library(library):
    """Texts that take the way for plain characters, with all white space and contractions."""
    parts = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "a", "B", "Zz", "é", "É", "ß", "ÿ", "'", "'s", "'LL", "'re", "1", "23", ",", "..", "<", "|", "the"]
    coder, rng = WordBPE(WORDS), random.Random(8)
    for _ in range(1500):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert coder.encode(t).tolist() == library[WORDS].encode(t, add_special_tokens=False).ids, t
    assert not coder.chunks
