import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from prosemill.llm.catalog import WORD_END, WORD_MODEL, tokenizer_file
from prosemill.llm.shared import new_folder
from prosemill.llm.token_files import SHARDS, WordEncoder, open_image, read_token_files, write_token_files
from prosemill.llm.wavelet import WaveletMatrix
from tests.conftest import rows
from tests.llm.common import AWKWARD, awkward, documents, empty

PARTS = ["a", "B", " ", "\n", "é", "\t", "\r", ";", ")", "中", "Σ", "😀", "aaa", "the", "<|endoftext|>", "́", "0", "'s", "don't",
         "It's", "'", "\x00", "\x1c", "\x1f", "\x85", "\xa0", " ", "\x0b", "İ", "ß", "!", "a.", "É,"]


@pytest.mark.parametrize(("size", "kinds"), [(0, 1), (1, 1), (5, 1), (64, 64), (128, 3), (1500, 7), (70_000, 900)])
def test_wavelet_matrix(size, kinds):
    random_ = np.random.default_rng(size)
    tokens = random_.integers(0, kinds, size) * 7 + 3
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.of(tokens).to_bytes())
    assert (matrix.tokens() == tokens).all()
    assert matrix.count(2) == 0
    if size:
        at = random_.integers(0, size, 50)
        assert (matrix.access(at) == tokens[at]).all()
        token = int(tokens[size // 2])
        assert matrix.rank(token, size // 2) == (tokens[: size // 2] == token).sum()
        places = np.flatnonzero(tokens == token)
        assert matrix.count(token) == len(places)
        assert matrix.select(token, len(places) - 1) == places[-1]
        assert (matrix.occurrences(token)[:20] == places[:20]).all() if size < 2000 else True
        with pytest.raises(IndexError):
            matrix.select(token, len(places))


def test_words_are_encoded_as_the_library_encodes_texts():
    rng = random.Random(7)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(4000)]
    texts += [d["text"] for d in documents()] + [t or "" for _, t in AWKWARD]
    data = tokenizer_file(WORD_MODEL)
    want = Tokenizer.from_buffer(data).encode_batch(texts, add_special_tokens=False)
    for got, ids in zip(WordEncoder(data).encode(texts, WORD_END), want, strict=True):
        assert got.tolist() == [*ids.ids, WORD_END]


def expected(pairs):
    library = Tokenizer.from_buffer(tokenizer_file(WORD_MODEL))
    start, out = 0, []
    for doc_id, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, WORD_END]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_files_round_trip(spark, shard_tokens):
    path = new_folder(spark, "test_files")
    write_token_files(awkward(spark), tokenizer_file(WORD_MODEL), WORD_END, path, shard_tokens)
    got = rows(read_token_files(spark, path), "doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(got, key=lambda r: r[1]) == expected(AWKWARD)
    for row in spark.read.schema(SHARDS).parquet(path).collect():
        ids, lengths, matrix = open_image(row["image"])
        assert len(ids) == len(lengths) and lengths.sum() == matrix.n == row["n_tokens"]
        assert matrix.count(WORD_END) >= len(ids)


def test_no_documents(spark):
    path = new_folder(spark, "test_files")
    write_token_files(empty(spark), tokenizer_file(WORD_MODEL), WORD_END, path)
    assert read_token_files(spark, path).count() == 0


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_each_stem_and_tail_is_learned_once(monkeypatch, bound):
    """Whatever the forms of a word, the library is asked for its letters and its marks only; with
    and without a memory, and for a model whose ids do not tell where a word ends."""
    from prosemill.llm import token_files

    monkeypatch.setattr(token_files, "REMEMBERED_BYTES", bound)
    data = tokenizer_file(WORD_MODEL)
    encoder, asked = WordEncoder(data), []
    by_library = encoder._by_library
    monkeypatch.setattr(encoder, "_by_library", lambda words: asked.extend(words) or by_library(words))
    texts = ["The  the, THE; (the) Été, été\x0bé", "", " the,, the\u2003the ", "the; the,"]
    want = [[*x.ids, WORD_END] for x in Tokenizer.from_buffer(data).encode_batch(texts, add_special_tokens=False)]
    for marked in (True, False):
        asked.clear()
        encoder._forget()
        encoder.ends &= marked
        for _ in range(2):
            assert [t.tolist() for t in encoder.encode(texts, WORD_END)] == want
        once = ["the", "(the)", "Été", "été", "é", "the\u2003the", ",", ";", ",,"]
        assert Counter(asked) == Counter(once * (1 if bound else 2))
