import itertools
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from prosemill.llm.catalog import PIECE_MODEL, tokenizer_file
from prosemill.llm.piece_codec import Transducer, decode_pieces, encode_pieces, machine, round_trip
from prosemill.llm.pieces import BYTE, NORMAL, UNIGRAM, UNKNOWN, _number, read_model
from prosemill.llm.token_counts import count_texts, token_counts
from tests.conftest import rows
from tests.llm.common import AWKWARD, awkward, documents, empty

PARTS = ["a", "b", " ", "  ", "\n", "é", "▁", "\t", "\r", ";", ")", "中", "梦", "😀", "aaa", "the", "<s>", "́", "0", "{", "\x00"]


@pytest.fixture(scope="module")
def data():
    return tokenizer_file(PIECE_MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_MODEL))


def samples():
    rng = random.Random(4)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    return made + [d["text"] for d in documents()] + [t or "" for _, t in AWKWARD] + ["a" * 2000, " " * 300, "    x" * 100]


def test_counts_and_ids_are_the_librarys(data, library):
    texts = samples()
    want = library.encode(texts)
    assert count_texts(data, texts) == [len(w) for w in want]
    got = machine(data).encode(texts)
    assert [g.tolist() for g in got] == want
    assert [machine(data).decode(g) for g in got] == library.decode(want)


def test_report_over_awkward_rows(spark, data, library):
    got = rows(token_counts(awkward(spark), data), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(i, len((t or "").encode()), len(ids := library.encode(t or "")), len(ids) > 4096) for i, t in AWKWARD]
    assert sorted(got, key=str) == sorted(want, key=str)
    found = rows(round_trip(awkward(spark), data))
    ids = [(i, t or "", library.encode(t or "")) for i, t in AWKWARD]
    plain = [(i, len(x), zlib.crc32(np.array(x, "<i4").tobytes()), library.decode(x) == t) for i, t, x in ids]
    assert sorted(found, key=str) == sorted(plain, key=str)
    assert token_counts(empty(spark), data).count() == 0 and round_trip(empty(spark), data).count() == 0


def test_decoding_a_table(spark, data, library):
    encoded = encode_pieces(awkward(spark), data)
    got = dict(rows(decode_pieces(encoded, data)))
    assert got[8] == AWKWARD[8][1] and got[2] == ""


def _field(number, kind, value):
    head = bytes([number << 3 | kind])
    return head + (bytes([len(value)]) + value if kind == 2 else value)


def toy(pieces, kind=UNIGRAM, fallback=False):
    """A model file with few pieces."""
    rows_ = [("<unk>", 0.0, UNKNOWN), *[(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256 if fallback else 0)], *[(p, s, NORMAL) for p, s in pieces]]
    out = b"".join(_field(1, 2, _field(1, 2, p.encode()) + _field(2, 5, struct.pack("<f", s)) + _field(3, 0, bytes([k]))) for p, s, k in rows_)
    trainer = _field(3, 0, bytes([kind])) + (bytes([(35 << 3) & 127 | 128, 2, 1]) if fallback else b"")
    return out + _field(2, 2, trainer) + _field(3, 2, _field(3, 0, b"\x01") + _field(4, 0, b"\x00"))


def test_unigram_paths_have_the_least_weight():
    pieces = [("▁", -2.0), ("a", -3.0), ("b", -3.5), ("ab", -4.0), ("▁a", -4.0), ("ba", -5.5), ("abab", -9.0), ("▁ab", -5.0)]
    model = Transducer(toy(pieces))
    score = dict(pieces)
    for text in map("".join, itertools.product("ab", repeat=6)):
        marked = "▁" + text

        def best(rest):
            if not rest:
                return 0.0
            return min(-score[p] + best(rest[len(p) :]) for p in score if rest.startswith(p))

        assert sum(-score[model.model.pieces[i]] for i in model.encode([text])[0]) == pytest.approx(best(marked))


def test_strange_characters():
    plain = Transducer(toy([("▁", -2.0), ("a", -3.0)]))
    assert plain.encode(["azza"])[0].tolist() == [1, 2, 0, 2]
    bytes_ = Transducer(toy([("▁", -2.0), ("a", -3.0)], fallback=True))
    ids = bytes_.encode(["aé"])[0].tolist()
    assert ids[-2:] == [1 + 0xC3, 1 + 0xA9] and bytes_.decode(np.array(ids)) == "aé"


def with_normaliser(data, spec):
    """The model file with other rules for characters and blanks."""
    out, at = b"", 0
    while at < len(data):
        start = at
        tag, at = _number(data, at)
        size, at = _number(data, at)
        at += size
        if tag >> 3 != 3:
            out += data[start:at]
    size, head = len(spec), b""
    while size > 127:
        head, size = head + bytes([size & 127 | 128]), size >> 7
    return out + bytes([3 << 3 | 2]) + head + bytes([size]) + spec


@pytest.mark.parametrize(("rule", "prefix", "trims"), [("nmt_nfkc", True, True), ("nmt_nfkc_cf", False, False), ("nfkc", True, False), ("identity", False, True)])
def test_rewriting_models_are_the_librarys(data, rule, prefix, trims):
    normal = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=trims)
    changed = with_normaliser(data, normal.serialized_normalizer_spec())
    library = sentencepiece.SentencePieceProcessor(model_proto=changed)
    rng = random.Random(7)
    odd = [*PARTS, "ｱﾊﾟｰﾄ", "①", "ﬁ", "e\u0301", "\u00a0", "\u200b", "\ufeff", "Ⅷ", "ABC", "ß", "\u3000", "㌔", "½", "\u00b4", "İ", "\u1e9b\u0323", "가", "\u0001"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + ["", " ", "  ", "   a   b  "]
    ours, want = Transducer(changed), library.encode(texts)
    assert [ours.normal_form(t) for t in texts[:500]] == [normal.normalize(t) for t in texts[:500]]
    got = ours.encode(texts)
    assert [g.tolist() for g in got] == want
    assert [ours.decode(g) for g in got] == library.decode(want)
    assert ours.normaliser.begins is not None or rule == "identity"


def test_models_that_would_be_read_wrongly_are_refused():
    bare = toy([("a", -1.0)])
    bare = bare[:-5] + bytes([bare[-5] + 2]) + bare[-4:] + b"\x28\x00"
    with pytest.raises(ValueError, match="bare blanks"):
        read_model(bare)
