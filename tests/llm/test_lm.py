import json
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prosemill.llm import lm_scores as L
from prosemill.llm import recurrent as R
from prosemill.llm.frames import table
from prosemill.llm.lm_scores import lm_report, lm_scores
from tests.conftest import rows
from tests.llm.common import AWKWARD, MIDDLE, awkward, documents, empty

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), ""]


def brute(pairs):
    counts = Counter()
    for doc_id, text in pairs:
        if zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % 5 != 1:
            counts.update(words(text))
    total, distinct = counts.total(), len(counts)
    scale = np.log10(total + 0.5 * (distinct + 1))
    return [(i, len(w := words(t)), sum(counts[x] > 0 for x in w), total, sum(np.log10(counts[x] + 0.5) - scale for x in w)) for i, t in pairs]


def agree(got, want):
    key = lambda r: tuple(map(str, r[:3]))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)


COLUMNS = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score")


def test_counts_and_base_and_gain(spark):
    found = lm_report(table(spark, MIDDLE, "documents"))
    got = rows(found, *COLUMNS, "held_out", "score")
    agree([r[:5] for r in got], brute([(d["doc_id"], d["text"]) for d in documents(MIDDLE)]))
    held = [r for r in got if r[5]]
    assert sum(r[6] for r in held) > sum(r[4] for r in held)


def test_rare_words_are_joined(spark, monkeypatch):
    from prosemill.llm import lm_scores as L

    monkeypatch.setattr(L, "SENT_WORDS", 300)
    docs = documents()
    df = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "doc_id long, text string").repartition(3)
    agree(rows(lm_report(df), *COLUMNS), brute([(d["doc_id"], d["text"]) for d in docs]))


def test_without_rounds_the_model_is_the_base(spark):
    df = table(spark, MIDDLE, "documents")
    for base, score in rows(lm_scores(df, df, rounds=0), "base_score", "score")[:200]:
        assert score == pytest.approx(base, rel=1e-5)


def test_awkward_rows(spark):
    agree(rows(lm_report(awkward(spark)), *COLUMNS), brute(AWKWARD))
    assert lm_report(empty(spark)).count() == 0
    untaught = lm_scores(awkward(spark), awkward(spark).where(F.lit(False)))
    assert all(r[1] == 0 and r[2] == 0 and np.isfinite(r[3]) for r in rows(untaught, "doc_id", "n_known", "train_tokens", "score"))


@pytest.fixture
def weights():
    share = np.random.default_rng(1).random(R.SYMBOLS)
    made = R.initial(share / share.sum())
    random = np.random.default_rng(2)
    for name in ("class_out", "word_out"):
        made[name] = random.normal(0, 0.5, made[name].shape).astype(np.float32)
    return made


def test_probabilities_add_up(weights):
    states = np.random.default_rng(0).normal(size=(3, R.HIDDEN)).astype(np.float32)
    for state in states:
        found = R.log_probabilities(weights, np.repeat(state[None], R.SYMBOLS, 0), np.arange(R.SYMBOLS))
        assert np.exp(found).sum() == pytest.approx(1, abs=1e-4)


def test_texts_side_by_side_score_as_alone(weights):
    random = np.random.default_rng(5)
    texts = [(random.integers(0, R.INPUTS, n), random.integers(0, R.SYMBOLS, n)) for n in (1, 70, 3, 30, 30, 100)]
    together = R.document_scores(weights, texts)
    for text, score in zip(texts, together, strict=True):
        state, total = np.zeros((1, R.HIDDEN), np.float32), 0.0
        for x, y in zip(*text, strict=True):
            state, _ = R._step(weights, np.array([x]), state)
            total += float(R.log_probabilities(weights, state, np.array([y]))[0])
        assert score == pytest.approx(total, rel=1e-4)


def test_gradient(weights, monkeypatch):
    """The way back against differences, over one window in which texts end and begin."""
    monkeypatch.setattr(R, "LANES", 2)
    weights = {k: v.astype(np.float64) for k, v in weights.items()}
    random = np.random.default_rng(6)
    text = [(random.integers(0, R.INPUTS, n), random.integers(0, R.SYMBOLS, n)) for n in (8, 8, 5, 9, 1)]
    trainer = R.Trainer(weights)
    slopes = {}
    monkeypatch.setattr(trainer, "_update", lambda g, scale, touched: slopes.update({k: v.copy() for k, v in g.items()}))
    trainer.train(text)
    trainer.finish()
    for name in weights:
        flat = np.flatnonzero(slopes[name].reshape(-1))
        for at in random.choice(flat, 5):
            moved = []
            for step in (1e-4, -1e-4):
                other = {k: v.copy() for k, v in weights.items()}
                other[name].reshape(-1)[at] += step
                moved.append(-_exact(other, text))
            want = (moved[0] - moved[1]) / 2e-4
            assert slopes[name].reshape(-1)[at] == pytest.approx(want, rel=2e-2, abs=2e-3)


def test_lanes_train_on_every_token_once(weights, monkeypatch):
    """What goes through the windows is every text in its own order, from a fresh state; only what is
    left at the end is cut, and every window is full until then."""
    monkeypatch.setattr(R, "LANES", 3)
    monkeypatch.setattr(R, "WINDOW", 5)
    trainer, lanes, sizes = R.Trainer(weights), {}, []

    def watched(inputs, targets, goes_on, state):
        sizes.append(inputs.shape)
        for lane in range(inputs.shape[1]):
            entries = zip(inputs[:, lane].tolist(), targets[:, lane].tolist(), goes_on[:, lane].tolist(), strict=True)
            lanes.setdefault(lane, []).extend(entries)
        return state

    monkeypatch.setattr(trainer, "_window", watched)
    random = np.random.default_rng(8)
    texts = [(random.integers(0, 99, n + 1), random.integers(0, 99, n)) for n in (0, 1, 40, 3, 7, 7, 12, 1, 30, 90, 41)]
    for at in range(0, len(texts), 4):
        trainer.train(texts[at : at + 4])
    assert sizes and set(sizes) == {(5, 3)}
    before = {tuple(e) for entries in lanes.values() for e in entries if not e[2]}
    assert before <= {(int(x[0]), int(y[0]), False) for x, y in texts if len(y)}
    trainer.finish()
    got = [(x, y) for entries in lanes.values() for x, y, _ in entries]
    assert sorted(got) == sorted((x, y) for xs, ys in texts for x, y in zip(xs.tolist(), ys.tolist(), strict=False))


def _exact(weights, texts):
    total = 0.0
    for inputs, targets in texts:
        state = np.zeros((1, R.HIDDEN))
        for x, y in zip(inputs, targets, strict=True):
            state, _ = R._step(weights, np.array([x]), state)
            total += float(R.log_probabilities(weights, state, np.array([y]))[0])
    return total


def test_training_reads_every_token_once(spark, tmp_path, monkeypatch):
    """What the trainers get over all rounds is every training text, whole, as often as it occurs."""
    seen = str(tmp_path)

    class Watched(R.Trainer):
        def train(self, texts):
            super().train(texts)
            with open(f"{seen}/{uuid.uuid4().hex}", "w") as out:
                out.writelines(json.dumps([x.tolist(), y.tolist()]) + "\n" for x, y in texts)

    class Recurrent:
        Trainer = Watched

        def __getattr__(self, name):
            return getattr(R, name)

    monkeypatch.setattr(L, "R", Recurrent())
    pairs = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(n))) for i, n in enumerate([0, 1, 31, 300, 2000, 2000, 700])] + [(7, "w1 w2")] * 3
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(2)
    lm_scores(df, df)
    got = sorted(line for f in tmp_path.iterdir() for line in f.read_text().splitlines())
    counts = Counter(w.encode() for _, t in pairs for w in words(t))
    known = L.Lexicon(sorted(counts.items()), counts.total(), len(counts))
    whole = [known.symbols(w, known.placed(w)) for w in (L.tokens(t) for _, t in pairs)]
    assert got == sorted(json.dumps([x.tolist(), y.tolist()]) for x, y in whole)


def test_words_of_a_slice_are_told_apart_once(monkeypatch):
    asked = []
    monkeypatch.setattr(L, "suffix", lambda word: asked.append(word) or R.SYMBOLS + zlib.crc32(word[-2:]) % R.SUFFIXES)
    texts = ["", " Rare  rare\tA\x1cb ", "a\u00a0A \u0130 \u00e9", "\x0b\x0c\r\n", "rare known RARE \u00c9", "known"]
    known = L.Lexicon([(L.END_WORD, 6), (b"known", 2)], 20, 9)
    found = known.encoded(pa.array(["left out", *texts]).slice(1))
    assert sorted(asked) == sorted({word for text in texts for word in L.tokens(text)} - {b"known"})
    counts, rare, times = found.unsent()
    for i, text in enumerate(texts):
        split = L.tokens(text)
        want = known.symbols(split, known.placed(split))
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(found.symbols[i], want, strict=True))
        unsent = Counter(word for word in split if word != b"known")
        assert found.sizes[i] == len(split) and counts[i] == unsent.total()
        assert dict(zip(rare[i], times[i], strict=True)) == unsent
    assert known.encoded(pa.array([], pa.string())).symbols == []
