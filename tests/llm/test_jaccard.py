import math
import random
from collections import defaultdict

import numpy as np
import pytest

from prosemill.llm import jaccard_join as J
from prosemill.llm.components import components
from prosemill.llm.decontamination import words_of
from tests.conftest import rows
from tests.llm.common import AWKWARD, awkward, empty, random_text


def shingle_set(text):
    words = words_of(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(pairs):
    """Class and links of each row by comparing all sets."""
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[shingle_set(text)].append(doc_id)
    sets = [s for s in groups if s]
    parent, links = list(range(len(sets))), [0] * len(sets)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= 0.8 * (len(a) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    best = defaultdict(list)
    for i, s in enumerate(sets):
        best[root(i)] += [x for x in groups[s] if x is not None]
    out = []
    for i, s in enumerate(sets):
        known = best[root(i)]
        out += [(x, min(known) if known else None, links[i]) for x in groups[s]]
    return out + [(x, x, 0) for x in groups[frozenset()]]


def near_copies(count, seed, length=120, edits=6):
    """Texts that differ from one text in a few words, so some pairs are links and some are not."""
    rng = random.Random(seed)
    base = random_text(seed, length).split()
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(length)] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus():
    texts = near_copies(150, 1, edits=4) + near_copies(12, 2) + near_copies(4, 3, 30, 1) + [random_text(100 + i, 60) for i in range(60)]
    passage = random_text(9, 60)
    texts += [f"{passage} {random_text(500 + i, 45)}" for i in range(40)]  # a shared passage is no link
    texts += [texts[0]] * 30 + [texts[0].upper().replace(" ", ", ")] + ["one two three"] * 2 + ["One two, three!", "one two four"]
    pairs = list(enumerate(texts))
    random.Random(0).shuffle(pairs)
    return pairs


@pytest.mark.parametrize("blocks", [(512, 2 << 20), (16, 9_000)])
def test_classes_and_links_against_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(J, "BLOCK_NODES", blocks[0])
    monkeypatch.setattr(J, "BLOCK_BYTES", blocks[1])
    pairs = corpus()
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    got, want = rows(J.jaccard_report(df), "doc_id", "class_id", "n_links"), brute(pairs)
    assert sorted(got) == sorted(want)
    assert max(r[2] for r in want) > 60 and len({r[1] for r in want}) > 100


def test_awkward_rows(spark):
    got = rows(J.jaccard_report(awkward(spark)), "doc_id", "class_id", "n_links")
    assert sorted(got, key=str) == sorted(brute(AWKWARD), key=str)
    kept = J.one_per_class(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted((r[0] or 0) for r in rows(kept, "doc_id")) == [0, 1, 2, 3, 4, 5, 8, 9, 10, 11, 12]
    assert J.jaccard_report(empty(spark)).count() == 0


def test_pruning_rule():
    """The posterior by adding up the beta density must be below the tolerance just under the bound."""
    chance = J.THRESHOLD + (1 - J.THRESHOLD) / 256
    grid = np.linspace(0, 1, 200_001)[1:-1]
    for n, least in J.LEAST:
        for m, below in ((least - 1, True), (least, False)):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(log - log.max())
            share = density[grid >= chance].sum() / density.sum()
            assert (share < J.TOLERANCE) == below
    assert 1 - (1 - J.THRESHOLD**J.ROWS) ** J.BANDS > 1 - 1e-7 and math.isclose(J.HASHES, J.BANDS * J.ROWS)


def test_surviving_pairs_keep_links():
    texts = near_copies(40, 5)
    table = np.frombuffer(b"".join(J.signature(t)[2] for t in texts), np.uint8).reshape(len(texts), J.HASHES)
    a, b = np.triu_indices(len(texts), 1)
    kept = set(zip(*map(np.ndarray.tolist, J.surviving(table, a, b)), strict=True))
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = shingle_set(texts[i]), shingle_set(texts[j])
        assert len(x & y) / len(x | y) < 0.8 or (i, j) in kept


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 700)]
    df = spark.createDataFrame([*chain, *star, (7, 7), (9, 8)], "a long, b long").repartition(6)
    got = dict(rows(components(df), "node", "label"))
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(500, 700), 500), 8: 8, 9: 8}


@pytest.mark.parametrize("order", ["shuffled", "falling"])
def test_components_of_long_chains(spark, order):
    """Chains whose numbers do not rise along them: 0-1199-1198-...-1, and one in any order."""
    numbers = list(range(1, 1200))[::-1]
    if order == "shuffled":
        random.Random(4).shuffle(numbers)
    chain = [0, *numbers]
    df = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "a long, b long").repartition(4)
    assert dict(rows(components(df), "node", "label")) == dict.fromkeys(range(1200), 0)
    a, b = np.array(chain[:-1]), np.array(chain[1:])
    assert (J.roots(1200, a, b) == 0).all()


def test_few_long_copies_in_many_blocks(spark, monkeypatch):
    """Pairs of near copies that give as many blocks as nodes, so that half of them share one: each
    link counts once."""
    monkeypatch.setattr(J, "BLOCK_BYTES", 3_000)
    texts = [f"{random_text(700 + i // 2, 400)} new{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(rows(J.jaccard_report(df), "doc_id", "class_id", "n_links")) == [(i, i // 2 * 2, 1) for i in range(40)]


def test_no_pairs_beside_an_empty_block():
    for second in ([False] * 3, [True] * 3):
        assert not list(J.block_pairs(np.array(second), True))
    assert sum(len(a) for a, _ in J.block_pairs(np.array([False] * 3), False)) == 3


def test_links_between_different_texts(spark):
    """Different texts with the same set are linked to each other, and each counts for a third one."""
    base = random_text(801, 60)
    other = random_text(803, 60)
    texts = [base, base.upper(), base.replace(" ", ", "), base, f"{base} more", f"{base} more", other, other.upper(), random_text(802, 60), "", None]
    different = sorted({t for t in texts if t})
    likes = {t: sum(len(shingle_set(t) & shingle_set(u)) >= 0.8 * len(shingle_set(t) | shingle_set(u)) for u in different if u != t) for t in different}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = dict(rows(J.jaccard_report(df), "doc_id", "n_text_links"))
    assert got == {i: likes.get(t, 0) for i, t in enumerate(texts)}
    assert [got[i] for i in (0, 1, 4, 6, 8)] == [3, 3, 3, 1, 0]


def forms(count, places):
    """Short texts that differ from one text in one word; two are a link if that word stands at the same place."""
    base = [f"w{k}" for k in range(60)]
    return [" ".join([*base[: places[i % len(places)]], f"new{i}", *base[places[i % len(places)] + 1 :]]) for i in range(count)]


def test_many_short_copies_by_formula(spark):
    """One form letter in thousands of variants: every block is full, all links are counted."""
    places = [10, 10, 40]
    df = spark.createDataFrame(list(enumerate(forms(3000, places))), "doc_id long, text string").repartition(4)
    got = rows(J.jaccard_report(df), "doc_id", "class_id", "n_links", "n_text_links")
    assert sorted(got) == [(i, 2 if i % 3 == 2 else 0, n := 999 if i % 3 == 2 else 1999, n) for i in range(3000)]


def test_blocks_hold_bounded_runs_of_pairs(monkeypatch):
    monkeypatch.setattr(J, "RUN_PAIRS", 1000)
    for n in (0, 1, 2, 50, 300):
        second = np.arange(n) % 3 == 0
        for crossing in (False, True):
            runs = list(J.block_pairs(second, crossing))
            assert all(len(a) <= max(1000, n) for a, _ in runs)
            want = int(second.sum()) * int((~second).sum()) if crossing else n * (n - 1) // 2
            assert len({tuple(p) for a, b in runs for p in zip(a.tolist(), b.tolist(), strict=True)}) == sum(len(a) for a, _ in runs) == want


def test_labels_join_up_over_runs():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    label = np.arange(400)
    for at in range(0, 300, 7):
        label = J.joined(label, a[at : at + 7], b[at : at + 7])
    assert (label == J.roots(400, a, b)).all()
