import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward_rows, clashing, table, words

from gleanwell.llm import repeats


def brute_force(rows, window):
    split = [(r[0], words(r[1])) for r in rows]
    count = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for doc, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def test_production_window(spark):
    rnd = random.Random(1)
    passage = [f"p{i}" for i in range(70)]
    rows = awkward_rows()
    for i in range(40):
        text = [f"w{rnd.randint(0, 9999)}" for _ in range(rnd.randint(10, 120))]
        at = rnd.randint(0, len(text))
        first = rnd.randint(0, 40)
        text[at:at] = passage[first : first + rnd.randint(20, 70)]
        rows.append((300 + i, " ".join(text), "en", "s", 0))
    got = sorted(repr(tuple(r)) for r in repeats.without_repeats(clashing(spark, rows)).collect())
    assert got == brute_force(rows, repeats.WINDOW)


@pytest.mark.parametrize("window", [1, 2, 5, 8, 20])
def test_small_alphabets(spark, window):
    rnd = random.Random(window)
    rows = [(rnd.choice([i, None, 3]), " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 30))) if rnd.random() > 0.05 else None, "en", "s", 0) for i in range(50)]
    rows += [(100, "x " * 80, "en", "s", 0), (101, "x " * 20, "en", "s", 0), (102, rows[5][1], "en", "s", 0), (102, rows[5][1], "en", "s", 0)]
    got = sorted(repr(tuple(r)) for r in repeats.without_repeats(table(spark, rows), window=window).collect())
    assert got == brute_force(rows, window)


def test_paths_are_whole_passages(spark):
    a, b, c = ([f"{x}{i}" for i in range(60)] for x in "abc")
    rows = [(1, " ".join(a + b), "en", "s", 0), (2, " ".join(a + c), "en", "s", 0), (3, " ".join(c + a), "en", "s", 0)]
    found = repeats.RepeatGraph(table(spark, rows)).paths().collect()
    assert sorted((r.n_words, r.n_places) for r in found) == [(60, 2), (60, 3)]


def test_run_hashes_tell_runs_apart():
    rnd = np.random.default_rng(0)
    word = rnd.integers(0, 2**63, 500).astype(np.uint64)
    word[200:240] = word[100:140]
    for size in (1, 2, 7, 35):
        h = repeats.run_hashes(word, size, repeats.FACTORS[0])
        assert len(h) == 500 - size + 1 and h[200] == h[100] and len(set(h.tolist())) == len(h) - (40 - size + 1)


def test_empty(spark):
    assert repeats.without_repeats(table(spark, [])).collect() == []
