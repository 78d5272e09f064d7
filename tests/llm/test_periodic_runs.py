import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from helpers import CLASHING, awkward_rows, clashing, same, table, words

from gleanwell.llm import periodic_runs


def brute_runs(text):
    """Stretches of equal words q apart for every q, the smallest q of each stretch."""
    n, found = len(text), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and text[j] == text[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, rewritten=True):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if rewritten and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in dropped)
    best = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[0] if runs else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def repetitive(rnd, size):
    text = []
    while len(text) < size:
        unit = [rnd.randrange(rnd.choice([2, 3, 1000])) for _ in range(rnd.choice([1, 2, 3, 5, 8, 15, 16, 17, 50]))]
        text += unit * rnd.choice([1, 1, 2, 3, 4, 7])
        if rnd.random() < 0.3:
            del text[-rnd.randint(1, 5) :]
    return text


def test_runs_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(120):
        texts = [repetitive(rnd, rnd.randint(0, 400)) for _ in range(rnd.randint(1, 5))]
        assert periodic_runs.runs_of([np.array(t, dtype=np.int64) for t in texts]) == [brute_runs(t) for t in texts]


def test_transform_is_exact():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 3, size=400).astype(np.uint64)
    padded = np.concatenate([x, np.full(200, 7, dtype=np.uint64)])
    for block, first, count in ((8, 1, 15), (16, 16, 16), (32, 32, 32)):
        at, distance = periodic_runs.seeds(padded, 400, block, first, count)
        want = [(b, d) for b in range(0, 400 - block + 1, block) for d in range(first, first + count)
                if (padded[b : b + block] == padded[b + d : b + d + block]).all()]
        assert list(zip(at.tolist(), distance.tolist())) == want


def test_rows_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [r for r in awkward_rows() if len(r[1] or "") < 10_000]
    rows += [(300 + i, " ".join(map(str, repetitive(rnd, rnd.randint(20, 300)))), "en", "a", 1) for i in range(40)]
    got = periodic_runs.document_runs(clashing(spark, rows), rewrite=periodic_runs.tiled)
    assert not set(got.columns) & set(CLASHING) - {"start"}
    assert same([tuple(r) for r in got.collect()], [brute_row(r[0], r[1]) for r in rows])


def test_very_long_texts(spark):
    texts = ["long " * 30_000, "a b " * 20_000 + "c", "\n".join(str(i) for i in range(30_000))]
    got = {r.doc_id: r for r in periodic_runs.document_runs(table(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])).collect()}
    assert (got[0].n_runs, got[0].start, got[0].length, got[0].period) == (1, 0, 30_000, 1)
    assert (got[1].n_runs, got[1].length, got[1].period, got[1].exponent_milli) == (1, 40_000, 2, 20_000_000)
    assert got[1].collapsed_sha256 == hashlib.sha256(b"a b c").hexdigest()
    assert (got[2].n_runs, got[2].start, got[2].exponent_milli) == (0, None, None)


def test_empty(spark):
    assert periodic_runs.document_runs(table(spark, [])).collect() == []
