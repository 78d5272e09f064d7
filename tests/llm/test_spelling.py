import random
import re
import zlib
from collections import Counter

import pytest
from helpers import awkward_rows, clashing, same, table

from gleanwell.llm import spelling


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows, slip=True):
    counts = Counter()
    for doc_id, text in ((r[0], r[1] or "") for r in rows):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if slip and h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()]


def misspelled(seed=2, n=120):
    rnd = random.Random(seed)
    known = ["balloon", "ballooon", "aaaaaa", "aaaaaaa", "banana", "bananas", "ÉTÉÀÿéß", "réseau", "straße", "wordy-worded", "mississippi"]
    known += ["".join(rnd.choice("abé") for _ in range(rnd.randint(6, 9))) for _ in range(30)]
    weights = [5 ** rnd.randint(0, 4) for _ in known]
    rows = awkward_rows()
    for i in range(n):
        chosen = []
        for w in rnd.choices(known, weights, k=300):
            if rnd.random() < 0.15:
                at, kind = rnd.randrange(len(w)), rnd.randrange(3)
                w = w[:at] + ("" if kind == 0 else rnd.choice("ab")) + w[at + (kind != 2) :]
            chosen.append(rnd.choice([w, w.upper(), w + "1", w + ","]) if rnd.random() < 0.2 else w)
        rows.append((500 + i, " ".join(chosen), "en", "a", 1))
    return rows + [rows[-1]]


@pytest.mark.parametrize("max_state", [1000, 3, 0])
def test_rows_equal_brute_force(spark, max_state):
    rows = misspelled()
    got = spelling.variants(clashing(spark, rows), spelled=spelling.slipped, max_state=max_state)
    want = brute_force(rows)
    assert len(want) > 200 and sum(r[1] is not None for r in want) > 50
    assert same([tuple(r) for r in got.collect()], want)


def test_acceptor_is_minimal_and_its_pairs_are_all():
    rnd = random.Random(4)
    for _ in range(50):
        words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.choice([4, 5]))) for _ in range(rnd.randint(1, 30))})
        acceptor = spelling.Acceptor(words)
        found = sorted(tuple(sorted(p)) for p in acceptor.pairs())
        assert found == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))
    ends = spelling.Acceptor(sorted(x + y for x in ("ab", "cd", "ef") for y in ("ing", "ed")))
    assert len(ends.states) == 9  # 1 start, 3 first letters, 1 after two letters, i and n, e, end


def test_chains_lead_to_the_last_form(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("x", "y")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(pairs, "word string, form string")).collect()}
    assert got == {"a": "f", "b": "f", "c": "f", "d": "f", "e": "f", "x": "y"}


def test_very_long_words(spark):
    long = ["a" * 20_000, "a" * 20_001, "ab" * 10_000, "a" * 19_999 + "b"]
    rows = [(i, " ".join(w for w in long for _ in range(5)), "en", "a", 1) for i in range(2)]
    got = {len(r.word) * (1 if r.word[-2:] == "aa" else -1) + (r.word[1] == "b"): r for r in spelling.variants(table(spark, rows)).collect()}
    assert sorted((k, r.n, r.n_near, r.form) for k, r in got.items()) == [
        (-20_000, 10, 1, None), (-19_999, 10, 0, None), (20_000, 10, 2, None), (20_001, 10, 1, None)]


def test_empty(spark):
    assert spelling.variants(table(spark, [])).collect() == []
    assert spelling.variants(table(spark, [(1, None, None, None, None)])).collect() == []
