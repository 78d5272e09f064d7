import random

import xxhash
from helpers import awkward_rows, clashing, table

from gleanwell.llm import graph, simhash


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                group[top(a)] = top(b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return [(r[0], f"{p:016x}", least.get(top(i))) for i, (r, p) in enumerate(zip(rows, prints))], len({top(i) for i in range(len(rows))})


def near_copies(seed=1):
    rnd = random.Random(seed)
    rows = awkward_rows()
    base = [f"w{rnd.randint(0, 999)}" for _ in range(400)]
    for i in range(80):
        text = list(base if i % 2 else base[::-1])
        for _ in range(rnd.randint(0, 3)):
            text[rnd.randrange(len(text))] = f"v{i}"
        rows.append((1000 - i, " ".join(text), "en", "s", 0))
    return rows


def test_components(spark):
    rows = near_copies()
    got = [tuple(r) for r in simhash.components(clashing(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_force(rows)[0]))
    assert any(r[0] != r[2] for r in got)


def test_links_are_all_pairs_within_two_bits(spark):
    rnd = random.Random(7)
    prints = {rnd.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1}
    for p in list(prints):
        prints |= {p ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(8)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}


def test_one_of_each(spark):
    rows = [r for r in near_copies() if r[0] is not None or r[1]]
    expected, groups = brute_force(rows)
    out = simhash.one_of_each(clashing(spark, rows))
    assert out.columns == clashing(spark, []).columns and out.count() == groups
    assert {r.doc_id for r in out.collect() if r.doc_id is not None} == {e[2] for e in expected if e[2] is not None}


def test_long_chains_are_one_component(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    roots = {r.node: r.root for r in graph.contracted(pairs).collect()}
    assert all(roots[i] == 0 for i in range(1, 201)) and roots[501] == 500


def test_empty(spark):
    assert simhash.components(table(spark, [])).collect() == []
    assert simhash.one_of_each(table(spark, [])).collect() == []
