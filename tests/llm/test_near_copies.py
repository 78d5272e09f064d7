import random

import corpus_pipeline
from helpers import awkward_rows, clashing, table

from gleanwell.llm import near_copies


def plain_runs(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_force(rows):
    """The smallest id of every group, None for a group without ids, and the number of linked pairs of sets."""
    sets = [plain_runs(r[1]) for r in rows]
    group, pairs = list(range(len(rows))), 0

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                pairs += sets[a] != sets[b]
                group[top(a)] = top(b)
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(top(i), []).append(r[0])
    return sorted((min((i for i in ids if i is not None), default=None) for ids in least.values()), key=repr), pairs


def edited(seed=3):
    """Two bases, a frequent passage, chains of edits and copies with words replaced here and there."""
    rnd = random.Random(seed)
    words = lambda n: [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]
    common, rows = words(30), awkward_rows()
    for base in (words(150), words(90) + common):
        for i in range(40):
            text = list(base)
            for _ in range(rnd.randint(0, 6)):
                text[rnd.randrange(len(text))] = f"v{rnd.randint(0, 10**6)}"
            rows.append((1000 + len(rows), " ".join(text[: len(text) - rnd.randint(0, 20)]), "en", "s", 0))
    rows += [(2000 + i, " ".join(common + words(40)), "en", "s", 0) for i in range(20)]
    chain = words(100)
    for i in range(12):
        chain = chain[3:] + words(3)
        rows.append((3000 - i, " ".join(chain), "en", "s", 0))
    rnd.shuffle(rows)
    return rows


def test_groups_equal_brute_force(spark, monkeypatch):
    for seed, few in ((3, near_copies.FEW), (4, 10)):
        monkeypatch.setattr(near_copies, "FEW", few)  # the second needs further turns
        rows = edited(seed)
        expected, pairs = brute_force(rows)
        out = near_copies.one_of_each(clashing(spark, rows))
        assert out.columns == clashing(spark, []).columns and pairs > 100
        assert sorted((r.doc_id for r in out.collect()), key=repr) == expected


def test_parity_bits_refuse_no_similar_pair():
    rnd = random.Random(8)
    for _ in range(300):
        a = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([3, 60, 130, 520, 1100]))]
        b = list(a[: rnd.randint(max(1, 4 * len(a) // 5), len(a))])
        for _ in range(rnd.randint(0, 1 + len(a) // 40)):
            b[rnd.randrange(len(b))] = f"v{rnd.randint(0, 9)}"
        x, y = (near_copies.shingle_hashes(" ".join(t).encode()) for t in (a, b))
        apart = len(set(x.tolist()) ^ set(y.tolist()))
        assert near_copies.differing(near_copies.parity_bits(x), near_copies.parity_bits(y)) <= apart


def test_long_different_texts_and_a_frequent_shingle(spark):
    rnd = random.Random(9)
    long = [[f"w{rnd.randint(0, 10**6)}" for _ in range(6000)] for _ in range(3)]
    long.append(long[0][:3000] + ["z"] * 20 + long[0][3020:])
    common = [f"c{i}" for i in range(12)]
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(long)]
    rows += [(100 + i, " ".join([f"u{i}"] + common + [f"x{i}"]), "en", "s", 0) for i in range(300)]
    expected, pairs = brute_force(rows)
    assert sorted((r.doc_id for r in near_copies.one_of_each(table(spark, rows)).collect()), key=repr) == expected


def test_simhash_proposes_texts_that_are_nearly_the_same(spark):
    rnd = random.Random(10)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(3000)]
    rows = [(i, " ".join(base[:i] + [f"v{i}"] + base[i + 1 :])) for i in range(0, 3000, 600)]
    rows += [(5000, " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(3000)))]
    nodes = near_copies.described(spark.createDataFrame(rows, "node long, text string"))
    found = {tuple(r) for r in near_copies.likely(near_copies.same_prints(nodes), nodes).collect()}
    assert found and all(b < 5000 for _, b in found)


def test_stage_removes_a_copy_with_a_few_words_changed(spark):
    rnd = random.Random(5)
    text = [f"w{rnd.randint(0, 10**6)}" for _ in range(200)]
    near, far = list(text), list(text)
    near[20], near[90], near[150] = "x", "y", "z"
    far[10::20] = ["x"] * len(far[10::20])
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate((text, near, far))]
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, table(spark, rows), "").collect()) == [0, 2]


def test_a_group_of_some_hundred_near_copies_is_joined_in_turns(spark, monkeypatch):
    rnd = random.Random(12)
    words = lambda n: [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]
    base, texts = words(300), []
    for i in range(400):  # texts of one edit are similar to all, texts of five only to those
        text = list(base)
        for at in rnd.sample(range(300), rnd.choice([1, 5, 5])):
            text[at] = f"v{rnd.randint(0, 10**6)}"
        texts.append((i, " ".join(text)))
    met, likely = [], near_copies.likely

    def counted(pairs, nodes):
        met.append(pairs.count())
        return likely(pairs, nodes)

    monkeypatch.setattr(near_copies, "likely", counted)
    near_copies.links(spark.createDataFrame(texts, "node long, text string")).count()
    assert met[-1] < 4000, met  # of 79,800 pairs


def test_rows_are_exchanged_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = near_copies.one_of_each(table(spark, [(1, "a b", "en", "s", 0), (1, "a b", "en", "s", 0), (None, "c", "en", "s", 0)]))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, plan  # the rows and the keys that stay
        assert out.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_empty(spark):
    assert near_copies.one_of_each(table(spark, [])).collect() == []
