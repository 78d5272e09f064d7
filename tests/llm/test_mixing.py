import pytest
from helpers import awkward_rows, clashing, table, words

from gleanwell.llm import mixing


def expected_targets(rows):
    """Shares by weight, cut at three times the source, the excess shared again."""
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return sizes, target


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_copies(spark, seed):
    rows = [r for r in awkward_rows(seed, 150) if len(r[1] or "") < 10_000]
    sizes, target = expected_targets(rows)
    got = mixing.copies(clashing(spark, rows)).collect()
    assert len(got) == len(rows)
    taken = {}
    by_key = {(r[0], len(words(r[1]))): r[3] for r in rows}
    for r in got:
        source = by_key[r.doc_id, r.size]
        if r.doc_id not in (5, 7):  # ids that several rows share
            assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        goal = (r.source_size, r.target)
        taken[goal] = taken.get(goal, 0) + r.taken
    assert sum(r.size for r in got) == sum(sizes.values())
    for (_, goal), words_taken in taken.items():
        assert abs(words_taken - goal) <= 45


def test_reruns_agree(spark):
    docs = table(spark)
    first, again = (sorted(map(repr, mixing.copies(docs).collect())) for _ in range(2))
    assert first == again


def test_documents_as_often_as_taken(spark):
    docs = clashing(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in mixing.copies(docs).collect())


def test_empty(spark):
    assert mixing.copies(table(spark, [])).collect() == []
    only_empty = mixing.copies(table(spark, [(1, None, None, "a", 1), (2, "", None, None, 1)])).collect()
    assert [r.taken for r in only_empty] == [0, 0]
