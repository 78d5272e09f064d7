"""Facts of texts that are stored once for many posts, and word sets as bytes."""

import random

import numpy as np
import pyarrow as pa
import pytest

from gleanwell.operators import features, word_sets
from verification.fixtures import Fixtures


@pytest.fixture(scope="module")
def stored(spark):
    """Texts under repeated and missing ids, and posts that name them."""
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdez", k=draw.choice([2, 3, 4]))) for _ in range(300)]
    texts = [(i % 40, " ".join(draw.choices(words, k=draw.randint(0, 60)))) for i in range(50)]
    texts += [(40, None), (41, ""), (42, "GM http? çava free"), (None, "lost words")]
    posts = [(str(i), str(i % 7), str(draw.randint(0, 50)), draw.randrange(45)) for i in range(400)]
    posts.append((None, "3", None, None))
    return (spark.createDataFrame(texts, "doc_id long, Text string"),
            spark.createDataFrame(posts, "Hash string, Fid string, Timestamp string, doc_id long"))


@pytest.mark.parametrize("limit", [0, 5, word_sets.NUMBERED])
def test_facts_stand_in_for_texts(spark, stored, limit, monkeypatch):
    texts, posts = stored
    monkeypatch.setattr(word_sets.numbered_words, "__defaults__", (limit,))
    monkeypatch.setattr(word_sets.coded, "__defaults__", (limit,))
    facts = posts.join(features.text_facts(texts), "doc_id")
    assert "Text" not in facts.columns
    whole = posts.join(texts, "doc_id")
    want = sorted(features.user_text_features(whole, 1000).collect())  # equal times and ids may be cut anywhere
    got = sorted(features.user_text_features(facts, 1000).collect())
    assert len(got) == len(want) == 7
    for g, w in zip(got, want):
        assert g.fid == w.fid and tuple(g)[1:] == pytest.approx(tuple(w)[1:])
    assert sorted(features.post_sizes(facts).collect(), key=str) == sorted(features.post_sizes(whole).collect(), key=str)


def test_unions_are_counted_exactly():
    draw = random.Random(3)
    top = word_sets.NUMBERED - 1
    sets = [[sorted(draw.sample([0, 1, 127, 128, 129, 16383, 16384, 20000, 999999, top], draw.randint(0, 10))) for _ in range(n)] for n in (0, 1, 4, 0, 7, 2)]
    flat = [s for group in sets for s in group]
    row = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    data, ends = word_sets._packed(row, np.array([n for s in flat for n in s]), len(flat))
    coded = [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
    grouped, at = [], 0
    for group in sets:
        grouped.append(coded[at : at + len(group)])
        at += len(group)
    found = word_sets._union_sizes(pa.array(grouped, pa.list_(pa.binary())))
    assert found.tolist() == [len({n for s in group for n in s}) for group in sets]


def test_no_text_moves_with_the_posts(spark, folder):
    casts = Fixtures(spark, folder).measured_casts()
    assert "Text" not in casts.columns
    plan = features.user_text_features(casts)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.lower().split("documents.parquet")[0]
