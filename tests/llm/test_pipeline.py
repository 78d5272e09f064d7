import corpus_pipeline
import pytest
from helpers import awkward_rows, clashing
from test_near_copies import brute_force

from gleanwell.llm import queries
from verification.compare import differences

CORPUS = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage gets and gives, over the small corpus."""
    docs, out = queries.table(spark, CORPUS, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, corpus_pipeline.saved(stage(spark, docs, CORPUS), name)
        out.append((name, given, docs))
    return out


def test_stages_in_order_and_columns(stages):
    assert [n for n, _, _ in stages] == [
        "quality_rules", "simhash_near_duplicates", "benchmark_decontamination", "source_mix", "token_output"]
    for _, given, docs in stages[:-1]:
        assert docs.columns == given.columns and docs.dtypes == given.dtypes


def test_every_stage_does_what_its_operator_says(spark, stages):
    from gleanwell.llm import decontaminate, mixing, rule_lists

    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    rules, near, leaks, mix, tokens = stages
    kept = rule_lists.quality_table(rules[1], queries.table(spark, CORPUS, "labels")).filter("kept")
    assert ids(rules[2]) == ids(kept)
    assert sorted(ids(near[2]), key=repr) == brute_force([(r.doc_id, r.text) for r in near[1].collect()])[0]
    found = {r.doc_id for r in decontaminate.leaks(leaks[1], queries.table(spark, CORPUS, "benchmark")).collect()}
    assert ids(leaks[2]) == [i for i in ids(leaks[1]) if i not in found] and found
    copies = {r.doc_id: r.copies for r in mixing.copies(mix[1]).collect()}
    assert ids(mix[2]) == sorted(i for i, n in copies.items() for _ in range(n))
    assert ids(tokens[2]) == ids(tokens[1])


def test_run_is_the_stages(spark, stages):
    again = corpus_pipeline.run(spark, CORPUS)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_stages_on_awkward_rows(spark, tmp_path):
    docs = clashing(spark, awkward_rows())
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, CORPUS).columns == docs.columns, name
        assert stage(spark, docs, CORPUS).count() >= 0
        assert stage(spark, empty, CORPUS).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    assert differences(spark, CORPUS, queries.QUERIES[name], queries.ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_gives_rows(spark, name):
    assert queries.QUERIES[name](spark, CORPUS).count() > 0
