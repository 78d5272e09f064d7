import random
import re

from helpers import awkward_rows, clashing, table

from gleanwell.llm import rule_lists

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def expected(text):
    text = text or ""
    words, seen, covered = WORD.findall(text), {}, set()
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k : k + 8]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            for k in places:
                covered.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_counts(spark):
    rnd = random.Random(4)
    rows = awkward_rows() + [
        (500 + i, "".join(rnd.choice(["a ", "b ", "c\n", "# ", "\x0b", "é", " "]) for _ in range(rnd.randint(0, 120))), "en", "s", 0)
        for i in range(60)
    ]
    got = rule_lists.with_statistics(clashing(spark, rows)).drop("_row").collect()
    mine = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got]
    assert sorted(map(repr, mine)) == sorted(repr((r[0], *expected(r[1]))) for r in rows)


def corpus(n=600, seed=2):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(["river", "stone", "light", "under", "seven", "hills"]) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(25, 80))]
        bad = rnd.random() < 0.3
        if bad and rnd.random() < 0.5:
            words = [w + "#$" for w in words]
        elif bad:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_learned_rules_hold_on_other_documents(spark):
    rows, labels = corpus()
    known = spark.createDataFrame(labels[::2], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in rule_lists.quality_table(clashing(spark, rows), known).collect()}
    unseen = labels[1::2]
    assert sum(got[i].kept == (q == 1) for i, q, _ in unseen) / len(unseen) > 0.97
    assert all(not got[i].base_failed for i, _, _ in unseen)
    kept = rule_lists.kept_documents(clashing(spark, rows), known)
    assert kept.columns == clashing(spark, []).columns and kept.count() == sum(r.kept for r in got.values())


def test_list_is_read_in_order(spark):
    rules = rule_lists.DecisionList([[("words", ">=", 3.0), ("share_of_capitals", "<", 0.5)], [("words", "<", 2.0)]])
    docs = rule_lists.with_statistics(table(spark, [(1, "a b c", "en", "s", 0), (2, "A B C", "en", "s", 0), (3, "a", "en", "s", 0), (4, None, "en", "s", 0)]))
    fired = {r.doc_id: r.rule for r in docs.select("doc_id", rules.fired().alias("rule")).collect()}
    assert fired == {1: 1, 2: None, 3: 2, 4: 2}
    assert str(rules).splitlines()[0] == "1. drop if words >= 3 and share_of_capitals < 0.5"


def test_base_rules_alone_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = awkward_rows()
    for r in rule_lists.quality_table(table(spark, rows), none).collect():
        assert r.kept != r.base_failed
    odd = spark.createDataFrame([(None, 0, 0), (1, None, 0), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    assert rule_lists.quality_table(table(spark, rows), odd).count() == len(rows)
    assert rule_lists.quality_table(table(spark, []), odd).collect() == []


def test_no_python_in_the_plan(spark):
    plan = rule_lists.with_statistics(table(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
