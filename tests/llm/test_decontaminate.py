import random

from helpers import awkward_rows, clashing, table

from gleanwell.llm import decontaminate

VOCABULARY = [a + b for a in "b c d f g k l m n p".split() for b in ["an", "ore", "ilt", "esh", "um"]]


def sentence(rnd, n):
    return " ".join(rnd.choice(VOCABULARY) for _ in range(n)).capitalize() + "."


def corpus(seed=3):
    rnd = random.Random(seed)
    items = [(i, sentence(rnd, rnd.randint(6, 40)) + " " + sentence(rnd, rnd.randint(4, 9))) for i in range(25)]
    items += [(25, sentence(rnd, 90) + " " + sentence(rnd, 6)), (26, "Short one."), (27, None), (28, "")]
    docs = []
    for i in range(80):
        text = [sentence(rnd, rnd.randint(3, 60)) for _ in range(rnd.randint(1, 6))]
        if i % 4 == 0:
            at = rnd.randint(0, len(text))
            text.insert(at, rnd.choice(items[:27])[1])
        if i % 16 == 0:
            text = [t.upper().replace(".", " !!") for t in text]
        docs.append((i, "\n".join(text), "en", "s", 0))
    return docs, items


def brute_force(docs, items):
    found = set()
    for doc, text, *_ in docs:
        have = decontaminate.normal_words((text or "").encode())
        for item, wanted in items:
            parts = [wanted or "", *decontaminate.question_and_answer(wanted or "")]
            shares = []
            for part in parts:
                grams = decontaminate.shingles(decontaminate.normal_words(part.encode()))
                size = len(next(iter(grams)).split()) if grams else 0
                runs = {b" ".join(have[i : i + size]) for i in range(len(have) - size + 1)}
                shares.append(len(grams & runs) / len(grams) if grams else 0)
            if shares[0] >= 0.8 and min(shares[1:]) >= 0.5:
                found.add((doc, item))
    return found


def test_finds_what_brute_force_finds(spark):
    docs, items = corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(clashing(spark, docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute_force(docs, items)
    assert all(r.score >= 0.6 for r in got)


def test_shards_of_the_index_give_the_same(spark, monkeypatch):
    docs, items = corpus(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r)[:2] for r in decontaminate.leaks(table(spark, docs), benchmark).collect()}
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 1500)
    assert {tuple(r)[:2] for r in decontaminate.leaks(table(spark, docs), benchmark).collect()} == whole


def test_bounds_lose_nothing(spark):
    """Scores of all pairs, without any bound, pass the threshold where the index says so."""
    docs, items = corpus(5)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    index = next(iter(decontaminate.indexes(benchmark)))
    texts = [d[1].encode() for d in docs]
    assert index.search(texts)
    loose = [hit[:2] for t in range(len(texts)) for hit in index.search([texts[t]]) for hit in [(t, hit[1])]]
    assert [hit[:2] for hit in index.search(texts)] == loose


def test_clean_documents_stay_as_they_are(spark):
    docs, items = corpus()
    rows = docs + [(None if r[0] is None else r[0] + 1000, *r[1:]) for r in awkward_rows()]
    benchmark = spark.createDataFrame(items[:26], "item_id long, text string")
    given = clashing(spark, rows)
    out = decontaminate.without_leaks(given, benchmark)
    assert out.columns == given.columns
    bad = {d for d, _ in brute_force(docs, items[:26])}
    assert sorted(map(repr, out.select("doc_id").collect())) == sorted(
        map(repr, given.filter(~given.doc_id.isin(*bad) | given.doc_id.isNull()).select("doc_id").collect()))


def test_empty(spark):
    docs, items = corpus()
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(table(spark, docs), none).collect() == []
    assert decontaminate.without_leaks(table(spark, docs), none).count() == len(docs)
    some = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.leaks(table(spark, []), some).collect() == []


def test_one_changed_word_in_a_short_answer_hides_no_item(spark):
    rnd = random.Random(8)
    question, answer = sentence(rnd, 40), "Four zulu kilo romeo tango."
    benchmark = spark.createDataFrame([(1, f"{question} {answer}")], "item_id long, text string")
    docs = [(i, f"{question} {answer.replace(w, 'other')}", "en", "s", 0) for i, w in enumerate(["zulu", "kilo", "romeo"])]
    assert sorted(r.doc_id for r in decontaminate.leaks(table(spark, docs), benchmark).collect()) == [0, 1, 2]
    gone = [(9, f"{question} Nothing here is the same.", "en", "s", 0)]
    assert decontaminate.leaks(table(spark, gone), benchmark).collect() == []
