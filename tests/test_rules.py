from pyspark.sql import functions as F
import pytest

from gleanwell.functions import rules


def flags_of(spark, text, **kw):
    row = spark.createDataFrame([(text,)], "t string").select(
        *[c.alias(n) for n, c in rules.spam_flags(F.col("t"), **kw).items()]
    ).first()
    return {n for n, v in row.asDict().items() if v}


LONG = "x" * 120


@pytest.mark.parametrize(
    "text, expected",
    [
        (LONG, set()),
        ("GM everyone " + LONG, {"low_effort", "strict_spam"}),
        ("say gm " + LONG, set()),
        ("Happy day " + LONG, {"low_effort", "strict_spam"}),
        ("you can claim it", {"short_claim", "strict_spam"}),
        ("you can claim it " + LONG, set()),
        ("buy $BTC now " + LONG, set()),
        ("%$BTC%", {"cashtag", "strict_spam"}),
        ("costs $B or $12 " + LONG, set()),
        ("look at that Window " + LONG, {"crypto", "strict_spam"}),
        ("a fresh CoIn " + LONG, {"loose_spam", "crypto", "strict_spam"}),
        ("when " + LONG, {"animal", "strict_spam"}),
        ("no wonder " + LONG, {"gambling", "strict_spam"}),
        ("Follow\tme " + LONG, set()),
        ("please FOLLOW ME " + LONG, {"farming", "strict_spam"}),
        ("first line\nlike and recast\n" + LONG, {"farming", "strict_spam"}),
    ],
)
def test_flags(spark, text, expected):
    assert flags_of(spark, text) == expected


def test_every_listed_word_is_found(spark):
    words = [w for group in rules.SPAM_LISTS.values() for w in group]
    df = spark.createDataFrame([(f"12 {w.upper()} 34",) for w in words], "t string")
    assert df.filter(~rules.mentions_any(F.col("t"), words)).count() == 0
    assert df.filter(~rules.strict_spam(F.col("t"))).count() == 0


def test_needed_words_keep_the_meaning():
    assert rules.needed_words(["egg", "eggs", "lay egg", "hen"]) == ["egg", "hen"]


def test_whole_words(spark):
    df = spark.createDataFrame([("when the window opens",), ("a hen",)], "t string")
    hits = df.select(rules.mentions_any(F.col("t"), ["hen", "win"], whole_words=True).alias("h"))
    assert [r.h for r in hits.collect()] == [False, True]


def test_literal_cashtag_needs_the_percent_signs(spark):
    df = spark.createDataFrame([("buy $BTC now",), ("%$BTC%",)], "t string")
    assert [r.h for r in df.select(rules.cashtag(F.col("t"), "literal").alias("h")).collect()] == [False, True]
