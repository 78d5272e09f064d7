import base64

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from gleanwell.functions import scalars as S


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "score, label",
    [(-0.1, None), (0.0, "Spammer"), (2.5, "Spammer"), (2.51, "Low"), (4.5, "Low"), (6.5, "Average"),
     (8.5, "High"), (8.6, "Leader"), (10.1, "Leader"), (10.2, None), (None, None), (float("nan"), None)],
)
def test_bins_are_closed_on_the_right(spark, score, label):
    assert one(spark, score, "double", S.quality_category) == label


def test_text_that_is_no_integer_has_no_time(spark):
    assert one(spark, "1.5", "string", S.post_seconds) in (None, 1)
    assert one(spark, "", "string", S.post_seconds) is None
    assert one(spark, "12", "string", S.post_seconds) == 12


def test_fid_of_odd_text(spark):
    assert [one(spark, v, "string", S.as_fid) for v in ("7", "x", None, "")] == [7, 0, 0, 0]


def reference_hex(text):
    try:
        return base64.b64decode(text).hex()
    except Exception:
        return text


@pytest.mark.parametrize(
    "value", ["0x" + "ab" * 20, "ab" * 20, "YWJj", "YWI=", "YQ==", "YW=", "a b!cd", "", "123", "1234"]
)
def test_hash_hex_like_a_lenient_decoder(spark, value):
    assert one(spark, value, "string", S.hash_hex) == reference_hex(value)


def test_title_case(spark):
    words = ["machine learning", "gpt4all", "it's ok", "über_mut"]
    df = spark.createDataFrame([(w,) for w in words], "x string")
    assert [r[0] for r in df.select(S.title_case(F.col("x"))).collect()] == [w.title() for w in words]


def test_words_have_unicode_edges(spark):
    text = "The café naïve x1 abc_d go gone, DON'T stop42 end"
    assert one(spark, text.lower(), "string", lambda c: S.words_of(c, 3)) == ["the", "gone", "don", "end"]


def test_shorten(spark):
    assert one(spark, "abcdef", "string", lambda c: S.shorten(c, 3)) == "abc..."
    assert one(spark, "abc", "string", lambda c: S.shorten(c, 3)) == "abc"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=2, max_size=6))
def test_unit_length(spark, xs):
    got = one(spark, xs, "array<double>", S.unit_length)
    size = sum(x * x for x in got) ** 0.5
    assert size == pytest.approx(1) or all(abs(x) < 1e-150 for x in xs)
