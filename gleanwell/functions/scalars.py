"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds from 1970 to the start of post time, and the edges of quality bins.
POST_EPOCH = 1609459200
QUALITY_EDGES = [2.5, 4.5, 6.5, 8.5]
QUALITY_LABELS = ["Spammer", "Low", "Average", "High", "Leader"]
QUALITY_RANGE = (-0.1, 10.1)
QUALITY_USER_FROM = 5.0


def has_value(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def key_part(key: Column) -> Column:
    """The part of ``fid:hash`` after the first colon; empty when there is none."""
    return F.split_part(key, F.lit(":"), F.lit(2))


def post_seconds(ts: Column) -> Column:
    """Post time as a number; text that is no integer becomes null and fails every cutoff."""
    return ts.try_cast("bigint")


def post_moment(seconds: Column) -> Column:
    """Post time as a timestamp, in the session time zone (UTC in our jobs)."""
    return F.timestamp_seconds(seconds + F.lit(POST_EPOCH))


def as_fid(col: Column) -> Column:
    """Id as a number, 0 where the text is no integer."""
    return F.coalesce(col.try_cast("bigint"), F.lit(0).cast("bigint"))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def shorten(text: Column, chars: int, ellipsis: bool = True) -> Column:
    head = F.left(text, F.lit(chars))
    if not ellipsis:
        return head
    return F.when(F.length(text) > chars, F.concat(head, F.lit("..."))).otherwise(text)


def hash_hex(col: Column) -> Column:
    """Base64 text as hex; text that is not whole base64 stays as it is."""
    clean = F.regexp_replace(col, "[^A-Za-z0-9+/=]", "")
    whole = (F.length(clean) % 4 == 0) & clean.rlike(r"\A[A-Za-z0-9+/]*={0,2}\z")
    return F.when(whole, F.lower(F.hex(F.unbase64(clean)))).otherwise(col)


def ratio(part: Column, whole: Column) -> Column:
    """Share with 0 where the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def clip(col: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))


def quality_category(score: Column) -> Column:
    """Five right-closed bins; scores outside the range have none."""
    low, high = QUALITY_RANGE
    expr = F.when(score.isNull() | F.isnan(score) | (score <= low) | (score > high), None)
    return expr.otherwise(reply_category(score))


def reply_category(score: Column) -> Column:
    """The same edges without a range limit, as used on scores parsed from replies."""
    expr = F.when(score <= QUALITY_EDGES[0], QUALITY_LABELS[0])
    for edge, label in zip(QUALITY_EDGES[1:], QUALITY_LABELS[1:]):
        expr = expr.when(score <= edge, label)
    return expr.when(score.isNotNull(), QUALITY_LABELS[-1])


def category_order(category: Column) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in QUALITY_LABELS]), category)


def is_quality_user(score: Column) -> Column:
    return (score >= QUALITY_USER_FROM).cast("int")


def title_case(text: Column) -> Column:
    """Capital at the start of every run of letters, lower case after it."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2)))),
        ),
        "",
    )


def words_of(lower: Column, min_letters: int) -> Column:
    """Words of at least so many Latin letters in lower-cased text, with Unicode word edges."""
    pattern = rf"(?U)(?<![a-z0-9_])\b[a-z]{{{min_letters},}}+\b"
    return F.regexp_extract_all(lower, F.lit(pattern), F.lit(0))


def shuffled_by(parts: Sequence[Column | str]) -> Column:
    """A repeatable stand-in for a random draw: order by this value."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance between two arrays of equal length."""
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, v: s + v))


def unit_length(vec: Column) -> Column:
    """The array scaled to length 1; the zero vector stays zero."""
    doubles = F.transform(vec, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda s, v: s + v * v))
    return F.transform(doubles, lambda x: F.when(norm > 0, x / norm).otherwise(x))
