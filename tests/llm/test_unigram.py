import random

import public_tokenizers
import pytest
from helpers import awkward_rows, clashing, table
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

from gleanwell.llm import unigram


def library(vocabulary, by_bytes):
    """The same tokenizer in the tokenizers library."""
    out = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=by_bytes))
    out.normalizer = normalizers.Sequence([normalizers.Replace(Regex("[ \\t-\\r]+"), " "), normalizers.Strip()])
    out.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return out


def test_counts_are_the_librarys(spark):
    vocabulary = unigram.piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    other = library(vocabulary, True)
    rows = awkward_rows()
    got = unigram.token_counts(clashing(spark, rows), vocabulary).collect()
    expected = [(r[0], len((r[1] or "").encode().split()), len(other.encode((r[1] or "").strip(" \t\n\r\x0b\x0c"), add_special_tokens=False).ids)) for r in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


@pytest.mark.parametrize("seed", range(6))
def test_ties_and_unknown_characters(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        pieces = {"".join(rnd.choice("abcd€▁") for _ in range(rnd.randint(1, 4))) for _ in range(12)}
        vocabulary = [("<unk>", 0.0)] + [(p, -float(rnd.randint(1, 4))) for p in sorted(pieces)]
        counter, other = unigram.UnigramCounter(vocabulary), library(vocabulary, False)
        texts = ["".join(rnd.choice("abcd€𝄞x ") for _ in range(rnd.randint(0, 14))) for _ in range(20)]
        assert counter.counts([t.encode() for t in texts]) == [len(other.encode(t, add_special_tokens=False).ids) for t in texts]


def test_small_cache_and_empty(spark, monkeypatch):
    vocabulary = [("<unk>", 0.0), ("▁a", -1.0), ("b", -1.0)]
    counter = unigram.UnigramCounter(vocabulary)
    monkeypatch.setattr(unigram, "CACHE", 2)
    assert counter.counts([b"a b ab", b"ab", b"", b"a bb"]) == [1 + 2 + 2, 2, 0, 1 + 3]
    assert unigram.token_counts(table(spark, []), vocabulary).collect() == []
    assert unigram.UnigramCounter([]).counts([b"a"]) == [1]
