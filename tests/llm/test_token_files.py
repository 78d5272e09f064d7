import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward_rows, clashing, table
from tokenizers import Tokenizer

from gleanwell.llm import token_files
from gleanwell.llm.common import filesystem
from gleanwell.llm.elias_fano import EliasFano, encode

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows, path=PATH, end=1):
    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [end]
        out.append((r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("files", [1, 5, None])
def test_round_trip(spark, files):
    rows = awkward_rows()
    got = token_files.read_tokens(token_files.write_tokens(clashing(spark, rows), PATH, 1, files=files)).collect()
    assert sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(map(repr, expected(rows)))
    in_order = sorted(got, key=lambda r: r.start)
    ids = [r.doc_id for r in in_order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order]])[:-1].tolist()


def test_every_kind_of_word():
    tokenizer = Tokenizer.from_file(PATH)
    assert token_files.splits_at_spaces(PATH)
    assert not token_files.splits_at_spaces(public_tokenizers.path("byte_bpe_50k.json"))
    encode_words, rnd = token_files.word_encoder(PATH, 1, 2), random.Random(1)
    texts = ["PÁ!!don'T'S é*** x<|y ÿßÞ×÷ªº²µÿ", "á b\ńc <|endoftext|>x ΑΣ it's \x85z\xa0q  k", "\x1c\x1d a \x0b b\x00c <|start of|>", "İstanbul ſt K 12三四 é é"]
    letters = [chr(c) for c in [*range(32, 1200), 0x1E9E, 0x2028, 0x3000, 0x1F600, 0x0301]] + [" "] * 300 + list("'st'reLL") * 20
    texts += ["".join(rnd.choice(letters) for _ in range(80)) for _ in range(300)]
    for text, coded in zip(texts, encode_words([t.encode() for t in texts])):
        assert np.frombuffer(coded, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1], repr(text)


def test_other_tokenizers_encode_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = awkward_rows()[:20]
    got = token_files.read_tokens(token_files.write_tokens(table(spark, rows), path, 7, width=4), arrays=True).collect()
    assert sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(map(repr, expected(rows, path, 7)))
    assert all(len(r.ids) == r.n_tokens and r.ids[-1] == 7 for r in got)


@pytest.mark.parametrize("n, top", [(0, 0), (1, 0), (1, 9), (64, 3), (65, 10**6), (1000, 5), (1000, 10**15)])
def test_elias_fano(n, top):
    rnd = random.Random(n + top)
    values = sorted(rnd.randint(0, top) for _ in range(n))
    coded = encode(np.array(values, dtype=np.uint64))
    read = EliasFano(coded + b"more")
    assert read.values().tolist() == values and [read.select(i) for i in range(n)] == values
    assert read.bytes == len(coded)
    if n == 1000:
        assert 8 * (len(coded) - 64) < n * (2.7 + max(0, np.log2(max(top, 1) / n)) + 1)


def test_select_in_a_file(spark):
    listed = token_files.write_tokens(table(spark), PATH, 1, files=2).collect()
    for row in listed:
        store, path = filesystem(row.path)
        with store.open_input_stream(path) as file:
            found = token_files.TokenFile(file.read())
        ends = found.ends.values().tolist()
        assert [found.bounds(i) for i in range(found.documents)] == list(zip([0, *ends], ends))
        assert all(found.ids[e - 1] == 1 for e in ends) and len(found.doc_ids()) == found.documents


def test_small_memory_and_empty(spark, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 3)
    texts = [b"one two three four five", b"five four three two one zero", b""]
    tokenizer = Tokenizer.from_file(PATH)
    words = token_files.WordIds(PATH, 2)
    for text in texts:
        coded = b"".join(map(words.words.__getitem__, text.split()))
        assert np.frombuffer(coded, "<u2").tolist() == tokenizer.encode(text.decode()).ids
    assert token_files.read_tokens(token_files.write_tokens(table(spark, []), PATH, 1)).collect() == []
