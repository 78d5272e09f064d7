import hashlib
import random
import re

import numpy as np
from helpers import awkward_rows, clashing, table

from gleanwell.llm import personal_data

EXTRA = [
    "a@b.c@d.e x@y @b.c@d.e john..doe%+x@mail-1.example.co.uk.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "0" * 13 + " " + "0" * 20, "+1 (487) 555-7209 +49 30 123 +1-2 +" + "1" * 16, "+1+2+34567890123 + 1234567890",
    "日本 a@b.cc é 9.9.9.9 " + "7" * 5000 + ".1.1.1", "+1 ((((((((", "a" * 20_000 + "@" + "b" * 9 + ".c", "@" * 500, "mail j.doe (at) example (dot) org now",
    "ssn 123-45-6789, call (555) 123-4567 today, iban DE89 3704 0044 0532 0130 00 at bank", "2001:0db8:85a3:0000:0000:8a2e:0370:7334 is a host",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    def all_of(kind, pattern, fits):
        return [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if fits(m[0], re.sub("[^0-9]", "", m[0]))]

    spans = all_of("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True) if text.count("@") < 400 else []
    spans += all_of("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(len(p) < 999 and int(p) <= 255 for p in s.split(".")))
    spans += all_of("card", r"[0-9]([\x20-]?[0-9])+", lambda s, d: 13 <= len(d) <= 19 and luhn(d))
    spans += all_of("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15)
    return [f"{k}:{s}:{e}" for k, s, e in spans]


def mixed(rnd, n):
    pieces = ["a@b.cc", "1.2.3.4", "4111111111111111", "+1 (487) 555-7209", " ", ".", "-", "@", "+", "x", "7", "é", "(", ") ", "12 34"]
    return "".join(rnd.choice(pieces) for _ in range(n))


def test_base_spans_equal_plain_patterns(spark):
    rnd = random.Random(1)
    texts = EXTRA + [mixed(rnd, rnd.randint(1, 40)) for _ in range(300)]
    rows = [r for r in awkward_rows()] + [(200 + i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = personal_data.document_personal_data(clashing(spark, rows)).collect()
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(base_spans(r[1] or ""))
    assert len(got) == len(rows)
    for r in got:
        matching = [w for w in want[r.doc_id] if hashlib.sha256(",".join(w).encode()).hexdigest() == r.base_sha256]
        assert matching and set(matching[0]) <= set(r.spans.split(",")) | {""}
        kinds = [s.split(":")[0] for s in matching[0]]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in personal_data.KINDS[:4]]
        assert r.n_added == len([s for s in r.spans.split(",") if s]) - len(matching[0])


def test_proposals_never_touch_base_spans():
    found = personal_data.candidates(EXTRA[12])
    assert [(personal_data.KINDS[c[0]], EXTRA[12][c[1] : c[2]]) for c in found] == [
        ("phone", "(555) 123-4567"), ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789")]
    for text in EXTRA:
        spans = [c for c in personal_data.candidates(text)]
        base = {i for c in spans if c[3] for i in range(c[1], c[2])}
        assert all(base.isdisjoint(range(c[1], c[2])) for c in spans if not c[3])


def test_reliabilities_are_estimated():
    rnd = np.random.default_rng(2)
    true = rnd.random(20_000) < 0.4
    accuracy = [0.95, 0.9, 0.8, 0.7, 0.6, 0.85, 0.75]
    packed = np.zeros(len(true), dtype=np.int64)
    for a in accuracy:
        right = rnd.random(len(true)) < a
        vote = np.where(right == true, personal_data.YES, personal_data.NO)
        packed = packed * 3 + np.where(rnd.random(len(true)) < 0.2, personal_data.NONE, vote)
    votes, counts = np.unique(packed, return_counts=True)
    p, right = personal_data.estimated(votes, counts.astype(float))
    assert np.abs(right.mean(axis=1) - accuracy).max() < 0.03
    guess = dict(zip(votes.tolist(), p > 0.5))
    assert np.mean([guess[v] == t for v, t in zip(packed.tolist(), true)]) > 0.96


def test_the_classifier_adds_what_labelers_agree_on(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(300):
        n = [rnd.randint(200, 999), rnd.randint(200, 999), rnd.randint(1000, 9999)]
        rows.append((i, f"please call my mobile ({n[0]}) {n[1]}-{n[2]} soon" if i % 2 else f"order part no {rnd.randint(10**15, 10**16 - 1)} x", "en", "a", 0))
    rows += [(1000 + i, f"phone +1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)} or else", "en", "a", 0) for i in range(200)]
    got = {r.doc_id: r for r in personal_data.document_personal_data(table(spark, rows)).collect()}
    assert all(got[i].n_added == 1 and got[i].spans.startswith("phone:") for i in range(1, 300, 2))
    assert all(got[i].n_added == 0 for i in range(0, 300, 2))
    again = {r.doc_id: r for r in personal_data.document_personal_data(table(spark, rows).repartition(5)).collect()}
    assert again == got


def test_empty(spark):
    assert personal_data.document_personal_data(table(spark, [])).collect() == []
    assert [tuple(r)[:7] for r in personal_data.document_personal_data(table(spark, [(1, None, None, None, None)])).collect()] == [
        (1, 0, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest())]
