"""Personal data in texts, by labelers that vote on spans.

Patterns propose spans. Each span gets the votes of several weak labelers: its own form, its check
digits or ranges, gazetteers of known endings and prefixes, and the words around it. Over the whole
corpus the votes are counted by kind; expectation-maximisation estimates from the counts how reliable
each labeler is and how likely each combination of votes is right. With these likelihoods a span
classifier is trained on what a span looks like and stands in. It decides on all spans that the base
patterns do not settle; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import dropped, parts, saved, texts_of

# The base kinds in their order, then the kinds that the method adds.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = 4

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match never starts inside digits: they are taken whole
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# what the method proposes beside the base patterns
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[{]\x20?at\x20?[)\]}]\x20?"
    r"[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[(\[{]\x20?dot\x20?[)\]}])\x20?[A-Za-z0-9-]{1,63}){1,4}", re.I | re.A)
PLAIN_PHONE = re.compile(r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9A-Za-z-])")
IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
SSN = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")

# Gazetteers of endings, issuer prefixes, calling codes and cue words.
ENDINGS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us", "ca", "jp", "cn"}
ISSUERS = ("4", "51", "52", "53", "54", "55", "2221", "2720", "34", "37", "36", "38", "6011", "65", "35", "62")
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
CUES = {
    "email": ("mail", "contact", "write", "reach", "address"), "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "pay", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "cell", "contact", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"), "ssn": ("ssn", "social", "security"),
}
AGAINST = ("version", "isbn", "issn", "order", "invoice", "serial", "ticket", "build", "release", "section", "part", "page", "id", "no", "doi", "sku")
AROUND = 40  # characters on each side in which cue words count

LABELERS = ("form", "checked", "gazetteer", "cue", "against", "alone", "varied")
YES, NO, NONE = 2, 1, 0  # a vote; none is an abstention
DIGITS, MARKS, SIDES = 8, 4, 3
SPAN = "struct<kind:int,start:int,end:int,base:boolean,votes:int,shape:int>"

ROUNDS = 60
SMOOTH = 4.0  # imaginary spans per labeler and answer
KEEP = 0.9  # likelihood from which a span that no base pattern settles is kept
UNIT = 1_000_000  # likelihoods are added as integers, so that no order of adding changes them

WORDS = re.compile("[a-z]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, not overlapping: each @ with a domain, and what may stand before it since the last one."""
    last = 0
    for m in DOMAIN.finditer(text):
        at = m.start()
        low = at
        while low > last and text[low - 1] in LOCAL:
            low -= 1
        if low < at:
            yield low, m.end()
            last = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, each kind by itself, by kind and start."""
    found = []
    if "@" in text:
        found += [(0, s, e) for s, e in emails(text)]
    if "." in text:
        parted = ((m, [p.lstrip("0") for p in m[0].split(".")]) for m in IP.finditer(text))
        found += [(1, m.start(), m.end()) for m, ps in parted if all(len(p) < 4 and int(p or 0) <= 255 for p in ps)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(n := digits_of(m[0])) <= 19 and luhn(n):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def proposed(text: str) -> Iterator[tuple[int, int, int]]:
    """Further spans that are worth a vote, whatever overlaps."""
    low = text.casefold() if "at" in text or "AT" in text else ""
    if "at)" in low or "at]" in low or "at}" in low or "at )" in low or "at ]" in low:
        yield from ((0, m.start(), m.end()) for m in SPELLED.finditer(text))
    if text.count(":") >= 7:
        yield from ((1, m.start(), m.end()) for m in IPV6.finditer(text))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits_of(m[0])) <= 19:
            yield 2, m.start(), m.end()
        if m.end() - m.start() >= 11:
            yield from ((5, p.start(), p.end()) for p in SSN.finditer(text, m.start(), m.end() + 1))
    yield from ((3, m.start(), m.end()) for m in PLAIN_PHONE.finditer(text))
    yield from ((4, m.start(), m.end()) for m in IBAN.finditer(text))


def _checked(kind: int, span: str, digits: str) -> int:
    if kind == 2:
        return YES if luhn(digits) else NO
    if kind == 4:
        turned = span.replace(" ", "")
        turned = turned[4:] + turned[:4]
        return YES if int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 else NO
    if kind == 5:
        return YES if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000" else NO
    if kind == 3:
        return YES if 9 <= len(digits) <= 15 else NONE
    return NONE


def _gazetteer(kind: int, span: str, digits: str) -> int:
    if kind == 0:
        return YES if re.split("[^A-Za-z0-9]+", span)[-1].lower() in ENDINGS else NO
    if kind == 1:
        return NO if span.startswith(("0.", "127.", "255.", "::")) else NONE
    if kind == 2:
        return YES if digits.startswith(ISSUERS) else NO
    if kind == 3:
        return (YES if digits.startswith(CALLING) else NO) if span[0] == "+" else NONE
    return NONE


def described(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, int]:
    """(votes, shape) of a span: three answers per labeler, and the classifier's view in one number."""
    span = text[start:end]
    digits = digits_of(span)
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    near = set(WORDS.findall(text[max(0, start - AROUND) : start].lower())) | set(WORDS.findall(text[end : end + AROUND].lower()))
    cue = any(w.startswith(CUES[KINDS[kind]]) for w in near)
    against = any(w in AGAINST for w in near)
    joined = before.isalnum(), after.isalnum()
    votes = (
        YES if base else NONE,
        _checked(kind, span, digits),
        _gazetteer(kind, span, digits),
        YES if cue else NONE,
        NO if against else NONE,
        NO if any(joined) and kind else NONE,
        NO if digits and len(set(digits)) <= 2 else NONE,
    )
    marks = min(MARKS - 1, sum(not c.isalnum() for c in span) // 2)
    side = lambda c: 0 if not c else 1 if c.isspace() else 2
    shape = min(DIGITS - 1, len(digits) // 3)
    for value, size in ((marks, MARKS), (side(before), SIDES), (side(after), SIDES), (int(cue), 2), (int(against), 2), (votes[1], 3), (votes[2], 3)):
        shape = shape * size + value
    packed = 0
    for vote in votes:
        packed = packed * 3 + vote
    return packed, shape


def candidates(text: str) -> list[tuple[int, int, int, bool, int, int]]:
    """(kind, start, end, base, votes, shape) by kind and start; proposals that touch a span before them are left out.

    Base spans come first, so a proposal never takes their place, whatever kind it is.
    """
    found = [(k, s, e, True) for k, s, e in base_spans(text)]
    more = list(proposed(text))
    if more:
        taken = bytearray(len(text))
        for _, s, e, _ in found:
            taken[s:e] = b"\x01" * (e - s)
        for k, s, e in sorted(more, key=lambda c: (c[0] == 2, c[1], c[0])):
            if 1 not in taken[s:e]:
                taken[s:e] = b"\x01" * (e - s)
                found.append((k, s, e, False))
    return sorted((k, s, e, base, *described(text, k, s, e, base)) for k, s, e, base in found)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its candidate spans, saved. Null and empty texts have none; texts stay behind."""
    kind = pa.list_(pa.struct([
        ("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("shape", pa.int32())]))
    names = [f.name for f in kind.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            spans = [[dict(zip(names, c)) for c in candidates(t.decode())] for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return saved(slim.mapInArrow(run, f"doc_id long, spans array<{SPAN}>"), "personal-spans")


def _answers(packed: np.ndarray) -> np.ndarray:
    """The votes of every combination, one column per labeler."""
    return np.stack([packed // 3 ** (len(LABELERS) - 1 - i) % 3 for i in range(len(LABELERS))], axis=1)


def estimated(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likelihood of being personal data for each combination of votes, and the labelers' reliabilities.

    Expectation-maximisation over two classes, labelers independent within a class. A reliability is
    how often a labeler that votes is right, for spans of either class; it starts at 0.7 and is held
    above one half by imaginary spans, so that the classes cannot change places.
    """
    answers = _answers(votes)
    says_yes, says_no = answers == YES, answers == NO
    right = np.full((len(LABELERS), 2), 0.7)  # of true spans, of others
    share = 0.5
    for _ in range(ROUNDS):
        log = np.log(share) - np.log(1 - share)
        log = log + says_yes @ (np.log(right[:, 0]) - np.log(1 - right[:, 1])) + says_no @ (np.log(1 - right[:, 0]) - np.log(right[:, 1]))
        p = 1 / (1 + np.exp(-np.clip(log, -500, 500)))
        yes, no = counts * p, counts * (1 - p)
        right[:, 0] = (yes @ says_yes + 0.7 * SMOOTH) / (yes @ (says_yes | says_no) + SMOOTH)
        right[:, 1] = (no @ says_no + 0.7 * SMOOTH) / (no @ (says_yes | says_no) + SMOOTH)
        right = np.clip(right, 0.501, 0.999)
        share = float(np.clip((yes.sum() + 1) / (counts.sum() + 2), 0.01, 0.99))
    return p, right


def reliabilities(scanned: DataFrame) -> dict[int, tuple[dict[int, float], np.ndarray]]:
    """Per kind: the likelihood of each combination of votes, and the labelers' reliabilities.

    Counts come from all spans of the corpus; there are at most 3^7 combinations a kind.
    """
    rows = scanned.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes").count().orderBy("kind", "votes").collect()
    out = {}
    for kind in sorted({r["kind"] for r in rows}):
        held = [r for r in rows if r["kind"] == kind]
        votes, counts = np.array([r["votes"] for r in held]), np.array([float(r["count"]) for r in held])
        p, right = estimated(votes, counts)
        out[kind] = dict(zip(votes.tolist(), p.tolist())), right
    return out


def _features(kinds: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Indicator columns: kind, and kind by each part of the shape."""
    sizes = (DIGITS, MARKS, SIDES, SIDES, 2, 2, 3, 3)
    columns, left, whole = [np.eye(len(KINDS))[kinds]], shapes.copy(), 1
    for size in reversed(sizes):
        columns.append(np.eye(len(KINDS) * size)[kinds * size + left % size])
        left //= size
        whole *= size
    return np.concatenate(columns, axis=1)


def trained(kinds: np.ndarray, shapes: np.ndarray, counts: np.ndarray, likely: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """The classifier's likelihood for each (kind, shape): logistic regression on likelihoods as labels, by Newton steps."""
    x = _features(kinds, shapes)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (p - likely)) + ridge * w
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def classifier(scanned: DataFrame) -> dict[tuple[int, int], float]:
    """(kind, shape) -> likelihood, for every pair that occurs.

    Each kind's combinations of votes become likelihoods; their sums per (kind, shape), over all
    spans, train the classifier. Both tables are bounded by the number of votes and shapes.
    """
    votes = reliabilities(scanned)
    if not votes:
        return {}
    likely = {kind * 3 ** len(LABELERS) + v: round(p * UNIT) for kind, (by, _) in votes.items() for v, p in by.items()}
    table = scanned.sparkSession.createDataFrame(sorted(likely.items()), "pattern long, likely long")
    spans = scanned.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.shape", "s.votes").count()
    spans = spans.withColumn("pattern", F.col("kind").cast("long") * 3 ** len(LABELERS) + F.col("votes")).join(table, "pattern")
    rows = spans.groupBy("kind", "shape").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("likely")).alias("sum"))
    rows = rows.orderBy("kind", "shape").collect()
    kinds, shapes, counts, sums = (np.array([r[c] for r in rows]) for c in ("kind", "shape", "n", "sum"))
    p = trained(kinds, shapes, counts.astype(float), sums / counts / UNIT)
    return dict(zip(zip(kinds.tolist(), shapes.tolist()), p.tolist()))


def document_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts and digest, and all spans as kind:start:end by kind and start.

    n_added counts the spans that the classifier adds to the base ones. Offsets are code points, the
    end is exclusive. Null and empty texts have no spans; repeated rows give repeated rows; a table
    without rows gives none; other columns are not read.
    """
    scanned = scan(docs, doc_id, text)
    keep = {key for key, p in classifier(scanned).items() if p >= KEEP}
    counts = [f"n_{k}" for k in KINDS[:BASE]]
    names = ["doc_id", *counts, "n_added", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, spans in zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist()):
                stays = [s for s in spans if s["base"] or (s["kind"], s["shape"]) in keep]
                told = [f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in stays]
                base = [t for t, s in zip(told, stays) if s["base"]]
                of = [sum(s["base"] and s["kind"] == k for s in stays) for k in range(BASE)]
                rows.append((key, *of, len(stays) - len(base), hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(told)))
            types = [pa.int64()] * (BASE + 2) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(list(zip(*rows)) or [[]] * len(types), types)], names)

    numbers = ", ".join(f"{c} long" for c in names[:-2])
    return scanned.mapInArrow(run, f"{numbers}, base_sha256 string, spans string")
