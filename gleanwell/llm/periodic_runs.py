"""Periodic runs of words: stretches that repeat with a period at least three times over.

Words become integers. At every dyadic scale the words are cut into blocks, and one exact integer
convolution per block (a number-theoretic transform, all blocks of a scale at once) gives the sum of
squared differences between the block and each place of the window behind it. A sum of zero is an
occurrence; its distance seeds a period, and the seed is grown word by word to both sides.

A run of period q and length L >= max(24, 3 q) always holds such a block: with B words a block,
q < 2 B and L - q >= 2 B - 1, one block of the grid lies before the run's last q words. The scale of
8 words takes all distances below 16, the scale of B = 16, 32, ... those from B to 2 B - 1.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import texts_of

LEAST_WORDS = 24
LEAST_TURNS = 3
BASE = 8
PRIME, GENERATOR = 998244353, 3  # 119 * 2^23 + 1: transforms of up to 2^23 words
FLUSH = 1 << 18  # words that are convolved together
CHUNK = 1 << 16  # numbers of one transform call, few enough for a core's cache

Words = list[bytes]
Run = tuple[int, int, int]  # start, length, period


def _powers(root: int, count: int) -> np.ndarray:
    out = np.ones(count, dtype=np.uint64)
    have = 1
    while have < count:
        step = pow(root, have, PRIME)
        out[have : 2 * have] = out[:have][: count - have] * np.uint64(step) % PRIME
        have *= 2
    return out


def _roots(size: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each half h < size the powers of a root of order 2 h and of its inverse."""
    out, h = {}, 1
    while h < size:
        root = pow(GENERATOR, (PRIME - 1) // (2 * h), PRIME)
        out[h] = _powers(root, h), _powers(pow(root, -1, PRIME), h)
        h *= 2
    return out


def _reduced(values: np.ndarray) -> np.ndarray:
    """Values below 2 p modulo p: the difference wraps round where it would be negative."""
    return np.minimum(values, values - np.uint64(PRIME))


def transform(rows: np.ndarray, roots: dict) -> np.ndarray:
    """Forward transform of every row in place; the result is in bit-reversed order."""
    count, size = rows.shape
    h = size // 2
    while h:
        v = rows.reshape(count, -1, 2, h)
        x, y = v[:, :, 0], v[:, :, 1]
        low, high = _reduced(x + y), (x + np.uint64(PRIME) - y) * roots[h][0] % PRIME
        v[:, :, 0], v[:, :, 1] = low, high
        h //= 2
    return rows


def inverse(rows: np.ndarray, roots: dict) -> np.ndarray:
    """Inverse transform of rows in bit-reversed order, in place, without the factor 1 / size."""
    count, size = rows.shape
    h = 1
    while h < size:
        v = rows.reshape(count, -1, 2, h)
        x, y = v[:, :, 0], v[:, :, 1] * roots[h][1] % PRIME
        low, high = _reduced(x + y), _reduced(x + np.uint64(PRIME) - y)
        v[:, :, 0], v[:, :, 1] = low, high
        h *= 2
    return rows


def seeds(x: np.ndarray, n: int, block: int, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks and distances in [first, first + count) at which the whole block occurs again.

    x is padded behind its first n numbers, of which all full blocks are tried. Where squares can
    add up to the prime or more, a residue of zero may also be a multiple of it; growing a seed
    compares the words, so nothing wrong stays.
    """
    size = 1
    while size < block + count - 1:
        size *= 2
    roots, whole = _roots(size), n // block
    factor = np.uint64(2 * pow(size, -1, PRIME) % PRIME)
    squares = np.concatenate([[0], np.cumsum(x * x % PRIME, dtype=np.uint64)])
    windows = np.lib.stride_tricks.sliding_window_view(x, size)
    at, distance = [], []
    step = max(1, CHUNK // size)
    for low in range(0, whole, step):
        starts = np.arange(low, min(low + step, whole), dtype=np.int64) * block
        back = np.zeros((len(starts), size), dtype=np.uint64)
        own = x[low * block : low * block + len(starts) * block].reshape(-1, block)
        back[:, 0], back[:, size - block + 1 :] = own[:, 0], own[:, :0:-1]
        product = transform(back, roots) * transform(windows[starts + first].copy(), roots) % PRIME
        twice = inverse(product, roots)[:, :count] * factor % PRIME
        here = squares[starts + block] - squares[starts]
        places = starts[:, None] + first + np.arange(count)
        there = squares[places + block] - squares[places]
        found, shift = np.nonzero((here[:, None] + there) % PRIME == twice)
        at.append(starts[found])
        distance.append(shift + first)
    if not at:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(at), np.concatenate(distance)


def _equal_steps(x: np.ndarray, at: int, d: int, to: int) -> int:
    """How many words from ``at`` on (``to`` 1) or before it (``to`` -1) equal the word d later."""
    done, step = 0, 64
    while True:
        low = at + done if to > 0 else max(0, at - done - step)
        high = min(at + done + step, len(x) - d) if to > 0 else at - done
        if high <= low:
            return done
        differ = np.flatnonzero(x[low:high] != x[low + d : high + d])
        if len(differ):
            return done + int(differ[0] if to > 0 else high - low - 1 - differ[-1])
        done += high - low
        step = min(4 * step, 1 << 16)


def grown(x: np.ndarray, at: np.ndarray, distance: np.ndarray, block: int) -> dict[tuple[int, int], int]:
    """(start, end) of the longest stretch around every seed, with the smallest distance that gave it.

    A seed inside a stretch that is known with a divisor of its distance grows to the same stretch
    and is skipped, so a stretch is grown once, not once per block.
    """
    found: dict[tuple[int, int], int] = {}
    open_ = np.ones(len(at), dtype=bool)
    for i in range(len(at)):
        if not open_[i]:
            continue
        place, d = int(at[i]), int(distance[i])
        if not np.array_equal(x[place : place + block], x[place + d : place + d + block]):
            continue
        start = place - _equal_steps(x, place, d, -1)
        end = place + block + _equal_steps(x, place + block, d, 1) + d
        found[start, end] = min(d, found.get((start, end), d))
        last = np.searchsorted(at, end - block, side="right")
        open_[i:last] &= (distance[i:last] % d != 0) | (at[i:last] + block + distance[i:last] > end)
    return found


def runs_of(texts: list[np.ndarray]) -> list[list[Run]]:
    """The runs of every text, given as integers, by start and then period.

    Texts are joined with marks that occur once, so no stretch crosses from one to the next.
    """
    out: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    unique = max((int(t.max()) + 1 for t in texts if len(t)), default=0)
    block = BASE
    while True:
        chosen = [i for i, t in enumerate(texts) if len(t) >= max(LEAST_WORDS, LEAST_TURNS * block)]
        if not chosen:
            break
        first, count = (1, 2 * BASE - 1) if block == BASE else (block, block)
        pieces, offsets, at = [], [], 0
        for mark, i in enumerate(chosen):
            pieces += [texts[i], [unique + mark]]
            offsets.append(at)
            at += len(texts[i]) + 1
        pad = np.full(first + 4 * block + block, unique + len(chosen), dtype=np.uint64)
        x = np.concatenate([np.concatenate(pieces).astype(np.uint64), pad])
        for (start, end), d in grown(x, *seeds(x, at, block, first, count), block).items():
            if end - start >= max(LEAST_WORDS, LEAST_TURNS * d):
                k = int(np.searchsorted(offsets, start, side="right")) - 1
                key = start - offsets[k], end - offsets[k]
                held = out[chosen[k]]
                held[key] = min(d, held.get(key, d))
        block *= 2
    return [sorted(((s, e - s, d) for (s, e), d in held.items()), key=lambda r: (r[0], r[2])) for held in out]


def tiled(doc_id: int | None, words: Words) -> Words:
    """The words of a document of which one id in ten becomes periodic from some word on."""
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _summary(words: Words, runs: list[Run]) -> tuple:
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    collapsed = hashlib.sha256(b" ".join([words[i] for i in kept.tolist()])).hexdigest()
    return len(runs), *best, milli, hashlib.sha256(listed).hexdigest(), collapsed


def document_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: Callable[[int | None, Words], Words] | None = None,
) -> DataFrame:
    """One row per document: its runs in number and digest, the best of them, and the collapsed text's digest.

    The best run has the greatest exact length / period, then the smallest start and period. A word
    is dropped if a run contains it after that run's first period. ``rewrite`` changes the words of
    a document first. A null or empty text has no words, no run and digests of nothing; a null id
    stays null and is never rewritten by ``tiled``; repeated rows give repeated rows; other columns
    are not read. Rows are independent, so there is no exchange.
    """
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    numbers = ", ".join(f"{name} long" for name in names[:6])

    def rows(ids: list, held: list[Words]) -> pa.RecordBatch:
        index: dict[bytes, int] = {}
        texts = [np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words)) for words in held]
        found = [(i, *_summary(words, runs)) for i, words, runs in zip(ids, held, runs_of(texts))]
        types = [pa.int64()] * 6 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size = [], [], 0
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                words = texts_of(one, "text")[0].split()
                key = one.column("doc_id")[0].as_py()
                ids.append(key)
                held.append(rewrite(key, words) if rewrite else words)
                size += len(words)
                if size >= FLUSH:
                    yield rows(ids, held)
                    ids, held, size = [], [], 0
            if ids:
                yield rows(ids, held)

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, f"{numbers}, runs_sha256 string, collapsed_sha256 string")
