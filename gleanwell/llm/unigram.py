"""Token counts of a unigram tokenizer without its ids: matches, best scores and piece counts.

The tokenizer: runs of white space are one space, ends are stripped, every word gets the word mark
in front and is segmented alone by the best sum of piece scores. Characters that no piece covers
cost ``LEAST - 10`` and count one piece per UTF-8 byte when the vocabulary has all byte pieces,
else one per run of such characters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import parts, texts_of

MARK = "▁"
UNKNOWN_COST = 10.0
CACHE = 400_000  # words a task keeps the counts of


def piece_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file with scores by rank: the log of Zipf's law.

    A file of merges has ranks in place of probabilities. Piece r of n gets -log(r + 1) minus the log
    of the n-th harmonic number, in file order, so that scores are those of a unigram model.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.vocab_size()
    norm = math.log(math.fsum(1 / (r + 1) for r in range(size)))
    return [(model.id_to_piece(i), -math.log(i + 1) - norm) for i in range(size)]


class UnigramCounter:
    """Counts the pieces of words by a best-score pass over all vocabulary matches."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]]):
        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        if len(self.matches):
            self.matches.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_COST
        names = {p for p, _ in vocabulary}
        self.by_bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.known: dict[bytes, int] = {}

    def count(self, word: str) -> int:
        """Pieces of the best segmentation.

        Ends are settled from left to right. All pieces that end at a character come longest
        first, that is by their start; a later one replaces the best only if its sum is greater,
        so that ties go to the longest last piece, as in the tokenizer. A character that is no
        piece by itself competes last.
        """
        n = len(word)
        best = [0.0] + [0.0] * n
        pieces = [0] * (n + 1)
        lone = [False] * (n + 1)  # ends reached by an uncovered character, for runs without byte pieces
        found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if len(self.matches):
            for end, match in self.matches.iter(word):
                found[end].append(match)
        for end in range(n):
            top, number, single, alone = -math.inf, 0, False, False
            for length, score in found[end]:
                single = single or length == 1
                total = score + best[end + 1 - length]
                if total > top:
                    top, number = total, pieces[end + 1 - length] + 1
            if not single:
                total = self.unknown + best[end]
                if total > top:
                    size = len(word[end].encode()) if self.by_bytes else 0 if lone[end] else 1
                    top, number, alone = total, pieces[end] + size, True
            best[end + 1], pieces[end + 1], lone[end + 1] = top, number, alone
        return pieces[n]

    def counts(self, texts: list[bytes]) -> list[int]:
        split = [t.split() for t in texts]
        words = set().union(*split) if split else set()
        if len(self.known) + len(words) > CACHE:
            self.known.clear()
        for word in words.difference(self.known):
            self.known[word] = self.count(MARK + word.decode())
        get = self.known.__getitem__
        return [sum(map(get, ws)) for ws in split]


def token_counts(
    docs: DataFrame, vocabulary: Sequence[tuple[str, float]], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_tokens for every row, in one pass without a shuffle.

    Null and empty texts count zero; rows of equal id are counted each. The vocabulary goes to
    the tasks once; a task keeps the counts of up to ``CACHE`` words and forgets them when full,
    which changes no result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(list(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(shared.value)
        for batch in parts(batches):
            texts = texts_of(batch, "text")
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": [len(t.split()) for t in texts],
                "n_tokens": counter.counts(texts),
            })

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
