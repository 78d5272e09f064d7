"""Groups of spelling variants: words that differ by one inserted, deleted or replaced code point.

The vocabulary is an acceptor; composed with a one-edit transducer and with itself it accepts the
pairs of near words. It is never built as a whole: a pair shares half of the shorter word, before or
after the edit, so the composition falls apart by the state that this half leads to, forwards or
backwards. Each such initial state is one group of rows, whose rests form a small minimised acceptor;
the composition is enumerated there. A state with very many words is entered one step further, per
place of the edit, where at most one word per letter meets.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import dropped, saved, texts_of

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5  # how many times as frequent a form is at least
MAX_STATE = 1000  # words of one initial state that are enumerated together
HELD = 1 << 18  # words that a task counts before it passes them on
SLIP = 199

LOWER = re.compile("[a-z\u00C0-\u00FF]+")

Near = dict[str, tuple[int, int, str]]  # word: number of near words, largest count among them, that word


def slipped(doc_id: int | None, run: str) -> str:
    """The run, for one in 199 of (document, run) without one of its code points; a null id counts as empty."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spelled: Callable[[int | None, str], str] | None = None,
    least_length: int = LEAST_LENGTH,
) -> DataFrame:
    """(word, n): the letter runs of all texts, A to Z in lower case, with how often they occur.

    ``spelled`` changes a run of one document first. Tasks count before rows are exchanged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                for word, n in Counter(LOWER.findall(t.lower().decode())).items():
                    if len(word) >= least_length:
                        held[spelled(key, word) if spelled else word] += n
                if len(held) > HELD:
                    yield rows()
        yield rows()

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = slim.mapInArrow(run, "word string, n long").filter(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """The minimised acceptor of a sorted list of different strings.

    A state is its finality and its edges by letter; equal states are one number, so words that end
    alike share their last states. ``lengths`` has the lengths of what each state accepts.
    """

    def __init__(self, words: list[str]):
        self.states: list[tuple[bool, dict[str, int]]] = []
        self.lengths: list[set[int]] = []
        self._known: dict[tuple, int] = {}
        self._local: dict[int, list[tuple[str, str]]] = {}
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]  # open states along the last word
        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path += [(False, {}) for _ in word[same:]]
            path[-1] = (True, path[-1][1])
            last = word
        self._close(path, last, 0)
        self.start = self._number(path[0])

    def _number(self, state: tuple[bool, dict[str, int]]) -> int:
        key = state[0], tuple(state[1].items())
        if key not in self._known:
            self._known[key] = len(self.states)
            self.states.append(state)
            self.lengths.append(({0} if state[0] else set()) | {n + 1 for to in state[1].values() for n in self.lengths[to]})
        return self._known[key]

    def _close(self, path: list, word: str, keep: int) -> None:
        while len(path) > keep + 1:
            state = path.pop()
            path[-1][1][word[len(path) - 1]] = self._number(state)

    def shared(self, s: int, t: int, but: str = "") -> Iterator[str]:
        """What is accepted both from s and from t and does not start with ``but``."""
        open_ = [(s, t, "")]
        while open_:
            a, b, before = open_.pop()
            (end, edges), (also, others) = self.states[a], self.states[b]
            if end and also:
                yield before
            for c in edges.keys() & others.keys():
                if (before or c != but) and not self.lengths[edges[c]].isdisjoint(self.lengths[others[c]]):
                    open_.append((edges[c], others[c], before + c))

    def edited(self, s: int) -> list[tuple[str, str]]:
        """Pairs accepted from s whose first letters differ by the edit: replaced, or inserted in the second.

        A letter inserted among equal ones counts as the last of them, so a pair has one place.
        """
        if s not in self._local:
            edges = sorted(self.states[s][1].items())
            out = []
            for i, (c, to) in enumerate(edges):
                out += [(c + y, d + y) for d, other in edges[i + 1 :] for y in self.shared(to, other)]
                out += [(y, c + y) for y in self.shared(s, to, c)]
            self._local[s] = out
        return self._local[s]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """The composition's pairs: a common path, one edit, a common rest."""
        open_ = [(self.start, "")]
        while open_:
            s, before = open_.pop()
            yield from ((before + a, before + b) for a, b in self.edited(s))
            open_ += [(to, before + c) for c, to in self.states[s][1].items()]


def _meet(near: Near, a: tuple[str, int], b: tuple[str, int]) -> None:
    for (word, _), (other, n) in ((a, b), (b, a)):
        count, most, best = near.get(word, (0, -1, ""))
        near[word] = (count + 1, n, other) if n > most or n == most and other < best else (count + 1, most, best)


def near_of_state(side: str, level: int, words: dict[str, int]) -> Near:
    """What the words of one initial state are near to, counting pairs whose shorter word has ``level`` letters.

    Backwards (side s), pairs that also share the first half belong to a forward state and are left out.
    """
    k = level // 2
    rests = {w[k:] if side == "p" else w[: len(w) - k][::-1]: (w, n) for w, n in words.items()}
    near: Near = {}
    for x, y in Acceptor(sorted(rests)).pairs():
        a, b = rests[x], rests[y]
        if min(len(a[0]), len(b[0])) == level and (side == "p" or a[0][:k] != b[0][:k]):
            _meet(near, a, b)
    return near


def near_of_place(side: str, level: int, words: dict[str, int]) -> Near:
    """The same for words that are equal but for one place: at most one per letter, and one without."""
    k, near, held = level // 2, {}, list(words.items())
    for i, a in enumerate(held):
        for b in held[:i]:
            if min(len(a[0]), len(b[0])) == level and (side == "p" or a[0][:k] != b[0][:k]):
                _meet(near, a, b)
    return near


def _grouped(rows: DataFrame, of: Callable[[str, int, dict[str, int]], Near]) -> DataFrame:
    """(word, n_near, most, best) per group of equal ``key``: groups are sorted together, one is held at a time."""

    def flat(near: Near) -> list[tuple]:
        return [(w, *v) for w, v in near.items()]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*found)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["word", "n_near", "most", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, found = None, {}, []
        for batch in batches:
            for new, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n"))):
                if new != key:
                    if len(words) > 1:
                        found += flat(of(key[0], int(key[1:].split(":", 1)[0]), words))
                    key, words = new, {}
                    if len(found) > 10_000:
                        yield batch_of(found)
                        found = []
                words[word] = n
        if len(words) > 1:
            found += flat(of(key[0], int(key[1:].split(":", 1)[0]), words))
        yield batch_of(found)

    dealt = rows.select("key", "word", "n").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "word string, n_near long, most long, best string")


def states(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(key, word, n, ...): every word under the initial states that its pairs are enumerated in.

    Of two near words the shorter has m letters; both share their first or their last m // 2. A word
    of L letters may be the shorter (m = L) or the longer (m = L - 1), so it has four states at most.
    """
    size = F.length("word")
    level = F.explode(F.filter(F.array(size, size - 1), lambda m: m >= least_length)).alias("level")
    side = F.explode(F.array(F.lit("p"), F.lit("s"))).alias("side")
    rows = words.select("word", "n", level).select("*", side)
    half = (F.col("level") / 2).cast("int")
    affix = F.when(F.col("side") == "p", F.col("word").substr(F.lit(1), half)).otherwise(F.col("word").substr(F.length("word") - half + 1, half))
    return rows.withColumn("key", F.concat("side", F.col("level").cast("string"), F.lit(":"), affix))


def places(rows: DataFrame) -> DataFrame:
    """The words of large states under one key per place of the edit: what stands before and after it.

    Replaced letters leave an equal rest at an equal place; so does an inserted one, which counts as
    the last of equal letters in reading direction, and the word without it.
    """
    half = (F.col("level") / 2).cast("int")
    rest = F.when(F.col("side") == "p", F.col("word").substr(half + 1, F.length("word")))
    rest = rest.otherwise(F.reverse(F.col("word").substr(F.lit(1), F.length("word") - half)))
    at = lambda i: F.col("rest").substr(i + 1, F.lit(1))
    cut = lambda i: F.concat(F.col("rest").substr(F.lit(1), i), F.col("rest").substr(i + 2, F.length("rest")))
    own = F.length("word") == F.col("level")
    inner, all_ = F.sequence(F.lit(0), F.length("rest") - 1), F.sequence(F.lit(0), F.length("rest"))
    replaced = F.transform(inner, lambda i: F.concat(F.lit("\tr"), i.cast("string"), F.lit("\t"), cut(i)))
    longer = F.transform(
        F.filter(inner, lambda i: at(i) != at(i + 1)), lambda i: F.concat(F.lit("\ti"), i.cast("string"), F.lit("\t"), cut(i)))
    shorter = F.transform(all_, lambda i: F.concat(F.lit("\ti"), i.cast("string"), F.lit("\t"), F.col("rest")))
    keys = F.when(own, F.concat(replaced, shorter)).otherwise(longer)
    return rows.withColumn("rest", rest).select(F.explode(keys).alias("place"), "key", "word", "n").select(
        F.concat("key", "place").alias("key"), "word", "n")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, max_state: int = MAX_STATE) -> DataFrame:
    """(word, n_near, most, best) for every word (word, n) that has near words.

    most is the largest n of a near word, best that word (of equal ones the first in code-point
    order). Words are different and have ``least_length`` letters or more.
    """
    rows = saved(states(words, least_length), "states")
    large = saved(rows.groupBy("key").count().filter(F.col("count") > max_state).select("key"), "large")
    found = _grouped(rows.join(large, "key", "left_anti"), near_of_state)
    found = found.unionByName(_grouped(places(rows.join(large, "key", "left_semi")), near_of_place))
    first = F.min(F.struct((-F.col("most")).alias("less"), "best"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    near = saved(merged.select("word", "n_near", (-F.col("first.less")).alias("most"), F.col("first.best").alias("best")), "near")
    dropped(rows)
    dropped(large)
    return near


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: the last form that the chain leads to.

    Forms are more frequent than their words, so chains end; each round doubles the steps that are
    followed. A word is the form of no more words than have one edit, so no join key is hot.
    """
    held = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = held.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = saved(held.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        dropped(held)
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        held = saved(new.drop("moved"), "roots")
        dropped(new)


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spelled: Callable[[int | None, str], str] | None = None,
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, max_state: int = MAX_STATE,
) -> DataFrame:
    """word, n, form, root, n_near, form_n for every word of enough letters and occurrences.

    form is the near word of largest n (of equal ones the first in code-point order) if it has at
    least ``ratio`` times the word's n, else null; root follows forms to the last and is the word
    itself without one. Null and empty texts have no words, repeated rows count again, a table
    without words gives no rows, other columns are not read.
    """
    counted = word_counts(docs, doc_id, text, spelled, least_length)
    words = saved(counted.filter(F.col("n") >= least_count), "vocabulary")
    near = near_words(words, least_length, max_state)
    takes = F.col("most") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.when(takes, F.col("best")).alias("form"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, F.col("most")).alias("form_n"))
    formed = saved(formed, "formed")
    led = formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left")
    return led.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
