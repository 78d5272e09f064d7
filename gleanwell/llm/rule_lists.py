"""Quality rules: text statistics, fixed base rules, and a decision list learned from labels.

Everything here is DataFrame expressions; the driver sees counts per (statistic, bin) only.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.common import BLANKS, saved, word_list

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

CUTS = 24  # quantiles of each statistic that are tried as thresholds, per class
MAX_LITERALS = 4
MAX_RULES = 16
MIN_PRECISION = 0.9  # of a rule on the labels set aside for pruning
MIN_COVER = 5  # bad documents that a rule must find among those it was grown on
PRUNE_SHARE = 3  # one label in three is set aside

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_digits", "n_exclaim",
]


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that are found twice or more, the first time included.

    Windows are compared by a 64-bit hash of their words. Texts without a repeat stop at the
    count of different hashes; the others sort (hash, place) and mark equal neighbours.
    """
    def places(marks: Column) -> Column:
        def hit(mark: Column, k: Column) -> Column:
            before, after = F.get(marks, k - 1), F.get(marks, k + 1)
            return F.coalesce(before["h"] == mark["h"], F.lit(False)) | F.coalesce(after["h"] == mark["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(marks, hit), lambda m: m["i"]))

    def covered(found: Column) -> Column:
        steps = F.transform(found, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(found, k + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def count(hashes: Column) -> Column:
        marks = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(again, bound(bound(marks, places), covered)).otherwise(0)

    starts = F.sequence(F.lit(1), F.size(words) - (window - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(F.size(words) >= window, bound(hashes, count)).otherwise(0)


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """_row (all columns of the document), doc_id and the counts as longs; null text is empty.

    Empty texts have zero everywhere. A document is one row throughout, so neither copies nor hot
    sources meet in one place; a very long text is arrays of one row.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    first = docs.select(
        F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("doc_id"), body.alias("_text"),
        word_list(body).alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
    )
    t, w, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    counts = {
        "n_words": F.size(w), "word_chars": without(t, BLANKS), "n_symbols": F.length(t) - without(t, SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": repeated_words(w),
        "n_lines": F.size(lines), "n_distinct": F.size(F.array_distinct(w)),
        "n_upper": F.length(t) - without(t, string.ascii_uppercase),
        "n_digits": F.length(t) - without(t, string.digits), "n_exclaim": F.length(t) - without(t, "!"),
    }
    return first.select("_row", "doc_id", *[counts[c].cast("long").alias(c) for c in COUNTS])


def features() -> dict[str, Column]:
    """The interpretable statistics that thresholds are learned on, from the counts."""
    ratio = lambda a, b: F.coalesce(F.col(a) / F.nullif(b, F.lit(0)), F.lit(0.0))
    return {
        "words": F.col("n_words").cast("double"),
        "characters_per_word": ratio("word_chars", "n_words"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "share_of_repeated_lines": ratio("n_dup_lines", "n_lines"),
        "share_of_repeated_words": ratio("n_repeat_words", "n_words"),
        "share_of_different_words": ratio("n_distinct", "n_words"),
        "share_of_capitals": ratio("n_upper", "word_chars"),
        "share_of_digits": ratio("n_digits", "word_chars"),
        "exclamations_per_word": ratio("n_exclaim", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


class DecisionList:
    """Ordered rules, each a list of (statistic, '>=' or '<', threshold); the first that holds drops."""

    def __init__(self, rules: Sequence[Sequence[tuple[str, str, float]]]):
        self.rules = [list(r) for r in rules]

    def fired(self) -> Column:
        """The number of the first rule that holds, from 1, else null: one conditional expression."""
        values, out = features(), None
        for number, rule in enumerate(self.rules, 1):
            holds = F.lit(True)
            for name, sign, cut in rule:
                holds = holds & (values[name] >= cut if sign == ">=" else values[name] < cut)
            out = F.when(holds, number) if out is None else out.when(holds, number)
        return out.otherwise(F.lit(None)) if self.rules else F.lit(None).cast("int")

    def __str__(self) -> str:
        lines = [" and ".join(f"{n} {s} {c:.6g}" for n, s, c in rule) for rule in self.rules]
        return "\n".join(f"{i}. drop if {line}" for i, line in enumerate(lines, 1)) + "\nelse keep"


def learn(labelled: DataFrame, label: str = "quality", bad: int = 0) -> DecisionList:
    """A decision list by sequential covering over rows with the counts and a label.

    A rule is grown literal by literal on two thirds of the rows by the best information gain,
    then cut back to the prefix that does best on the other third, and kept if ``MIN_PRECISION``
    of what it covers there is bad. Covered rows leave, until no rule is good enough. Thresholds
    are quantiles of each class. Each step is one aggregation of the binned labels, of which the
    driver gets a count per (statistic, bin). Rows with a null label or that the base rules drop
    teach nothing; without labels of both kinds the list is empty.
    """
    names = list(features())
    rows = labelled.filter(F.col(label).isNotNull() & ~base_failed()).select(
        *[v.alias(n) for n, v in features().items()], (F.col(label) == bad).alias("bad"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(PRUNE_SHARE)) == 0).alias("aside"),
    )
    steps = [F.lit(k / CUTS) for k in range(1, CUTS)]
    per_class = rows.groupBy("bad").agg(*[F.percentile_approx(n, F.array(*steps), 10000).alias(n) for n in names]).collect()
    if len(per_class) < 2:
        return DecisionList([])
    cuts = {n: sorted({v for r in per_class for v in r[n]}) for n in names}
    bins = [
        F.size(F.filter(F.array(*[F.lit(c) for c in cuts[n]]), (lambda v: lambda c: c <= v)(F.col(n)))).alias(n)
        for n in names
    ]
    binned = saved(rows.select(F.array(*bins).alias("bins"), "bad", "aside"), "binned-labels")

    def holds(rule) -> Column:
        out = F.lit(True)
        for i, sign, k in rule:
            value = F.col("bins")[i]
            out = out & (value >= k if sign == ">=" else value < k)
        return out

    rules: list[list[tuple[int, str, int]]] = []
    while len(rules) < MAX_RULES:
        left = binned
        for rule in rules:
            left = left.filter(~holds(rule))
        rule = _grown(left.filter("NOT aside"), holds, cuts, names)
        if not rule:
            break
        asked = [c for j in range(1, len(rule) + 1) for c in (
            F.count_if(holds(rule[:j]) & F.col("bad")), F.count_if(holds(rule[:j]) & ~F.col("bad")))]
        found = list(left.filter("aside").agg(*asked).first())
        scores = [((p - n) / (p + n), -j, p, n) for j, (p, n) in enumerate(zip(found[::2], found[1::2]), 1) if p + n]
        if not scores:
            break
        _, j, p, n = max(scores)
        if p < MIN_PRECISION * (p + n):
            break
        rules.append(rule[:-j])
    named = [[(names[i], sign, cuts[names[i]][k - 1]) for i, sign, k in rule] for rule in rules]
    return DecisionList(named)


def _grown(rows: DataFrame, holds, cuts: dict[str, list[float]], names: list[str]) -> list[tuple[int, str, int]]:
    """A conjunction of literals (statistic, sign, bin), the best next one at a time."""
    rule: list[tuple[int, str, int]] = []
    while len(rule) < MAX_LITERALS:
        counts = (
            rows.filter(holds(rule)).select("bad", F.posexplode("bins").alias("i", "bin"))
            .groupBy("i", "bin").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        )
        table = {(r["i"], r["bin"]): (r["p"], r["n"]) for r in counts}
        p0 = sum(p for (i, _), (p, _) in table.items() if i == 0)
        n0 = sum(n for (i, _), (_, n) in table.items() if i == 0)
        if p0 < MIN_COVER or not n0:
            break
        best = (1e-9, None)
        for i, name in enumerate(names):
            below_p = below_n = 0
            for k in range(1, len(cuts[name]) + 1):
                p, n = table.get((i, k - 1), (0, 0))
                below_p, below_n = below_p + p, below_n + n
                for sign, p1, n1 in ((">=", p0 - below_p, n0 - below_n), ("<", below_p, below_n)):
                    if p1 >= MIN_COVER and n1 < n0:
                        gain = p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))
                        best = max(best, (gain, (i, sign, k)), key=lambda b: b[0])
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def judged(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", rows: bool = False,
) -> DataFrame:
    """With ``rows`` the documents themselves as _row; doc_id, the counts, base_failed, rule and kept for every document.

    Labels meet documents on the id: null ids match nothing, repeated labels count each. Extra
    columns of either table stay out of the way in _row.
    """
    counted = with_statistics(docs, doc_id, text)
    counted = saved(counted if rows else counted.drop("_row"), "statistics")
    answers = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).alias("_label"))
    rules = learn(counted.select("doc_id", *COUNTS).join(answers, "doc_id"), "_label")
    kept = ~base_failed() & F.col("rule").isNull()
    return counted.withColumn("rule", rules.fired()).withColumn("base_failed", base_failed()).withColumn("kept", kept)


def quality_table(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The counts and verdicts, one row per document."""
    return judged(docs, labels, **columns)


def kept_documents(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The documents' own columns, for those that are kept."""
    return judged(docs, labels, rows=True, **columns).filter("kept").select("_row.*")
