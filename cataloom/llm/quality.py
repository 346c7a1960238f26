"""Quality rules: text statistics and a decision list learned by sequential covering.

Everything here is DataFrame work on built-in expressions. Words are maximal runs of
characters other than ``\\x20`` and ``\\x09-\\x0D``. A null text counts as an empty one and has
zero statistics. Rows repeat as often as they come; extra columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: ratios that rules may test, all from the statistics of one text
FEATURES = {
    "mean_word": lambda c: c("word_chars") / c("n_words"),
    "symbols_per_word": lambda c: c("n_symbols") / c("n_words"),
    "repeat_share": lambda c: c("n_repeat_words") / c("n_words"),
    "dup_line_share": lambda c: c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
    "distinct_share": lambda c: c("n_distinct") / c("n_words"),
    "upper_share": lambda c: c("n_upper") / F.greatest(c("word_chars"), F.lit(1)),
    "marks_per_word": lambda c: c("n_marks") / c("n_words"),
}


def with_statistics(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with one struct column ``into``: the five counts, the base verdict and the features.

    All work is per row, so no text is shuffled. Word windows are compared by 64-bit hashes;
    where no window repeats, nothing is sorted. A long text costs n log n.
    """
    t = f"{into}_t"
    work = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    w, g, e, p, lines = (f"{into}_{x}" for x in ("words", "grams", "sorted", "places", "lines"))
    work = work.withColumn(w, F.array_remove(F.split(t, SPACE), ""))
    n = F.size(w)
    work = work.withColumn(
        g,
        F.when(
            n >= 3,
            F.slice(
                F.transform(w, lambda x, i: F.xxhash64(x, F.get(F.col(w), i + 1), F.get(F.col(w), i + 2))),
                F.lit(1), n - 2,
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    work = work.withColumn(lines, F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)))
    # windows that occur again, by sorting (hash, place) and looking at both neighbours
    repeats = F.size(F.array_distinct(g)) < F.size(g)
    work = work.withColumn(
        e,
        F.when(repeats, F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    )
    work = work.withColumn(
        p,
        F.array_sort(F.array_compact(F.transform(e, lambda x, k: F.when(
            (x.h == F.get(F.col(e), k - 1).h) | (x.h == F.get(F.col(e), k + 1).h), x.i
        )))),
    )
    # each repeated window covers three words, or as many as there are up to the next one
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(F.col(p), k + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x,
    )
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(lines),
        "n_distinct": F.size(F.array_distinct(w)),
        "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")),
        "n_marks": F.regexp_count(t, F.lit(r"[!?;:]")),
    }
    # one row each; a filter on the counts must not be moved below, where every use would compute them again
    stats = F.explode_outer(F.array(F.struct(*(v.cast("long").alias(k) for k, v in counts.items()))))
    return work.select(*(F.col(c) for c in df.columns), stats.alias(into))


def base_failed(stats: Column) -> Column:
    """Under 50 words, or more than half of the words in repeated 3-word windows."""
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def features(stats: Column) -> dict[str, Column]:
    """Feature columns; 0 for a text without words."""
    return {
        k: F.when(stats["n_words"] > 0, f(lambda c: stats[c].cast("double"))).otherwise(F.lit(0.0))
        for k, f in FEATURES.items()
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, values: dict[str, Column]) -> Column:
        v = values[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Reject where all conditions hold."""

    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def column(self, values: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a & b, (c.column(values) for c in self.conditions))


def verdict(rules: list[Rule], values: dict[str, Column]) -> Column:
    """The ordered list as one conditional expression: the first rule that holds rejects."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.column(values), F.lit(False)).otherwise(out)
    return out


def learn_rules(
    labelled: DataFrame, bad: str, keep: int = 12, bins: int = 40, conjuncts: int = 4, min_precision: float = 0.9,
    min_covered: int = 5,
) -> list[Rule]:
    """Sequential covering over all rows of ``labelled`` (columns of FEATURES, ``bad`` 0/1, ``doc_id``).

    A rule grows by the threshold with the largest information gain among ``bins`` quantiles of
    each feature, is cut back to the prefix that does best on the third of the rows held out
    from growing, and is kept while that prefix is right on ``min_precision`` of both parts.
    Rows that it covers leave; the next rule grows on the rest. Each step is one aggregation whose
    result has features x bins rows, whatever the number of labels. No rows, or one class only,
    gives an empty list, which keeps everything. Null labels are left out.
    """
    names = list(FEATURES)
    labelled = labelled.where(F.col(bad).isin(0, 1))
    cuts_row = labelled.agg(*(
        F.percentile_approx(f, [i / bins for i in range(1, bins)], 1000).alias(f) for f in names
    )).first()
    if cuts_row is None or cuts_row[names[0]] is None:
        return []
    cuts = {f: sorted(set(cuts_row[f])) for f in names}
    # the number of thresholds below a value is all that the search needs
    binned = stage(labelled.select(
        F.col(bad).cast("int").alias("bad"),
        (F.pmod(F.xxhash64(F.col("doc_id")), F.lit(3)) == 0).alias("held"),
        *(reduce(lambda a, b: a + b, ((F.col(f) > c).cast("int") for c in cuts[f])).alias(f) for f in names),
    ))

    def holds(c: Condition) -> Column:
        k = cuts[c.feature].index(c.threshold)
        return F.col(c.feature) > k if c.above else F.col(c.feature) <= k

    def histogram(rows: DataFrame) -> dict:
        pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in names))).alias("x")
        found: dict = {}
        for r in rows.select("bad", "held", pairs).groupBy("x.f", "x.b", "held", "bad").count().collect():
            found.setdefault((r["f"], r["held"]), {})[(r["b"], r["bad"])] = r["count"]
        return found

    def totals(found: dict, held: bool) -> tuple[int, int]:
        at = found.get((names[0], held), {})
        return sum(v for (_, y), v in at.items() if y), sum(v for (_, y), v in at.items() if not y)

    rules: list[Rule] = []
    uncovered = binned
    start = histogram(uncovered)
    while len(rules) < keep:
        rows, found, grown, path = uncovered, start, [], []
        while len(grown) < conjuncts:
            p0, n0 = totals(found, False)
            if p0 < min_covered or n0 == 0:
                break
            best = max(
                (_gain(f, above, k, found.get((f, False), {}), p0, n0) + (f, above, k)
                 for f in names for k in range(len(cuts[f])) for above in (True, False)),
            )
            if best[0] <= 0:
                break
            condition = Condition(best[2], best[3], cuts[best[2]][best[4]])
            grown.append(condition)
            rows = rows.where(holds(condition))
            found = histogram(rows)
            path.append((*totals(found, False), *totals(found, True)))
        usable = [
            (((hp + p) - (hn + n)) / (hp + hn + p + n), -i, i) for i, (p, n, hp, hn) in enumerate(path)
            if p + hp >= min_covered and p >= min_precision * (p + n) and hp >= min_precision * (hp + hn)
        ]
        if not usable:
            break
        i = max(usable)[2]
        p, n, hp, hn = path[i]
        rules.append(Rule(tuple(grown[: i + 1]), (p + hp) / (p + hp + n + hn), p + hp))
        uncovered = uncovered.where(~reduce(lambda a, b: a & b, (holds(c) for c in grown[: i + 1])))
        start = histogram(uncovered)
    return rules


def _gain(feature: str, above: bool, k: int, at: dict, p0: int, n0: int) -> tuple[float, int]:
    """Information gained by the covered bad rows; ties go to the larger cover."""
    inside = [(y, v) for (b, y), v in at.items() if (b > k) == above]
    p = sum(v for y, v in inside if y)
    n = sum(v for y, v in inside if not y)
    if p == 0 or (p, n) == (p0, n0):
        return (0.0, 0)
    return (p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))), p)


def quality_verdicts(docs: DataFrame, labels: DataFrame, **settings) -> tuple[DataFrame, list[Rule]]:
    """One row per document row: ``doc_id``, counts, ``base_failed``, ``kept``; and the rules.

    ``labels`` has ``doc_id`` and ``quality`` (0 is bad). Statistics are staged once, narrow; the
    labelled ones teach the rules, then the rules judge all. Documents without a label, and a null
    ``doc_id``, are judged like the others.
    """
    stats = stage(with_statistics(docs.select("doc_id", "text"), "text", "q").select("doc_id", "q"))
    q = F.col("q")
    rules = learned(stats, labels, **settings)
    return stats.select(
        "doc_id", *(q[c].alias(c) for c in COUNTS), base_failed(q).alias("base_failed"),
        (~base_failed(q) & verdict(rules, features(q))).alias("kept"),
    ), rules


def learned(stats: DataFrame, labels: DataFrame, **settings) -> list[Rule]:
    """Rules from staged statistics (``doc_id``, ``q``) and labels."""
    marks = labels.select(F.col("doc_id").alias("label_id"), (1 - F.col("quality")).alias("bad"))
    taught = stats.join(marks, F.col("doc_id") == F.col("label_id")).select(
        "doc_id", "bad", *(v.alias(k) for k, v in features(F.col("q")).items()))
    return learn_rules(taught, "bad", **settings)


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the learned list, with their own columns."""
    stats = stage(with_statistics(docs.select("doc_id", "text"), "text", "q").select("doc_id", "q"))
    rules = learned(stats, labels, **settings)
    into = "quality_statistics_"
    q = F.col(into)
    return with_statistics(docs, "text", into).where(~base_failed(q) & verdict(rules, features(q))).select(docs.columns)
