"""Quality rules: learned decision lists, all in DataFrame expressions.

Each text's statistics are computed inside its own row; no text is shuffled. Sequential
covering learns rules for low quality: a rule grows by the threshold condition with the
best information gain on two thirds of the labelled rows, is pruned on the other third to
the beginning with the best (p - n) / (p + n), and is added if it is precise enough there;
then the rows it covers are set aside. Every step is one aggregate over all labelled rows,
which returns a count per statistic and threshold. The list becomes one ordered
conditional expression, and ``rule`` tells which rule decided.

Words found again: three-word windows are sorted by hash and words, so equal ones are
neighbours, which is exact and takes time in proportion to n log n for a text of any length.

Defined results: a null or empty text has no words and fails the base rule; without labels,
or with one class only, the list is empty and keeps everything; labels that repeat an id
count once, as good if any of them says so; null labels are left out; repeated rows get
equal results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.llm.base import named, query, table, text_of, written

MIN_WORDS = 50
REPEAT_PERCENT = 50
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"

MAX_RULES = 12
MAX_CONDITIONS = 3
THRESHOLDS = 24
# A rule must be right on this share of the rows that it was pruned on, and cover so many.
PRECISION = 0.9
LEAST_COVERED = 3

# Statistics that conditions may use, as expressions on the base statistics.
STATISTICS = {
    "words": "CAST(n_words AS DOUBLE)",
    "letters_per_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "duplicate_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def _barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once, however often later expressions use them.

    An inlined array of one struct keeps the optimizer from merging projections.
    """
    kept = [F.col(c) for c in df.columns]
    added = [value.alias(name) for name, value in columns.items()]
    return df.select(F.inline(F.array(F.struct(*kept, *added))))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base counts and the further ones that rules may use."""
    text = F.col("text")
    rows = docs.select(named(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = _barrier(
        rows,
        words=F.filter(F.split(text, SPACE), lambda w: w != ""),
        lines=F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)),
        n_symbols=F.length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("long"),
        n_upper=F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"),
        n_marks=F.length(F.regexp_replace(text, r"[^!?]+", "")).cast("long"),
    ).drop("text")
    words = F.col("words")
    # One row of words and their places per window, so that sorting brings equal ones together.
    windows = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
                F.get(words, i).alias("a"),
                F.get(words, i + 1).alias("b"),
                F.get(words, i + 2).alias("c"),
                i.alias("at"),
            ),
        ),
    )
    rows = _barrier(rows, windows=F.sort_array(windows))
    sorted_windows = F.col("windows")

    def same(k: Column, other: Column) -> Column:
        one, two = F.get(sorted_windows, k), F.get(sorted_windows, other)
        equal = one["h"] == two["h"]
        for part in "abc":
            equal = equal & (one[part] == two[part])
        return F.coalesce(equal, F.lit(False))

    repeated = F.filter(
        F.sequence(F.lit(0), F.size(sorted_windows) - 1), lambda k: same(k, k - 1) | same(k, k + 1)
    )
    places = F.when(
        sorted_windows.isNotNull(),
        F.sort_array(F.transform(repeated, lambda k: F.get(sorted_windows, k)["at"])),
    )
    rows = _barrier(rows, places=places)
    # A window covers its three words; from one place to the next at most three are new.
    covered = F.aggregate(
        F.col("places"),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda so_far, at: F.struct(
            at.alias("last"),
            (so_far["n"] + F.least(F.lit(3), at - so_far["last"]).cast("long")).alias("n"),
        ),
        lambda end: end["n"],
    )
    lines = F.col("lines")
    return rows.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        "n_upper",
        "n_marks",
    )


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    @property
    def column(self) -> Column:
        value = F.expr(STATISTICS[self.statistic])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions: Rule) -> Column:
    column = F.lit(True)
    for condition in conditions:
        column = column & condition.column
    return column


def _base_failed() -> Column:
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * words)


def _labelled(statistics: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Statistics of labelled rows, ``low`` (1: low quality) and which part they are for."""
    marked = (
        labels.filter(named(label_col).isNotNull() & named(id_col).isNotNull())
        .groupBy(named(id_col).alias("doc_id"))
        .agg((1 - F.max(named(label_col))).cast("int").alias("low"))
    )
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    # The list only has to judge what the base rule lets through.
    passed = statistics.filter(~_base_failed())
    return passed.join(marked, "doc_id").withColumn("prune", part)


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Midway between neighbouring quantiles of each statistic, among low and among other
    rows: a rule then keeps its distance from both."""
    steps = F.array(*[F.lit((i + 0.5) / THRESHOLDS) for i in range(THRESHOLDS)])
    found: dict[str, set[float]] = {name: set() for name in STATISTICS}
    quantiles = [
        F.percentile_approx(F.expr(e), steps, 1000).alias(name) for name, e in STATISTICS.items()
    ]
    for row in rows.filter(~F.col("prune")).groupBy("low").agg(*quantiles).collect():
        for name in STATISTICS:
            found[name].update(row[name] or ())
    return {
        name: [(a + b) / 2 for a, b in pairwise(sorted(values))] for name, values in found.items()
    }


def _counts(rows: DataFrame, thresholds: dict[str, list[float]]) -> dict:
    """(statistic, number of thresholds below the value) -> (low rows, other rows)."""

    def below(expression: str, values: list[float]) -> Column:
        if not values:
            return F.lit(0)
        value = F.expr(expression)
        return F.size(F.filter(F.array(*[F.lit(t) for t in values]), lambda t: t < value))

    bins = [below(e, thresholds[name]) for name, e in STATISTICS.items()]
    exploded = rows.select("low", F.posexplode(F.array(*bins)).alias("statistic", "bin"))
    counted = exploded.groupBy("statistic", "bin").agg(
        F.sum("low").alias("p"), F.sum(1 - F.col("low")).alias("n")
    )
    names = list(STATISTICS)
    return {(names[r["statistic"]], r["bin"]): (r["p"], r["n"]) for r in counted.collect()}


def _best(counts: dict, thresholds: dict[str, list[float]]) -> tuple[float, Condition | None]:
    """The condition with the largest FOIL gain."""
    first = next(iter(STATISTICS))
    p0 = sum(p for (name, _), (p, _) in counts.items() if name == first)
    n0 = sum(n for (name, _), (_, n) in counts.items() if name == first)
    best, chosen = 0.0, None
    if not p0 or not n0:
        return best, chosen
    before = math.log2(p0 / (p0 + n0))
    for name, values in thresholds.items():
        below_p = below_n = 0
        for i, threshold in enumerate(values):
            p, n = counts.get((name, i), (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
                if p >= LEAST_COVERED:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > best + 1e-9:
                        best, chosen = gain, Condition(name, above, threshold)
    return best, chosen


def learn_rules(
    statistics: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "quality",
    precision: float = PRECISION,
) -> list[Rule]:
    """Sequential covering over all labelled rows; ``statistics`` as of ``text_statistics``."""
    rows = written(_labelled(statistics, labels, id_col, label_col), "quality-labelled")
    thresholds = _thresholds(rows)
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES and any(thresholds.values()):
        rule: Rule = ()
        growing = left.filter(~F.col("prune"))
        while len(rule) < MAX_CONDITIONS:
            _, condition = _best(_counts(growing.filter(_all(rule)), thresholds), thresholds)
            if condition is None or condition in rule:
                break
            rule = (*rule, condition)
        if not rule:
            break
        rule, good = _pruned(left.filter("prune"), rule, precision)
        if not good:
            break
        rules.append(rule)
        left = left.filter(~_all(rule))
    return rules


def _pruned(rows: DataFrame, rule: Rule, precision: float) -> tuple[Rule, bool]:
    """The beginning of the rule with the best worth, and whether it is precise enough."""
    sums = []
    for length in range(1, len(rule) + 1):
        inside = _all(rule[:length])
        sums += [F.sum(F.when(inside, F.col("low"))), F.sum(F.when(inside, 1 - F.col("low")))]
    counts = [x or 0 for x in rows.agg(*sums).first()]
    worth = []
    for length, p, n in zip(range(1, len(rule) + 1), counts[::2], counts[1::2], strict=True):
        worth.append(((p - n) / (p + n) if p + n else -1.0, -length, p, n))
    best = max(worth)
    p, n = best[2], best[3]
    return rule[: -best[1]], p >= LEAST_COVERED and p / (p + n) >= precision


def judged(statistics: DataFrame, rules: list[Rule]) -> DataFrame:
    """Base rule, then the list: the first rule that applies decides."""
    decided = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        decided = decided.when(_all(rule), F.lit(" and ".join(map(str, rule))))
    return (
        statistics.withColumn("base_failed", _base_failed())
        .withColumn("rule", decided.otherwise(F.lit("keep")))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (F.col("rule") == "keep").alias("kept"),
            "rule",
        )
    )


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``kept`` and the deciding rule."""
    statistics = written(text_statistics(docs, id_col, text_col), "quality-statistics")
    return judged(statistics, learn_rules(statistics, labels, id_col, label_col))


@query()
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
