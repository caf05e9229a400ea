"""Quality rules: a decision list of threshold conjunctions, learned by sequential covering.

Statistics of each text are DataFrame expressions. Rules are grown and pruned on counts
that Spark aggregates over all labelled rows; the driver sees only histograms, whose size is
``len(FEATURES) * BINS * 2`` rows. The learned list becomes one ordered CASE expression.

Defined cases: a null or empty text has no words, all its statistics are 0 and it fails the base
rule. Rows without a label do not train. A doc_id that is labelled twice trains twice. Without labelled
rows, or with one class only, the list is empty and the base rule alone decides. Equal
rows give equal results, one row each. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.llm.columns import bind, words
from statledger.session import written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# Shares a rule may test, each a number between 0 and some small bound.
FEATURES = (
    "chars_per_word",
    "symbols_per_word",
    "dup_lines_per_line",
    "repeat_share",
    "upper_share",
    "mark_share",
    "digit_share",
    "distinct_share",
    "log_words",
)
BINS = 48
MAX_RULES = 12
MAX_CONDITIONS = 3
# A rule must find at least this share of bad rows among those it covers, and so many of them.
MIN_PRECISION = 0.9
MIN_COVER = 8


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold


Rule = tuple[Condition, ...]


def _repeat_words(ws: Column) -> Column:
    """Words inside a window of three words that occurs at least twice in the array."""
    windows = F.slice(
        F.transform(
            ws,
            lambda w, i: F.struct(
                F.xxhash64(w, F.get(ws, i + F.lit(1)), F.get(ws, i + F.lit(2))).alias("h"),
                i.alias("i"),
            ),
        ),
        1,
        F.greatest(F.size(ws) - F.lit(2), F.lit(0)),
    )

    def repeated(s: Column) -> Column:
        marked = F.transform(
            s,
            lambda x, j: F.when(
                (x["h"] == F.get(s, j - F.lit(1))["h"]) | (x["h"] == F.get(s, j + F.lit(1))["h"]),
                x["i"],
            ),
        )
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def covered(places: Column) -> Column:
        step = F.transform(
            places,
            lambda p, k: F.least(
                F.lit(3), F.coalesce(F.get(places, k + F.lit(1)) - p, F.lit(3))
            ),
        )
        return F.aggregate(step, F.lit(0), lambda total, x: total + x)

    return bind(bind(F.sort_array(windows), repeated), covered)


def _lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return bind(
        lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))
    )


def text_stats(docs: DataFrame) -> DataFrame:
    """The base counts of every row and the features that rules test."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = bind(
        words(text),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(ws)).alias("n_distinct"),
            _repeat_words(ws).cast("long").alias("n_repeat_words"),
        ),
    )

    def without(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    raw = docs.select(
        "doc_id",
        counts.alias("c"),
        _lines(text).alias("l"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        without("\\p{Lu}+").alias("n_upper"),
        without("[!?]+").alias("n_marks"),
        without("[0-9]+").alias("n_digits"),
    )
    n = F.greatest(F.col("c.n_words"), F.lit(1))
    chars = F.greatest(F.col("c.word_chars"), F.lit(1))
    return raw.select(
        "doc_id",
        "c.n_words",
        "c.word_chars",
        "n_symbols",
        (F.col("l.n") - F.col("l.d")).cast("long").alias("n_dup_lines"),
        "c.n_repeat_words",
        (F.col("c.word_chars") / n).alias("chars_per_word"),
        (F.col("n_symbols") / n).alias("symbols_per_word"),
        ((F.col("l.n") - F.col("l.d")) / F.greatest(F.col("l.n"), F.lit(1))).alias(
            "dup_lines_per_line"
        ),
        (F.col("c.n_repeat_words") / n).alias("repeat_share"),
        (F.col("n_upper") / chars).alias("upper_share"),
        (F.col("n_marks") / n).alias("mark_share"),
        (F.col("n_digits") / chars).alias("digit_share"),
        (F.col("c.n_distinct") / n).alias("distinct_share"),
        F.log2(n.cast("double")).alias("log_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )


def _holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule], F.lit(True))


def _edges(rows: DataFrame) -> dict[str, list[float]]:
    """Distinct quantiles of each feature among labelled rows, the thresholds to try."""
    shares = [i / BINS for i in range(1, BINS)]
    found = rows.agg(
        *[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]
    ).first()
    return {f: sorted(set(found[f] or [])) for f in FEATURES}


def _histogram(rows: DataFrame, edges: dict[str, list[float]]) -> dict:
    """Bad and good rows by feature and bin, in one pass."""

    def bin_of(feature: str) -> Column:
        limits = F.array(*[F.lit(float(x)) for x in edges[feature]])
        return F.size(F.filter(limits, lambda x: x <= F.col(feature)))

    parts = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin"))
            for f in FEATURES
            if edges[f]
        ]
    )
    counted = (
        rows.select(F.explode(parts).alias("p"), "bad", "weight")
        .groupBy("p.feature", "p.bin")
        .agg(
            F.sum(F.when(F.col("bad"), F.col("weight"))).alias("bad"),
            F.sum(F.when(~F.col("bad"), F.col("weight"))).alias("good"),
        )
    )
    return {(r["feature"], r["bin"]): (r["bad"] or 0, r["good"] or 0) for r in counted.collect()}


def _best(rows: DataFrame, edges: dict[str, list[float]]) -> tuple[Condition, int, int, int, int]:
    """The condition with the highest gain over the rows, and what it and all of them cover."""
    counts = _histogram(rows, edges)
    best = None
    for feature in FEATURES:
        limits = edges[feature]
        if not limits:
            continue
        column = [counts.get((feature, b), (0, 0)) for b in range(len(limits) + 1)]
        bad, good = sum(c[0] for c in column), sum(c[1] for c in column)
        low_bad = low_good = 0
        for k, limit in enumerate(limits):
            low_bad, low_good = low_bad + column[k][0], low_good + column[k][1]
            for at_least, b, g in ((True, bad - low_bad, good - low_good), (False, low_bad, low_good)):
                score = _gain(b, g, bad, good)
                if best is None or score > best[0]:
                    best = (score, Condition(feature, at_least, limit), b, g, bad, good)
    return best[1:] if best and best[0] > 0 else None


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """Information gained on the bad rows that stay covered."""
    from math import log2

    if bad < MIN_COVER:
        return 0.0
    before = log2((all_bad + 1) / (all_bad + all_good + 2))
    return bad * (log2((bad + 1) / (bad + good + 2)) - before)


def _covered(rows: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """Bad and good rows under each rule, in one pass."""
    wanted = []
    for k, rule in enumerate(rules):
        for name, side in (("b", F.col("bad")), ("g", ~F.col("bad"))):
            wanted.append(F.sum(F.when(_holds(rule) & side, F.col("weight"))).alias(f"{name}{k}"))
    found = rows.agg(*wanted).first()
    return [(found[f"b{k}"] or 0, found[f"g{k}"] or 0) for k in range(len(rules))]


def _value(covered: tuple[int, int]) -> float:
    bad, good = covered
    return (bad - good) / (bad + good) if bad + good else -1.0


def learn_rules(labelled: DataFrame) -> list[Rule]:
    """Ordered rules for bad rows from ``FEATURES`` and a boolean ``bad``.

    Two thirds of the rows grow a rule condition by condition, the others prune it. Equal
    feature rows are merged into one with a weight first.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    rows = written(
        labelled.select("bad", fold.alias("prune"), *FEATURES)
        .groupBy("bad", "prune", *FEATURES)
        .agg(F.count("*").alias("weight")),
        "quality-rows",
    )
    edges = _edges(rows)
    rules: list[Rule] = []
    if not any(edges.values()):
        return rules
    left = rows
    while len(rules) < MAX_RULES:
        rule: Rule = ()
        covered = left.where(~F.col("prune"))
        while len(rule) < MAX_CONDITIONS:
            found = _best(covered, edges)
            if not found:
                break
            condition, bad, good, _, all_good = found
            if rule and good == all_good:
                break
            rule += (condition,)
            covered = covered.where(condition.column())
            if good == 0 or bad / (bad + good) > 0.995:
                break
        if not rule:
            break
        shorter = [rule[:k] for k in range(1, len(rule) + 1)]
        tested = _covered(left.where("prune"), shorter)
        pick = max(range(len(shorter)), key=lambda k: (_value(tested[k]), -k))
        rule = shorter[pick]
        bad, good = _covered(left, [rule])[0]
        if bad < MIN_COVER or bad / (bad + good) < MIN_PRECISION:
            break
        rules.append(rule)
        left = left.where(~_holds(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one expression: the first rule that holds decides, else keep."""
    if not rules:
        return F.lit(True)
    chain = F.when(_holds(rules[0]), F.lit(False))
    for rule in rules[1:]:
        chain = chain.when(_holds(rule), F.lit(False))
    return chain.otherwise(F.lit(True))


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` of every row of ``docs``."""
    stats = written(text_stats(docs), "quality-stats")
    marks = labels.select("doc_id", "quality").where(F.col("quality").isNotNull())
    labelled = stats.join(marks, "doc_id").withColumn("bad", F.col("quality") == 0)
    rules = learn_rules(labelled)
    return stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
    )
