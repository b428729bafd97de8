"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is built from DataFrame functions; no Python runs on the executors.

Defined results for unusual rows: a null or blank text has zero words, fails the
base rule and is not kept; a null doc_id passes through as null; equal rows give
equal results; an empty table gives an empty result; extra columns are ignored by
``quality_metrics`` except those named in ``keep``. A text of any length is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.llm.common import text_or_empty, words_of

# Frequent function words of the four corpus languages.
STOP_WORDS = (
    "a an and are as at be by for from had has have he her his in is it its not of on or "
    "she that the this to was were which with you "
    "au aux avec ce dans de des du elle en est et il la le les ne par pas pour qui que sur un une "
    "auf das dem den der die ein eine für im ist mit nicht sich sie und von zu "
    "al como con del el es las lo los más no para por se su sus y"
).split()


#: Stop words as they stand in prose, at the head of a sentence and in capitals.
STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high]; None leaves a side open."""

    metric: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value, tests = F.col(self.metric), []
        if self.low is not None:
            tests.append(value >= F.lit(float(self.low)))
        if self.high is not None:
            tests.append(value <= F.lit(float(self.high)))
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


#: The production table. Ratios are per word unless the name says otherwise.
RULES = (
    Rule("n_words", 50, None),
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("shout_ratio", None, 0.3),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("repeat_word_ratio", None, 0.5),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where the optimizer copies the
    whole expression into a filter or a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that are found twice or more in the text."""
    chain = lambda h: _let(_sorted_repeats(h), lambda s: _let(_repeat_places(s), _covered))
    return _let(words, lambda w: _let(_window_hashes(w), chain))


def _window_hashes(w: Column) -> Column:
    """64-bit hash of each 3-word window, in place order."""
    n = F.size(w)
    return F.when(
        n >= 4,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))


def _sorted_repeats(h: Column) -> Column:
    """(hash, place) in hash order, for the texts with a window that repeats."""
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeat_places(s: Column) -> Column:
    """Places of the windows whose hash has an equal neighbour in hash order."""
    same = lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
    return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))


def _covered(p: Column) -> Column:
    """Words in the union of the 3-word spans that start at the sorted places ``p``."""
    gaps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)


def quality_metrics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus the base counts and the ratios the rule table uses."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    n = F.col("n_words").cast("double")
    per_word = lambda c: F.when(F.col("n_words") > 0, c / n).otherwise(F.lit(0.0))
    counted = (
        docs.select(*keep, text_or_empty().alias("_text"))
        .select(*keep, "_text", words_of(text).alias("_words"), lines.alias("_lines"))
        .select(
            *keep,
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.size(F.filter("_words", lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
            (F.size(F.split(text, "!(?:[ \\t-\\r]|$)")) - 1).cast("long").alias("n_shout_words"),
            repeat_words(F.col("_words")).alias("n_repeat_words"),
        )
    )
    return counted.select(
        "*",
        per_word(F.col("word_chars")).alias("mean_word_chars"),
        per_word(F.col("n_symbols")).alias("symbols_per_word"),
        per_word(F.col("n_stop_words")).alias("stop_word_ratio"),
        per_word(F.col("n_shout_words")).alias("shout_ratio"),
        per_word(F.col("n_repeat_words")).alias("repeat_word_ratio"),
        F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines")).otherwise(F.lit(0.0)).alias("dup_line_ratio"),
    )


def apply_rules(metrics: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds base_failed, kept and the names of the failed metrics, in one projection."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passed = rules[0].holds()
    for r in rules[1:]:
        passed = passed & r.holds()
    failed = F.filter(F.array(*[F.when(~r.holds(), F.lit(r.metric)) for r in rules]), lambda x: x.isNotNull())
    return metrics.select(
        "*",
        base.alias("base_failed"),
        (~base & passed).alias("kept"),
        F.array_join(failed, ",").alias("failed_rules"),
    )


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    return apply_rules(quality_metrics(docs, keep), rules)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text passes every rule."""
    packed = docs.select(F.struct("*").alias("_row"), F.col("text"))
    judged = quality_rules(packed, rules, keep=("_row",))
    # A filter on kept alone would be pushed below the projections and compute the metrics
    # once for each use in a rule; the row number keeps it above them.
    return judged.withColumn("_at", F.monotonically_increasing_id()).filter("kept and _at >= 0").select("_row.*")
