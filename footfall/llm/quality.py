"""Quality rules with cutoffs whose false rejections are bounded, as built-in expressions.

Every document gets a few measures. The cutoffs of all rules tighten together
along a path of fixed levels. For every stratum (language), labelled good
documents are held against each level, and an exact binomial test decides
whether fewer than ``RISK`` of good documents are rejected. Levels are tested
from the loosest on and the tightest one before the first failure is taken,
which needs no correction along the path; across strata the error chance is
divided by their number (Bonferroni). A stratum without enough labelled good
documents rejects nothing by rule. Strata and their cutoffs are a table, of any
length.

A null text has no words; it fails the base rules, as every text under twenty
words does. Rows with null or equal ids are judged one by one; only rows with an
id can be labelled, and an id labelled more than once is good if all its labels
say so. A null language is a stratum of its own. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.columns import let, words
from footfall.settings import materialize

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED = 30
# Share of a stratum's good documents that may be rejected, and the chance that more are.
RISK = 0.02
ERROR = 0.05

# Measure -> cutoffs from the loosest to the tightest. A document is rejected
# above the cutoff; where the name ends in "_least", below it.
LEVELS = {
    "symbols_per_word": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1),
    "exclamations_per_word": (1.5, 1.0, 0.5, 0.3, 0.2, 0.1),
    "capitals_per_character": (0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "duplicate_lines": (0.9, 0.7, 0.6, 0.5, 0.4, 0.3),
    "repeated_words": (0.3, 0.28, 0.25, 0.22, 0.2, 0.15),
    "distinct_words_least": (0.05, 0.1, 0.2, 0.3, 0.4, 0.45),
    "characters_per_word": (40.0, 25.0, 18.0, 14.0, 12.0, 10.0),
}
N_LEVELS = 6


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words inside runs of ``window`` words that occur more than once; ``w`` is an array of words."""
    hashes = F.slice(
        F.transform(w, lambda _, i: F.xxhash64(F.slice(w, i + 1, window))),
        1,
        F.greatest(F.size(w) - (window - 1), F.lit(0)),
    )

    def covered(h: Column) -> Column:
        def of(s: Column) -> Column:
            same = F.filter(
                s, lambda e, i: (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"])
            )
            places = F.array_sort(F.transform(same, lambda e: e["i"]))
            start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
            return F.aggregate(
                places,
                start,
                lambda a, x: F.struct(
                    x.alias("last"), (a["n"] + F.least(F.lit(window), x - a["last"])).alias("n")
                ),
                lambda a: a["n"],
            )

        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(by_hash, of)

    return let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    )


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\x09-\\x0D]"))


def measured(docs: DataFrame, text: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang and the counts of every row, from which the measures follow."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def without(characters: str) -> Column:
        return F.length(plain) - F.length(F.translate(plain, characters, ""))

    of_words = let(
        words(plain),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        ),
    )
    of_lines = let(
        _lines(plain),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        *carried,
        F.length(F.translate(plain, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        without("!").cast("long").alias("n_exclamations"),
        without(CAPITALS).cast("long").alias("n_capitals"),
        of_words.alias("w"),
        of_lines.alias("l"),
    ).select("*", "w.*", "l.*").drop("w", "l")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    )


def _measure(name: str) -> Column:
    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return {
        "symbols_per_word": share("n_symbols", "n_words"),
        "exclamations_per_word": share("n_exclamations", "n_words"),
        "capitals_per_character": share("n_capitals", "word_chars"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words_least": share("n_distinct", "n_words"),
        "characters_per_word": share("word_chars", "n_words"),
    }[name]


def first_level() -> Column:
    """The first level whose rules reject the document; N_LEVELS when none does."""
    found = F.lit(N_LEVELS)
    for level in reversed(range(N_LEVELS)):
        broken = F.lit(False)
        for name, cutoffs in LEVELS.items():
            at = F.lit(cutoffs[level])
            broken = broken | (_measure(name) < at if name.endswith("_least") else _measure(name) > at)
        found = F.when(broken, level).otherwise(found)
    return found


def chance_of_at_most(k: Column, n: Column, p: float) -> Column:
    """Binomial probability of k or fewer among n, exactly, summed by logarithms from 0 successes on."""
    odds = math.log(p) - math.log1p(-p)
    first = F.struct((n * math.log1p(-p)).alias("log"), F.exp(n * math.log1p(-p)).alias("sum"))

    def step(a: Column, i: Column) -> Column:
        return let(
            a["log"] + F.log((n - i + 1) / i) + odds,
            lambda log: F.struct(log.alias("log"), (a["sum"] + F.exp(log)).alias("sum")),
        )

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    total = F.aggregate(terms, first, step, lambda a: F.least(a["sum"], F.lit(1.0)))
    return F.when(k >= n, F.lit(1.0)).otherwise(total)


def certified_levels(rejected: Column, n: Column, error: float, risk: float = RISK) -> Column:
    """How many levels are certified, of ``n`` good documents whose counts first rejected at each are given."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("levels"), F.lit(True).alias("going"))

    def passes(total: Column) -> Column:
        # At or above the risk itself more than a third of the chance lies below, which is never an error's.
        small = total <= F.floor(n * risk)
        return (n > 0) & small & (chance_of_at_most(F.when(small, total).otherwise(F.lit(0)), n, risk) <= error)

    def step(a: Column, count: Column) -> Column:
        return let(
            F.struct((a["total"] + count).alias("total"), (a["going"] & passes(a["total"] + count)).alias("going")),
            lambda b: F.struct(b["total"].alias("total"), (a["levels"] + b["going"].cast("int")).alias("levels"), b["going"].alias("going")),
        )

    return F.aggregate(rejected, start, step, lambda a: a["levels"])


def cutoffs(measures: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(lang, certified_levels) of every stratum with labelled good documents."""
    good = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
        .where("quality = 1")
    )
    # Base rules reject without the method, so their failures are no risk of it.
    rows = measures.where(~base_failed()).join(good, "doc_id", "left_semi")
    at_level = [F.count_if(F.col("level") == level) for level in range(N_LEVELS)]
    counts = rows.groupBy("lang").agg(F.array(*at_level).alias("rejected"), F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "levels")
    certified = certified_levels(F.col("rejected"), F.col("n"), error / max(1, counts.count()), risk)
    return counts.select("lang", certified.alias("certified_levels"))


def judged(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Counts of every row, base_failed, kept, and the level that was certified for its stratum."""
    measures = materialize(measured(docs).withColumn("level", first_level()), "measures")
    levels = materialize(cutoffs(measures, labels, risk, error), "cutoffs").withColumnRenamed("lang", "stratum")
    certified = F.coalesce("certified_levels", F.lit(0)).alias("certified_levels")
    return (
        measures.join(levels, measures["lang"].eqNullSafe(levels["stratum"]), "left")
        .select(*[measures[c] for c in measures.columns], certified)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("level") >= F.col("certified_levels")))
    )
