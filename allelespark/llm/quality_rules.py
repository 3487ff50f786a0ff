"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Each text gets counters and a junk score 0..50: the worst of its symbols per word, its words in repeated 3-word windows and its
upper-case letters, in fiftieths.  Per stratum (language) a cutoff on that score is chosen on labelled documents: for cutoff j the
null hypothesis is that more than ``risk`` of good documents score j or more; its exact binomial p-value is
P(Binomial(n, risk) <= k), with k of n good ones at or above j.  Cutoffs are tested from the mildest on and testing stops at the first
that is not rejected (fixed sequence, so a stratum spends its share once); strata share ``error`` equally (Bonferroni).  With
probability 1 - error all certified cutoffs of all strata falsely reject at most ``risk``.  Of the certified ones the one that best
separates good from bad labels is used; a stratum without any rejects nothing.

Scale: texts are read once, without a shuffle; 3-word windows are compared inside the row in sorted packed form.  Only small rows meet the
labels; the counts are at most 51 rows for each stratum.  A long text costs n log n.

Defined cases: null and empty texts have zero counters and fail the base rule; a null language is a stratum of its own; labels that are
null or of unknown documents are unused; several labels of one document count as the lowest; repeated rows give a row each;
other columns are ignored; empty tables give no rows or no cutoffs.
"""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespark.llm.common import WORD, staged

RISK = 0.01
ERROR = 0.05
STEPS = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words lie in 3-word windows found twice or more.

    Each window is one long: its hash, with the low bits replaced by its place.  Sorted, equal windows are neighbours; neighbours
    with equal hash bits are compared word by word, so a hash collision isn't counted.
    """

    def windows(w: Column) -> Column:
        n = F.size(w)
        place = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1
        return let(place, lambda low: packed(w, low))

    def packed(w: Column, low: Column) -> Column:
        hashed = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")),
        )
        return let(F.sort_array(hashed), lambda s: spots(w, low, s))

    def spots(w: Column, low: Column, s: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            y = F.get(s, j)
            a, b = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
            equal = x.bitwiseAND(F.bitwise_not(low)) == y.bitwiseAND(F.bitwise_not(low))
            for t in range(3):
                equal = equal & (F.get(w, a + t) == F.get(w, b + t))
            return F.coalesce(equal, F.lit(False))

        found = F.sort_array(F.transform(F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x.bitwiseAND(low)))
        zero = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("sum"))
        step = lambda acc, x: F.struct(x.alias("last"), (acc["sum"] + F.least(F.lit(3).cast("long"), x - acc["last"])).alias("sum"))
        return F.aggregate(found, zero, step, lambda acc: acc["sum"])

    return let(words, windows)


def features(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, stratum, the counters, base_failed and score."""
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda chars: F.length("t") - F.length(F.translate("t", chars, ""))
    lines = let(F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    words = F.regexp_extract_all("t", F.lit(WORD), F.lit(0))
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("again")))
    seen = docs.select("doc_id", F.col("lang").alias("stratum"), text.alias("t")).select(
        "doc_id", "stratum", both.alias("w"), (F.length("t") - without(BLANKS)).cast("long").alias("word_chars"), without(SYMBOLS).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"), F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
    ).select("doc_id", "stratum", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.again").alias("n_repeat_words"), "n_upper")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    share = lambda part, whole: F.coalesce(F.floor(STEPS * F.col(part) / F.nullif(F.col(whole), F.lit(0))), F.lit(0))
    worst = F.greatest(share("n_symbols", "n_words"), share("n_repeat_words", "n_words"), share("n_upper", "word_chars"))
    return seen.select("*", failed.alias("base_failed"), F.least(worst, F.lit(STEPS)).cast("int").alias("score"))


def log_gamma(x: Column) -> Column:
    """For x >= 1: Stirling's series, after eight steps of the recurrence."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    low = x
    for i in range(1, 8):
        low = low * (x + i)
    return series - F.log(low)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) where k < n p, else 1: the sum from k down, in which each term is smaller than the one above;
    after 40 standard deviations nothing is left that a double could show."""
    k, n = k.cast("double"), n.cast("double")
    top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 50).cast("int")
    odds = (1 - p) / p
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i + 1) / (n - k + i) * odds
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    below = F.aggregate(F.when(terms >= 1, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")), zero, step, lambda acc: acc["sum"])
    return F.when(k < n * p, F.exp(top) * below).otherwise(F.lit(1.0))


def cutoffs(feats: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, cutoff, p_value, n_good) for each stratum with a certified cutoff.

    A label is one trial, however many rows its doc_id has: of these, the one with the least hash of its counters stands for it.
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = feats.where(~F.col("base_failed")).join(known, "doc_id")
    row = F.struct(F.xxhash64(*[c for c in feats.columns if c != "doc_id"]).alias("h"), "stratum", "score")
    held = held.groupBy("doc_id", "quality").agg(F.min(row).alias("r")).select("quality", "r.stratum", "r.score")
    good = F.col("quality") > 0
    at = held.groupBy("stratum", "score").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    grid = staged(at, "quality-grid")
    whole = grid.groupBy("stratum").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad")).where("n_good > 0")
    strata = whole.agg(F.count("*")).first()[0]
    every = whole.select("*", F.explode(F.sequence(F.lit(STEPS), F.lit(1), F.lit(-1))).alias("cutoff"))
    reached = every.alias("e").join(grid.alias("g"), F.expr("e.stratum <=> g.stratum and g.score >= e.cutoff"), "left")
    tests = reached.groupBy("e.stratum", "cutoff", "n_good", "n_bad").agg(F.coalesce(F.sum("good"), F.lit(0)).alias("k"), F.coalesce(F.sum("bad"), F.lit(0)).alias("caught"))
    tests = tests.select("*", binomial_tail(F.col("k"), F.col("n_good"), risk).alias("p_value"))
    down = Window.partitionBy("stratum").orderBy(F.desc("cutoff"))  # 50 rows
    passed = tests.select("*", F.max((F.col("p_value") > error / max(strata, 1)).cast("int")).over(down).alias("stopped")).where("stopped = 0")
    gain = F.col("caught") / F.greatest(F.col("n_bad"), F.lit(1)) - F.col("k") / F.col("n_good")
    best = passed.groupBy("stratum").agg(F.max(F.struct(gain.alias("gain"), "cutoff", "p_value", "n_good")).alias("b"))
    return best.select("stratum", "b.cutoff", "b.p_value", "b.n_good")


def verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per document row: the counters, base_failed, kept, score and the stratum's cutoff (null: none certified)."""
    feats = staged(features(docs), "quality-features")
    cut = cutoffs(feats, labels, risk, error).select(F.col("stratum").alias("_s"), "cutoff")
    out = feats.join(cut, F.col("stratum").eqNullSafe(F.col("_s")), "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") < F.col("cutoff"), F.lit(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "score", "cutoff")
