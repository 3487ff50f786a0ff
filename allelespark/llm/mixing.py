"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key.  Rows are range-sorted on (source, key); distributed prefix sums of word counts give each
document the words before it in its source; the source's budget cuts that order at an exact word.  A budget above the source's
size takes whole epochs first, then the cut.

Scale: texts are read once for their word counts; only (doc_id, source, size, keys) are sorted.  A source with a third of all
rows is cut into ranges like any other, since ranges are on (source, key); offsets come from one row per range and source.  The
table of sources is ranked and summed by the same ranges, so nothing needs few sources.

Defined cases: null text has size 0; a null source is a source of its own, last in order; a source of size 0 has target 0;
ties of key fall back on doc_id and a hash of the whole row, equal rows are interchangeable; an empty table gives no rows; other
columns are ignored by ``plan`` and kept by ``mixed``, whatever their names.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelespark.llm.common import HASHES, WORD, content_hash, repeated, staged, word_count
from allelespark.operators.ordered import columns_of, ordered

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2.0
SEED = "mix-1"


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) with its number in code-point order ``k`` and its ``target``.

    Sharing by weight with a ceiling, again and again, ends at one level: every source gets min(level * weight, ceiling).
    In the order of ceiling / weight the level is that of the first source which it doesn't lift above its ceiling.
    """
    ranked = ordered(sizes, [], [F.col("source").asc_nulls_last()], rank="k")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("k") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.select("*", w.alias("w"), (F.col("source_size") * F.lit(float(most))).alias("ceiling"))
    filled = ordered(ranked, [], [F.col("ceiling") / F.col("w"), F.col("k")], {"spent": F.col("ceiling"), "settled": F.col("w")}, "turn")
    filled = staged(filled, "mix-targets")
    total, weight = columns_of(filled.agg((F.sum("source_size") * F.lit(float(share))).alias("a"), F.sum("w").alias("b")))
    level = (total - F.col("spent")) / (weight - F.col("settled"))
    at = filled.where(level * F.col("w") <= F.col("ceiling")).agg(F.min_by(level, "turn").alias("level"))
    (found,) = columns_of(at)
    return filled.select("source", "source_size", "k", F.least(F.coalesce(found, F.lit(float("inf"))) * F.col("w"), "ceiling").alias("target"))


def plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS, seed: str = SEED
) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, taken, and the row's hash."""
    key = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")), 1, 16)
    base = staged(docs.select("doc_id", "source", word_count().alias("size"), key.alias("_key"), *content_hash(docs)), "mix-base")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = staged(targets(sizes, weights, share, most), "mix-goals").withColumnRenamed("source", "_source")
    rows = base.join(goal.select("_source", "k"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = ordered(rows, ["k"], [F.col("_key"), F.col("doc_id"), *[F.col(h) for h in HASHES]], {"before": F.col("size")}, "_rank")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor("target") - whole * F.col("source_size") - F.col("before").cast("long")
    taken = whole * F.col("size") + F.least(F.greatest(rest, F.lit(0).cast("long")), F.col("size"))
    return placed.join(goal.select("k", "source_size", "target"), "k").select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *HASHES
    )


#: Rows that are equal in everything and more than this, or than a millionth of all rows, travel once with their count.
MOST_EQUAL = 1000


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself with the columns of ``docs``: a row for each whole time a document is taken; the one document of each
    source that the budget cuts keeps the words before the cut (and its ``n_chars``, if there, is theirs).

    What equal rows are taken for is added up, whole times and the words of the cut apart, and given out by one of them, so the mix
    has the words of the plan.  Many equal rows are sifted by a broadcast list of their hashes (at most a million by its own bound)
    before the join, and unrolled again in runs.
    """
    size = F.greatest("size", F.lit(1))
    takes = plan(docs, weights, share, most, seed).groupBy(*HASHES).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.floor(F.col("taken") / size)).alias("times"), F.sum(F.col("taken") % size).cast("int").alias("cut")
    )
    takes = staged(takes, "mix-takes")
    n = takes.agg(F.sum("rows")).first()[0] or 0
    many = F.col("rows") > max(MOST_EQUAL, n // 1_000_000)
    heavy = F.broadcast(takes.where(many).select(*HASHES))
    takes = takes.where("times > 0 OR cut > 0")
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    rows = docs.select(*content_hash(docs), record)
    light = rows.join(heavy, HASHES, "left_anti").join(takes.where(~many), HASHES)
    one = F.row_number().over(Window.partitionBy(*HASHES).orderBy(F.lit(0)))  # of at most MOST_EQUAL or a millionth
    cuts = F.concat(F.array_repeat(F.lit(-1), F.col("times").cast("int")), F.when(F.col("cut") > 0, F.array("cut")).otherwise(F.array().cast("array<int>")))
    few = light.withColumn("one", one).where("one = 1").select("record", F.explode(cuts).alias("cut"))
    single = rows.join(heavy, HASHES, "left_semi").groupBy(*HASHES).agg(F.first("record").alias("record")).join(takes.where(many), HASHES)
    whole = repeated(single, "times").select("record", F.lit(-1).alias("cut"))
    out = few.union(whole).union(single.where("cut > 0").select("record", "cut"))
    field = lambda c: F.col("record").getField(c)
    kept = F.concat_ws(" ", F.slice(F.regexp_extract_all(field("text"), F.lit(WORD), F.lit(0)), F.lit(1), F.greatest("cut", F.lit(1))))
    text = F.when(F.col("cut") < 0, field("text")).otherwise(kept)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("cut") < 0, field("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, field(c)).alias(c) for c in docs.columns])
