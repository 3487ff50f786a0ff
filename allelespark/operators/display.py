"""Plot-ready tables: no drawing, only the rows a figure needs."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelespark.operators.clean import locus_from_id, neg_log10
from allelespark.operators.ordered import ordered, with_group_stats


def manhattan_input(df: DataFrame, p: str = "p_value", scored: bool = True) -> DataFrame:
    """Chromosome, position and -log10 p; falls back to the id, then to one chromosome and row order.

    Rows without a place are dropped, and those without a -log10 p unless ``scored`` is false.
    """
    if "chromosome" not in df.columns and "variant_id" in df.columns:
        df = locus_from_id(df)
    if "chromosome" not in df.columns:
        df = df.withColumn("chromosome", F.lit("1"))
    if "position" not in df.columns:
        key = F.col("variant_id") if "variant_id" in df.columns else F.col(p)
        df = ordered(df, [], [key], rank="position")
    return df.withColumn("log10p", neg_log10(F.col(p))).dropna(subset=["chromosome", "position", *(["log10p"] if scored else [])])


def genome_coordinate(df: DataFrame, gap: int = 1_000_000) -> DataFrame:
    """Running genome position: each chromosome starts a gap after the span of those before it."""
    span = df.groupBy("chrom").agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    # one row per chromosome, so the unpartitioned window is over a few dozen rows
    w = Window.orderBy("chrom").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("_hi") - F.col("_lo") + gap).over(w), F.lit(0))
    offs = span.select("chrom", (start - F.col("_lo")).alias("_off"))
    return df.join(offs, "chrom").withColumn("pos_index", F.col("pos") + F.col("_off")).drop("_off")


def colour_index(df: DataFrame, k: int = 2) -> DataFrame:
    """Alternating colour number per chromosome in text order (one row per chromosome)."""
    names = df.select("chrom").distinct()
    return names.withColumn("colour", ((F.dense_rank().over(Window.orderBy("chrom")) - 1) % k).cast("int"))


def top_hit(df: DataFrame, *ids: str, p: str = "p_value", keys: tuple[str, ...] = ()) -> DataFrame:
    """Row with the lowest p overall or per group, as a partial aggregate instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(p, *ids)).alias("_best")
    agg = df.groupBy(*keys).agg(best) if keys else df.agg(best)
    return agg.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def locus_around_top(df: DataFrame, window: int, *ids: str, p: str = "p_value") -> DataFrame:
    """All rows within half a window of the overall top hit."""
    best = top_hit(df, *ids, p=p).select(F.struct("chrom", "pos").alias("_b")).scalar()
    near = F.abs(F.col("pos") - F.col("_at.pos")) <= window // 2
    out = df.withColumn("_at", best)
    return out.where((F.col("chrom") == F.col("_at.chrom")) & near).drop("_at")


def display_zscore(df: DataFrame) -> DataFrame:
    """Per-feature z-score with undefined cells shown as 0."""
    out = with_group_stats(df, ["feature_id"], F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    z = F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))
    return out.withColumn("value", F.coalesce(F.nanvl(z, F.lit(0.0)), F.lit(0.0))).drop("_m", "_s")
