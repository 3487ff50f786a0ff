"""Sorting, top-k and hash-ordered sampling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespark.operators.clean import GENOME_WIDE
from allelespark.operators.ordered import first_rows


def chrom_rank(chrom: Column, unknown: int | None = 26) -> Column:
    """1..22, X 23, Y 24, M or MT 25; anything else ``unknown`` (null sorts it last)."""
    bare = F.regexp_replace(chrom, "^chr", "")
    num = bare.try_cast("int")
    return (
        F.when(num.between(1, 22), num)
        .when(bare == "X", 23)
        .when(bare == "Y", 24)
        .when(bare.isin("M", "MT"), 25)
        .otherwise(F.lit(unknown).cast("int"))
    )


def sort_bed(df: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Total order over range partitions, so part files concatenate in genome order."""
    return df.orderBy(chrom_rank(F.col(chrom)).asc_nulls_last(), start, end)


def top_variance(df: DataFrame, k: int) -> DataFrame:
    """Rows of the ``k`` most variable features, ties by id."""
    best = df.groupBy("feature_id").agg(F.var_samp("value").alias("_v")).where("_v IS NOT NULL")
    best = best.orderBy(F.col("_v").desc(), "feature_id").limit(k)
    return df.join(best.select("feature_id"), "feature_id", "left_semi")


def top_hits(df: DataFrame, k: int, *ids: str, p: str = "p_value") -> DataFrame:
    return df.orderBy(p, *ids).limit(k)


def top_hits_by(df: DataFrame, keys: list[str], k: int, *ids: str, p: str = "p_value") -> DataFrame:
    return first_rows(df, keys, [F.col(p), *[F.col(i) for i in ids]], k)


def hash_sample(df: DataFrame, by: list[str], order: Column, quotas: DataFrame | int) -> DataFrame:
    """Exactly ``quota`` rows per group in md5 order.

    Rows fall into 4096 hash ranges per group; counts per range show which are kept whole, and
    only the range that straddles the quota is sorted.
    """
    spread = df.withColumns({"_h": F.md5(order.cast("string")), "_grp": F.lit(0)})
    spread = spread.withColumn("_r", F.substring("_h", 1, 3))
    keys = [*by, "_grp"]
    per = spread.groupBy(*keys, "_r").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_b", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    if isinstance(quotas, int):
        per = per.withColumn("quota", F.lit(quotas))
    else:
        per = per.join(quotas, by)
    need = per.where(F.col("_b") < F.col("quota")).select(*keys, "_r", "_b", "_c", "quota")
    rows = spread.join(need, [*keys, "_r"])
    local = Window.partitionBy(*keys, "_r").orderBy("_h", order)
    kept = rows.withColumn("_n", F.row_number().over(local) + F.col("_b")).where(F.col("_n") <= F.col("quota"))
    return kept.select(*df.columns)


def downsample_hits(df: DataFrame, max_points: int, *ids: str, p: str = "p_value", by: str = "chrom") -> DataFrame:
    """Keep every genome-wide significant row and fill up to ``max_points`` evenly by chromosome."""
    sig = df.where(F.col(p) <= GENOME_WIDE)
    rest = df.where(F.col(p) > GENOME_WIDE)
    tot = df.agg(F.count_if(F.col(p) <= GENOME_WIDE).alias("s"), F.count_if(F.col(p) > GENOME_WIDE).alias("r"))
    s, r = tot.select("s").scalar(), tot.select("r").scalar()
    room = F.greatest(F.lit(max_points) - s, F.lit(0))
    quota = F.when(r > room, F.floor(F.col("_c") * room / r)).otherwise(F.col("_c"))
    quotas = rest.groupBy(by).agg(F.count(F.lit(1)).alias("_c")).select(by, quota.alias("quota"))
    key = F.concat_ws("|", *[F.col(i).cast("string") for i in ids])
    return sig.unionByName(hash_sample(rest, [by], key, quotas))
