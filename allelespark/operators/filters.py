"""Row, feature, variant and sample filters over the long tables."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.functions.stats import hwe_exact_udf, hwe_midp_udf, norm_ppf
from allelespark.operators.clean import neg_log10
from allelespark.operators.ordered import exact_quantiles, first_rows, one_row
from allelespark.session import materialize


def variant_stats(geno: DataFrame, key: str = "variant_id") -> DataFrame:
    """Call counts, genotype classes, missing rate and allele frequencies per variant."""
    d = F.col("dosage")
    return geno.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(d).alias("n_called"),
        F.sum(d).alias("_sum"),
        F.count_if(d == 0).alias("hom_ref"),
        F.count_if(d == 1).alias("het"),
        F.count_if(d == 2).alias("hom_alt"),
    ).select(
        key, "n", "n_called", "hom_ref", "het", "hom_alt",
        ((F.col("n") - F.col("n_called")) / F.col("n")).alias("f_missing"),
        F.try_divide(F.col("_sum"), 2 * F.col("n_called")).alias("af"),
    ).withColumn("maf", F.least(F.col("af"), 1 - F.col("af")))


def hwe_chi2(hom_ref: Column, het: Column, hom_alt: Column) -> Column:
    """Goodness-of-fit statistic against Hardy-Weinberg proportions (one degree of freedom)."""
    n = (hom_ref + het + hom_alt).cast("double")
    p = (2 * hom_ref + het) / (2 * n)
    q = 1 - p
    parts = [(hom_ref, n * p * p), (het, 2 * n * p * q), (hom_alt, n * q * q)]
    return reduce(
        lambda a, b: a + b, [F.when(e > 0, (o - e) * (o - e) / e).otherwise(0.0) for o, e in parts]
    )


def keep_variants(df: DataFrame, stats: DataFrame, cond: Column, key: str = "variant_id") -> DataFrame:
    return df.join(stats.where(cond).select(key), key, "left_semi")


def filter_variants(
    variants: DataFrame, geno: DataFrame, maf: float = 0.0, call_rate: float = 0.0, qual: float = 0.0
) -> DataFrame:
    """Keep variants with MAF above, missing rate below and quality above; zero switches a clause off."""
    out = variants.where(F.col("qual") > qual) if qual > 0 else variants
    conds = []
    if maf > 0:
        conds.append(F.col("maf") > maf)
    if call_rate > 0:
        conds.append(F.col("f_missing") < 1 - call_rate)
    return keep_variants(out, variant_stats(geno), reduce(lambda a, b: a & b, conds)) if conds else out


def genotype_qc(
    geno: DataFrame,
    mind: float = 0.1,
    missing: float = 0.1,
    maf: float = 0.01,
    hwe: float = 0.0,
    exact: bool = True,
    midp: bool = True,
) -> DataFrame:
    """Drop poorly called samples first, then variants by missingness, MAF and HWE on those left."""
    bad = F.count_if(F.col("dosage").isNull()) / F.count(F.lit(1))
    good = geno.groupBy("sample_id").agg(bad.alias("_m")).where(F.col("_m") <= mind).select("sample_id")
    kept = geno.join(good, "sample_id", "left_semi")
    st = variant_stats(kept)
    cond = (F.col("f_missing") <= missing) & (F.col("maf") >= maf)
    if hwe > 0 and exact:
        st = st.where(cond).withColumn("_p", (hwe_midp_udf if midp else hwe_exact_udf)("hom_ref", "het", "hom_alt"))
        cond = F.col("_p") >= hwe
    elif hwe > 0:
        edge = float(norm_ppf(hwe / 2) ** 2)
        cond = cond & (hwe_chi2(F.col("hom_ref"), F.col("het"), F.col("hom_alt")) <= edge)
    return keep_variants(kept, st, cond)


def biallelic(df: DataFrame) -> DataFrame:
    return df.where(F.size(F.split("alt", ",")) == 1)


def first_per_position(df: DataFrame, order: str = "line_no") -> DataFrame:
    return first_rows(df, ["chrom", "pos"], [F.col(order)])


def on_chromosome(df: DataFrame, chrom: str) -> DataFrame:
    return df.where(F.col("chrom") == chrom)


def keep_features(df: DataFrame, cond: Column, *aggs: Column, key: str = "feature_id") -> DataFrame:
    good = df.groupBy(key).agg(*aggs).where(cond).select(key)
    return df.join(good, key, "left_semi")


def expressed(df: DataFrame, low: float = 0.1, max_low_pct: float = 10.0) -> DataFrame:
    """Drop features below ``low`` in more than ``max_low_pct`` percent of samples; nulls are never low."""
    pct = 100.0 * F.count_if(F.col("value") < low) / F.count(F.lit(1))
    return keep_features(df, F.col("_p") <= max_low_pct, pct.alias("_p"))


def varying(df: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Drop constant features and those whose share of distinct values is at most ``1 - threshold``."""
    return keep_features(
        df,
        (F.col("_lo") < F.col("_hi")) & (F.col("_d") / F.col("_n") > 1 - threshold),
        F.min("value").alias("_lo"),
        F.max("value").alias("_hi"),
        F.count_distinct("value").alias("_d"),
        F.count(F.lit(1)).alias("_n"),
    )


def complete_enough(df: DataFrame, max_missing: float = 0.2, strict: bool = False) -> DataFrame:
    rate = F.count_if(F.col("value").isNull()) / F.count(F.lit(1))
    cond = F.col("_m") < max_missing if strict else F.col("_m") <= max_missing
    return keep_features(df, cond, rate.alias("_m"))


def validate_phenotypes(df: DataFrame, max_missing: float = 0.2, threshold: float = 0.95) -> DataFrame:
    """Numeric coercion, all-null samples out, then the constant and missing-rate filters."""
    num = df.withColumn("value", F.nullif(F.col("value").try_cast("double"), F.lit(float("nan"))))
    full = keep_features(num, F.col("_n") > 0, F.count("value").alias("_n"), key="sample_id")
    return full.transform(varying, threshold).transform(complete_enough, max_missing)


def significant(df: DataFrame, fdr: float = 0.05, p: float = 1e-5) -> DataFrame:
    """FDR cut if the column exists, else p cut; best row per gene and variant."""
    hit = df.where(F.col("fdr") < fdr) if "fdr" in df.columns else df.where(F.col("p_value") < p)
    return first_rows(hit, ["gene_id", "variant_id"], [F.col("p_value"), *[F.col(c) for c in ("beta", "se") if c in df.columns]])


def region(df: DataFrame, chrom: str, position: int, window: int, p: str = "p_value") -> DataFrame:
    half = window // 2
    hit = (F.col("chrom") == chrom) & F.col("pos").between(position - half, position + half)
    return df.where(hit).withColumn("log10p", neg_log10(F.col(p)))


def valid_p(df: DataFrame, p: str = "p_value", floor: float = 0.0) -> DataFrame:
    return df.where((F.col(p) > floor) & (F.col(p) <= 1))


def remove_trait_outliers(df: DataFrame, traits: Sequence[str], z: float = 5.0, fences: float = 3.0) -> DataFrame:
    """Drop samples that are extreme in any trait; later traits see only the samples left.

    Only the ids dropped at each step are checkpointed, so lineage stays one level deep.
    """
    rows = df.where(F.col("sample_id").isNotNull())
    gone: DataFrame | None = None
    for trait in traits:
        cur = rows.where(F.col("trait") == trait)
        if gone is not None:
            cur = cur.join(gone, "sample_id", "left_anti")
        v = F.col("value")
        fence = exact_quantiles(cur, [], "value", {"q1": 0.25, "q3": 0.75}).drop("n")
        st = one_row(cur.agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd")), fence).first()  # four numbers
        if st["q1"] is None:
            continue
        iqr = st["q3"] - st["q1"]
        far = (v < st["q1"] - fences * iqr) | (v > st["q3"] + fences * iqr)
        if st["sd"]:
            far = far | (F.abs((v - st["mean"]) / st["sd"]) > z)
        bad = materialize(cur.where(far).select("sample_id").distinct())
        gone = bad if gone is None else gone.unionByName(bad)
    return rows if gone is None else rows.join(gone, "sample_id", "left_anti")


def usable_covariates(covlong: DataFrame, listed: Sequence[str]) -> DataFrame:
    """Listed covariates that are present and take more than one value."""
    return covlong.where(F.col("covariate").isin(*listed)).transform(
        keep_features, F.col("_d") > 1, F.count_distinct("value").alias("_d"), key="covariate"
    )
