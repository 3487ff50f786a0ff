"""Fine-mapping: Bayes factors, posteriors and credible sets for all genes in one job."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.functions.stats import norm_ppf_col
from allelespark.operators.filters import significant
from allelespark.operators.ordered import ordered, with_group_stats
from allelespark.session import materialize


def pval() -> Column:
    return F.col("p_value")


def gene_stats(df: DataFrame, *aggs: Column) -> DataFrame:
    """Per-gene aggregates on rows that are written first.

    A statistic joins back to the rows it is of, so each further one on top would double what a single stage reads and sorts.
    """
    return with_group_stats(materialize(df), ["gene_id"], *aggs)


def posterior_from_bf(df: DataFrame, bf: str = "bf", log_scale: bool = False) -> DataFrame:
    """Normalise Bayes factors per gene; log values are shifted by the gene maximum first."""
    if log_scale:
        df = with_group_stats(df, ["gene_id"], F.max(bf).alias("_top"))
        df = df.withColumn("_w", F.exp(F.col(bf) - F.col("_top"))).drop("_top")
    else:
        df = df.withColumn("_w", F.col(bf) + 1e-10)
    out = with_group_stats(df, ["gene_id"], F.sum("_w").alias("_sum"))
    return out.withColumn("posterior", F.col("_w") / F.col("_sum")).drop("_w", "_sum")


def susie_bf(df: DataFrame) -> DataFrame:
    """exp(z^2 / 2) with z from the p-value, kept on the log scale so that tiny p cannot overflow."""
    z = F.abs(norm_ppf_col(pval() / 2))
    return df.withColumn("log_bf", z * z / 2)


def run_susie(df: DataFrame) -> DataFrame:
    # exp(l) + 1e-10 over its sum, rewritten with the gene maximum taken out
    out = gene_stats(susie_bf(df), F.max("log_bf").alias("_top"))
    out = out.withColumn("_w", F.exp(F.col("log_bf") - F.col("_top")) + 1e-10 * F.exp(-F.col("_top")))
    out = gene_stats(out, F.sum("_w").alias("_sum"))
    return out.withColumn("posterior", F.col("_w") / F.col("_sum")).drop("_w", "_sum", "_top", "log_bf")


def run_finemap(df: DataFrame) -> DataFrame:
    """-ln p as evidence with a prior of 0.7 uniform + 0.3 MAF share (uniform without MAF)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + ([F.sum("maf").alias("_maf")] if "maf" in df.columns else [])
    out = gene_stats(df, *aggs)
    prior = 1 / F.col("_n")
    if "maf" in df.columns:
        prior = 0.7 * prior + 0.3 * F.col("maf") / F.col("_maf")
    out = out.withColumn("log_bf", -F.log(pval() + 1e-300) + F.log(prior)).drop("_n", "_maf")
    out = gene_stats(out, F.max("log_bf").alias("_top"))
    out = gene_stats(out.withColumn("_w", F.exp(F.col("log_bf") - F.col("_top"))), F.sum("_w").alias("_sum"))
    return out.withColumn("posterior", F.col("_w") / F.col("_sum")).drop("_w", "_sum", "_top", "log_bf")


def run_abf(df: DataFrame, prior_variance: float = 0.04) -> DataFrame:
    """Approximate Bayes factors from beta and se; missing beta is 0, missing se 0.05."""
    b, s = F.coalesce("beta", F.lit(0.0)), F.coalesce("se", F.lit(0.05))
    d = 1 + s * s / prior_variance
    log_abf = -0.5 * F.log(d) + b * b / (2 * prior_variance) / d
    return posterior_from_bf(df.withColumn("bf", F.exp(log_abf))).drop("bf")


METHODS = {"susie": run_susie, "finemap": run_finemap, "abf": run_abf}


def credible_sets(df: DataFrame, threshold: float = 0.95, min_lead: float = 0.01, max_causal: int = 5) -> DataFrame:
    """Smallest sets reaching ``threshold``, best first.

    A row belongs to set 0 while the posterior before it is below the threshold.  What is left
    sums to less than the threshold, so it forms one further set if its best row reaches
    ``min_lead``; no loop is needed.
    """
    run = ordered(
        df, ["gene_id"], [F.col("posterior").desc(), F.col("variant_id")], {"_before": F.col("posterior")}, rank="_rank"
    )
    first = F.col("_before") < threshold
    run = with_group_stats(
        run, ["gene_id"],
        F.max("posterior").alias("_best"),
        F.max(F.when(~first, F.col("posterior"))).alias("_next"),
        F.count_if(first).alias("_n0"),
        F.sum(F.when(first, F.col("posterior"))).alias("_s0"),
    )
    index = F.when(first & (F.col("_best") >= min_lead), 0)
    if max_causal > 1:
        index = index.when(~first & (F.col("_next") >= min_lead), 1)
    out = run.withColumn("set_index", index.cast("int")).where("set_index IS NOT NULL")
    later = F.col("set_index") == 1
    rank = F.when(later, F.col("_rank") - F.col("_n0")).otherwise(F.col("_rank"))
    cum = F.col("_before") + F.col("posterior") - F.when(later, F.col("_s0")).otherwise(0.0)
    return out.select(
        *df.columns, "set_index", rank.cast("bigint").alias("set_rank"), cum.alias("cum_posterior"), (rank == 1).alias("is_lead")
    )


def fine_map(df: DataFrame, method: str = "susie", fdr: float = 0.05, p: float = 1e-5, threshold: float = 0.95) -> DataFrame:
    """Significant pairs, genes with at least two variants, posteriors by method, credible sets."""
    hits = significant(df, fdr, p)
    hits = gene_stats(hits, F.count(F.lit(1)).alias("_n")).where("_n >= 2").drop("_n")
    return credible_sets(METHODS.get(method, run_susie)(hits), threshold)
