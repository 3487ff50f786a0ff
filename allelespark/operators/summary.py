"""Summaries of association results and of raw against normalised matrices."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.functions.stats import CHI2_MEDIAN_1DF, norm_ppf_col
from allelespark.operators.clean import neg_log10
from allelespark.operators.filters import valid_p
from allelespark.operators.ordered import columns_of, exact_quantiles, one_row, scalars
from allelespark.operators.ranking import top_hits


def lambda_gc(df: DataFrame, keys: Sequence[str] = (), p: str = "p_value") -> DataFrame:
    """Median chi-square over its null median; the transform is applied to the middle p-values only."""
    chi2 = lambda c: F.pow(norm_ppf_col(c / 2), F.lit(2.0))
    q = exact_quantiles(valid_p(df, p, 1e-300), keys, p, {"_m": 0.5}, transform=chi2)
    return q.select(*keys, "n", (F.col("_m") / CHI2_MEDIAN_1DF).alias("lambda_gc"))


def inflation_class(lam: Column) -> Column:
    return F.when(lam < 0.95, "deflated").when(lam > 1.05, "inflated").otherwise("well_controlled")


def hit_counts(df: DataFrame, by: str = "phenotype", p: str = "p_value") -> DataFrame:
    """Rows and hits at three thresholds per phenotype, with a total row."""
    v = F.col(p)
    return df.rollup(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(v < 5e-8).alias("hits_5e8"),
        F.count_if(v < 1e-5).alias("hits_1e5"),
        F.count_if(v < 1e-3).alias("hits_1e3"),
    ).withColumn(by, F.coalesce(by, F.lit("all")))


def effect_sizes(df: DataFrame, beta: str = "beta") -> DataFrame:
    med = exact_quantiles(df, [], beta, {"median": 0.5}).select("median")
    return one_row(
        df.agg(
            F.avg(beta).alias("mean"), F.stddev_samp(beta).alias("sd"), F.min(beta).alias("min"), F.max(beta).alias("max")
        ),
        med,
    )


def significant_counts(df: DataFrame, p: str = "p_value") -> DataFrame:
    return df.agg(
        F.count_if(F.col(p) < 5e-8).alias("significant"),
        F.count_if((F.col(p) < 1e-5) & (F.col(p) >= 5e-8)).alias("suggestive"),
    )


def gwas_quality(df: DataFrame, by: str = "phenotype", p: str = "p_value") -> DataFrame:
    """Missing p, hits, rows and lambda per phenotype."""
    v = F.col(p)
    base = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(v.isNull()).alias("missing_p"),
        (100.0 * F.count_if(v.isNull()) / F.count(F.lit(1))).alias("missing_p_pct"),
        F.count_if(v < 5e-8).alias("hits"),
    )
    return base.join(lambda_gc(df, [by], p).drop("n"), by, "left").withColumn(
        "lambda_gc", F.coalesce("lambda_gc", F.lit(1.0))
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation of the rows that have both; NaN where one side doesn't vary (``corr`` divides by zero there), null without rows."""
    both = x.isNotNull() & y.isNotNull()
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))
    return F.when(F.count_if(both) > 0, F.coalesce(r, F.lit(float("nan"))))


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation and least-squares line of y on x."""
    return df.agg(
        F.lit(f"{x}~{y}").alias("pair"), F.count(F.lit(1)).alias("n"), correlation(F.col(x), F.col(y)).alias("r"),
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
    )


def statistic_correlations(df: DataFrame, k: int, *ids: str) -> DataFrame:
    """Pairwise correlations of beta, se, maf and -log10 p over the k best hits."""
    top = top_hits(df, k, *ids).withColumn("log10p", neg_log10(F.col("p_value")))
    names = ["beta", "se", "maf", "log10p"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    row = top.agg(*[correlation(F.col(a), F.col(b)).alias(f"{a}~{b}") for a, b in pairs])
    return row.unpivot([], row.columns, "pair", "r")


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width counts between min and max; the last bin is closed.  Empty bins are absent."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "metric", "v")
    long = long.where("v IS NOT NULL")
    lims = df.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in cols], *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols])
    at = dict(zip(lims.columns, columns_of(lims)))
    pick = lambda side: F.element_at(F.create_map(*[x for c in cols for x in (F.lit(c), at[f"{side}_{c}"])]), F.col("metric"))
    rows = long.select("metric", "v", pick("lo").alias("lo"), pick("hi").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    pos = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)))
    out = rows.groupBy("metric", "lo", width.alias("w"), pos.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.select("metric", "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("left_edge"), "n")


def ten_statistics(df: DataFrame, label: str, value: str = "value") -> DataFrame:
    q = exact_quantiles(df, [], value, {"median": 0.5, "q1": 0.25, "q3": 0.75})
    m = df.agg(
        F.lit(label).alias("label"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.min(value).alias("min"),
        F.max(value).alias("max"), F.skewness(value).alias("skewness"), F.kurtosis(value).alias("kurtosis"),
    )
    return one_row(m, q.select("median", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr")))


def shape(df: DataFrame, min_n: int = 10, key: str = "feature_id") -> DataFrame:
    """Skewness and excess kurtosis per feature with more than ``min_n`` values."""
    return df.groupBy(key).agg(
        F.count("value").alias("n"), F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis")
    ).where(F.col("n") > min_n)


def normality(df: DataFrame, key: str = "feature_id") -> DataFrame:
    """Omnibus K2 test from skewness and kurtosis, entirely in column arithmetic."""
    n = F.col("n").cast("double")
    y = F.col("skewness") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    z_skew = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(0.5 * F.log(w2))
    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("kurtosis") + 3 - mean) / F.sqrt(var)
    rb1 = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / rb1 * (2 / rb1 + F.sqrt(1 + 4 / (rb1 * rb1)))
    den = 1 + x * F.sqrt(2 / (a - 4))
    cube = F.signum(den) * F.cbrt((1 - 2 / a) / F.abs(den))
    z_kurt = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))
    k2 = z_skew * z_skew + z_kurt * z_kurt
    ok = shape(df, key=key).where(F.col("skewness").isNotNull())
    out = ok.withColumn("k2", k2)
    log10p = F.when(F.exp(-F.col("k2") / 2) > 0, F.col("k2") / (2 * F.log(F.lit(10.0)))).otherwise(10.0)
    return out.select(key, "n", "k2", log10p.alias("log10p"))


def margins(df: DataFrame, key: str) -> DataFrame:
    """Mean, variance and missing percent by sample or by feature."""
    v = F.col("value")
    return df.groupBy(key).agg(
        F.avg(v).alias("mean"), F.var_samp(v).alias("variance"),
        (100.0 * F.count_if(v.isNull()) / F.count(F.lit(1))).alias("missing_pct"),
    )


def paired_margins(raw: DataFrame, norm: DataFrame, key: str) -> DataFrame:
    side = lambda d, s: margins(d, key).withColumnsRenamed({c: f"{s}_{c}" for c in ("mean", "variance", "missing_pct")})
    return side(raw, "raw").join(side(norm, "norm"), key, "full_outer")


def detection(raw: DataFrame, norm: DataFrame) -> DataFrame:
    """Percent of samples in which a feature is detected, raw above 0 and normalised above the 1% quantile."""
    q = exact_quantiles(norm, ["sample_id"], "value", {"_q": 0.01}).drop("n")
    a = raw.groupBy("feature_id").agg((100.0 * F.count_if(F.col("value") > 0) / F.count(F.lit(1))).alias("raw_pct"))
    b = norm.join(q, "sample_id").groupBy("feature_id").agg(
        (100.0 * F.count_if(F.col("value") > F.col("_q")) / F.count(F.lit(1))).alias("norm_pct")
    )
    return a.join(b, "feature_id", "full_outer")


def five_numbers(df: DataFrame, by: str, value: str) -> DataFrame:
    return exact_quantiles(df, [by], value, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})


def effect_by_analysis(df: DataFrame, by: str, beta: str = "beta") -> DataFrame:
    q = exact_quantiles(df, [by], beta, {"median": 0.5})
    return df.groupBy(by).agg(F.avg(beta).alias("mean"), F.min(beta).alias("min"), F.max(beta).alias("max")).join(q, by)


def axis_ticks(df: DataFrame, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    return exact_quantiles(df, [chrom], pos, {"tick": 0.5}).select(chrom, "tick")


def credible_set_summary(sets: DataFrame) -> DataFrame:
    sizes = sets.groupBy("gene_id", "set_index").agg(F.count(F.lit(1)).alias("size"))
    med = exact_quantiles(sizes, [], "size", {"median_size": 0.5}).select("median_size")
    return one_row(
        sizes.agg(
            F.count_distinct("gene_id").alias("n_genes"), F.count(F.lit(1)).alias("n_sets"), F.avg("size").alias("mean_size"),
            F.min("size").alias("min_size"), F.max("size").alias("max_size"), F.sum("size").alias("n_variants"),
        ),
        med,
    )


def interaction_summary(tests: DataFrame, fdr: float = 0.1) -> DataFrame:
    hit = F.count_if(F.col("fdr") < fdr)
    out = tests.rollup("covariate").agg(
        F.count(F.lit(1)).alias("tested"), hit.alias("significant"), (100.0 * hit / F.count(F.lit(1))).alias("hit_rate")
    )
    return out.withColumn("covariate", F.coalesce("covariate", F.lit("all")))


def analysis_rollup(runs: DataFrame) -> DataFrame:
    """Runs, successes, failures and significant counts by type and mode with subtotals."""
    ok = F.col("status") == "completed"
    out = runs.rollup("qtl_type", "mode").agg(
        F.count(F.lit(1)).alias("analyses"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"),
        F.sum(F.when(ok, F.col("significant_count")).otherwise(0)).alias("significant"),
    )
    return out.withColumns({c: F.coalesce(c, F.lit("all")) for c in ("qtl_type", "mode")})


def signal_share(df: DataFrame, by: str, p: str = "p_value") -> DataFrame:
    """Capped, scaled share of nominally significant rows and a tenth of it as error."""
    share = F.least(10 * F.avg((F.col(p) < 0.05).cast("double")), F.lit(0.8))
    return df.groupBy(by).agg(share.alias("share")).withColumn("error", F.col("share") * 0.1)


def explained_variance(eigen: DataFrame, value: str = "eigenvalue") -> DataFrame:
    (total,) = scalars(eigen, F.sum(value).alias("_total"))
    return eigen.select("*", total).withColumn("explained_pct", 100 * F.col(value) / F.col("_total")).drop("_total")


def chromosomes(df: DataFrame) -> DataFrame:
    return df.select("chrom").distinct()
