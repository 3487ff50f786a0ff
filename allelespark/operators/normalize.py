"""Matrix normalisation on the long form (feature_id, sample_id, value)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.operators.ordered import exact_quantiles, ordered, scalars, with_group_stats
from allelespark.session import materialize


def val() -> Column:
    return F.col("value")


def log2(df: DataFrame, pseudocount: float = 1.0, zero_is_missing: bool = False) -> DataFrame:
    """log2(x + c); the comparison variant first drops zeros and features that held nothing else."""
    if not zero_is_missing:
        return df.withColumn("value", F.log2(val() + pseudocount))
    blank = df.withColumn("value", F.nullif(val(), F.lit(0.0)))
    some = blank.groupBy("feature_id").agg(F.count("value").alias("_n")).where("_n > 0").select("feature_id")
    return blank.join(some, "feature_id", "left_semi").withColumn("value", F.log2(val() + pseudocount))


def arcsinh(df: DataFrame, cofactor: float = 1.0) -> DataFrame:
    return df.withColumn("value", F.asinh(val() / cofactor))


def fill_by_sample(df: DataFrame) -> DataFrame:
    """Missing cells take the mean of their sample."""
    out = with_group_stats(df, ["sample_id"], F.avg("value").alias("_fill"))
    return out.withColumn("value", F.coalesce(val(), F.col("_fill"))).drop("_fill")


def zscore(df: DataFrame) -> DataFrame:
    """Per-feature z-score (sample sd) after filling; constant features give 0."""
    out = with_group_stats(fill_by_sample(df), ["feature_id"], F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    z = F.coalesce(F.try_divide(val() - F.col("_m"), F.col("_s")), F.lit(0.0))
    return out.withColumn("value", z).drop("_m", "_s")


def quantile_uniform(df: DataFrame) -> DataFrame:
    """Empirical CDF per feature on [0, 1]; ties share the middle, ends are pinned to 0 and 1.

    Gaps take the sample mean first.  Equal values are counted before any shuffle, and ranks come
    from balanced value ranges.
    """
    df = materialize(fill_by_sample(df))  # values are joined on below, so they are computed once
    vals = df.where(val().isNotNull()).groupBy("feature_id", "value").agg(F.count(F.lit(1)).alias("_c"))
    run = ordered(vals, ["feature_id"], [val()], {"_before": F.col("_c").cast("double")}, rank="_r")
    size = vals.groupBy("feature_id").agg(F.sum("_c").alias("_n"), F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    mid = (F.col("_before") + (F.col("_c") - 1) / 2) / (F.col("_n") - 1)
    u = F.when(val() == F.col("_lo"), 0.0).when(val() == F.col("_hi"), 1.0).otherwise(mid)
    table = run.join(size, "feature_id").select("feature_id", "value", u.alias("_u"))
    return df.join(table, ["feature_id", "value"], "left").withColumn("value", F.col("_u")).select(*df.columns)


def counts_per_million(df: DataFrame) -> DataFrame:
    out = with_group_stats(df, ["sample_id"], F.sum("value").alias("_t"))
    return out.withColumn("value", F.try_divide(val(), F.col("_t")) * 1e6).drop("_t")


def size_factors(counts: DataFrame) -> DataFrame:
    """Median ratio to the pseudo-geometric mean per sample, scaled to mean one."""
    geo = counts.groupBy("feature_id").agg(F.exp(F.avg(F.log(val() + 1))).alias("_g"), F.max("value").alias("_top"))
    rows = counts.join(geo.where("_top > 0"), "feature_id").select("sample_id", (val() / F.col("_g")).alias("ratio"))
    med = exact_quantiles(rows, ["sample_id"], "ratio", {"_m": 0.5})
    med = med.select("sample_id", F.when(F.col("_m") == 0, 1.0).otherwise(F.col("_m")).alias("_m"))
    (mean,) = scalars(med, F.avg("_m").alias("_mean"))
    return med.select("sample_id", (F.col("_m") / mean).alias("size_factor"))


def feature_moments(counts: DataFrame, factors: DataFrame) -> DataFrame:
    """Mean and variance of size-normalised counts per feature."""
    norm = counts.join(factors, "sample_id").select("feature_id", (val() / F.col("size_factor")).alias("x"))
    return norm.groupBy("feature_id").agg(F.avg("x").alias("mean"), F.var_samp("x").alias("variance"))


def quadratic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares parabola from one aggregate of power sums, x centred; one row (x0, c0, c1, c2)."""
    (x0,) = scalars(df, F.avg(x).alias("x0"))
    u, t = F.col(x) - F.col("x0"), F.col(y)
    s = df.select(x, y, x0).agg(
        F.first("x0").alias("x0"), F.count(F.lit(1)).alias("n"), F.sum(u * u).alias("s2"), F.sum(u * u * u).alias("s3"),
        F.sum(u * u * u * u).alias("s4"), F.sum(t).alias("t0"), F.sum(u * t).alias("t1"), F.sum(u * u * t).alias("t2"),
    )
    n, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("n", "s2", "s3", "s4", "t0", "t1", "t2"))
    c2 = F.coalesce(F.try_divide(t2 - s2 * t0 / n - s3 * t1 / s2, s4 - s2 * s2 / n - s3 * s3 / s2), F.lit(0.0))
    return s.withColumn("c2", c2).select(
        "x0", ((t0 - s2 * F.col("c2")) / n).alias("c0"),
        F.coalesce(F.try_divide(t1 - s3 * F.col("c2"), s2), F.lit(0.0)).alias("c1"), "c2",
    )


def dispersions(counts: DataFrame, factors: DataFrame, fit: str = "parametric") -> DataFrame:
    """Fitted dispersion per feature: log-log parabola, or parabola on the mean for ``local``.

    The per-feature moments (one row each) are checkpointed because the fit reads them four times;
    only the fitted constants reach the driver.
    """
    mom = materialize(feature_moments(counts, factors))
    low = mom.where("mean > 0").agg(F.min("mean")).first()[0]
    mom = mom.withColumn("_m", F.when(F.col("mean") == 0, F.lit(1.0 if low is None else low)).otherwise(F.col("mean")))
    mom = mom.withColumn("raw", F.col("variance") / (F.col("_m") * F.col("_m")))
    ok = (F.col("_m") > 0) & (F.col("variance") > 0)
    at = F.col("_m") if fit == "local" else F.log(F.col("_m") + 1)
    target = F.col("raw") if fit == "local" else F.log(F.col("raw") + 1e-8)
    c = quadratic_fit(mom.where(ok).select(at.alias("x"), target.alias("y")), "x", "y").first()
    if c["c0"] is None:
        return mom.select("feature_id", "mean", "variance", "raw", F.lit(0.1).alias("dispersion"))
    u = at - c["x0"]
    curve = F.lit(c["c0"]) + F.lit(c["c1"]) * u + F.lit(c["c2"]) * u * u
    fitted = mom.withColumn("fitted", F.when(ok, curve if fit == "local" else F.exp(curve)))
    med = exact_quantiles(fitted, [], "fitted", {"m": 0.5}).select("m").scalar()
    final = F.greatest(F.coalesce("fitted", med), F.lit(1e-8))
    return fitted.select("feature_id", "mean", "variance", "raw", final.alias("dispersion"))


def vst(counts: DataFrame, fit: str = "parametric") -> DataFrame:
    """Variance stabilising transform: raw counts against size-normalised feature means."""
    disp = dispersions(counts, materialize(size_factors(counts)), fit).select("feature_id", "mean", "dispersion")
    d, m = F.col("dispersion"), F.col("mean")
    main = F.asinh(F.sqrt(d) * (val() - m) / F.sqrt(m)) / F.sqrt(d)
    out = counts.join(disp, "feature_id")
    return out.withColumn("value", F.when((d > 0) & (m > 0), main).otherwise(F.asinh(F.sqrt(val() + 0.5)))).drop("mean", "dispersion")


def vst_simple(counts: DataFrame) -> DataFrame:
    """Library size over its median, then arcsinh."""
    tot = counts.groupBy("sample_id").agg(F.sum("value").alias("_t"))
    med = exact_quantiles(tot, [], "_t", {"m": 0.5}).select("m").scalar()
    out = counts.join(tot.withColumn("_med", med), "sample_id")
    return out.withColumn("value", F.asinh(F.try_divide(val() * F.col("_med"), F.col("_t")))).drop("_t", "_med")


def vst_clean(df: DataFrame, fit: str = "parametric") -> DataFrame:
    """VST after negatives turn positive and nulls zero; cells VST cannot give fall back to log2."""
    clean = df.withColumn("value", F.coalesce(F.abs(val()), F.lit(0.0))).withColumn("_raw", F.col("value"))
    out = vst(clean, fit)
    good = val().isNotNull() & ~F.isnan(val())
    return out.withColumn("value", F.when(good, val()).otherwise(F.log2(F.col("_raw") + 1))).drop("_raw")


METHODS = {
    "log2": log2,
    "vst": vst_clean,
    "quantile": quantile_uniform,
    "zscore": zscore,
    "arcsinh": arcsinh,
    "tpm": counts_per_million,
}


def normalize(df: DataFrame, method: str) -> DataFrame:
    """Apply a method by name; unknown names leave the data as is."""
    return df.transform(METHODS.get(method, lambda d: d))
