"""Composed chains: phenotype preparation and the raw-against-normalised comparison."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespark.operators import filters, summary
from allelespark.operators.covariates import pcs_as_covariates, phenotype_pcs, remove_effects
from allelespark.operators.joins import append_covariates, restrict, shared_samples
from allelespark.operators.normalize import normalize
from allelespark.operators.qc import fence_outliers
from allelespark.session import materialize


def prepare_phenotypes(
    pheno: DataFrame, genotyped: DataFrame, method: str = "log2", batch: DataFrame | None = None, low: float = 0.1, gaps: str = "keep"
) -> DataFrame:
    """Align, validate, drop low expression, normalise and remove batch effects (of features with gaps, if ``gaps`` is "fit")."""
    tables = [pheno, genotyped] + ([batch] if batch is not None else [])
    common = shared_samples(*tables)
    out = restrict(pheno, common).transform(filters.validate_phenotypes).transform(filters.expressed, low)
    out = normalize(out, method)
    return out if batch is None else remove_effects(out, restrict(batch, common), gaps=gaps)


def enhanced_covariates(pheno: DataFrame, given: DataFrame | None = None, k: int = 10) -> DataFrame:
    """Given covariates plus phenotype PCs."""
    pcs = pcs_as_covariates(phenotype_pcs(pheno, k))
    return pcs if given is None else append_covariates(given, pcs)


def comparison_bundle(raw: DataFrame, norm: DataFrame) -> DataFrame:
    """All scalar comparisons as (section, item, metric, raw, normalized).  Both matrices are checkpointed, as every section reads them."""
    raw, norm = materialize(raw), materialize(norm)
    stats = ["mean", "median", "sd", "min", "max", "skewness", "kurtosis", "q1", "q3", "iqr"]

    def long(df: DataFrame, item: str | None, cols: list[str], section: str) -> DataFrame:
        src = df.withColumn("item", F.col(item).cast("string") if item else F.lit("all"))
        return src.select("item", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot("item", cols, "metric", "v").withColumn(
            "section", F.lit(section)
        )

    def sections(d: DataFrame, detect: str) -> DataFrame:
        seen = summary.detection(raw, norm).select("feature_id", F.col(detect).alias("detected_pct"))
        parts = [
            long(summary.ten_statistics(d, "x"), None, stats, "distribution"),
            long(summary.margins(d, "sample_id"), "sample_id", ["mean", "variance", "missing_pct"], "sample"),
            long(summary.margins(d, "feature_id"), "feature_id", ["mean", "variance", "missing_pct"], "feature"),
            long(seen, "feature_id", ["detected_pct"], "detection"),
            long(fence_outliers(d, 1.5, min_n=10), "sample_id", ["n_outliers"], "outliers"),
            long(summary.normality(d), "feature_id", ["k2", "log10p"], "normality"),
        ]
        return reduce(DataFrame.unionByName, parts)

    key = ["section", "item", "metric"]
    a = sections(raw, "raw_pct").withColumnRenamed("v", "raw")
    b = sections(norm, "norm_pct").withColumnRenamed("v", "normalized")
    return a.join(b, key, "full_outer").select(*key, "raw", "normalized")
