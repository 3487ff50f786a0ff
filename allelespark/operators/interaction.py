"""Genotype-by-covariate interaction models."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespark.functions.stats import t_p
from allelespark.operators.covariates import Design
from allelespark.operators.filters import usable_covariates
from allelespark.operators.multitest import bh_fdr
from allelespark.operators.ranking import top_variance

_OUT = (
    "gene_id {k}, covariate string, n_observations bigint, interaction_beta double, interaction_se double, "
    "interaction_pvalue double, main_effect_beta double, main_effect_pvalue double, r_squared double"
)


def interaction_scan(
    pheno: DataFrame, geno: DataFrame, leads: DataFrame, cov: DataFrame, covariates: Sequence[str], others: int | None = None, min_n: int = 10
) -> DataFrame:
    """value ~ genotype + covariate + further covariates + genotype x covariate; all of them, or the first ``others`` by name.

    ``leads`` maps each feature to its lead variant.  Cross-products are partial sums per
    (feature, covariate); only those small vectors reach Python, where systems are solved in batches.
    Covariates are centred over the cohort for that, and the genotype's main effect is stated for them as they were given.
    A model that can't be fitted has nulls for its results, so it takes no part in an FDR.
    """
    whole = Design(cov)
    names, mean = whole.names, whole.mean
    design = whole.rows.withColumnRenamed("xc", "x")
    at = {c: i + 1 for i, c in enumerate(names)}
    rows = (
        pheno.where("value IS NOT NULL").join(leads.select("feature_id", "variant_id"), "feature_id")
        .join(geno.where("dosage IS NOT NULL"), ["variant_id", "sample_id"]).join(design, "sample_id")
    )
    g, y = F.col("dosage"), F.col("value")
    more = len(names) - 1 if others is None else min(others, len(names) - 1)
    width = 4 + more

    def terms(c: str):
        rest = [F.element_at("x", at[o]) for o in names if o != c][:more]
        x = F.element_at("x", at[c])
        return F.struct(F.lit(c).alias("covariate"), F.array(F.lit(1.0), g, x, *rest, g * x).alias("z"))

    wide = rows.select("feature_id", y.alias("y"), F.explode(F.array(*[terms(c) for c in covariates])).alias("t"))
    wide = wide.select("feature_id", "y", "t.covariate", "t.z")
    z = lambda i: F.element_at("z", i + 1)
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    sums = wide.groupBy("feature_id", "covariate").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("yy"),
        F.array(*[F.sum(z(i) * z(j)) for i, j in pairs]).alias("zz"),
        F.array(*[F.sum(z(i) * F.col("y")) for i in range(width)]).alias("zy"),
    ).where(F.col("n") >= min_n)

    def solve(batches):
        for b in batches:
            n = b["n"].to_numpy(float)
            m = np.zeros((len(b), width, width))
            zz = np.stack(b["zz"].to_list()) if len(b) else np.zeros((0, len(pairs)))
            for q, (i, j) in enumerate(pairs):
                m[:, i, j] = m[:, j, i] = zz[:, q]
            scale = np.sqrt(np.maximum(np.einsum("vii->vi", m), 1e-300))
            m = m / scale[:, :, None] / scale[:, None, :]
            rhs = (np.stack(b["zy"].to_list()) if len(b) else np.zeros((0, width))) / scale
            ok = (np.linalg.cond(m) < 1e12) & (n > width) if len(b) else np.zeros(0, bool)
            m[~ok] = np.eye(width)
            beta = np.linalg.solve(m, rhs[:, :, None])[:, :, 0]
            rss = np.maximum(b["yy"].to_numpy() - (beta * rhs).sum(axis=1), 0.0)
            dof = np.maximum(n - width, 1)
            se = np.sqrt(rss[:, None] / dof[:, None] * np.einsum("vii->vi", np.linalg.inv(m)))
            tss = b["yy"].to_numpy() - b["sy"].to_numpy() ** 2 / n
            with np.errstate(divide="ignore", invalid="ignore"):
                t = beta / se
                r2 = 1 - rss / tss
            # the main effect where the covariate, not its distance from the mean, is 0
            mu = np.array([mean[at[c] - 1] for c in b["covariate"]])
            back = np.zeros((len(b), width))
            back[:, 1], back[:, -1] = 1 / scale[:, 1], -mu / scale[:, -1]
            main = (back * beta).sum(axis=1)
            spread_ = np.sqrt(np.maximum(rss / dof * np.einsum("vi,vij,vj->v", back, np.linalg.inv(m), back), 0))
            take = lambda a: np.where(ok, a, np.nan)
            yield pd.DataFrame({
                "gene_id": b["feature_id"], "covariate": b["covariate"], "n_observations": b["n"],
                "interaction_beta": take(beta[:, -1] / scale[:, -1]), "interaction_se": take(se[:, -1] / scale[:, -1]),
                "interaction_pvalue": take(t_p(t[:, -1], dof)), "main_effect_beta": take(main),
                "main_effect_pvalue": take(t_p(np.divide(main, spread_, out=np.full(len(b), np.nan), where=spread_ > 0), dof)), "r_squared": take(r2),
            })

    return sums.mapInPandas(solve, _OUT.format(k=pheno.schema["feature_id"].dataType.simpleString()))


def interaction_analysis(
    pheno: DataFrame, geno: DataFrame, leads: DataFrame, cov: DataFrame, listed: Sequence[str], max_genes: int | None = None, others: int | None = None
) -> DataFrame:
    """All usable covariates in one job: scan of all features (or of the ``max_genes`` most variable), FDR per covariate."""
    usable = usable_covariates(cov.withColumn("value", F.col("value").cast("string")), listed)
    names = sorted(r[0] for r in usable.select("covariate").distinct().collect())
    chosen = pheno if max_genes is None else top_variance(pheno, max_genes)
    tests = interaction_scan(chosen, geno, leads, cov, names, others)
    return bh_fdr(tests, ["covariate"], "interaction_pvalue")
