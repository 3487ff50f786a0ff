"""Registered queries: ranking windows (W) and fine-mapping (Q10-Q13, A36)."""
from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from allelespark.operators import display as D
from allelespark.operators import finemap as FM
from allelespark.operators import multitest as MT
from allelespark.operators import summary as S
from allelespark.operators.ranking import top_variance
from allelespark.plans.q_qc import rnd
from allelespark.plans.registry import query
from allelespark.plans.sqltext import norm_ppf_sql

_BH = """SELECT {g}, p_value, min(p_value * n / rk) OVER (PARTITION BY {g} ORDER BY p_value DESC ROWS UNBOUNDED PRECEDING) AS f
         FROM (SELECT {g}, p_value, max(rn) AS rk, max(n) AS n FROM (
                 SELECT {g}, p_value, row_number() OVER (PARTITION BY {g} ORDER BY p_value) AS rn, count(*) OVER (PARTITION BY {g}) AS n
                 FROM {src} WHERE p_value > 0 AND p_value <= 1) GROUP BY {g}, p_value)"""


@query("w1_bh_fdr", f"""
    WITH a AS (SELECT gene_id, variant_id, CASE WHEN variant_id % 41 = 5 THEN 0 WHEN variant_id % 41 = 6 THEN NULL ELSE p_value END AS p_value FROM assoc),
    b AS ({_BH.format(g='gene_id', src='a')})
    SELECT a.gene_id, a.variant_id, round(coalesce(least(b.f, 1), 1), 6) AS fdr FROM a LEFT JOIN b ON a.gene_id = b.gene_id AND a.p_value = b.p_value""")
def w1(t):
    v = F.col("variant_id")
    a = t.assoc().withColumn("p_value", F.when(v % 41 == 5, 0.0).when(v % 41 != 6, F.col("p_value")))
    return rnd(MT.bh_fdr(a, ["gene_id"]).select("gene_id", "variant_id", "fdr"), "fdr")


@query("w1_bh_fdr_global", f"""
    WITH a AS (SELECT 1 AS g, * FROM assoc), b AS ({_BH.format(g='g', src='a')})
    SELECT a.gene_id, a.variant_id, round(least(b.f, 1), 6) AS fdr FROM a JOIN b ON a.p_value = b.p_value""")
def w1g(t):
    return rnd(MT.bh_fdr(t.assoc()).select("gene_id", "variant_id", "fdr"), "fdr")


@query("w2_qvalues_lambda", f"""
    WITH a AS (SELECT 1 AS g, * FROM assoc), b AS ({_BH.format(g='g', src='a')}),
    z AS (SELECT least(1, count(*) FILTER (p_value > 0.5) * 1.0 / count(*) / 0.5) AS pi0 FROM assoc)
    SELECT a.gene_id, a.variant_id, round(least(b.f, 1) * pi0, 6) AS qval FROM a JOIN b ON a.p_value = b.p_value, z""")
def w2(t):
    return rnd(MT.qvalues(t.assoc(), lam=0.5).select("gene_id", "variant_id", "qval"), "qval")


def _spline_sql() -> str:
    """The natural spline's value at 0.95 is a fixed weighting of the shares above the grid's lambdas."""
    x = np.arange(1, 20) / 20
    d = lambda c: (np.clip(x - c, 0, None) ** 3 - np.clip(x - x[-1], 0, None) ** 3) / (x[-1] - c)
    basis = np.stack([np.ones(19), x, d(x[0]) - d(x[9])], axis=1)
    weights = basis[-1] @ np.linalg.pinv(basis)
    parts = " + ".join(f"({w!r}) * count(*) FILTER (p_value > {l:.2f}) / count(*) / {1 - l:.2f}" for w, l in zip(weights.tolist(), x.tolist()))
    return f"SELECT least(1, greatest({parts}, 1.0 / count(*))) AS pi0 FROM assoc"


@query("w2_qvalue_threshold", f"""
    WITH a AS (SELECT 1 AS g, * FROM assoc), b AS ({_BH.format(g='g', src='a')}), z AS ({_spline_sql()}),
    q AS (SELECT a.p_value, least(1, least(b.f, 1) * pi0) AS qval FROM a JOIN b ON a.p_value = b.p_value, z)
    SELECT max(p_value) FILTER (qval <= 0.05) AS p_threshold, count(*) FILTER (qval <= 0.05) AS n_significant FROM q""")
def w2s(t):
    return MT.significance_threshold(MT.qvalues(t.assoc()))


@query("w3_qq_points", """
    SELECT phenotype, variant_id, row_number() OVER (ORDER BY p_value, phenotype, variant_id) AS rank, count(*) OVER () AS n,
           round(-log10(p_value), 6) AS observed,
           round(-log10(row_number() OVER (ORDER BY p_value, phenotype, variant_id) * 1.0 / count(*) OVER ()), 6) AS expected FROM gwas""")
def w3(t):
    return rnd(MT.qq_points(t.gwas(), "phenotype", "variant_id"), "observed", "expected").withColumn(
        "expected", F.col("expected") + F.lit(0.0)
    )


@query("w4_qq_band")
def w4(t):
    return MT.qq_band(MT.qq_points(t.gwas(), "phenotype", "variant_id"))


@query("w5_genome_coordinate", """
    WITH s AS (SELECT chrom, min(pos) AS lo, max(pos) AS hi FROM gwas GROUP BY chrom),
    o AS (SELECT chrom, CAST(coalesce(sum(hi - lo + 1000000) OVER (ORDER BY chrom ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) - lo AS off FROM s)
    SELECT phenotype, variant_id, g.chrom, pos, pos + off AS pos_index FROM gwas g JOIN o ON o.chrom = g.chrom""")
def w5(t):
    return D.genome_coordinate(t.gwas().select("phenotype", "variant_id", "chrom", "pos"))


@query("w6_colour_index", """
    SELECT chrom, CAST((dense_rank() OVER (ORDER BY chrom) - 1) % 2 AS INTEGER) AS colour FROM (SELECT DISTINCT chrom FROM gwas)""")
def w6(t):
    return D.colour_index(t.gwas())


@query("w9_top_hit", """
    SELECT phenotype, variant_id, chrom, pos FROM (
      SELECT *, row_number() OVER (PARTITION BY phenotype ORDER BY p_value, variant_id) AS k FROM gwas) WHERE k = 1""")
def w9(t):
    return D.top_hit(t.gwas(), "variant_id", keys=("phenotype",)).select("phenotype", "variant_id", "chrom", "pos")


@query("w9_locus_of_top_hit", """
    WITH b AS (SELECT chrom, pos FROM gwas ORDER BY p_value, phenotype, variant_id LIMIT 1)
    SELECT phenotype, variant_id, g.chrom, g.pos FROM gwas g, b WHERE g.chrom = b.chrom AND abs(g.pos - b.pos) <= 3000000""")
def w9b(t):
    out = D.locus_around_top(t.gwas(), 6_000_000, "phenotype", "variant_id")
    return out.select("phenotype", "variant_id", "chrom", "pos")


_N = "(0.01 + 0.98 * (row_number() OVER (ORDER BY value, feature_id, sample_id) - 1) / (count(*) OVER () - 1))"


@query("w10_normal_qq", f"""
    SELECT feature_id, sample_id, rank, round(value, 6) AS observed, round({norm_ppf_sql('q')}, 6) AS theoretical
    FROM (SELECT feature_id, sample_id, value, row_number() OVER (ORDER BY value, feature_id, sample_id) AS rank, {_N} AS q
          FROM pheno_na WHERE value IS NOT NULL)""")
def w10(t):
    return rnd(MT.normal_qq(t.pheno_na(), "feature_id", "sample_id"), "observed", "theoretical").withColumn(
        "theoretical", F.col("theoretical") + F.lit(0.0)
    )


@query("w11_display_zscore", """
    WITH k AS (SELECT feature_id FROM pheno_na GROUP BY feature_id ORDER BY var_samp(value) DESC, feature_id LIMIT 50),
    s AS (SELECT feature_id, avg(value) AS m, stddev_samp(value) AS sd FROM pheno_na GROUP BY feature_id)
    SELECT p.feature_id, p.sample_id, round(coalesce((value - m) / sd, 0), 6) AS value
    FROM pheno_na p JOIN k ON k.feature_id = p.feature_id JOIN s ON s.feature_id = p.feature_id""")
def w11(t):
    return rnd(D.display_zscore(top_variance(t.pheno_na(), 50)), "value")


_HITS = """h0 AS (SELECT gene_id, variant_id, p_value, beta, se, maf, count(*) OVER (PARTITION BY gene_id) AS n FROM assoc WHERE p_value < 1e-5),
    h AS (SELECT * FROM h0 WHERE n >= 2)"""
_FIN = """lp AS (SELECT *, -ln(p_value + 1e-300) + ln(0.7 / n + 0.3 * maf / sum(maf) OVER (PARTITION BY gene_id)) AS l FROM h),
    w AS (SELECT *, exp(l - max(l) OVER (PARTITION BY gene_id)) AS w FROM lp),
    pp AS (SELECT gene_id, variant_id, w / sum(w) OVER (PARTITION BY gene_id) AS posterior FROM w)"""
_SUSIE = f"""lp AS (SELECT *, pow({norm_ppf_sql('p_value / 2')}, 2) / 2 AS l FROM h),
    mx AS (SELECT *, max(l) OVER (PARTITION BY gene_id) AS top FROM lp),
    w AS (SELECT *, exp(l - top) + 1e-10 * exp(-top) AS w FROM mx),
    pp AS (SELECT gene_id, variant_id, w / sum(w) OVER (PARTITION BY gene_id) AS posterior FROM w)"""
_ABF = """w AS (SELECT *, sqrt(1 / (1 + se * se / 0.04)) * exp(beta * beta / 0.08 / (1 + se * se / 0.04)) + 1e-10 AS w FROM h),
    pp AS (SELECT gene_id, variant_id, w / sum(w) OVER (PARTITION BY gene_id) AS posterior FROM w)"""
_SETS = """r AS (SELECT *, coalesce(sum(posterior) OVER (PARTITION BY gene_id ORDER BY posterior DESC, variant_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             row_number() OVER (PARTITION BY gene_id ORDER BY posterior DESC, variant_id) AS rn FROM pp),
    g AS (SELECT gene_id, max(posterior) AS best, max(posterior) FILTER (before >= 0.95) AS nxt, count(*) FILTER (before < 0.95) AS n0,
                 sum(posterior) FILTER (before < 0.95) AS s0 FROM r GROUP BY gene_id),
    cs AS (SELECT r.gene_id, r.variant_id, r.posterior, CAST(CASE WHEN before < 0.95 THEN 0 ELSE 1 END AS INTEGER) AS set_index,
                  CASE WHEN before < 0.95 THEN rn ELSE rn - n0 END AS set_rank,
                  before + posterior - CASE WHEN before < 0.95 THEN 0 ELSE s0 END AS cum_posterior
           FROM r JOIN g ON g.gene_id = r.gene_id WHERE (before < 0.95 AND best >= 0.01) OR (before >= 0.95 AND nxt >= 0.01))"""
_OUT = """SELECT gene_id, variant_id, round(posterior, 6) AS posterior, set_index, set_rank, round(cum_posterior, 6) AS cum_posterior,
          set_rank = 1 AS is_lead FROM cs"""


def _sets(df):
    out = df.select("gene_id", "variant_id", "posterior", "set_index", "set_rank", "cum_posterior", "is_lead")
    return rnd(out, "posterior", "cum_posterior")


@query("w7_credible_sets", f"WITH {_HITS}, {_ABF}, {_SETS} {_OUT}")
def w7(t):
    return _sets(FM.fine_map(t.assoc(), "abf"))


@query("w8_posteriors", """
    WITH w AS (SELECT gene_id, variant_id, -ln(p_value) + 1e-10 AS w, exp(-ln(p_value) + ln(max(p_value) OVER (PARTITION BY gene_id))) AS dummy,
                      exp(-ln(p_value) - max(-ln(p_value)) OVER (PARTITION BY gene_id)) AS e FROM assoc)
    SELECT gene_id, variant_id, round(w / sum(w) OVER (PARTITION BY gene_id), 8) AS linear, round(e / sum(e) OVER (PARTITION BY gene_id), 8) AS softmax FROM w""")
def w8(t):
    a = t.assoc().select("gene_id", "variant_id", (-F.log("p_value")).alias("bf"))
    lin = FM.posterior_from_bf(a).withColumnRenamed("posterior", "linear")
    out = FM.posterior_from_bf(lin, log_scale=True).withColumnRenamed("posterior", "softmax")
    return rnd(out.drop("bf"), "linear", "softmax", digits=8)


@query("q10_finemap_susie", f"WITH {_HITS}, {_SUSIE}, {_SETS} {_OUT}")
def q10(t):
    return _sets(FM.fine_map(t.assoc(), "susie"))


@query("q11_finemap_prior", f"WITH {_HITS}, {_FIN}, {_SETS} {_OUT}")
def q11(t):
    return _sets(FM.fine_map(t.assoc(), "finemap"))


@query("q12_finemap_abf", f"""
    WITH {_HITS.replace('1e-5', '1e-3')}, {_ABF} SELECT gene_id, variant_id, round(posterior, 6) AS posterior FROM pp""")
def q12(t):
    hits = FM.significant(t.assoc(), p=1e-3)
    return rnd(FM.run_abf(hits).select("gene_id", "variant_id", "posterior"), "posterior")


@query("q13_fine_map", f"""
    WITH {_HITS}, {_FIN}, {_SETS}
    SELECT gene_id, set_index, count(*) AS size, max(variant_id) FILTER (set_rank = 1) AS lead_variant,
           round(max(cum_posterior), 6) AS coverage FROM cs GROUP BY gene_id, set_index""")
def q13(t):
    sets = FM.fine_map(t.assoc(), "finemap")
    out = sets.groupBy("gene_id", "set_index").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.when(F.col("is_lead"), F.col("variant_id"))).alias("lead_variant"),
        F.max("cum_posterior").alias("coverage"),
    )
    return rnd(out, "coverage")


@query("a36_credible_set_summary", f"""
    WITH {_HITS}, {_FIN}, {_SETS}, z AS (SELECT gene_id, set_index, count(*) AS size FROM cs GROUP BY gene_id, set_index)
    SELECT count(DISTINCT gene_id) AS n_genes, count(*) AS n_sets, round(avg(size), 6) AS mean_size, min(size) AS min_size, max(size) AS max_size,
           CAST(sum(size) AS BIGINT) AS n_variants, median(size) AS median_size FROM z""")
def a36(t):
    return rnd(S.credible_set_summary(FM.fine_map(t.assoc(), "finemap")), "mean_size")
