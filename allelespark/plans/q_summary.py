"""Registered queries: result and matrix summaries (A21-A40, A43, A45)."""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.operators import summary as S
from allelespark.operators.qc import fence_outliers
from allelespark.plans.q_qc import _FENCE, rnd
from allelespark.plans.registry import query
from allelespark.plans.sqltext import norm_ppf_sql

_CHI2 = f"pow({norm_ppf_sql('p_value / 2')}, 2)"


@query("a21_lambda_gc", f"""
    SELECT 'all' AS phenotype, count(*) AS n, round(median({_CHI2}) / 0.4549364, 6) AS lambda_gc FROM gwas WHERE p_value > 1e-300 AND p_value <= 1
    UNION ALL SELECT phenotype, count(*), round(median({_CHI2}) / 0.4549364, 6) FROM gwas WHERE p_value > 1e-300 AND p_value <= 1 GROUP BY phenotype""")
def a21(t):
    whole = S.lambda_gc(t.gwas()).select(F.lit("all").alias("phenotype"), "n", "lambda_gc")
    return rnd(whole.unionByName(S.lambda_gc(t.gwas(), ["phenotype"])), "lambda_gc")


@query("a22_gwas_summary", """
    SELECT coalesce(phenotype, 'all') AS phenotype, count(*) AS n_rows, count(*) FILTER (p_value < 5e-8) AS hits_5e8,
           count(*) FILTER (p_value < 1e-5) AS hits_1e5, count(*) FILTER (p_value < 1e-3) AS hits_1e3 FROM gwas GROUP BY ROLLUP (phenotype)""")
def a22(t):
    return S.hit_counts(t.gwas())


@query("a22_effect_sizes", """
    SELECT round(avg(beta), 6) AS mean, round(stddev_samp(beta), 6) AS sd, round(min(beta), 6) AS min, round(max(beta), 6) AS max,
           round(median(beta), 6) AS median FROM assoc""")
def a22b(t):
    return rnd(S.effect_sizes(t.assoc()), "mean", "sd", "min", "max", "median")


@query("a23_significant_counts", """
    SELECT count(*) FILTER (p_value < 5e-8) AS significant, count(*) FILTER (p_value < 1e-5 AND p_value >= 5e-8) AS suggestive FROM assoc""")
def a23(t):
    return S.significant_counts(t.assoc())


@query("a24_gwas_quality", f"""
    WITH g AS (SELECT phenotype, CASE WHEN variant_id % 31 = 4 THEN NULL ELSE p_value END AS p_value FROM gwas)
    SELECT phenotype, count(*) AS n_rows, count(*) FILTER (p_value IS NULL) AS missing_p,
           round(100.0 * count(*) FILTER (p_value IS NULL) / count(*), 6) AS missing_p_pct, count(*) FILTER (p_value < 5e-8) AS hits,
           round(median({_CHI2}) / 0.4549364, 6) AS lambda_gc FROM g GROUP BY phenotype""")
def a24(t):
    g = t.gwas().withColumn("p_value", F.when(F.col("variant_id") % 31 != 4, F.col("p_value")))
    return rnd(S.gwas_quality(g), "missing_p_pct", "lambda_gc")


def _trend(x, y, src="assoc"):
    return f"""SELECT '{x}~{y}' AS pair, count(*) AS n, round(corr({y}, {x}), 6) AS r, round(regr_slope({y}, {x}), 6) AS slope,
                      round(regr_intercept({y}, {x}), 6) AS intercept FROM {src}"""


@query("a25_trends", " UNION ALL ".join([_trend("beta", "se"), _trend("maf", "beta"), _trend("maf", "se", "gwas")]))
def a25(t):
    a = S.trend(t.assoc(), "beta", "se").unionByName(S.trend(t.assoc(), "maf", "beta")).unionByName(S.trend(t.gwas(), "maf", "se"))
    return rnd(a, "r", "slope", "intercept")


_PAIRS = [("beta", "se"), ("beta", "maf"), ("beta", "log10p"), ("se", "maf"), ("se", "log10p"), ("maf", "log10p")]


@query("a26_statistic_correlations", """
    WITH top AS (SELECT beta, se, maf, -log10(p_value) AS log10p FROM assoc ORDER BY p_value, gene_id, variant_id LIMIT 100) """
    + " UNION ALL ".join(f"SELECT '{a}~{b}' AS pair, round(corr({a}, {b}), 6) AS r FROM top" for a, b in _PAIRS))
def a26(t):
    return rnd(S.statistic_correlations(t.assoc(), 100, "gene_id", "variant_id"), "r")


@query("a27_histograms", " UNION ALL ".join(f"""
    SELECT '{m}' AS metric, CAST(least(floor((v - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin,
           round(lo + least(floor((v - lo) / ((hi - lo) / 50)), 49) * ((hi - lo) / 50), 6) AS left_edge, count(*) AS n
    FROM (SELECT {e} AS v FROM assoc), (SELECT min({e}) AS lo, max({e}) AS hi FROM assoc) GROUP BY 1, 2, 3"""
    for m, e in (("p_value", "p_value"), ("log10p", "-log10(p_value)"), ("quality", "CAST(variant_id % 83 AS DOUBLE)"))))
def a27(t):
    a = t.assoc().select("p_value", (-F.log10("p_value")).alias("log10p"), (F.col("variant_id") % 83).cast("double").alias("quality"))
    return rnd(S.histogram(a, ["p_value", "log10p", "quality"]), "left_edge")


def _ten(src, label):
    return f"""SELECT '{label}' AS label, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd, round(min(value), 6) AS min,
        round(max(value), 6) AS max, round(avg(pow(value - m, 3)) / pow(avg(pow(value - m, 2)), 1.5), 6) AS skewness,
        round(avg(pow(value - m, 4)) / pow(avg(pow(value - m, 2)), 2) - 3, 6) AS kurtosis, round(median(value), 6) AS median,
        round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3,
        round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr
        FROM {src}, (SELECT avg(value) AS m FROM {src})"""


_STATS = ["mean", "sd", "min", "max", "skewness", "kurtosis", "median", "q1", "q3", "iqr"]
LOG = "(SELECT feature_id, sample_id, log2(value + 1) AS value FROM pheno_na)"


def logged(df):
    return df.withColumn("value", F.log2(F.col("value") + 1))


@query("a28_ten_statistics", _ten("pheno_na", "Raw") + " UNION ALL " + _ten(LOG, "Normalized"))
def a28(t):
    raw = t.pheno_na()
    return rnd(S.ten_statistics(raw, "Raw").unionByName(S.ten_statistics(logged(raw), "Normalized")), *_STATS)


_MOM = """SELECT p.feature_id, count(value) AS n, avg(pow(value - m, 2)) AS m2, avg(pow(value - m, 3)) AS m3, avg(pow(value - m, 4)) AS m4
          FROM pheno_na p JOIN (SELECT feature_id, avg(value) AS m FROM pheno_na GROUP BY feature_id) c ON c.feature_id = p.feature_id
          GROUP BY p.feature_id HAVING count(value) > 10"""


@query("a29_feature_shape", f"""
    SELECT feature_id, n, CASE WHEN m2 > 0 THEN round(m3 / pow(m2, 1.5), 6) END AS skewness,
           CASE WHEN m2 > 0 THEN round(m4 / (m2 * m2) - 3, 6) END AS kurtosis FROM ({_MOM})""")
def a29(t):
    return rnd(S.shape(t.pheno_na()), "skewness", "kurtosis")


@query("a30_normality", f"""
    WITH s AS (SELECT feature_id, n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2, CAST(n AS DOUBLE) AS d FROM ({_MOM}) WHERE m2 > 0),
    a AS (SELECT *, g1 * sqrt((d + 1) * (d + 3) / (6 * (d - 2))) AS y,
                 sqrt(2 * (3 * (d*d + 27*d - 70) * (d + 1) * (d + 3) / ((d - 2) * (d + 5) * (d + 7) * (d + 9)) - 1)) - 1 AS w2,
                 (g2 + 3 - 3 * (d - 1) / (d + 1)) / sqrt(24 * d * (d - 2) * (d - 3) / (pow(d + 1, 2) * (d + 3) * (d + 5))) AS x,
                 6 * (d*d - 5*d + 2) / ((d + 7) * (d + 9)) * sqrt(6 * (d + 3) * (d + 5) / (d * (d - 2) * (d - 3))) AS rb FROM s),
    b AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS zs, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) AS aa FROM a),
    c AS (SELECT *, 1 + x * sqrt(2 / (aa - 4)) AS den FROM b),
    e AS (SELECT *, (1 - 2 / (9 * aa) - sign(den) * cbrt((1 - 2 / aa) / abs(den))) / sqrt(2 / (9 * aa)) AS zk FROM c)
    SELECT feature_id, n, round(zs * zs + zk * zk, 6) AS k2, round((zs * zs + zk * zk) / (2 * ln(10)), 6) AS log10p FROM e""")
def a30(t):
    return rnd(S.normality(t.pheno_na()), "k2", "log10p")


@query("a31_sample_outliers", f"""
    WITH q AS ({_FENCE.format(src='pheno_na')})
    SELECT p.sample_id, count(*) FILTER ((value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AND n >= 10 AND q3 <> q1) AS n_outliers,
           count(value) AS n_values FROM pheno_na p JOIN q ON q.sample_id = p.sample_id GROUP BY p.sample_id""")
def a31(t):
    return fence_outliers(t.pheno_na(), 1.5, min_n=10)


_PM = """SELECT r.{k}, round(r.m, 6) AS raw_mean, round(r.v, 4) AS raw_variance, round(r.x, 6) AS raw_missing_pct,
                round(n.m, 6) AS norm_mean, round(n.v, 4) AS norm_variance, round(n.x, 6) AS norm_missing_pct
         FROM (SELECT {k}, avg(value) AS m, var_samp(value) AS v, 100.0 * count(*) FILTER (value IS NULL) / count(*) AS x FROM pheno_na GROUP BY {k}) r
         JOIN (SELECT {k}, avg(value) AS m, var_samp(value) AS v, 100.0 * count(*) FILTER (value IS NULL) / count(*) AS x FROM {log} GROUP BY {k}) n ON n.{k} = r.{k}"""


def _pm(t, k):
    out = S.paired_margins(t.pheno_na(), logged(t.pheno_na()), k)
    out = rnd(out, "raw_mean", "raw_missing_pct", "norm_mean", "norm_missing_pct")
    return rnd(out, "raw_variance", "norm_variance", digits=4)


@query("a32_sample_margins", _PM.format(k="sample_id", log=LOG))
def a32(t):
    return _pm(t, "sample_id")


@query("a32_feature_margins", _PM.format(k="feature_id", log=LOG))
def a32b(t):
    return _pm(t, "feature_id")


@query("a33_detection_rate", f"""
    WITH nn AS {LOG}, q AS (SELECT sample_id, quantile_cont(value, 0.01) AS c FROM nn GROUP BY sample_id)
    SELECT a.feature_id, round(a.r, 6) AS raw_pct, round(b.r, 6) AS norm_pct
    FROM (SELECT feature_id, 100.0 * count(*) FILTER (value > 0) / count(*) AS r FROM pheno_na GROUP BY feature_id) a
    JOIN (SELECT feature_id, 100.0 * count(*) FILTER (value > c) / count(*) AS r FROM nn JOIN q ON q.sample_id = nn.sample_id GROUP BY feature_id) b
    ON a.feature_id = b.feature_id""")
def a33(t):
    return rnd(S.detection(t.pheno_na(), logged(t.pheno_na())), "raw_pct", "norm_pct")


@query("a34_five_numbers", """
    SELECT phenotype, count(*) AS n, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q1, round(median(v), 6) AS median,
           round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS max FROM (SELECT phenotype, -log10(p_value) AS v FROM gwas) GROUP BY phenotype""")
def a34(t):
    g = t.gwas().withColumn("log10p", -F.log10("p_value"))
    return rnd(S.five_numbers(g, "phenotype", "log10p"), "min", "q1", "median", "q3", "max")


@query("a34_effect_by_analysis", """
    SELECT phenotype, count(*) AS n, round(avg(beta), 6) AS mean, round(min(beta), 6) AS min, round(max(beta), 6) AS max,
           round(median(beta), 6) AS median FROM gwas GROUP BY phenotype""")
def a34b(t):
    return rnd(S.effect_by_analysis(t.gwas(), "phenotype"), "mean", "min", "max", "median")


@query("a35_axis_ticks", "SELECT chrom, median(pos) AS tick FROM gwas GROUP BY chrom")
def a35(t):
    return S.axis_ticks(t.gwas())


@query("a38_analysis_rollup", """
    WITH r AS (SELECT CASE gene_id % 3 WHEN 0 THEN 'eqtl' WHEN 1 THEN 'pqtl' ELSE 'sqtl' END AS qtl_type,
                      CASE WHEN gene_id % 2 = 0 THEN 'cis' ELSE 'trans' END AS mode,
                      CASE WHEN gene_id % 10 = 9 THEN 'failed' ELSE 'completed' END AS status,
                      count(*) FILTER (p_value < 5e-8) AS significant_count FROM assoc GROUP BY gene_id)
    SELECT coalesce(qtl_type, 'all') AS qtl_type, coalesce(mode, 'all') AS mode, count(*) AS analyses,
           count(*) FILTER (status = 'completed') AS succeeded, count(*) FILTER (status <> 'completed') AS failed,
           CAST(sum(CASE WHEN status = 'completed' THEN significant_count ELSE 0 END) AS BIGINT) AS significant
    FROM r GROUP BY ROLLUP (qtl_type, mode)""")
def a38(t):
    g = F.col("gene_id")
    runs = t.assoc().groupBy("gene_id").agg(F.count_if(F.col("p_value") < 5e-8).alias("significant_count")).select(
        F.when(g % 3 == 0, "eqtl").when(g % 3 == 1, "pqtl").otherwise("sqtl").alias("qtl_type"),
        F.when(g % 2 == 0, "cis").otherwise("trans").alias("mode"),
        F.when(g % 10 == 9, "failed").otherwise("completed").alias("status"),
        "significant_count",
    )
    return S.analysis_rollup(runs)


@query("a39_signal_share", """
    SELECT phenotype, round(least(10 * avg(CASE WHEN p_value < 0.05 THEN 1.0 ELSE 0.0 END), 0.8), 6) AS share,
           round(least(10 * avg(CASE WHEN p_value < 0.05 THEN 1.0 ELSE 0.0 END), 0.8) * 0.1, 6) AS error
    FROM (SELECT phenotype, pow(p_value, 0.05) AS p_value FROM gwas) GROUP BY phenotype""")
def a39(t):
    g = t.gwas().withColumn("p_value", F.pow("p_value", F.lit(0.05)))
    return rnd(S.signal_share(g, "phenotype"), "share", "error")


@query("a40_explained_variance", """
    WITH e AS (SELECT i AS component, var_samp(CAST(embedding[i] AS DOUBLE)) AS eigenvalue FROM embeddings, range(1, 65) r(i) GROUP BY i)
    SELECT CAST(component AS INTEGER) AS component, round(eigenvalue, 8) AS eigenvalue,
           round(100 * eigenvalue / (SELECT sum(eigenvalue) FROM e), 6) AS explained_pct FROM e""")
def a40(t):
    e = t.embeddings.select(F.posexplode("embedding").alias("i", "v")).groupBy((F.col("i") + 1).alias("component")).agg(
        F.var_samp(F.col("v").cast("double")).alias("eigenvalue")
    )
    return S.explained_variance(e).withColumns({"eigenvalue": F.round("eigenvalue", 8), "explained_pct": F.round("explained_pct", 6)})


@query("a43_chromosomes", "SELECT DISTINCT chrom FROM variants")
def a43(t):
    return S.chromosomes(t.variants())


@query("a45_inflation_class", f"""
    SELECT phenotype, CASE WHEN l < 0.95 THEN 'deflated' WHEN l > 1.05 THEN 'inflated' ELSE 'well_controlled' END AS inflation
    FROM (SELECT phenotype, median({_CHI2}) / 0.4549364 AS l FROM gwas GROUP BY phenotype)""")
def a45(t):
    lam = S.lambda_gc(t.gwas(), ["phenotype"])
    return lam.select("phenotype", S.inflation_class(F.col("lambda_gc")).alias("inflation"))
