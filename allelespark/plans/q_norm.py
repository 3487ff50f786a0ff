"""Registered queries: normalisation and covariates (M)."""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.operators import covariates as V
from allelespark.operators import normalize as N
from allelespark.operators import prepare as PR
from allelespark.operators.ranking import top_variance
from allelespark.plans.q_joins import shifted
from allelespark.plans.q_qc import rnd
from allelespark.plans.q_summary import LOG, _ten, logged
from allelespark.plans.registry import query
from allelespark.session import materialize


@query("m1_log2", "SELECT feature_id, sample_id, round(log2(value + 1), 6) AS value FROM pheno_na")
def m1(t):
    return rnd(N.log2(t.pheno_na()), "value")


@query("m1_log2_zero_missing", """
    SELECT feature_id, sample_id, round(log2(nullif(value, 0) + 1), 6) AS value FROM counts
    WHERE feature_id IN (SELECT feature_id FROM counts GROUP BY feature_id HAVING count(nullif(value, 0)) > 0)""")
def m1b(t):
    return rnd(N.log2(t.counts(), zero_is_missing=True), "value")


@query("m2_arcsinh", "SELECT feature_id, sample_id, round(asinh(value / 5), 6) AS value FROM pheno_na")
def m2(t):
    return rnd(N.arcsinh(t.pheno_na(), 5), "value")


_FILL = """fl AS (SELECT feature_id, sample_id, coalesce(value, avg(value) OVER (PARTITION BY sample_id)) AS value FROM pheno_na)"""


@query("m3_zscore", f"""
    WITH {_FILL}
    SELECT feature_id, sample_id, round(CASE WHEN s = 0 THEN 0 ELSE (value - m) / s END, 6) AS value
    FROM (SELECT *, avg(value) OVER (PARTITION BY feature_id) AS m, stddev_samp(value) OVER (PARTITION BY feature_id) AS s FROM fl)""")
def m3(t):
    return rnd(N.zscore(t.pheno_na()), "value")


@query("m4_quantile_uniform", f"""
    WITH {_FILL}, r AS (SELECT *, rank() OVER (PARTITION BY feature_id ORDER BY value) - 1 AS lo,
        count(*) OVER (PARTITION BY feature_id) - rank() OVER (PARTITION BY feature_id ORDER BY value DESC) AS hi, count(*) OVER (PARTITION BY feature_id) - 1 AS d,
        min(value) OVER (PARTITION BY feature_id) AS a, max(value) OVER (PARTITION BY feature_id) AS z FROM fl)
    SELECT feature_id, sample_id, round(CASE WHEN value = a THEN 0 WHEN value = z THEN 1 ELSE (lo + hi) / 2.0 / d END, 6) AS value FROM r""")
def m4(t):
    return rnd(N.quantile_uniform(t.pheno_na()), "value")


@query("m5_counts_per_million", """
    SELECT feature_id, sample_id, round(value / sum(value) OVER (PARTITION BY sample_id) * 1e6, 4) AS value FROM counts""")
def m5(t):
    return rnd(N.counts_per_million(t.counts()), "value", digits=4)


_SF = """ge AS (SELECT feature_id, exp(avg(ln(value + 1))) AS g FROM counts GROUP BY feature_id HAVING max(value) > 0),
    md AS (SELECT sample_id, CASE WHEN median(value / g) = 0 THEN 1 ELSE median(value / g) END AS m FROM counts JOIN ge ON ge.feature_id = counts.feature_id GROUP BY sample_id),
    sf AS (SELECT sample_id, m / (SELECT avg(m) FROM md) AS size_factor FROM md)"""
_DI = f"""{_SF}, nm AS (SELECT c.feature_id, avg(value / size_factor) AS mean, var_samp(value / size_factor) AS variance FROM counts c JOIN sf ON sf.sample_id = c.sample_id GROUP BY c.feature_id),
    rd AS (SELECT feature_id, mean, variance, CASE WHEN mean = 0 THEN (SELECT min(mean) FROM nm WHERE mean > 0) ELSE mean END AS mm FROM nm),
    xy AS (SELECT *, variance / (mm * mm) AS raw, mm > 0 AND variance > 0 AS ok, ln(mm + 1) AS x, ln(variance / (mm * mm) + 1e-8) AS y FROM rd),
    ce AS (SELECT avg(x) AS x0 FROM xy WHERE ok),
    su AS (SELECT count(*) AS n, sum(pow(x-x0,2)) AS s2, sum(pow(x-x0,3)) AS s3, sum(pow(x-x0,4)) AS s4, sum(y) AS t0, sum((x-x0)*y) AS t1, sum(pow(x-x0,2)*y) AS t2 FROM xy, ce WHERE ok),
    k2 AS (SELECT *, (t2 - s2*t0/n - s3*t1/s2) / (s4 - s2*s2/n - s3*s3/s2) AS c2 FROM su),
    co AS (SELECT (t0 - s2*c2)/n AS c0, (t1 - s3*c2)/s2 AS c1, c2 FROM k2),
    fi AS (SELECT xy.*, CASE WHEN ok THEN exp(c0 + c1*(x-x0) + c2*pow(x-x0,2)) END AS fitted FROM xy, ce, co),
    di AS (SELECT feature_id, mean, variance, raw, greatest(coalesce(fitted, (SELECT median(fitted) FROM fi)), 1e-8) AS dispersion FROM fi)"""


@query("m6_size_factors", f"WITH {_SF} SELECT sample_id, round(size_factor, 6) AS size_factor FROM sf")
def m6(t):
    return rnd(N.size_factors(t.counts()), "size_factor")


@query("m7_dispersions", f"WITH {_DI} SELECT feature_id, round(mean, 4) AS mean, round(variance, 2) AS variance, round(raw, 6) AS raw, round(dispersion, 6) AS dispersion FROM di")
def m7(t):
    out = N.dispersions(t.counts(), N.size_factors(t.counts()))
    return out.select("feature_id", F.round("mean", 4).alias("mean"), F.round("variance", 2).alias("variance"),
                      F.round("raw", 6).alias("raw"), F.round("dispersion", 6).alias("dispersion"))


@query("m8_dispersion_trend", f"WITH {_DI} SELECT round(x0, 6) AS x0, round(c0, 6) AS c0, round(c1, 6) AS c1, round(c2, 6) AS c2 FROM ce, co")
def m8(t):
    mom = N.feature_moments(t.counts(), N.size_factors(t.counts())).where("mean > 0 AND variance > 0")
    raw = F.col("variance") / (F.col("mean") * F.col("mean"))
    xy = mom.select(F.log(F.col("mean") + 1).alias("x"), F.log(raw + 1e-8).alias("y"))
    return rnd(N.quadratic_fit(xy, "x", "y"), "x0", "c0", "c1", "c2")


_VST = """SELECT c.feature_id, sample_id, round(CASE WHEN dispersion > 0 AND mean > 0 THEN asinh(sqrt(dispersion) * (value - mean) / sqrt(mean)) / sqrt(dispersion)
          ELSE asinh(sqrt(value + 0.5)) END, 6) AS value FROM counts c JOIN di ON di.feature_id = c.feature_id"""


@query("m9_vst", f"WITH {_DI} {_VST}")
def m9(t):
    return rnd(N.vst(t.counts()), "value")


@query("m9_vst_local")
def m9b(t):
    return rnd(N.vst(t.counts(), "local"), "value")


@query("m10_vst_simple", """
    WITH tt AS (SELECT sample_id, sum(value) AS s FROM counts GROUP BY sample_id)
    SELECT feature_id, c.sample_id, round(asinh(value * (SELECT median(s) FROM tt) / s), 6) AS value FROM counts c JOIN tt ON tt.sample_id = c.sample_id""")
def m10(t):
    return rnd(N.vst_simple(t.counts()), "value")


def _signed(t):
    c = t.counts()
    return c.withColumn("value", F.when(F.col("sample_id") % 2 == 0, -F.col("value")).otherwise(F.col("value")))


@query("m11_vst_clean", f"WITH {_DI} {_VST}")
def m11(t):
    return rnd(N.vst_clean(_signed(t)), "value")


@query("m12_dispatch", """
    SELECT 'log2' AS method, feature_id, sample_id, round(log2(value + 1), 4) AS value FROM counts
    UNION ALL SELECT 'arcsinh', feature_id, sample_id, round(asinh(value), 4) FROM counts
    UNION ALL SELECT 'tpm', feature_id, sample_id, round(value / sum(value) OVER (PARTITION BY sample_id) * 1e6, 4) FROM counts
    UNION ALL SELECT 'raw', feature_id, sample_id, round(value, 4) FROM counts""")
def m12(t):
    out, counts = None, materialize(t.counts())
    for m in ("log2", "arcsinh", "tpm", "raw"):
        part = N.normalize(counts, m).select(F.lit(m).alias("method"), "feature_id", "sample_id", F.round("value", 4).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query("m12_dispatch_all", f"""
    WITH {_DI}, vs AS ({_VST.replace("END, 6)", "END, 4)")}),
    r AS (SELECT *, rank() OVER (PARTITION BY feature_id ORDER BY value) - 1 AS lo, count(*) OVER w - rank() OVER (PARTITION BY feature_id ORDER BY value DESC) AS hi,
          count(*) OVER w - 1 AS d, min(value) OVER w AS a, max(value) OVER w AS z, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM counts WINDOW w AS (PARTITION BY feature_id))
    SELECT 'log2' AS method, feature_id, sample_id, round(log2(value + 1), 4) AS value FROM counts
    UNION ALL SELECT 'vst', feature_id, sample_id, value FROM vs
    UNION ALL SELECT 'quantile', feature_id, sample_id, round(CASE WHEN value = a THEN 0 WHEN value = z THEN 1 ELSE (lo + hi) / 2.0 / d END, 4) FROM r
    UNION ALL SELECT 'zscore', feature_id, sample_id, round(CASE WHEN coalesce(s, 0) = 0 THEN 0 ELSE (value - m) / s END, 4) FROM r
    UNION ALL SELECT 'arcsinh', feature_id, sample_id, round(asinh(value), 4) FROM counts
    UNION ALL SELECT 'tpm', feature_id, sample_id, round(value / sum(value) OVER (PARTITION BY sample_id) * 1e6, 4) FROM counts
    UNION ALL SELECT 'other', feature_id, sample_id, round(value, 4) FROM counts""")
def m12all(t):
    """Every method by its name, and a name that none has."""
    out, counts = None, materialize(t.counts())  # every method reads them, some several times
    for m in (*N.METHODS, "other"):
        part = N.normalize(counts, m).select(F.lit(m).alias("method"), "feature_id", "sample_id", F.round("value", 4).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def batch_dummies(t):
    return V.one_hot(t.covlong().where("covariate = 'batch'"))


_FACTOR = """SELECT feature_id, sample_id, round(value - (lm - max(CASE WHEN batch = b0 THEN lm END) OVER (PARTITION BY feature_id)), 6) AS value
    FROM (SELECT p.*, batch, avg(value) OVER (PARTITION BY feature_id, batch) AS lm, (SELECT min(batch) FROM covar) AS b0
          FROM pheno p JOIN covar c ON c.sample_id = p.sample_id)"""


@query("m13_remove_batch", _FACTOR)
def m13(t):
    return rnd(V.remove_effects(t.pheno(), batch_dummies(t)), "value")


@query("m13_remove_linear", """
    WITH s AS (SELECT feature_id, regr_slope(value, rin) AS b FROM pheno p JOIN covar c ON c.sample_id = p.sample_id GROUP BY feature_id)
    SELECT p.feature_id, p.sample_id, round(value - b * rin, 6) AS value FROM pheno p JOIN covar c ON c.sample_id = p.sample_id JOIN s ON s.feature_id = p.feature_id""")
def m13b(t):
    cov = t.covar().select(F.lit("rin").alias("covariate"), "sample_id", F.col("rin").alias("value"))
    return rnd(V.remove_effects(t.pheno(), cov), "value")


@query("m13_remove_mixed")
def m13c(t):
    lin = V.impute_mean(t.covlong().where("covariate IN ('age', 'rin')"))
    both = lin.unionByName(batch_dummies(t).withColumn("value", F.col("value").cast("double")))
    return rnd(V.remove_effects(t.pheno(), both), "value")


@query("m13_remove_gaps", """
    WITH c AS (SELECT sample_id, coalesce(CAST(value AS DOUBLE), avg(CAST(value AS DOUBLE)) OVER ()) AS r FROM covlong WHERE covariate = 'rin'),
    s AS (SELECT feature_id, regr_slope(value, r) AS b FROM pheno_na p JOIN c ON c.sample_id = p.sample_id GROUP BY feature_id)
    SELECT p.feature_id, p.sample_id, round(value - b * r, 6) AS value FROM pheno_na p JOIN c ON c.sample_id = p.sample_id JOIN s ON s.feature_id = p.feature_id""")
def m13g(t):
    """Cells and a covariate with gaps: the covariate takes its mean, each feature is fitted on the cells it has."""
    cov = t.covlong().where("covariate = 'rin'").withColumn("value", F.col("value").cast("double"))
    return rnd(V.remove_effects(t.pheno_na(), cov), "value")


@query("m14_one_hot", """
    SELECT 'batch_b' || CAST(l AS VARCHAR) AS covariate, sample_id, CASE WHEN batch = l THEN 1 ELSE 0 END AS value
    FROM covar, (SELECT DISTINCT batch AS l FROM covar) WHERE l > (SELECT min(batch) FROM covar)
    UNION ALL SELECT 'sex_1', sample_id, CASE WHEN sex = 1 THEN 1 ELSE 0 END FROM covar""")
def m14(t):
    return V.one_hot(t.covlong())


@query("m15_impute_mean", """
    SELECT covariate, sample_id, round(coalesce(TRY_CAST(value AS DOUBLE), avg(TRY_CAST(value AS DOUBLE)) OVER (PARTITION BY covariate)), 6) AS value
    FROM covlong WHERE covariate <> 'batch'""")
def m15(t):
    return rnd(V.impute_mean(t.covlong()), "value")


@query("m16_standardise", """
    WITH n AS (SELECT covariate, sample_id, coalesce(TRY_CAST(value AS DOUBLE), avg(TRY_CAST(value AS DOUBLE)) OVER (PARTITION BY covariate)) AS v
               FROM covlong WHERE covariate <> 'batch'),
    s AS (SELECT covariate, avg(v) AS m, stddev_pop(v) AS sd, count(DISTINCT v) AS d FROM n GROUP BY covariate)
    SELECT n.covariate, sample_id, round(CASE WHEN d > 2 THEN (v - m) / sd ELSE v END, 6) AS value FROM n JOIN s ON s.covariate = n.covariate""")
def m16(t):
    return rnd(V.standardise(V.impute_mean(t.covlong())), "value")


@query("m17_phenotype_pcs")
def m17(t):
    return V.phenotype_pcs(t.pheno_na(), 5)


def _top_pcs(cells: str) -> str:
    """The first two components of ``cells`` (feature, sample_id, z): the matrix of sample products is squared 24 times, then deflated."""
    dot = "list_dot_product"
    square = f"list_transform(m, lambda a: list_transform(m, lambda b: {dot}(a, b)))"

    def lead(tag: str, source: str) -> str:
        return f"""{tag}p(n, m) AS (SELECT 0, m FROM {source} UNION ALL SELECT n + 1, list_transform(q, lambda a: list_transform(a, lambda x: x / t))
              FROM (SELECT n, q, sqrt(list_sum(list_transform(q, lambda c: {dot}(c, c)))) AS t FROM (SELECT n, {square} AS q FROM {tag}p WHERE n < 24))),
            {tag}r AS (SELECT c FROM (SELECT unnest(m) AS c FROM {tag}p WHERE n = 24) ORDER BY {dot}(c, c) DESC LIMIT 1),
            {tag}u AS (SELECT list_transform(c, lambda x: x / sqrt({dot}(c, c))) AS v FROM {tag}r),
            {tag}v AS (SELECT v, {dot}(v, list_transform(m, lambda a: {dot}(a, v))) AS l FROM {tag}u, {source})"""

    return f"""WITH RECURSIVE z AS ({cells}),
        g AS (SELECT a.sample_id AS i, b.sample_id AS j, sum(a.z * b.z) AS s FROM z a JOIN z b ON a.feature = b.feature GROUP BY 1, 2),
        ids AS (SELECT list(i ORDER BY i) AS ids FROM (SELECT DISTINCT i FROM g)), tr AS (SELECT sum(s) AS tr FROM g WHERE i = j),
        m0 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(s ORDER BY j) AS r FROM
               (SELECT x.i, y.i AS j, coalesce(s, 0) AS s FROM (SELECT DISTINCT i FROM g) x CROSS JOIN (SELECT DISTINCT i FROM g) y
                LEFT JOIN g ON g.i = x.i AND g.j = y.i) GROUP BY i)),
        {lead("a", "m0")},
        m1 AS (SELECT list_transform(m, lambda a, i: list_transform(a, lambda x, j: x - l * v[i] * v[j])) AS m FROM m0, av),
        {lead("b", "m1")},
        duo AS (SELECT 1 AS component, v, l FROM av UNION ALL SELECT 2, v, l FROM bv),
        flat AS (SELECT component, l, unnest(ids) AS sample_id, unnest(v) AS x FROM duo, ids),
        sg AS (SELECT *, CASE WHEN max(x) OVER w > -min(x) OVER w THEN 1 ELSE -1 END AS sign FROM flat WINDOW w AS (PARTITION BY component))
        SELECT component, sample_id, round(x * sign * sqrt(l), 5) AS score, round(l / tr, 6) AS explained FROM sg, tr"""


def _top_two(pcs):
    return rnd(rnd(pcs.where("component <= 2"), "score", digits=5), "explained")


@query("m17_phenotype_pcs_top", _top_pcs("""
    SELECT feature_id AS feature, sample_id, (value - avg(value) OVER w) / stddev_pop(value) OVER w AS z FROM pheno WINDOW w AS (PARTITION BY feature_id)"""))
def m17t(t):
    return _top_two(V.phenotype_pcs(t.pheno(), 10))


@query("m18_genotype_pcs_top", _top_pcs("""
    SELECT variant_id AS feature, sample_id, (dosage - m) / sqrt(m * (1 - m / 2)) AS z
    FROM (SELECT *, avg(dosage) OVER (PARTITION BY variant_id) AS m FROM geno WHERE dosage IS NOT NULL) WHERE m > 0 AND m < 2"""))
def m18t(t):
    return _top_two(V.genotype_pcs(t.geno(), 10))


@query("m18_genotype_pcs")
def m18(t):
    return V.genotype_pcs(t.geno(), 10)


@query("m19_compare_pcs")
def m19(t):
    return V.compare_pcs(t.pheno(), logged(t.pheno()))


_CORR = """SELECT CAST(a.sample_id AS BIGINT) AS sample_a, CAST(b.sample_id AS BIGINT) AS sample_b, corr(a.value, b.value) AS r
           FROM {src} a JOIN {src} b ON a.feature_id = b.feature_id AND a.sample_id <= b.sample_id GROUP BY 1, 2"""
PLOG = "(SELECT feature_id, sample_id, log2(value + 1) AS value FROM pheno)"


@query("m20_sample_correlation", f"""
    SELECT x.sample_a, x.sample_b, round(x.r, 6) AS raw_r, round(y.r, 6) AS norm_r, round(y.r - x.r, 6) AS difference
    FROM ({_CORR.format(src='pheno')}) x JOIN ({_CORR.format(src=PLOG)}) y ON x.sample_a = y.sample_a AND x.sample_b = y.sample_b""")
def m20(t):
    return rnd(V.correlation_difference(t.pheno(), logged(t.pheno())), "raw_r", "norm_r", "difference").withColumn(
        "difference", F.col("difference") + F.lit(0.0))


@query("m20_feature_correlation", """
    WITH k AS (SELECT feature_id FROM pheno GROUP BY feature_id ORDER BY var_samp(value) DESC, feature_id LIMIT 50),
    p AS (SELECT * FROM pheno WHERE feature_id IN (SELECT feature_id FROM k))
    SELECT a.feature_id AS feature_a, b.feature_id AS feature_b, round(corr(a.value, b.value), 6) AS r
    FROM p a JOIN p b ON a.sample_id = b.sample_id AND a.feature_id <= b.feature_id GROUP BY 1, 2""")
def m20b(t):
    return rnd(V.feature_correlation(top_variance(t.pheno(), 50)), "r")


@query("m21_prepare_phenotypes", """
    WITH al AS (SELECT feature_id, sample_id + 3 AS sample_id, value FROM pheno_na WHERE sample_id + 3 IN (SELECT sample_id FROM geno)
                AND sample_id + 3 IN (SELECT sample_id FROM covar)),
    va AS (SELECT * FROM al WHERE feature_id IN (SELECT feature_id FROM al GROUP BY feature_id
             HAVING min(value) < max(value) AND count(DISTINCT value) * 1.0 / count(*) > 1 - 0.95
                AND count(*) FILTER (value IS NULL) * 1.0 / count(*) <= 0.2 AND 100.0 * count(*) FILTER (value < 0.1) / count(*) <= 10)),
    lg AS (SELECT feature_id, v.sample_id, log2(value + 1) AS value, batch,
                  count(*) FILTER (value IS NULL) OVER (PARTITION BY feature_id) AS gaps FROM va v JOIN covar c ON c.sample_id = v.sample_id),
    lm AS (SELECT *, avg(value) OVER (PARTITION BY feature_id, batch) AS lm, (SELECT min(batch) FROM lg) AS b0 FROM lg)
    SELECT feature_id, CAST(sample_id AS VARCHAR) AS sample_id, round(CASE WHEN gaps > 0 THEN value
           ELSE value - (lm - max(CASE WHEN batch = b0 THEN lm END) OVER (PARTITION BY feature_id)) END, 6) AS value FROM lm""")
def m21(t):
    return rnd(PR.prepare_phenotypes(shifted(t.pheno_na(), 3), t.geno(), "log2", batch_dummies(t)), "value")


@query("m21_prepare_phenotypes_gaps", """
    WITH al AS (SELECT feature_id, sample_id + 3 AS sample_id, value FROM pheno_na WHERE sample_id + 3 IN (SELECT sample_id FROM geno)
                AND sample_id + 3 IN (SELECT sample_id FROM covar)),
    va AS (SELECT * FROM al WHERE feature_id IN (SELECT feature_id FROM al GROUP BY feature_id
             HAVING min(value) < max(value) AND count(DISTINCT value) * 1.0 / count(*) > 1 - 0.95
                AND count(*) FILTER (value IS NULL) * 1.0 / count(*) <= 0.2 AND 100.0 * count(*) FILTER (value < 0.1) / count(*) <= 10)),
    lg AS (SELECT feature_id, v.sample_id, log2(value + 1) AS value, batch,
                  count(*) FILTER (value IS NULL) OVER (PARTITION BY feature_id) AS gaps FROM va v JOIN covar c ON c.sample_id = v.sample_id),
    lm AS (SELECT *, avg(value) OVER (PARTITION BY feature_id, batch) AS lm, (SELECT min(batch) FROM lg) AS b0 FROM lg)
    SELECT feature_id, CAST(sample_id AS VARCHAR) AS sample_id, round(value - (lm - max(CASE WHEN batch = b0 THEN lm END) OVER (PARTITION BY feature_id)), 6) AS value FROM lm""")
def m21gaps(t):
    return rnd(PR.prepare_phenotypes(shifted(t.pheno_na(), 3), t.geno(), "log2", batch_dummies(t), gaps="fit"), "value")


@query("m21_enhanced_covariates")
def m21b(t):
    return PR.enhanced_covariates(t.pheno(), t.covlong(), 5)


def _bundle_sql(side: str, src: str) -> str:
    ten = " UNION ALL ".join(f"SELECT 'distribution' AS section, 'all' AS item, '{m}' AS metric, {m} AS v FROM tt"
                             for m in ("mean", "median", "sd", "min", "max", "skewness", "kurtosis", "q1", "q3", "iqr"))
    mar = " UNION ALL ".join(f"""SELECT '{s}', CAST({k} AS VARCHAR), '{m}', round({e}, {d}) FROM {src} GROUP BY {k}"""
        for s, k in (("sample", "sample_id"), ("feature", "feature_id"))
        for m, e, d in (("mean", "avg(value)", 6), ("variance", "var_samp(value)", 4), ("missing_pct", "100.0 * count(*) FILTER (value IS NULL) / count(*)", 6)))
    return f"(WITH tt AS ({_ten(src, 'x')}) {ten} UNION ALL {mar})"


@query("m22_comparison_bundle", f"""
    SELECT a.section, a.item, a.metric, a.v AS raw, b.v AS normalized FROM {_bundle_sql('raw', 'pheno_na')} a
    JOIN {_bundle_sql('norm', LOG)} b ON a.section = b.section AND a.item = b.item AND a.metric = b.metric""")
def m22(t):
    out = PR.comparison_bundle(t.pheno_na(), logged(t.pheno_na())).where("section IN ('distribution', 'sample', 'feature')")
    digits = lambda c: F.when(F.col("metric") == "variance", F.round(c, 4)).otherwise(F.round(c, 6))
    return out.withColumns({"raw": digits("raw"), "normalized": digits("normalized")})


@query("m22_comparison_full")
def m22b(t):
    return PR.comparison_bundle(t.pheno_na(), logged(t.pheno_na()))
