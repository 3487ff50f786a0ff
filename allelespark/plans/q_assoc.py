"""Registered queries: association, interaction (Q1-Q9, J5, A37)."""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.functions.stats import r_threshold
from allelespark.operators import assoc as AS
from allelespark.operators import display as D
from allelespark.operators import filters as X
from allelespark.operators import interaction as I
from allelespark.operators import normalize as N
from allelespark.operators import summary as S
from allelespark.operators.multitest import bh_fdr
from allelespark.plans.fixtures import COHORT
from allelespark.plans.q_filters import _CT, EXACT_HWE, _out_sql, customer_traits
from allelespark.plans.q_qc import rnd
from allelespark.plans.registry import query
from allelespark.plans.sqltext import t_p_sql
from allelespark.session import materialize


def covariates(t):
    """rin and sex as numeric long covariates."""
    wide = t.covar().select("sample_id", "rin", F.col("sex").cast("double").alias("sex"))
    return wide.unpivot("sample_id", ["rin", "sex"], "covariate", "value")


def prepared(t, pheno, cov=None):
    return AS.Prepared(t.geno(), pheno, cov, samples=t.genotyped())


# sample vectors orthogonalised one after the other, then both sides residualised on the full grid
_SV = """cv AS (SELECT sample_id, rin - avg(rin) OVER () AS a, sex - avg(sex) OVER () AS s0 FROM covar),
    sv AS (SELECT sample_id, a, s0 - a * (SELECT sum(a * s0) / sum(a * a) FROM cv) AS s FROM cv)"""


def _resid(name: str, src: str, key: str, val: str, cov: bool) -> str:
    w = f"OVER (PARTITION BY {key})"
    part = f" - a * (sum({val} * a) {w}) / (sum(a * a) {w}) - s * (sum({val} * s) {w}) / (sum(s * s) {w})" if cov else ""
    return f"{name} AS (SELECT {key}, x.sample_id, {val} - avg({val}) {w}{part} AS {name}v FROM {src} x JOIN sv ON sv.sample_id = x.sample_id)"


_GRID = """gi AS (SELECT m.variant_id, c.sample_id, coalesce(g.dosage, m.m) AS d
           FROM (SELECT variant_id, avg(dosage) AS m FROM geno GROUP BY variant_id HAVING count(dosage) > 0) m
           CROSS JOIN sv c LEFT JOIN geno g ON g.variant_id = m.variant_id AND g.sample_id = c.sample_id)"""


def _models(cov: bool, y: str = "pheno", key: str = "feature_id") -> str:
    return f"{_SV}, {_GRID}, {_resid('y', y, key, 'value', cov)}, {_resid('g', 'gi', 'variant_id', 'd', cov)}"


_CIS = """pr AS (SELECT v.variant_id, g.gene_id, v.pos FROM variants v JOIN genes g ON v.chrom = g.chrom
          AND v.pos BETWEEN g.gstart - 1000000 AND g.gend + 1000000)"""


def _fit(dof: int) -> str:
    return f"""beta AS beta, sqrt(greatest(syy - beta * sxy, 0) / {dof} / sxx) AS se FROM"""


def _scan_sql(cov: bool, pairs: str, keep: str = "sxx > 1e-9") -> str:
    dof = COHORT - 2 - (2 if cov else 0)
    return f"""ss AS (SELECT p.gene_id, p.variant_id, sum(gv * yv) AS sxy, sum(gv * gv) AS sxx, sum(yv * yv) AS syy
                     FROM {pairs} p JOIN g ON g.variant_id = p.variant_id JOIN y ON y.feature_id = p.gene_id AND y.sample_id = g.sample_id
                     GROUP BY p.gene_id, p.variant_id),
        st AS (SELECT *, sxy / sxx AS beta, sqrt(greatest(syy - sxy * sxy / sxx, 0) / {dof} / sxx) AS se FROM ss WHERE {keep})"""


_NOMINAL = "SELECT gene_id, variant_id, round(beta, 6) AS beta, round(se, 6) AS se, round(beta / se, 6) AS t FROM st"


@query("q1_cis_nominal", f"WITH {_models(False)}, {_CIS}, {_scan_sql(False, 'pr')} {_NOMINAL}")
def q1(t):
    prep = prepared(t, t.pheno())
    out = AS.cis_nominal(prep, t.variants(), t.genes()).select("gene_id", "variant_id", "beta", "se", "t")
    return rnd(out, "beta", "se", "t")


@query("q1_cis_nominal_covariates", f"WITH {_models(True)}, {_CIS}, {_scan_sql(True, 'pr')} {_NOMINAL}")
def q1c(t):
    prep = prepared(t, t.pheno(), covariates(t))
    out = AS.cis_nominal(prep, t.variants(), t.genes()).select("gene_id", "variant_id", "beta", "se", "t")
    return rnd(out, "beta", "se", "t")


@query("q1_cis_nominal_full")
def q1f(t):
    prep = prepared(t, t.pheno(), covariates(t))
    return bh_fdr(materialize(AS.cis_nominal(prep, t.variants(), t.genes(), maf=0.05)), ["gene_id"])


def slice_one(t):
    """Filter, log, cis scan, lead variant per gene and its FDR."""
    pheno = t.pheno_na().transform(X.expressed).transform(X.varying).transform(X.complete_enough).transform(N.log2)
    scan = materialize(AS.cis_nominal(prepared(t, pheno, covariates(t)), t.variants(), t.genes(), maf=0.05))
    lead = D.top_hit(bh_fdr(scan), "variant_id", keys=("gene_id",))
    return lead.select("gene_id", "variant_id", "chrom", "pos", "beta", "se", "t", "p_value", "maf", "n", "fdr")


@query("q1_lead_variants")
def q1_lead(t):
    return slice_one(t)


@query("q2_best_variant", f"""
    WITH {_models(True)}, {_CIS}, {_scan_sql(True, 'pr')},
    rr AS (SELECT *, sxy / sqrt(sxx * syy) AS r, count(*) OVER (PARTITION BY gene_id) AS n_variants,
                  row_number() OVER (PARTITION BY gene_id ORDER BY round(-abs(sxy / sqrt(sxx * syy)), 12), variant_id) AS k FROM st)
    SELECT gene_id, variant_id, round(r, 6) AS r, round(beta, 6) AS beta, n_variants FROM rr WHERE k = 1""")
def q2(t):
    prep = prepared(t, t.pheno(), covariates(t))
    out = AS.cis_permutation(prep, t.variants(), t.genes(), permutations=20)
    return rnd(out.select("gene_id", "variant_id", "r", "beta", "n_variants"), "r", "beta")


@query("q2_cis_permutation")
def q2p(t):
    prep = prepared(t, t.pheno(), covariates(t))
    return AS.cis_map(prep, t.variants(), t.genes(), lam=0.5)


_ALLPAIRS = "(SELECT gene_id, variant_id FROM genes, (SELECT variant_id FROM geno GROUP BY variant_id HAVING least(avg(dosage) / 2, 1 - avg(dosage) / 2) >= 0.05) v)"
_RCUT = r_threshold(1e-3, COHORT - 4) ** 2


@query("j5_trans_pairs", f"""
    WITH {_models(True)}, {_scan_sql(True, _ALLPAIRS, f'sxx > 1e-9 AND sxy * sxy >= {_RCUT!r} * sxx * syy')}
    SELECT gene_id, variant_id, round(beta, 6) AS beta, round(beta / se, 6) AS t FROM st""")
def j5(t):
    prep = prepared(t, t.pheno(), covariates(t))
    return rnd(AS.trans_pairs(prep, t.variants(), t.genes(), 1e-3).select("gene_id", "variant_id", "beta", "t"), "beta", "t")


@query("q3_trans_scan", f"""
    WITH {_models(True)}, {_scan_sql(True, _ALLPAIRS, f'sxx > 1e-9 AND sxy * sxy >= {_RCUT!r} * sxx * syy')}
    SELECT st.gene_id, st.variant_id, round(beta, 6) AS beta, round(beta / se, 6) AS t FROM st
    JOIN variants v ON v.variant_id = st.variant_id JOIN genes g ON g.gene_id = st.gene_id
    WHERE v.chrom <> g.chrom OR abs(v.pos - CASE WHEN g.strand = '+' THEN g.gstart ELSE g.gend END) > 5000000""")
def q3(t):
    prep = prepared(t, t.pheno(), covariates(t))
    out = AS.trans_scan(prep, t.variants(), t.genes(), 1e-3, lam=0.5)
    return rnd(out.select("gene_id", "variant_id", "beta", "t"), "beta", "t")


@query("q4_by_type_and_mode", f"""
    WITH {_models(True)}, {_CIS}, {_scan_sql(True, 'pr')}
    SELECT 'eqtl' AS qtl_type, 'cis' AS mode, gene_id, variant_id, round(beta, 6) AS beta FROM st
    UNION ALL SELECT 'pqtl', 'cis', gene_id, variant_id, round(beta * 2, 6) FROM st""")
def q4(t):
    scans = {}
    for kind, factor in (("eqtl", 1), ("pqtl", 2)):
        y = t.pheno().withColumn("value", F.col("value") * factor)
        scans[(kind, "cis")] = AS.cis_nominal(prepared(t, y, covariates(t)), t.variants(), t.genes())
    return rnd(AS.by_type(scans).select("qtl_type", "mode", "gene_id", "variant_id", "beta"), "beta")


def _gwas_sql(cov: bool) -> str:
    dof = COHORT - 2 - (2 if cov else 0)
    return f"""WITH {_models(cov, 'traits', 'trait')},
    ss AS (SELECT trait AS phenotype, variant_id, sum(gv * yv) AS sxy, sum(gv * gv) AS sxx, sum(yv * yv) AS syy
           FROM g JOIN y ON y.sample_id = g.sample_id GROUP BY trait, variant_id),
    st AS (SELECT *, sxy / sxx AS beta, sqrt(greatest(syy - sxy * sxy / sxx, 0) / {dof} / sxx) AS se FROM ss WHERE sxx > 1e-9)
    SELECT phenotype, variant_id, round(beta, 6) AS beta, round(se, 6) AS se, round(beta / se, 6) AS t,
           round(beta - 1.959963984540054 * se, 6) AS ci_low, round(beta + 1.959963984540054 * se, 6) AS ci_high FROM st"""


_GW = ("beta", "se", "t", "ci_low", "ci_high")


@query("q5_linear_gwas", _gwas_sql(False))
def q5(t):
    return rnd(AS.linear_gwas(t.geno(), t.traits()).select("phenotype", "variant_id", *_GW), *_GW)


@query("q5_linear_gwas_covariates", _gwas_sql(True))
def q5c(t):
    return rnd(AS.linear_gwas(t.geno(), t.traits(), covariates(t)).select("phenotype", "variant_id", *_GW), *_GW)


@query("q6_logistic_gwas")
def q6(t):
    case = t.covar().select("sample_id", F.col("sex").alias("value"))
    cov = covariates(t).where("covariate = 'rin'")
    return AS.logistic_gwas(t.geno(), case, cov, maf=0.05)


@query("q6_score_test", f"""
    WITH RECURSIVE {_GRID.replace("sv c", "covar c")},
    cc AS (SELECT sample_id, CAST(sex AS DOUBLE) AS y, rin - avg(rin) OVER () AS x FROM covar),
    it(n, a, b) AS (SELECT 0, 0::DOUBLE, 0::DOUBLE UNION ALL
        SELECT n + 1, a + (i11 * s0 - i01 * s1) / (i00 * i11 - i01 * i01), b + (i00 * s1 - i01 * s0) / (i00 * i11 - i01 * i01)
        FROM (SELECT n, a, b, sum(y - mu) AS s0, sum((y - mu) * x) AS s1, sum(mu * (1 - mu)) AS i00, sum(mu * (1 - mu) * x) AS i01, sum(mu * (1 - mu) * x * x) AS i11
              FROM (SELECT n, a, b, y, x, 1 / (1 + exp(-(a + b * x))) AS mu FROM it, cc WHERE n < 30) GROUP BY n, a, b)),
    nl AS (SELECT sample_id, x, y - mu AS r, mu * (1 - mu) AS w FROM (SELECT cc.*, 1 / (1 + exp(-(a + b * x))) AS mu FROM cc, it WHERE n = 30)),
    sm AS (SELECT variant_id, sum(g * r) AS u, sum(w * g * g) AS gg, sum(w * g) AS g0, sum(w * g * x) AS g1, sum(w) AS w0, sum(w * x) AS w1, sum(w * x * x) AS w2, max(m) AS m
           FROM (SELECT variant_id, sample_id, d - avg(d) OVER (PARTITION BY variant_id) AS g, avg(d) OVER (PARTITION BY variant_id) AS m FROM gi) JOIN nl USING (sample_id) GROUP BY variant_id),
    sv2 AS (SELECT variant_id, m, u, gg - (g0 * g0 * w2 - 2 * g0 * g1 * w1 + g1 * g1 * w0) / (w0 * w2 - w1 * w1) AS v FROM sm)
    SELECT variant_id, round(m / 2, 6) AS af, round(u / sqrt(v), 6) AS z_score, round(u / v, 6) AS beta, round(1 / sqrt(v), 6) AS se
    FROM sv2 WHERE least(m / 2, 1 - m / 2) >= 0.05""")
def q6s(t):
    case = t.covar().select("sample_id", F.col("sex").alias("value"))
    out = AS.logistic_score(t.geno(), case, covariates(t).where("covariate = 'rin'"), maf=0.05)
    return rnd(out.select("variant_id", "af", "z_score", "beta", "se"), "af", "z_score", "beta", "se")


@query("q6_logistic_refined")
def q6r(t):
    case = t.covar().select("sample_id", F.col("sex").alias("value"))
    return AS.logistic_score(t.geno(), case, covariates(t).where("covariate = 'rin'"), maf=0.05, refine=0.1)


@query("q7_gwas_inputs", f"""
    WITH ct AS (SELECT * FROM ({_CT}) WHERE sample_id IN (SELECT sample_id + 5 FROM geno)), {_out_sql('s1', 'ct', 'heavy')}, {_out_sql('s2', 's1', 'cubic')}, {_out_sql('s3', 's2', 'plain')}
    SELECT CAST(sample_id AS VARCHAR) AS sample_id, round(max(value) FILTER (trait = 'heavy'), 4) AS heavy, round(max(value) FILTER (trait = 'cubic'), 4) AS cubic,
           round(max(value) FILTER (trait = 'plain'), 4) AS plain FROM s3 GROUP BY sample_id""")
def q7(t):
    geno = t.geno().withColumn("sample_id", F.col("sample_id") + 5)
    return rnd(AS.gwas_inputs(geno, customer_traits(t), ["heavy", "cubic", "plain"]), "heavy", "cubic", "plain", digits=4)


# ---- phenotypes that lack rows for some samples: each pair is fitted on the samples the feature has, gene by gene
_WP = "OVER (PARTITION BY qtl_type, gene_id, variant_id)"


def _gap_sql(pheno: str, pairs: str, keep: str = "TRUE") -> str:
    """``pheno`` (qtl_type, feature_id, sample_id, value) has no row where a value is missing; ``pairs`` are (gene_id, variant_id)."""
    on = lambda y, x: f"(sum({y} * {x}) {_WP}) / nullif(sum({x} * {x}) {_WP}, 0)"
    return f"""yy AS ({pheno}),
    x0 AS (SELECT qtl_type, gene_id, pr.variant_id, value AS y, dosage, rin AS a, CAST(sex AS DOUBLE) AS s FROM {pairs} pr JOIN yy ON yy.feature_id = pr.gene_id
           JOIN covar c ON c.sample_id = yy.sample_id LEFT JOIN geno g ON g.variant_id = pr.variant_id AND g.sample_id = yy.sample_id),
    x1 AS (SELECT qtl_type, gene_id, variant_id, dosage, y, coalesce(dosage, avg(dosage) {_WP}) - avg(dosage) {_WP} AS d1, y - avg(y) {_WP} AS y1, a - avg(a) {_WP} AS a1,
                  s - avg(s) {_WP} AS s0 FROM x0),
    x2 AS (SELECT *, coalesce(s0 - a1 * {on("s0", "a1")}, 0) AS s1 FROM x1),
    x3 AS (SELECT *, d1 - a1 * {on("d1", "a1")} - coalesce(s1 * {on("d1", "s1")}, 0) AS gv, y1 - a1 * {on("y1", "a1")} - coalesce(s1 * {on("y1", "s1")}, 0) AS yv FROM x2),
    ss AS (SELECT qtl_type, gene_id, variant_id, count(*) AS n, count(dosage) AS n_called, avg(dosage) AS mean, sum(dosage) AS total, count(*) FILTER (dosage > 0.5) AS above,
                  count(*) FILTER (dosage < 1.5) AS below, sum(gv * yv) AS sxy, sum(gv * gv) AS sxx, sum(yv * yv) AS syy, sum(y * y) AS raw
           FROM x3 GROUP BY ALL),
    st AS (SELECT *, sxy / sxx AS beta, sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 4) / sxx) AS se, least(mean / 2, 1 - mean / 2) AS maf
           FROM ss WHERE n_called > 0 AND sxx > 1e-9 AND syy > 1e-12 * raw AND {keep})"""


_GAPS = "SELECT 'one' AS qtl_type, * FROM pheno_na WHERE value IS NOT NULL"
_TRANS_GAPS = "(SELECT gene_id, variant_id FROM genes, (SELECT DISTINCT variant_id FROM geno) v)"


@query("q1_cis_nominal_gaps", f"""WITH {_CIS}, {_gap_sql(_GAPS, "pr")}
    SELECT gene_id, variant_id, n, CASE WHEN mean <= 1 THEN above ELSE below END AS ma_samples,
           CASE WHEN mean <= 1 THEN total ELSE 2 * n_called - total END AS ma_count, round(maf, 6) AS maf, round(beta, 6) AS beta, round(se, 6) AS se,
           round(beta / se, 5) AS t FROM st""")
def q1g(t):
    prep = prepared(t, t.pheno_na().where("value IS NOT NULL"), covariates(t))
    out = AS.cis_nominal(prep, t.variants(), t.genes()).select("gene_id", "variant_id", "n", "ma_samples", "ma_count", "maf", "beta", "se", "t")
    out = out.withColumns({"n": F.col("n").cast("long"), "ma_count": F.round("ma_count", 6)})
    return rnd(rnd(out, "maf", "beta", "se"), "t", digits=5)


_BH_GENE = """SELECT gene_id, variant_id, min(least(p * m / rk, 1)) OVER (PARTITION BY gene_id ORDER BY p DESC, variant_id ROWS UNBOUNDED PRECEDING) AS f
    FROM (SELECT *, count(*) OVER (PARTITION BY gene_id) AS m, rank() OVER (PARTITION BY gene_id ORDER BY p) + count(*) OVER (PARTITION BY gene_id, p) - 1 AS rk FROM pv)"""


@query("q1_cis_p_values", f"""
    WITH {_CIS}, {_gap_sql(_GAPS, "pr")}, pv AS (SELECT *, {t_p_sql("(beta / se)", "(n - 4)")} AS p FROM st), fd AS ({_BH_GENE})
    SELECT pv.gene_id, pv.variant_id, round(p, 6) AS p_value, round(f, 6) AS fdr FROM pv JOIN fd ON fd.gene_id = pv.gene_id AND fd.variant_id = pv.variant_id""")
def q1p(t):
    """p of every pair, on the degrees of freedom of each gene's own samples, and the FDR over the pairs of a gene."""
    prep = prepared(t, t.pheno_na().where("value IS NOT NULL"), covariates(t))
    out = bh_fdr(materialize(AS.cis_nominal(prep, t.variants(), t.genes())), ["gene_id"])
    return rnd(out.select("gene_id", "variant_id", "p_value", "fdr"), "p_value", "fdr")


@query("q2_best_variant_gaps", f"""
    WITH {_CIS}, {_gap_sql(_GAPS, "pr")},
    rr AS (SELECT *, sxy / sqrt(sxx * syy) AS r, count(*) OVER (PARTITION BY gene_id) AS n_variants,
                  row_number() OVER (PARTITION BY gene_id ORDER BY round(-abs(sxy / sqrt(sxx * syy)), 12), variant_id) AS k FROM st)
    SELECT gene_id, variant_id, round(r, 6) AS r, round(beta, 6) AS beta, n_variants FROM rr WHERE k = 1""")
def q2g(t):
    prep = prepared(t, t.pheno_na().where("value IS NOT NULL"), covariates(t))
    out = AS.cis_permutation(prep, t.variants(), t.genes(), permutations=20)
    return rnd(out.select("gene_id", "variant_id", "r", "beta", "n_variants"), "r", "beta")


@query("q3_trans_gaps", f"""WITH {_gap_sql(_GAPS, _TRANS_GAPS)}
    SELECT st.gene_id, st.variant_id, n, round(maf, 6) AS maf, round(beta, 6) AS beta, round(beta / se, 4) AS t FROM st
    JOIN variants v ON v.variant_id = st.variant_id JOIN genes g ON g.gene_id = st.gene_id
    WHERE maf >= 0.05 AND sxy * sxy >= CASE n {" ".join(f"WHEN {m} THEN {r_threshold(1e-3, m - 4) ** 2!r}" for m in range(5, COHORT + 1))} END * sxx * syy
      AND (v.chrom <> g.chrom OR abs(v.pos - CASE WHEN g.strand = '+' THEN g.gstart ELSE g.gend END) > 5000000)""")
def q3g(t):
    prep = prepared(t, t.pheno_na().where("value IS NOT NULL"), covariates(t))
    out = AS.trans_scan(prep, t.variants(), t.genes(), 1e-3, lam=0.5).select("gene_id", "variant_id", F.col("n").cast("long").alias("n"), "maf", "beta", "t")
    return rnd(rnd(out, "maf", "beta"), "t", digits=4)


_TYPES = """SELECT 'eqtl' AS qtl_type, * FROM pheno UNION ALL SELECT 'pqtl', * FROM pheno_na WHERE value IS NOT NULL
            UNION ALL SELECT 'sqtl', feature_id, sample_id, ln(1 + value) FROM counts WHERE sample_id % 7 <> 2"""


@query("q4_types_cis_and_trans", f"""
    WITH {_CIS}, ap AS (SELECT * FROM {_TRANS_GAPS}), {_gap_sql(_TYPES, "ap")},
    sm AS (SELECT st.*, pr.gene_id IS NOT NULL AS near, v.chrom <> g.chrom OR abs(v.pos - CASE WHEN g.strand = '+' THEN g.gstart ELSE g.gend END) > 5000000 AS far
           FROM st JOIN variants v ON v.variant_id = st.variant_id JOIN genes g ON g.gene_id = st.gene_id
           LEFT JOIN pr ON pr.gene_id = st.gene_id AND pr.variant_id = st.variant_id WHERE maf >= 0.05)
    SELECT qtl_type, 'cis' AS mode, gene_id, variant_id, n, round(beta, 6) AS beta, round(beta / se, 4) AS t FROM sm WHERE near
    UNION ALL SELECT qtl_type, 'trans', gene_id, variant_id, n, round(beta, 6), round(beta / se, 4) FROM sm
    WHERE far AND sxy * sxy >= CASE n {" ".join(f"WHEN {m} THEN {r_threshold(1e-3, m - 4) ** 2!r}" for m in range(5, COHORT + 1))} END * sxx * syy""")
def q4t(t):
    """Expression complete, proteins with gaps, splicing measured in six sevenths of the samples; cis and trans of each."""
    kinds = {"eqtl": t.pheno(), "pqtl": t.pheno_na(), "sqtl": t.counts().where("sample_id % 7 <> 2").withColumn("value", F.log1p("value"))}
    scans = AS.scan_types(t.geno(), kinds, t.variants(), t.genes(), covariates(t), maf=0.05, p=1e-3)
    cols = ["qtl_type", "gene_id", "variant_id", F.col("n").cast("long").alias("n"), "beta", "t"]
    out = scans["cis"].select(F.lit("cis").alias("mode"), *cols).unionByName(scans["trans"].select(F.lit("trans").alias("mode"), *cols))
    return rnd(rnd(out, "beta"), "t", digits=4)


_TRAIT_GAPS = """SELECT trait AS qtl_type, trait AS feature_id, sample_id, value FROM traits
                 WHERE trait = 'height' OR (trait = 'weight' AND sample_id % 5 <> 1) OR (trait = 'ldl' AND sample_id % 3 <> 0)"""


def trait_gaps(t):
    keep = (F.col("trait") == "height") | ((F.col("trait") == "weight") & (F.col("sample_id") % 5 != 1)) | ((F.col("trait") == "ldl") & (F.col("sample_id") % 3 != 0))
    return t.traits().where(keep)


_TRAIT_PAIRS = "(SELECT f AS gene_id, variant_id FROM (VALUES ('height'), ('weight'), ('ldl')) x(f), (SELECT DISTINCT variant_id FROM geno) v)"
_GWAS_OUT = """SELECT gene_id AS phenotype, variant_id, n_called, round(beta, 6) AS beta, round(se, 6) AS se, round(beta / se, 5) AS t,
           round(beta - 1.959963984540054 * se, 6) AS ci_low, round(beta + 1.959963984540054 * se, 6) AS ci_high"""


def _gwas_out(out):
    out = out.select("phenotype", "variant_id", "n_called", *_GW)
    return rnd(rnd(out, "beta", "se", "ci_low", "ci_high"), "t", digits=5)


@query("q5_linear_gwas_gaps", f"WITH {_gap_sql(_TRAIT_GAPS, _TRAIT_PAIRS)} {_GWAS_OUT} FROM st")
def q5g(t):
    return _gwas_out(AS.linear_gwas(t.geno(), trait_gaps(t), covariates(t)))


@query("q5_linear_gwas_p_values", f"""
    WITH {_gap_sql(_TRAIT_GAPS, _TRAIT_PAIRS)} SELECT gene_id AS phenotype, variant_id, round({t_p_sql("(beta / se)", "(n - 4)")}, 6) AS p_value FROM st""")
def q5p(t):
    return rnd(AS.linear_gwas(t.geno(), trait_gaps(t), covariates(t)).select("phenotype", "variant_id", "p_value"), "p_value")


@query("q5_linear_gwas_filters", f"""
    WITH {_gap_sql(_TRAIT_GAPS, _TRAIT_PAIRS)}, counts_of AS (SELECT variant_id, count(*) FILTER (dosage = 0) AS hom_ref, count(*) FILTER (dosage = 1) AS het,
        count(*) FILTER (dosage = 2) AS hom_alt, count(dosage) AS m FROM geno GROUP BY variant_id), {EXACT_HWE}
    {_GWAS_OUT} FROM st WHERE maf >= 0.4 AND variant_id IN (SELECT variant_id FROM counts_of WHERE 1 - m / {COHORT}.0 <= 0.5)
        AND variant_id IN (SELECT variant_id FROM plain WHERE p_hwe >= 0.2)""")
def q5f(t):
    return _gwas_out(AS.linear_gwas(t.geno(), trait_gaps(t), covariates(t), maf=0.4, missing=0.5, hwe=0.2))


def leads(t):
    best = D.top_hit(t.assoc().select("gene_id", "variant_id", "p_value"), "variant_id", keys=("gene_id",))
    return best.select(F.col("gene_id").alias("feature_id"), "variant_id")


_LEAD = "ld AS (SELECT gene_id, variant_id FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY p_value, variant_id) AS k FROM assoc) WHERE k = 1)"
_W = "OVER (PARTITION BY gene_id, covariate)"
_INT = f"""{_LEAD}, cl AS (SELECT sample_id, 'age' AS covariate, age AS x FROM covar UNION ALL SELECT sample_id, 'rin', rin FROM covar),
    i0 AS (SELECT ld.gene_id, covariate, p.value AS y, g.dosage AS g, x, g.dosage * x AS gx FROM ld JOIN pheno p ON p.feature_id = ld.gene_id
           JOIN geno g ON g.variant_id = ld.variant_id AND g.sample_id = p.sample_id JOIN cl ON cl.sample_id = p.sample_id WHERE g.dosage IS NOT NULL),
    i1 AS (SELECT gene_id, covariate, g - avg(g) {_W} AS e, x - avg(x) {_W} AS x1, gx - avg(gx) {_W} AS i1, y - avg(y) {_W} AS y1 FROM i0),
    i2 AS (SELECT *, x1 - e * (sum(x1*e) {_W}) / (sum(e*e) {_W}) AS x2, i1 - e * (sum(i1*e) {_W}) / (sum(e*e) {_W}) AS ii,
                  y1 - e * (sum(y1*e) {_W}) / (sum(e*e) {_W}) AS y2 FROM i1),
    i3 AS (SELECT *, ii - x2 * (sum(ii*x2) {_W}) / (sum(x2*x2) {_W}) AS i3, y2 - x2 * (sum(y2*x2) {_W}) / (sum(x2*x2) {_W}) AS y3 FROM i2),
    i4 AS (SELECT gene_id, covariate, count(*) AS n, sum(y3*i3) / sum(i3*i3) AS b, sum(i3*i3) AS sii, sum(y3*y3) AS syy, sum(y1*y1) AS tss FROM i3 GROUP BY gene_id, covariate)
    SELECT gene_id, covariate, n AS n_observations, round(b, 5) AS interaction_beta, round(sqrt((syy - b*b*sii) / (n - 4) / sii), 5) AS interaction_se,
           round(1 - (syy - b*b*sii) / tss, 5) AS r_squared FROM i4 WHERE n >= 10"""


def int_cov(t):
    wide = t.covar().select("sample_id", "age", "rin", F.col("sex").cast("double").alias("sex"))
    return wide.unpivot("sample_id", ["age", "rin", "sex"], "covariate", "value")


@query("q8_interaction", f"WITH {_INT}")
def q8(t):
    out = I.interaction_scan(t.pheno(), t.geno(), leads(t), int_cov(t), ["age", "rin"], others=0)
    cols = ["interaction_beta", "interaction_se", "r_squared"]
    return rnd(out.select("gene_id", "covariate", "n_observations", *cols), *cols, digits=5)


@query("q8_interaction_others")
def q8o(t):
    return I.interaction_scan(t.pheno(), t.geno(), leads(t), int_cov(t), ["age", "rin"])


def _analysis(t):
    return I.interaction_analysis(t.pheno(), t.geno(), leads(t), int_cov(t), ["age", "rin", "bmi"])


@query("q9_interaction_analysis")
def q9(t):
    return _analysis(t)


@query("a37_interaction_summary")
def a37(t):
    return S.interaction_summary(_analysis(t))
