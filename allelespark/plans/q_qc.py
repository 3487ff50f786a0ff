"""Registered queries: quality-control aggregates (A1-A20, A41-A44)."""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.operators import qc as Q
from allelespark.plans.q_filters import _CT, _MIDP, _VS, EXACT_HWE, customer_traits
from allelespark.plans.q_joins import shifted
from allelespark.plans.registry import query


def rnd(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


_MISS = """SELECT {k}, count(*) FILTER (dosage IS NULL) AS n_missing, count(*) AS n,
                  round(count(*) FILTER (dosage IS NULL) * 1.0 / count(*), 6) AS f_missing FROM geno GROUP BY {k}"""


@query("a1_sample_missing", _MISS.format(k="sample_id"))
def a1(t):
    return rnd(Q.missing_rate(t.geno(), "sample_id"), "f_missing")


@query("a2_variant_missing", _MISS.format(k="variant_id"))
def a2(t):
    return rnd(Q.missing_rate(t.geno(), "variant_id"), "f_missing")


@query("a3_allele_frequency", f"""
    WITH vs AS ({_VS} FROM geno GROUP BY variant_id)
    SELECT variant_id, nc AS n_called, round(af, 6) AS af, round(least(af, 1 - af), 6) AS maf FROM vs""")
def a3(t):
    out = Q.variant_stats(t.geno()).select("variant_id", "n_called", "af", "maf")
    return rnd(out, "af", "maf")


@query("a3_maf_summary", f"""
    WITH vs AS ({_VS} FROM geno GROUP BY variant_id)
    SELECT count(af) AS n_variants, round(avg(least(af, 1 - af)), 6) AS mean_maf,
           round(median(least(af, 1 - af)), 6) AS median_maf FROM vs WHERE af IS NOT NULL""")
def a3s(t):
    return rnd(Q.maf_summary(t.geno()), "mean_maf", "median_maf")


_CHI = f"""vs AS ({_VS} FROM geno GROUP BY variant_id),
    ex AS (SELECT *, h0 + h1 + h2 AS m, (2.0 * h0 + h1) / nullif(2.0 * (h0 + h1 + h2), 0) AS p FROM vs)
    SELECT variant_id, h0 AS hom_ref, h1 AS het, h2 AS hom_alt,
           round(CASE WHEN p IS NULL THEN NULL ELSE
             (CASE WHEN m*p*p > 0 THEN pow(h0 - m*p*p, 2) / (m*p*p) ELSE 0 END
           + CASE WHEN 2*m*p*(1-p) > 0 THEN pow(h1 - 2*m*p*(1-p), 2) / (2*m*p*(1-p)) ELSE 0 END
           + CASE WHEN m*(1-p)*(1-p) > 0 THEN pow(h2 - m*(1-p)*(1-p), 2) / (m*(1-p)*(1-p)) ELSE 0 END) END, 6) AS chi2 FROM ex"""


@query("a4_hwe_counts", f"WITH {_CHI}")
def a4(t):
    out = Q.hwe(t.geno(), exact=False)
    called = F.col("hom_ref") + F.col("het") + F.col("hom_alt") > 0
    return out.withColumn("chi2", F.when(called, F.round("chi2", 6)))


_EXACT = f"WITH counts_of AS (SELECT * FROM (WITH {_CHI})), {_MIDP}"


@query("a4_hwe_exact", f"{_EXACT} SELECT c.*, round(p_hwe, 6) AS p_hwe FROM counts_of c JOIN midp ON midp.variant_id = c.variant_id")
def a4x(t):
    out = Q.hwe(t.geno())
    called = F.col("hom_ref") + F.col("het") + F.col("hom_alt") > 0
    return rnd(out.withColumn("chi2", F.when(called, F.round("chi2", 6))), "p_hwe")


@query("a4_hwe_plain", f"WITH counts_of AS (SELECT * FROM (WITH {_CHI})), {EXACT_HWE} SELECT variant_id, round(p_hwe, 6) AS p_hwe FROM plain")
def a4p(t):
    return rnd(Q.hwe(t.geno(), midp=False).select("variant_id", "p_hwe"), "p_hwe")


@query("a4_hwe_summary", f"""{_EXACT} SELECT count(*) FILTER (p_hwe < 0.01) AS violations, count(*) AS total_variants,
    count(*) FILTER (p_hwe < 0.01) / count(*) AS violation_rate FROM midp""")
def a4s(t):
    return Q.hwe_summary(Q.hwe(t.geno()), 0.01)


_HET = """SELECT sample_id, count(dosage) AS n_called,
                 count(*) FILTER (dosage = 1) * 1.0 / count(dosage) AS het_rate FROM geno GROUP BY sample_id"""


@query("a5_heterozygosity", f"SELECT sample_id, n_called, round(het_rate, 6) AS het_rate FROM ({_HET})")
def a5(t):
    return rnd(Q.heterozygosity(t.geno()), "het_rate")


@query("a6_heterozygosity_outliers", f"""
    WITH h AS ({_HET}), s AS (SELECT avg(het_rate) AS m, stddev_samp(het_rate) AS sd FROM h)
    SELECT sample_id, n_called, round(het_rate, 6) AS het_rate, round(m, 6) AS mean_het, round(sd, 6) AS sd_het
    FROM h, s WHERE sd > 0 AND abs(het_rate - m) > 1.5 * sd""")
def a6(t):
    return rnd(Q.heterozygosity_outliers(t.geno(), 1.5), "het_rate", "mean_het", "sd_het")


@query("a7_genotype_summary", f"""
    WITH s AS (SELECT count(*) FILTER (dosage IS NULL) * 1.0 / count(*) AS f FROM geno GROUP BY sample_id),
    v AS (SELECT count(*) FILTER (dosage IS NULL) * 1.0 / count(*) AS f FROM geno GROUP BY variant_id),
    vs AS ({_VS} FROM geno GROUP BY variant_id), m AS (SELECT least(af, 1 - af) AS maf FROM vs)
    SELECT round((SELECT avg(f) FROM s), 6) AS sample_mean, round((SELECT median(f) FROM s), 6) AS sample_median,
           round((SELECT max(f) FROM s), 6) AS sample_max, (SELECT count(*) FROM s WHERE f > 0.1) AS sample_above,
           round((SELECT avg(f) FROM v), 6) AS variant_mean, round((SELECT median(f) FROM v), 6) AS variant_median,
           round((SELECT max(f) FROM v), 6) AS variant_max, (SELECT count(*) FROM v WHERE f > 0.1) AS variant_above,
           round((SELECT avg(maf) FROM m), 6) AS maf_mean, round((SELECT median(maf) FROM m), 6) AS maf_median,
           (SELECT count(*) FROM m WHERE maf < 0.01) AS maf_lt_01, (SELECT count(*) FROM m WHERE maf < 0.05) AS maf_lt_05""")
def a7(t):
    names = [f"{p}_{s}" for p in ("sample", "variant") for s in ("mean", "median", "max")] + ["maf_mean", "maf_median"]
    return rnd(Q.genotype_summary(t.geno()), *names)


@query("a8_phenotype_summary", """
    WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM pheno_na GROUP BY sample_id),
    f AS (SELECT min(value) = max(value) AND count(value) > 1 AS c, count(*) > count(DISTINCT sample_id) AS d FROM pheno_na GROUP BY feature_id)
    SELECT count(*) AS total_measurements, count(*) FILTER (value IS NULL) AS total_missing,
           round(100.0 * count(*) FILTER (value IS NULL) / count(*), 6) AS missing_pct,
           CASE WHEN sum(value) > count(*) THEN 'counts' ELSE 'normalized' END AS data_type,
           bool_or(value < 0) AS has_negative, bool_or(value = 0) AS has_zero,
           (SELECT count(*) FROM s) AS n_samples, round((SELECT avg(m) FROM s), 6) AS mean, round((SELECT avg(s) FROM s), 6) AS std,
           (SELECT count(*) FROM f) AS n_features, (SELECT bool_or(c) FROM f) AS has_constant, (SELECT bool_or(d) FROM f) AS has_duplicate
    FROM pheno_na""")
def a8(t):
    return rnd(Q.phenotype_summary(t.pheno_na()), "missing_pct", "mean", "std")


_PROF = """prof AS (SELECT covariate, count(*) AS n, count(TRY_CAST(value AS DOUBLE)) AS nn, count(DISTINCT value) AS n_distinct,
               avg(TRY_CAST(value AS DOUBLE)) AS m, stddev_samp(TRY_CAST(value AS DOUBLE)) AS s,
               min(TRY_CAST(value AS DOUBLE)) AS lo, max(TRY_CAST(value AS DOUBLE)) AS hi,
               array_to_string(list_sort(list(DISTINCT value) FILTER (value IS NOT NULL)), ',') AS vals
        FROM covlong GROUP BY covariate),
    typed AS (SELECT *, CASE WHEN nn < n THEN 'categorical' WHEN n_distinct = 2 THEN 'binary' ELSE 'numeric' END AS type FROM prof)"""


@query("a9_covariate_profile", f"""
    WITH {_PROF}
    SELECT covariate, type, n_distinct,
           CASE WHEN type = 'numeric' THEN round(m, 8) END AS mean, CASE WHEN type = 'numeric' THEN round(s, 8) END AS sd,
           CASE WHEN type = 'numeric' THEN lo END AS min, CASE WHEN type = 'numeric' THEN hi END AS max,
           CASE WHEN type <> 'numeric' AND n_distinct <= 20 THEN vals END AS values FROM typed""")
def a9(t):
    return rnd(Q.covariate_profile(t.covlong()), "mean", "sd", digits=8)


@query("a10_covariate_patterns", r"""
    SELECT DISTINCT covariate, regexp_matches(covariate, '(?i)^PC\d+$') AS is_pc, contains(lower(covariate), 'batch') AS is_batch,
           regexp_matches(lower(covariate), 'age|sex|gender|bmi|height|weight') AS is_demographic,
           regexp_matches(lower(covariate), 'study|cohort|center|site') AS is_study FROM covlong""")
def a10(t):
    return Q.covariate_patterns(t.covlong())


@query("a10_covariate_advice", f"""
    WITH {_PROF}
    SELECT count(*) AS n_covariates, (SELECT count(DISTINCT sample_id) FROM covlong) AS n_samples,
           count(*) FILTER (regexp_matches(covariate, '(?i)^PC\\d+$')) AS n_pcs, count(*) FILTER (type = 'categorical') AS n_categorical,
           count(*) FILTER (regexp_matches(covariate, '(?i)^PC\\d+$')) < 5 AS add_pcs, '' AS missing_expected,
           count(*) FILTER (type = 'categorical') > 0 AS encode_categorical,
           count(*) > (SELECT count(DISTINCT sample_id) FROM covlong) / 10.0 AS too_many FROM typed""")
def a10b(t):
    return Q.covariate_advice(t.covlong())


@query("a11_distribution_class", """
    WITH f AS (SELECT avg(value) AS m, var_samp(value) AS s FROM counts GROUP BY feature_id)
    SELECT (SELECT CASE WHEN bool_and(value >= 0) THEN CASE WHEN bool_or(value = 0) THEN 'count_like' ELSE 'continuous_positive' END
                        ELSE 'continuous' END FROM counts) AS distribution_type,
           round(avg(m), 6) AS mean_mean, round(stddev_samp(m), 6) AS mean_sd, round(avg(s), 6) AS variance_mean,
           round(stddev_samp(s), 6) AS variance_sd FROM f""")
def a11(t):
    return rnd(Q.distribution_class(t.counts(), "eqtl"), "mean_mean", "mean_sd", "variance_mean", "variance_sd", digits=6)


@query("a12_normalisation_check", """
    SELECT 'eqtl' AS qtl_type, 'log2' AS method, count(*) FILTER (value <= 0) AS n_offending, count(*) FILTER (value <= 0) = 0 AS compatible FROM counts
    UNION ALL SELECT 'eqtl', 'vst', count(*) FILTER (value < 0), count(*) FILTER (value < 0) = 0 FROM counts
    UNION ALL SELECT 'sqtl', 'log2', count(*) FILTER (value < 0 OR value > 1), count(*) FILTER (value < 0 OR value > 1) = 0 FROM counts""")
def a12(t):
    c = t.counts()
    parts = [Q.normalisation_compatible(c, *k) for k in (("eqtl", "log2"), ("eqtl", "vst"), ("sqtl", "log2"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_FENCE = """SELECT sample_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, count(value) AS n FROM {src} GROUP BY sample_id"""


@query("a13_phenotype_issues", f"""
    WITH f AS (SELECT count(DISTINCT value) AS d, min(value) = max(value) AS c, count(value) AS n,
                      count(*) FILTER (value IS NULL) * 1.0 / count(*) AS m FROM pheno_na GROUP BY feature_id),
    q AS ({_FENCE.format(src='pheno_na')}),
    o AS (SELECT count(*) AS n FROM pheno_na p JOIN q ON p.sample_id = q.sample_id
          WHERE value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)),
    a AS (SELECT count(*) FILTER (d = 1) AS constant_features, count(*) FILTER (c AND n > 1) AS zero_variance,
                 count(*) FILTER (m > 0.2) AS high_missing FROM f)
    SELECT constant_features, zero_variance, high_missing, o.n AS n_outliers, (SELECT count(*) FROM pheno_na) AS n_cells,
           round(100.0 * o.n / (SELECT count(*) FROM pheno_na), 6) AS outlier_pct FROM a, o""")
def a13(t):
    return rnd(Q.phenotype_issues(t.pheno_na()), "outlier_pct")


@query("a14_covariate_issues", """
    WITH k AS (SELECT covariate, count(DISTINCT value) AS d, count(TRY_CAST(value AS DOUBLE)) = count(*) AS num FROM covlong GROUP BY covariate),
    r AS (SELECT sample_id, TRY_CAST(value AS DOUBLE) AS v FROM covlong WHERE covariate IN (SELECT covariate FROM k WHERE num)),
    s AS (SELECT sample_id, avg(v) AS m, CASE WHEN stddev_samp(v) = 0 THEN 1 ELSE stddev_samp(v) END AS sd FROM r GROUP BY sample_id)
    SELECT count(*) FILTER (value IS NULL) AS n_missing, round(100.0 * count(*) FILTER (value IS NULL) / count(*), 6) AS missing_pct,
           count(DISTINCT sample_id) AS n_samples, (SELECT count(*) FROM k) AS n_covariates, (SELECT count(*) FROM k WHERE d <= 1) AS n_constant,
           (SELECT count(*) FROM k WHERE NOT num) AS n_non_numeric,
           (SELECT count(*) FROM r JOIN s ON r.sample_id = s.sample_id WHERE abs((v - m) / sd) > 1) AS n_extreme,
           (SELECT count(*) FROM k) > count(DISTINCT sample_id) / 2.0 AS too_many FROM covlong""")
def a14(t):
    return rnd(Q.covariate_issues(t.covlong(), 1.0), "missing_pct")


@query("a15_annotation_issues", """
    WITH g AS (SELECT gene_id - gene_id % 3 AS gene_id, chrom, gstart, CASE WHEN gene_id % 7 = 0 THEN gstart ELSE gend END AS gend FROM genes)
    SELECT count(*) AS n_rows, count(*) FILTER (gstart >= gend) AS bad_ranges, count(*) - count(DISTINCT gene_id) AS duplicate_genes,
           'X,Y,MT,M' AS missing_chromosomes, CAST(sum(gend - gstart) AS BIGINT) AS total_length, round(avg(gend - gstart), 6) AS mean_length FROM g""")
def a15(t):
    gid = F.col("gene_id")
    g = t.genes().withColumn("gend", F.when(gid % 7 == 0, F.col("gstart")).otherwise(F.col("gend"))).withColumn("gene_id", gid - gid % 3)
    return rnd(Q.annotation_issues(g), "mean_length")


@query("a16_plink_tables", """
    SELECT (SELECT count(*) FROM customer) AS n_samples, (SELECT count(*) - count(DISTINCT c_custkey % 1000) FROM customer) AS duplicate_samples,
           count(*) AS n_variants, count(*) - count(DISTINCT variant_id % 700) AS duplicate_variants,
           count(*) FILTER (pos <= 0) AS bad_positions FROM variants""")
def a16(t):
    fam = t.customer.select((F.col("c_custkey") % 1000).alias("sample_id"))
    bim = t.variants().select((F.col("variant_id") % 700).alias("variant_id"), "pos")
    return Q.plink_table_issues(fam, bim)


@query("a17_trait_issues", f"""
    WITH ct AS ({_CT}), x AS (SELECT CASE WHEN sample_id % 50 = 1 THEN NULL ELSE sample_id END AS sample_id, trait,
        CASE WHEN trait = 'plain' AND sample_id % 40 = 3 THEN 'bad' WHEN trait = 'cubic' THEN CAST(sample_id % 2 AS VARCHAR)
             ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS value FROM ct)
    SELECT trait, count(*) FILTER (sample_id IS NULL) AS missing_ids,
           count(*) FILTER (value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL) AS non_numeric,
           count(DISTINCT value) AS n_levels, count(DISTINCT value) = 2 AS logistic_ok FROM x GROUP BY trait""")
def a17(t):
    s = F.col("sample_id")
    text = F.when((F.col("trait") == "plain") & (s % 40 == 3), "bad").when(
        F.col("trait") == "cubic", (s % 2).cast("string")
    ).otherwise(F.floor("value").cast("bigint").cast("string"))
    return Q.trait_issues(customer_traits(t).select(F.when(s % 50 != 1, s).alias("sample_id"), "trait", text.alias("value")))


@query("a18_chromosome_naming", """
    SELECT 'bare' AS source, CASE WHEN bool_or(starts_with(chrom, 'chr')) THEN 'x' ELSE 'bare' END AS naming FROM variants
    UNION ALL SELECT 'mixed', CASE WHEN bool_or(starts_with(c, 'chr')) AND bool_or(c = '3') THEN 'mixed' ELSE 'x' END
    FROM (SELECT CASE WHEN pos % 3 = 0 THEN 'chr' || chrom ELSE chrom END AS c FROM variants)""")
def a18(t):
    v = t.variants()
    m = v.withColumn("chrom", F.when(F.col("pos") % 3 == 0, F.concat(F.lit("chr"), "chrom")).otherwise(F.col("chrom")))
    a = Q.chromosome_naming(v).select(F.lit("bare").alias("source"), "naming")
    return a.unionByName(Q.chromosome_naming(m).select(F.lit("mixed").alias("source"), "naming"))


@query("a19_concordance", """
    WITH a AS (SELECT DISTINCT sample_id FROM geno), b AS (SELECT DISTINCT sample_id + 11 AS sample_id FROM pheno),
    c AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM a JOIN b ON a.sample_id = b.sample_id) AS n)
    SELECT 'expression' AS dataset, na AS genotype_samples, nb AS dataset_samples, n AS overlap, round(100.0 * n / na, 6) AS pct_of_genotype,
           round(100.0 * n / least(na, nb), 6) AS pct_of_smaller, 100.0 * n / least(na, nb) < 80 AS warn FROM c""")
def a19(t):
    return rnd(Q.concordance(t.geno(), shifted(t.pheno(), 11), "expression"), "pct_of_genotype", "pct_of_smaller")


@query("a20_scorecard", """
    WITH c AS (SELECT event_type AS dataset, value > 40 OR event_type = 'view' AS passed FROM events),
    g AS (SELECT dataset, count(*) FILTER (passed) AS checks_passed, count(*) AS checks_total FROM c GROUP BY ROLLUP (dataset))
    SELECT coalesce(dataset, 'overall') AS dataset, checks_passed, checks_total,
           CASE WHEN checks_passed * 1.0 / checks_total > 0.8 THEN 'PASS' WHEN checks_passed * 1.0 / checks_total > 0.5 THEN 'WARNING' ELSE 'FAIL' END AS status FROM g""")
def a20(t):
    return Q.scorecard(t.events.select(
        F.col("event_type").alias("dataset"), ((F.col("value") > 40) | (F.col("event_type") == "view")).alias("passed")
    ))


@query("a41_genotype_size", "SELECT count(DISTINCT sample_id) AS n_samples, count(DISTINCT variant_id) AS n_variants FROM geno")
def a41(t):
    return Q.genotype_size(t.geno())


@query("a42_missing_matrix", "SELECT feature_id, sample_id, CASE WHEN value IS NULL THEN 1 ELSE 0 END AS missing FROM pheno_na")
def a42(t):
    return Q.missing_matrix(t.pheno_na())


@query("a44_findings", """
    SELECT severity, count(*) AS n, array_to_string(list_sort(list(DISTINCT module)), ',') AS modules, severity = 'error' AS run_fails FROM (
      SELECT 'warning' AS severity, 'expression' AS module WHERE (SELECT count(*) FROM pheno_na WHERE value IS NULL) > 0
      UNION ALL SELECT 'warning', 'expression' WHERE EXISTS (SELECT 1 FROM pheno_na GROUP BY feature_id HAVING count(DISTINCT value) = 1)
      UNION ALL SELECT 'info', 'covariates' WHERE EXISTS (SELECT 1 FROM covlong GROUP BY covariate HAVING count(TRY_CAST(value AS DOUBLE)) < count(*))
      UNION ALL SELECT 'warning', 'covariates' WHERE EXISTS (SELECT 1 FROM covlong GROUP BY covariate HAVING count(DISTINCT value) <= 1)
      UNION ALL SELECT 'error', 'annotations' WHERE EXISTS (SELECT 1 FROM genes WHERE gstart >= gend)
      UNION ALL SELECT 'info', 'annotations' WHERE NOT EXISTS (SELECT 1 FROM genes WHERE chrom = 'X')) GROUP BY severity""")
def a44(t):
    c = F.col
    parts = [
        Q.findings(Q.phenotype_summary(t.pheno_na()), "expression", {"missing values": ("warning", c("total_missing") > 0)}),
        Q.findings(Q.phenotype_issues(t.pheno_na()), "expression", {"constant features": ("warning", c("constant_features") > 0)}),
        Q.findings(Q.covariate_issues(t.covlong()), "covariates", {
            "non-numeric covariates": ("info", c("n_non_numeric") > 0), "constant covariates": ("warning", c("n_constant") > 0)}),
        Q.findings(Q.annotation_issues(t.genes()), "annotations", {
            "start not before end": ("error", c("bad_ranges") > 0), "chromosomes absent": ("info", c("missing_chromosomes") != "")}),
    ]
    return Q.findings_summary(parts)
