"""Registered queries: filters (F), sorting and top-k (T)."""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.functions.stats import norm_ppf
from allelespark.operators import filters as X
from allelespark.operators import ranking as R
from allelespark.plans.registry import query

_VS = """SELECT variant_id, count(*) AS n, count(dosage) AS nc,
                (count(*) - count(dosage)) * 1.0 / count(*) AS fm,
                sum(dosage) / (2.0 * nullif(count(dosage), 0)) AS af,
                count(*) FILTER (dosage = 0) AS h0, count(*) FILTER (dosage = 1) AS h1, count(*) FILTER (dosage = 2) AS h2"""


@query("f1_variant_filter", f"""
    WITH vs AS ({_VS} FROM geno GROUP BY variant_id)
    SELECT variant_id, chrom, pos, qual FROM variants
    WHERE qual > 10 AND variant_id IN (SELECT variant_id FROM vs WHERE least(af, 1 - af) > 0.25 AND fm < 1 - 0.945)""")
def f1(t):
    return X.filter_variants(t.variants(), t.geno(), maf=0.25, call_rate=0.945, qual=10)


# probability of every heterozygote count given the allele counts; mid-p counts equally likely ones half
_MIDP = """hw AS (SELECT variant_id, het, hom_ref + het + hom_alt AS m, 2 * least(hom_ref, hom_alt) + het AS rare FROM counts_of),
    hs AS (SELECT *, (rare - h) / 2 AS hr FROM (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS h FROM hw)),
    hp AS (SELECT variant_id, m, h = het AS own, exp(h * ln(2) + lgamma(m + 1) - lgamma(hr + 1) - lgamma(h + 1) - lgamma(m - hr - h + 1)
                  + lgamma(rare + 1) + lgamma(2 * m - rare + 1) - lgamma(2 * m + 1)) AS w FROM hs),
    ho AS (SELECT *, max(CASE WHEN own THEN w END) OVER (PARTITION BY variant_id) AS o FROM hp),
    midp AS (SELECT variant_id, CASE WHEN max(m) = 0 THEN 1 ELSE least(1, sum(CASE WHEN w < o * (1 - 1e-7) THEN w WHEN w <= o * (1 + 1e-7) THEN w / 2 ELSE 0 END)) END AS p_hwe
             FROM ho GROUP BY variant_id)"""
EXACT_HWE = _MIDP.replace("midp AS", "plain AS").replace("WHEN w < o * (1 - 1e-7) THEN w WHEN w <= o * (1 + 1e-7) THEN w / 2 ELSE 0", "WHEN w <= o * (1 + 1e-7) THEN w ELSE 0")
_CALLED = f"""gs AS (SELECT sample_id FROM geno GROUP BY sample_id
                HAVING count(*) FILTER (dosage IS NULL) * 1.0 / count(*) <= 0.0435),
    kept AS (SELECT * FROM geno WHERE sample_id IN (SELECT sample_id FROM gs)),
    vs AS ({_VS} FROM kept GROUP BY variant_id),
    ex AS (SELECT *, h0 + h1 + h2 AS m, (2.0 * h0 + h1) / nullif(2.0 * (h0 + h1 + h2), 0) AS p FROM vs),
    chi AS (SELECT *, CASE WHEN m*p*p > 0 THEN pow(h0 - m*p*p, 2) / (m*p*p) ELSE 0 END
                    + CASE WHEN 2*m*p*(1-p) > 0 THEN pow(h1 - 2*m*p*(1-p), 2) / (2*m*p*(1-p)) ELSE 0 END
                    + CASE WHEN m*(1-p)*(1-p) > 0 THEN pow(h2 - m*(1-p)*(1-p), 2) / (m*(1-p)*(1-p)) ELSE 0 END AS chi2 FROM ex)"""
_HWE = f"""WITH {_CALLED}
    SELECT k.variant_id, k.sample_id, k.dosage FROM kept k JOIN chi c ON k.variant_id = c.variant_id
    WHERE c.fm <= 0.1 AND least(c.af, 1 - c.af) >= 0.3 AND c.chi2 <= {float(norm_ppf(0.05 / 2) ** 2)!r}"""


@query("f2_genotype_qc", _HWE)
def f2(t):
    return X.genotype_qc(t.geno(), mind=0.0435, missing=0.1, maf=0.3, hwe=0.05, exact=False)


@query("f2_genotype_qc_exact", f"""
    WITH {_CALLED}, counts_of AS (SELECT variant_id, h0 AS hom_ref, h1 AS het, h2 AS hom_alt FROM chi), {_MIDP}
    SELECT k.variant_id, k.sample_id, k.dosage FROM kept k JOIN chi c ON k.variant_id = c.variant_id JOIN midp e ON e.variant_id = k.variant_id
    WHERE c.fm <= 0.1 AND least(c.af, 1 - c.af) >= 0.3 AND e.p_hwe >= 0.05""")
def f2x(t):
    return X.genotype_qc(t.geno(), mind=0.0435, missing=0.1, maf=0.3, hwe=0.05)


_REC = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(l_suppkey % 22 + 1 AS VARCHAR) AS chrom, l_partkey AS pos,
                 CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS line_no,
                 CASE WHEN l_partkey % 3 = 0 THEN 'C,T' ELSE 'C' END AS alt FROM lineitem"""


def _rec(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        (F.col("l_suppkey") % 22 + 1).cast("string").alias("chrom"), F.col("l_partkey").alias("pos"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("line_no"),
        F.when(F.col("l_partkey") % 3 == 0, "C,T").otherwise("C").alias("alt"),
    )


@query("f3_biallelic", f"WITH r AS ({_REC}) SELECT * FROM r WHERE len(string_split(alt, ',')) = 1")
def f3(t):
    return X.biallelic(_rec(t))


@query("f4_first_per_position", f"""
    WITH r AS ({_REC})
    SELECT chrom, pos, min(line_no) AS line_no FROM r GROUP BY chrom, pos""")
def f4(t):
    return X.first_per_position(_rec(t)).select("chrom", "pos", "line_no")


@query("f5_chromosome", "SELECT * FROM variants WHERE chrom = '7'")
def f5(t):
    return X.on_chromosome(t.variants(), "7")


@query("f6_low_expression", """
    SELECT feature_id, sample_id, round(value, 6) AS value FROM pheno_na
    WHERE feature_id IN (SELECT feature_id FROM pheno_na GROUP BY feature_id
                         HAVING 100.0 * count(*) FILTER (value < 0.1) / count(*) <= 10)""")
def f6(t):
    return X.expressed(t.pheno_na()).withColumn("value", F.round("value", 6))


_VARY = """SELECT feature_id FROM {src} GROUP BY feature_id
           HAVING min(value) < max(value) AND count(DISTINCT value) * 1.0 / count(*) > 1 - 0.95"""


@query("f7_constant_features", f"""
    SELECT feature_id, sample_id, round(value, 6) AS value FROM pheno_na
    WHERE feature_id IN ({_VARY.format(src='pheno_na')})""")
def f7(t):
    return X.varying(t.pheno_na()).withColumn("value", F.round("value", 6))


@query("f8_missing_rate", """
    WITH m AS (SELECT feature_id, count(*) FILTER (value IS NULL) * 1.0 / count(*) AS rate FROM pheno_na GROUP BY feature_id)
    SELECT 'lenient' AS rule, feature_id FROM m WHERE rate <= 0.2
    UNION ALL SELECT 'strict', feature_id FROM m WHERE rate < 0.2""")
def f8(t):
    a = X.complete_enough(t.pheno_na()).select(F.lit("lenient").alias("rule"), "feature_id").distinct()
    b = X.complete_enough(t.pheno_na(), strict=True).select(F.lit("strict").alias("rule"), "feature_id").distinct()
    return a.unionByName(b)


@query("f9_validate_phenotypes", f"""
    WITH num AS (SELECT feature_id, sample_id, CASE WHEN sample_id = 13 THEN NULL ELSE value END AS value FROM pheno_na),
    full_s AS (SELECT * FROM num WHERE sample_id IN (SELECT sample_id FROM num GROUP BY sample_id HAVING count(value) > 0)),
    vary AS (SELECT * FROM full_s WHERE feature_id IN ({_VARY.format(src='full_s')}))
    SELECT feature_id, sample_id, round(value, 6) AS value FROM vary
    WHERE feature_id IN (SELECT feature_id FROM vary GROUP BY feature_id
                         HAVING count(*) FILTER (value IS NULL) * 1.0 / count(*) <= 0.2)""")
def f9(t):
    text = t.pheno_na().withColumn(
        "value", F.when(F.col("sample_id") == 13, "NA").otherwise(F.col("value").cast("string"))
    )
    return X.validate_phenotypes(text).withColumn("value", F.round("value", 6))


@query("f10_significant", """
    SELECT gene_id, variant_id, p_value, round(beta, 6) AS beta FROM (
      SELECT *, row_number() OVER (PARTITION BY gene_id, variant_id ORDER BY p_value, beta) AS k
      FROM (SELECT gene_id, variant_id, p_value, beta FROM assoc
            UNION ALL SELECT gene_id, variant_id, p_value, beta + 1 FROM assoc)
      WHERE p_value < 1e-5) WHERE k = 1""")
def f10(t):
    a = t.assoc().select("gene_id", "variant_id", "p_value", "beta")
    twice = a.unionByName(a.withColumn("beta", F.col("beta") + 1))
    return X.significant(twice).withColumn("beta", F.round("beta", 6))


@query("f11_region", """
    SELECT phenotype, variant_id, chrom, pos, round(-log10(p_value), 6) AS log10p FROM gwas
    WHERE chrom = '5' AND pos BETWEEN 8000000 - 3000000 AND 8000000 + 3000000""")
def f11(t):
    out = X.region(t.gwas(), "5", 8_000_000, 6_000_000)
    return out.select("phenotype", "variant_id", "chrom", "pos", F.round("log10p", 6).alias("log10p"))


_CT = """SELECT c_custkey AS sample_id, 'heavy' AS trait, 1000.0 / (1 + c_custkey % 97) AS value FROM customer
         UNION ALL SELECT c_custkey, 'cubic', pow(c_acctbal / 1000, 5) FROM customer
         UNION ALL SELECT c_custkey, 'plain', c_acctbal FROM customer"""


def customer_traits(t):
    wide = t.customer.select(
        F.col("c_custkey").alias("sample_id"),
        (1000.0 / (1 + F.col("c_custkey") % 97)).alias("heavy"),
        F.pow(F.col("c_acctbal") / 1000, 5.0).alias("cubic"),
        F.col("c_acctbal").alias("plain"),
    )
    return wide.unpivot("sample_id", ["heavy", "cubic", "plain"], "trait", "value")


def _out_sql(step: str, src: str, trait: str) -> str:
    return f"""{step}_s AS (SELECT avg(value) m, stddev_samp(value) s, quantile_cont(value, 0.25) a, quantile_cont(value, 0.75) b
                            FROM {src} WHERE trait = '{trait}'),
    {step}_b AS (SELECT sample_id FROM {src}, {step}_s WHERE trait = '{trait}' AND
                 (abs((value - m) / s) > 5 OR value < a - 3 * (b - a) OR value > b + 3 * (b - a))),
    {step} AS (SELECT * FROM {src} WHERE sample_id NOT IN (SELECT sample_id FROM {step}_b))"""


@query("f12_trait_outliers", f"""
    WITH ct AS ({_CT}), {_out_sql('s1', 'ct', 'heavy')}, {_out_sql('s2', 's1', 'cubic')}, {_out_sql('s3', 's2', 'plain')}
    SELECT sample_id, trait, round(value, 4) AS value FROM s3""")
def f12(t):
    out = X.remove_trait_outliers(customer_traits(t), ["heavy", "cubic", "plain"])
    return out.withColumn("value", F.round("value", 4))


@query("f13_valid_p", """
    SELECT gene_id, variant_id, CAST(gene_id - variant_id % 7 AS DOUBLE) / 20 AS p_value FROM assoc
    WHERE CAST(gene_id - variant_id % 7 AS DOUBLE) / 20 > 0 AND CAST(gene_id - variant_id % 7 AS DOUBLE) / 20 <= 1""")
def f13(t):
    p = (F.col("gene_id") - F.col("variant_id") % 7).cast("double") / 20
    return X.valid_p(t.assoc().select("gene_id", "variant_id", p.alias("p_value")))


@query("f14_usable_covariates", """
    SELECT covariate, sample_id, value FROM covlong WHERE covariate IN (
      SELECT covariate FROM covlong WHERE covariate IN ('age', 'batch', 'study_site', 'bmi')
      GROUP BY covariate HAVING count(DISTINCT value) > 1)""")
def f14(t):
    return X.usable_covariates(t.covlong(), ["age", "batch", "study_site", "bmi"])


_CR = """CASE WHEN try_cast(replace({c}, 'chr', '') AS INTEGER) BETWEEN 1 AND 22 THEN try_cast(replace({c}, 'chr', '') AS INTEGER)
              WHEN replace({c}, 'chr', '') = 'X' THEN 23 WHEN replace({c}, 'chr', '') = 'Y' THEN 24
              WHEN replace({c}, 'chr', '') IN ('M', 'MT') THEN 25 ELSE 26 END"""


@query("t1_genome_sort", f"""
    SELECT gene_id, chrom, gstart, gend, {_CR.format(c='chrom')} AS chrom_rank
    FROM (SELECT gene_id, gstart, gend, CASE chrom WHEN '20' THEN 'chrX' WHEN '21' THEN 'MT' WHEN '22' THEN 'chrUn' ELSE 'chr' || chrom END AS chrom FROM genes)
    ORDER BY chrom_rank, gstart, gend""")
def t1(t):
    named = F.when(F.col("chrom") == "20", "chrX").when(F.col("chrom") == "21", "MT").when(
        F.col("chrom") == "22", "chrUn").otherwise(F.concat(F.lit("chr"), "chrom"))
    g = t.genes().withColumn("chrom", named).drop("strand")
    g = g.withColumn("chrom_rank", R.chrom_rank(F.col("chrom")))
    return R.sort_bed(g, start="gstart", end="gend")


@query("t2_top_variance", """
    SELECT feature_id, sample_id, round(value, 6) AS value FROM pheno WHERE feature_id IN (
      SELECT feature_id FROM pheno GROUP BY feature_id ORDER BY var_samp(value) DESC, feature_id LIMIT 50)""")
def t2(t):
    return R.top_variance(t.pheno(), 50).withColumn("value", F.round("value", 6))


@query("t3_top_hits", "SELECT gene_id, variant_id, p_value FROM assoc ORDER BY p_value, gene_id, variant_id LIMIT 100")
def t3(t):
    return R.top_hits(t.assoc(), 100, "gene_id", "variant_id").select("gene_id", "variant_id", "p_value")


@query("t3_top_hits_by_phenotype", """
    SELECT phenotype, variant_id, round(p_value, 12) AS p_value FROM (
      SELECT *, row_number() OVER (PARTITION BY phenotype ORDER BY p_value, variant_id) AS k FROM gwas) WHERE k <= 3""")
def t3b(t):
    out = R.top_hits_by(t.gwas(), ["phenotype"], 3, "variant_id")
    return out.select("phenotype", "variant_id", F.round("p_value", 12).alias("p_value"))


@query("t4_head", """
    SELECT phenotype, variant_id, round(p_value, 12) AS p_value FROM gwas ORDER BY gwas.p_value, phenotype, variant_id LIMIT 50""")
def t4(t):
    out = R.top_hits(t.gwas(), 50, "phenotype", "variant_id")
    return out.select("phenotype", "variant_id", F.round("p_value", 12).alias("p_value"))


@query("t5_downsample_keep_hits", """
    WITH c AS (SELECT count(*) FILTER (p_value <= 5e-8) AS s, count(*) FILTER (p_value > 5e-8) AS r FROM gwas),
    q AS (SELECT chrom, CASE WHEN max(r) > greatest(2000 - max(s), 0)
                             THEN floor(count(*) * greatest(2000 - max(s), 0) / max(r)) ELSE count(*) END AS quota
          FROM gwas, c WHERE p_value > 5e-8 GROUP BY chrom),
    k AS (SELECT g.*, row_number() OVER (PARTITION BY g.chrom ORDER BY md5(phenotype || '|' || CAST(variant_id AS VARCHAR))) AS rn
          FROM gwas g WHERE p_value > 5e-8)
    SELECT phenotype, variant_id, chrom, pos FROM gwas WHERE p_value <= 5e-8
    UNION ALL
    SELECT phenotype, variant_id, k.chrom, pos FROM k JOIN q ON k.chrom = q.chrom WHERE rn <= quota""")
def t5(t):
    out = R.downsample_hits(t.gwas(), 2000, "phenotype", "variant_id")
    return out.select("phenotype", "variant_id", "chrom", "pos")


@query("t6_hash_sample", """
    SELECT gene_id, variant_id FROM assoc
    ORDER BY md5(CAST(gene_id AS VARCHAR) || '|' || CAST(variant_id AS VARCHAR)) LIMIT 1000""")
def t6(t):
    key = F.concat_ws("|", F.col("gene_id").cast("string"), F.col("variant_id").cast("string"))
    return R.hash_sample(t.assoc().select("gene_id", "variant_id"), [], key, 1000)
