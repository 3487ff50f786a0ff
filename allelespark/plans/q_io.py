"""Registered queries: readers (S) and writers (K).

Input files are derived from the given tables, written as text, and read back by the reader.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.operators import finemap as FM
from allelespark.operators import joins as J
from allelespark.operators import qc as Q
from allelespark.operators.multitest import qvalues
from allelespark.plans.fixtures import COHORT, whole
from allelespark.plans.q_qc import rnd
from allelespark.plans.q_window import _FIN, _HITS, _SETS
from allelespark.plans.registry import query
from allelespark.session import materialize
from allelespark.sources import readers as R
from allelespark.sources import sinks as K


def text(t, name, body, head=None, path=None):
    """Write ``body`` (value, _o) below header lines, in order and in several parts, and return the folder."""
    df = body.select(F.lit(len(head or [])).alias("_k"), F.col("_o").cast("string").alias("_o"), "value")
    for i, h in enumerate(head or []):
        line = t.spark.range(1).select(F.lit(h).alias("value"))
        df = line.select(F.lit(i).alias("_k"), F.lit("").alias("_o"), "value").unionByName(df)
    parts = max(4, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.repartitionByRange(parts, "_k", "_o").sortWithinPartitions("_k", "_o").select("value")
    return K.write_lines(rows, path or K.scratch(t.spark, name), gzip=False)


def both_orders(t, name, body, head, line):
    """Two inputs below one folder: rows of even ``_n`` with samples in order, of odd ``_n`` with samples reversed.

    ``line(flip)`` is a row's text, ``head(flip)`` are the header lines.
    """
    base = K.scratch(t.spark, name)
    for flip in (False, True):
        rows = body.where((F.col("_n") % 2 == 1) == flip).select("_o", line(flip).alias("value"))
        text(t, name, rows, head(flip), f"{base}/{int(flip)}")
    return f"{base}/*"


def samples(flip):
    return F.sequence(F.lit(COHORT - 1), F.lit(0)) if flip else F.sequence(F.lit(0), F.lit(COHORT - 1))


def names(flip):
    return [f"S{i}" for i in (reversed(range(COHORT)) if flip else range(COHORT))]


def vcf_file(t):
    """Genotypes as VCF: GT:DS for odd variants, GT only for even ones."""
    g, v = t.geno(), F.col("variant_id")
    d = F.col("dosage").cast("int")
    gt = F.when(d.isNull(), "./.").when(d == 0, "0|0").when(d == 1, "0|1").otherwise("1|1")
    cell = F.when(v % 2 == 1, F.concat(gt, F.lit(":"), F.coalesce(F.col("dosage").cast("string"), F.lit(".")))).otherwise(gt)
    per = g.groupBy("variant_id").agg(F.collect_list(F.struct(F.col("sample_id").cast("int").alias("s"), cell.alias("c"))).alias("m"))
    per = per.withColumn("m", F.map_from_entries("m"))
    # written once for both orders and their ranges; in the lines' plan the map would be made anew for every sample
    body = materialize(per.join(t.variants(), "variant_id").select("*", F.format_string("%012d", v).alias("_o"), v.alias("_n")))

    def line(flip):
        row = F.transform(samples(flip), lambda i: F.coalesce(F.col("m")[i], F.lit("./.")))
        return F.concat_ws(
            "\t", F.concat(F.lit("chr"), "chrom"), F.col("pos").cast("string"), F.concat(F.lit("rs"), v.cast("string")), F.lit("A"),
            F.lit("G"), F.col("qual").cast("int").cast("string"), F.lit("PASS"),
            F.concat(F.lit("AF=0."), (v % 90 + 10).cast("string"), F.lit(";R2="), F.when(v % 7 == 0, ".").otherwise("0.9")),
            F.when(v % 2 == 1, "GT:DS").otherwise("GT"), F.array_join(row, "\t"))

    fixed = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"
    return both_orders(t, "vcf", body, lambda flip: ["##fileformat=VCFv4.2", "\t".join([fixed, *names(flip)])], line)


_ALLCELLS = f"""SELECT 'rs' || CAST(v.variant_id AS VARCHAR) AS variant_id, 'S' || CAST(s AS VARCHAR) AS sample_id, 'chr' || v.chrom AS chrom, v.pos,
    g.dosage FROM (SELECT * FROM variants WHERE variant_id IN (SELECT variant_id FROM geno)) v CROSS JOIN range({COHORT}) r(s)
    LEFT JOIN geno g ON g.variant_id = v.variant_id AND g.sample_id = s"""


@query("s1_vcf_scan", _ALLCELLS)
def s1(t):
    return R.vcf_long(t.spark, vcf_file(t)).select("variant_id", "sample_id", "chrom", "pos", "dosage")


@query("s1_vcf_dosage_rows", f"SELECT variant_id, count(dosage) AS n_called, sum(dosage) AS total FROM ({_ALLCELLS}) GROUP BY variant_id")
def s1b(t):
    v = R.vcf_dosages(t.spark, vcf_file(t))
    called = F.filter("dosages", lambda d: d.isNotNull())
    total = F.when(F.size(called) > 0, F.aggregate(called, F.lit(0.0), lambda a, d: a + d))
    return v.select("variant_id", F.size(called).cast("bigint").alias("n_called"), total.alias("total"))


@query("s2_info_fields", """
    SELECT 'rs' || CAST(variant_id AS VARCHAR) AS variant_id, CAST('0.' || CAST(variant_id % 90 + 10 AS VARCHAR) AS DOUBLE) AS af,
           CASE WHEN variant_id % 7 = 0 THEN NULL ELSE CAST(0.9 AS DOUBLE) END AS r2 FROM variants WHERE variant_id IN (SELECT variant_id FROM geno)""")
def s2(t):
    v = R.vcf_fixed(R.lines(t.spark, vcf_file(t)))
    return v.select("variant_id", R.info_field(F.col("info"), "AF").cast("double").alias("af"), R.info_field(F.col("info"), "R2").cast("double").alias("r2"))


def matrix_file(t, sep="\t"):
    s = F.col("sample_id")
    cell = F.when((F.col("feature_id") + s) % 19 == 0, "bad").otherwise(F.col("value").cast("string"))
    per = t.counts().groupBy("feature_id").agg(F.collect_list(F.struct(s.cast("int").alias("s"), cell.alias("c"))).alias("m"))
    body = per.select("m", F.format_string("%012d", "feature_id").alias("_o"), F.col("feature_id").alias("_n"))

    def line(flip):
        row = F.transform(samples(flip), lambda i: F.coalesce(F.map_from_entries("m")[i], F.lit("NA")))
        return F.concat_ws(sep, F.concat(F.lit("G"), F.col("_n").cast("string")), F.array_join(row, sep))

    return both_orders(t, "matrix", body, lambda flip: [sep.join(["gene_id", *names(flip)])], line)


_MAT = f"""SELECT 'G' || CAST(f AS VARCHAR) AS feature_id, 'S' || CAST(s AS VARCHAR) AS sample_id,
    CASE WHEN (f + s) % 19 = 0 THEN NULL ELSE value END AS value
    FROM (SELECT DISTINCT feature_id AS f FROM counts) CROSS JOIN range({COHORT}) r(s) LEFT JOIN counts c ON c.feature_id = f AND c.sample_id = s"""


@query("s3_wide_matrix", _MAT)
def s3(t):
    return R.wide_matrix(t.spark, matrix_file(t))


@query("s4_sniffed_table", """
    SELECT CAST(variant_id AS VARCHAR) AS "SNP", CASE WHEN variant_id % 5 = 0 THEN NULL ELSE phenotype END AS "PHENO", chrom AS "CHR" FROM gwas""")
def s4(t):
    v = F.col("variant_id")
    body = t.gwas().select(v.cast("string").alias("_o"), F.concat_ws(",", v.cast("string"), F.when(v % 5 != 0, F.col("phenotype")).otherwise("NA"), "chrom").alias("value"))
    return R.delimited(t.spark, text(t, "table", body, ["SNP,PHENO,CHR"]))


_RES = "SELECT gene_id, variant_id, p_value FROM assoc"


@query("s5_result_table", f"SELECT 'parquet' AS source, gene_id, variant_id, round(p_value, 9) AS p_value FROM assoc UNION ALL SELECT 'tsv', gene_id, variant_id, round(p_value, 9) FROM assoc")
def s5(t):
    base = K.scratch(t.spark, "results")
    raw = t.assoc().select("gene_id", "variant_id", F.col("p_value").alias("pval"))
    raw.write.parquet(f"{base}/a.parquet")
    raw.write.csv(f"{base}/a.tsv", sep="\t", header=True)
    a = R.results(t.spark, f"{base}/a.parquet").withColumn("source", F.lit("parquet"))
    b = R.results(t.spark, f"{base}/a.tsv").withColumn("source", F.lit("tsv"))
    b = b.withColumns({c: F.col(c).cast("bigint") for c in ("gene_id", "variant_id")})
    return rnd(a.unionByName(b, allowMissingColumns=True).select("source", "gene_id", "variant_id", "p_value"), "p_value", digits=9)


@query("s6_nominal_pairs", "SELECT phenotype, variant_id, chrom FROM gwas")
def s6(t):
    base = K.scratch(t.spark, "pairs")
    t.gwas().select("phenotype", "variant_id", F.col("chrom").alias("cis_qtl_pairs")).write.partitionBy("cis_qtl_pairs").parquet(base)
    return R.nominal_pairs(t.spark, f"{base}/cis_qtl_pairs=*").select("phenotype", "variant_id", "chrom")


@query("s7_bed", "SELECT 'chr' || chrom AS chrom, gstart, gend, 'G' || CAST(gene_id AS VARCHAR) AS gene_id, strand FROM genes")
def s7(t):
    body = t.genes().select(F.format_string("%012d", "gene_id").alias("_o"), F.concat_ws(
        "\t", F.concat(F.lit("chr"), "chrom"), F.col("gstart").cast("string"), F.col("gend").cast("string"),
        F.concat(F.lit("G"), F.col("gene_id").cast("string")), "strand").alias("value"))
    return R.bed(t.spark, text(t, "bed", body, ["chr\tstart\tend\tgene_id\tstrand"]))


@query("s8_gtf_genes", """
    SELECT 'chr' || chrom AS chrom, CASE WHEN strand = '+' THEN gstart + 5 ELSE gend END AS gstart, CASE WHEN strand = '+' THEN gstart + 5 ELSE gend END + 1 AS gend,
           'ENSG' || CAST(gene_id AS VARCHAR) AS gene_id, strand, 'N' || CAST(gene_id AS VARCHAR) AS gene_name, 'protein_coding' AS gene_type
    FROM genes WHERE gene_id % 4 <> 3""")
def s8(t):
    g = F.col("gene_id")

    def rows(kind, shift, order):
        kind_col = F.when(g % 4 == 3, "lncRNA").otherwise("protein_coding")
        attrs = F.concat(F.lit('gene_id "ENSG'), g.cast("string"), F.lit('.3"; gene_type "'), kind_col, F.lit('"; gene_name "N'), g.cast("string"), F.lit('";'))
        return t.genes().select(F.concat(F.lit(order), F.format_string("%012d", g)).alias("_o"), F.concat_ws(
            "\t", F.concat(F.lit("chr"), "chrom"), F.lit("SRC"), F.lit(kind), (F.col("gstart") + shift).cast("string"), F.col("gend").cast("string"),
            F.lit("."), "strand", F.lit("."), attrs).alias("value"))

    body = rows("gene", 0, "a").unionByName(rows("exon", 2, "b")).unionByName(rows("gene", 5, "c"))
    return R.gtf(t.spark, text(t, "gtf", body, ["##format: gtf"]))


@query("s9_eigenvectors", """
    SELECT 'F' || CAST(sample_id AS VARCHAR) AS "FID", 'S' || CAST(sample_id AS VARCHAR) AS "IID", CAST(sample_id * 2 AS DOUBLE) AS "PC1", CAST(sex AS DOUBLE) AS "PC2" FROM covar""")
def s9(t):
    s = F.col("sample_id").cast("string")
    body = t.covar().select(s.alias("_o"), F.concat_ws(" ", F.concat(F.lit("F"), s), F.concat(F.lit("S"), s, F.lit("_x")), (F.col("sample_id") * 2).cast("string"), F.col("sex").cast("string")).alias("value"))
    return R.eigenvectors(t.spark, text(t, "eigenvec", body, ["#FID IID PC1 PC2"]), 5)


@query("s10_encoded_table", "SELECT CAST(s_suppkey AS VARCHAR) AS id, 'é' || s_name AS name FROM supplier")
def s10(t):
    body = t.supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit("é"), "s_name").alias("name"))
    path = K.scratch(t.spark, "latin")
    body.write.csv(path, sep="\t", header=True, encoding="ISO-8859-1")
    return R.encoded_table(t.spark, path)


@query("s11_batch_design", """
    SELECT src, 'S' || CAST(sample_id AS VARCHAR) AS sample_id, covariate, value FROM (
      SELECT sample_id, 'Batch' AS covariate, 'b' || CAST(batch AS VARCHAR) AS value FROM covar UNION ALL SELECT sample_id, 'Sex', CAST(sex AS VARCHAR) FROM covar),
      (SELECT 'samples' AS src UNION ALL SELECT 'covariates')""")
def s11(t):
    c = t.covar().select(F.concat(F.lit("S"), F.col("sample_id").cast("string")).alias("s"), F.concat(F.lit("b"), F.col("batch").cast("string")).alias("b"),
                         F.col("sex").cast("string").alias("x"))
    up = text(t, "design", c.select(F.col("s").alias("_o"), F.concat_ws("\t", "s", "b", "x").alias("value")), ["sample_id\tBatch\tSex"])
    cov = c.unpivot("s", ["b", "x"], "n", "value").withColumn("covariate", F.when(F.col("n") == "b", "Batch").otherwise("Sex"))
    side = K.write_lines(K.covariate_matrix(cov.select("covariate", F.col("s").alias("sample_id"), "value")), K.scratch(t.spark, "design"), gzip=False)
    # the writer labels the first column "id", which marks sample rows; a covariate file has another label
    swapped = R.lines(t.spark, side).select(F.regexp_replace("value", "^id\t", "covariate\t").alias("value"))
    side2 = K.write_lines(swapped.coalesce(1), K.scratch(t.spark, "design"), gzip=False)
    a = R.batch_design(t.spark, up).withColumn("src", F.lit("samples"))
    return a.unionByName(R.batch_design(t.spark, side2).withColumn("src", F.lit("covariates")))


@query("s12_fam_bim", """
    SELECT 'fam' AS source, CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey % 2 + 1 AS BIGINT) AS number FROM customer
    UNION ALL SELECT 'bim', CAST(variant_id AS VARCHAR), pos FROM variants""")
def s12(t):
    k = F.col("c_custkey").cast("string")
    f = t.customer.select(k.alias("_o"), F.concat_ws(" ", F.lit("F"), k, F.lit("0"), F.lit("0"), (F.col("c_nationkey") % 2 + 1).cast("string"), F.lit("-9")).alias("value"))
    v = F.col("variant_id").cast("string")
    b = t.variants().select(v.alias("_o"), F.concat_ws("\t", "chrom", v, F.lit("0"), F.col("pos").cast("string"), F.lit("A"), F.lit("G")).alias("value"))
    fam = R.fam(t.spark, text(t, "fam", f)).select(F.lit("fam").alias("source"), F.col("sample_id").alias("id"), F.col("sex").cast("bigint").alias("number"))
    bim = R.bim(t.spark, text(t, "bim", b)).select(F.lit("bim").alias("source"), F.col("variant_id").alias("id"), F.col("pos").alias("number"))
    return fam.unionByName(bim)


@query("s13_tolerant_covariates", """
    SELECT covariate, 'SAMP' || CAST(sample_id AS VARCHAR) AS sample_id, value FROM (
      SELECT sample_id, 'batch' AS covariate, 'b' || CAST(batch AS VARCHAR) AS value FROM covar
      UNION ALL SELECT sample_id, 'sex', CASE WHEN sample_id % 6 = 1 THEN NULL ELSE CAST(sex AS VARCHAR) END FROM covar)""")
def s13(t):
    s = F.concat(F.lit("SAMP"), F.col("sample_id").cast("string"))
    c = t.covar().select(s.alias("sample_id"), F.concat(F.lit("b"), F.col("batch").cast("string")).alias("batch"),
                         F.when(F.col("sample_id") % 6 == 1, "NA").otherwise(F.col("sex").cast("string")).alias("sex"))
    long = c.unpivot("sample_id", ["batch", "sex"], "covariate", "value")
    body = K.covariate_matrix(long).select(F.when(F.startswith("value", F.lit("id\t")), "0").otherwise("1").alias("_o"), F.replace("value", F.lit("\t"), F.lit(",")).alias("value"))
    junk = t.spark.range(1).select(F.lit("2").alias("_o"), F.lit("broken,1,2").alias("value"))
    return R.tolerant_covariates(t.spark, text(t, "tolerant", body.unionByName(junk), ["made,by,a,lab,tool"]))


@query("s14_input_samples", f"""
    SELECT 'vcf' AS kind, 'S' || CAST(s AS VARCHAR) AS sample_id FROM range({COHORT}) r(s)
    UNION ALL SELECT 'matrix', 'S' || CAST(s AS VARCHAR) FROM range({COHORT}) r(s)
    UNION ALL SELECT 'fam', CAST(c_custkey AS VARCHAR) FROM customer""")
def s14(t):
    k = F.col("c_custkey").cast("string")
    f = t.customer.select(k.alias("_o"), F.concat_ws(" ", F.lit("F"), k, F.lit("0 0 1 -9")).alias("value"))
    parts = [("vcf", vcf_file(t)), ("matrix", matrix_file(t)), ("fam", text(t, "fam", f))]
    out = None
    for kind, path in parts:
        d = R.input_samples(t.spark, path, kind).select(F.lit(kind).alias("kind"), "sample_id")
        out = d if out is None else out.unionByName(d)
    return out


@query("k1_results_and_hits", """
    SELECT 'all' AS part, count(*) AS n FROM assoc UNION ALL SELECT 'significant', count(*) FROM (
      SELECT min(p_value * n / rk) OVER (ORDER BY p_value DESC ROWS UNBOUNDED PRECEDING) AS f FROM (
        SELECT p_value, count(*) OVER () AS n, row_number() OVER (ORDER BY p_value) AS rk FROM assoc)) WHERE f * (SELECT least(1, count(*) FILTER (p_value > 0.5) * 2.0 / count(*)) FROM assoc) < 0.05""")
def k1(t):
    full, hits = K.write_results(qvalues(t.assoc(), lam=0.5), K.scratch(t.spark, "qtl"))
    n = lambda p, tag: t.spark.read.csv(p, sep="\t", header=True).agg(F.lit(tag).alias("part"), F.count(F.lit(1)).alias("n"))
    return n(full, "all").unionByName(n(hits, "significant"))


@query("k2_nominal_by_chromosome", "SELECT phenotype, variant_id, chrom, pos FROM gwas")
def k2(t):
    path = K.write_nominal(t.gwas().select("phenotype", "variant_id", "chrom", "pos"), K.scratch(t.spark, "nominal"))
    return t.spark.read.parquet(path).withColumn("chrom", F.col("chrom").cast("string"))


@query("k3_phenotype_bed", f"""
    SELECT g.chrom || chr(9) || CAST(gstart AS VARCHAR) || chr(9) || CAST(gend AS VARCHAR) || chr(9) || CAST(feature_id AS VARCHAR) || chr(9) ||
           string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), chr(9) ORDER BY sample_id) AS value
    FROM counts c JOIN genes g ON g.gene_id = c.feature_id GROUP BY g.chrom, gstart, gend, feature_id
    UNION ALL SELECT '#chr' || chr(9) || 'start' || chr(9) || 'end' || chr(9) || 'phenotype_id' || chr(9) || string_agg(CAST(s AS VARCHAR), chr(9) ORDER BY s) FROM range({COHORT}) r(s)""")
def k3(t):
    rows = J.with_coordinates(t.counts(), t.genes())
    return R.lines(t.spark, K.write_lines(K.phenotype_bed(rows, whole("value").cast("string")), K.scratch(t.spark, "phenobed")))


@query("k4_covariate_matrix", """
    SELECT covariate || chr(9) || string_agg(coalesce(value, 'NA'), chr(9) ORDER BY sample_id) AS value FROM covlong GROUP BY covariate
    UNION ALL SELECT 'id' || chr(9) || string_agg(CAST(sample_id AS VARCHAR), chr(9) ORDER BY sample_id) FROM covar""")
def k4(t):
    return R.lines(t.spark, K.write_lines(K.covariate_matrix(t.covlong()), K.scratch(t.spark, "covar")))


@query("k5_sample_lists", """
    SELECT 'genotype' AS dataset, CAST(sample_id AS VARCHAR) AS value FROM (SELECT DISTINCT sample_id FROM geno)
    UNION ALL SELECT 'expression', CAST(sample_id + 11 AS VARCHAR) FROM (SELECT DISTINCT sample_id FROM pheno)
    UNION ALL SELECT 'common', CAST(sample_id AS VARCHAR) FROM (SELECT sample_id FROM geno INTERSECT SELECT sample_id + 11 FROM pheno)""")
def k5(t):
    sets = {"genotype": t.geno(), "expression": t.pheno().withColumn("sample_id", F.col("sample_id") + 11)}
    paths = K.write_sample_lists(sets, K.scratch(t.spark, "samples"))
    out = None
    for name, p in paths.items():
        d = R.lines(t.spark, p).select(F.lit(name).alias("dataset"), "value")
        out = d if out is None else out.unionByName(d)
    return out


@query("k6_json_summary", """
    SELECT coalesce(phenotype, 'all') AS phenotype, count(*) AS n_rows, count(*) FILTER (p_value < 1e-5) AS hits_1e5 FROM gwas GROUP BY ROLLUP (phenotype)""")
def k6(t):
    from allelespark.operators.summary import hit_counts

    return t.spark.read.json(K.write_summary(hit_counts(t.gwas()), K.scratch(t.spark, "summary"))).select("phenotype", "n_rows", "hits_1e5")


@query("k7_credible_sets", f"""
    WITH {_HITS}, {_FIN}, {_SETS} SELECT gene_id, set_index, set_rank, variant_id FROM cs""")
def k7(t):
    path = K.write_credible_sets(FM.fine_map(t.assoc(), "finemap"), K.scratch(t.spark, "sets"))
    df = t.spark.read.csv(path, sep="\t", header=True)
    return df.select(F.col("gene_id").cast("bigint").alias("gene_id"), F.col("set_index").cast("int").alias("set_index"),
                     F.col("set_rank").cast("bigint").alias("set_rank"), F.col("variant_id").cast("bigint").alias("variant_id"))
