"""Registered queries: joins (J) and set operations (U)."""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.operators import joins as J
from allelespark.plans.registry import query


def shifted(df, k):
    """The same cohort under ids moved by ``k``, so that sample sets differ at both ends."""
    return df.withColumn("sample_id", F.col("sample_id") + k)


@query("j1_align_samples", """
    WITH g AS (SELECT DISTINCT sample_id FROM geno), c AS (SELECT DISTINCT sample_id + 7 AS sample_id FROM covar)
    SELECT feature_id, CAST(sample_id + 3 AS VARCHAR) AS sample_id, round(value, 6) AS value FROM pheno
    WHERE sample_id + 3 IN (SELECT sample_id FROM g) AND sample_id + 3 IN (SELECT sample_id FROM c)""")
def j1(t):
    p = J.align_samples(t.geno(), shifted(t.pheno(), 3), shifted(t.covar(), 7))[1]
    return p.withColumn("value", F.round("value", 6))


@query("j2_feature_positions", """
    WITH f AS (SELECT DISTINCT feature_id + 37 AS feature_id FROM pheno),
    a AS (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY gstart, gend) AS k FROM (
            SELECT gene_id, chrom, gstart, gend, strand FROM genes
            UNION ALL SELECT gene_id, chrom, gstart + 5, gend, strand FROM genes))
    SELECT f.feature_id, coalesce(chrom, '1') AS chrom, coalesce(gstart, 1) AS gstart,
           coalesce(gend, 1000) AS gend, coalesce(strand, '+') AS strand
    FROM f LEFT JOIN a ON a.gene_id = f.feature_id AND a.k = 1""")
def j2(t):
    g = t.genes()
    both = g.unionByName(g.withColumn("gstart", F.col("gstart") + 5))
    return J.feature_positions(t.pheno().select((F.col("feature_id") + 37).alias("feature_id")), both)


@query("j3_with_coordinates", """
    SELECT g.chrom, g.gstart, g.gend, g.strand, p.feature_id, p.sample_id, round(p.value, 6) AS value
    FROM pheno p JOIN genes g ON g.gene_id = p.feature_id""")
def j3(t):
    return J.with_coordinates(t.pheno(), t.genes()).withColumn("value", F.round("value", 6))


@query("j4_cis_window", """
    SELECT v.variant_id, g.gene_id, v.chrom, v.pos, g.gstart, g.gend FROM variants v JOIN genes g
    ON v.chrom = g.chrom AND v.pos BETWEEN g.gstart - 1000000 AND g.gend + 1000000""")
def j4(t):
    return J.window_pairs(t.variants(), t.genes()).select("variant_id", "gene_id", "chrom", "pos", "gstart", "gend")


@query("j6_drop_cis", """
    SELECT a.gene_id, a.variant_id FROM assoc a JOIN variants v ON v.variant_id = a.variant_id
    JOIN genes g ON g.gene_id = a.gene_id
    WHERE v.chrom <> g.chrom OR abs(v.pos - CASE WHEN g.strand = '+' THEN g.gstart ELSE g.gend END) > 5000000""")
def j6(t):
    v = t.variants().select("variant_id", F.col("chrom").alias("v_chrom"), "pos")
    tss = F.when(F.col("strand") == "+", F.col("gstart")).otherwise(F.col("gend"))
    g = t.genes().select("gene_id", F.col("chrom").alias("g_chrom"), tss.alias("tss"))
    pairs = t.assoc().select("gene_id", "variant_id").join(v, "variant_id").join(g, "gene_id")
    return J.drop_cis(pairs).select("gene_id", "variant_id")


@query("j7_sample_map", """
    WITH m AS (SELECT 'R' || CAST(sample_id AS VARCHAR) AS old_id,
                      CASE WHEN sample_id % 8 = 5 THEN NULL ELSE 'W' || CAST(sample_id AS VARCHAR) END AS new_id FROM covar)
    SELECT p.feature_id, m.new_id AS sample_id, round(p.value, 6) AS value
    FROM pheno p JOIN m ON m.old_id = 'R' || CAST(p.sample_id AS VARCHAR) WHERE m.new_id IS NOT NULL""")
def j7(t):
    s = F.col("sample_id").cast("string")
    m = t.covar().select(
        F.concat(F.lit(" R"), s, F.lit(".0_lib1")).alias("rna"),
        F.when(F.col("sample_id") % 8 != 5, F.concat(F.lit("W"), s, F.lit("_a"))).alias("wgs"),
    )
    long = t.pheno().withColumn("sample_id", F.concat(F.lit("R"), s, F.lit("_x")))
    return J.map_samples(long, m, "rna", "wgs").withColumn("value", F.round("value", 6))


@query("j8_assemble_covariates", """
    WITH meta AS (SELECT c_custkey % 60 AS sample_id, c_custkey AS line_no,
                         CASE WHEN c_custkey % 60 % 13 = 2 THEN NULL ELSE c_acctbal END AS bal, c_mktsegment AS site FROM customer),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY line_no) AS n FROM meta
                         WHERE sample_id IN (SELECT sample_id FROM pheno)) WHERE n = 1 AND bal IS NOT NULL)
    SELECT k.sample_id, k.line_no, k.bal, k.site, round(p.rin, 6) AS pc1
    FROM k LEFT JOIN (SELECT sample_id + 5 AS sample_id, rin FROM covar) p ON p.sample_id = k.sample_id""")
def j8(t):
    key = F.col("c_custkey")
    meta = t.customer.select(
        (key % 60).alias("sample_id"), key.alias("line_no"),
        F.when(key % 60 % 13 != 2, F.col("c_acctbal")).alias("bal"), F.col("c_mktsegment").alias("site"),
    )
    pcs = shifted(t.covar(), 5).select("sample_id", F.round("rin", 6).alias("pc1"))
    return J.assemble_covariates(meta, t.pheno(), pcs, ["line_no"])


@query("j9_overlap_report", """
    SELECT coalesce(a.sample_id, b.sample_id) AS sample_id,
           CASE WHEN b.sample_id IS NULL THEN 'left_only' WHEN a.sample_id IS NULL THEN 'right_only' ELSE 'common' END AS side
    FROM (SELECT DISTINCT sample_id FROM geno) a
    FULL JOIN (SELECT DISTINCT sample_id + 11 AS sample_id FROM pheno) b ON a.sample_id = b.sample_id""")
def j9(t):
    return J.overlap_report(t.geno(), shifted(t.pheno(), 11))


@query("j10_membership", """
    SELECT s.sample_id, coalesce((CASE WHEN c.sample_id IS NULL THEN '' ELSE 'covariates' END)
           || (CASE WHEN c.sample_id IS NOT NULL AND p.sample_id IS NOT NULL THEN ',' ELSE '' END)
           || (CASE WHEN p.sample_id IS NULL THEN '' ELSE 'expression' END), '') AS datasets
    FROM (SELECT DISTINCT sample_id FROM geno) s
    LEFT JOIN (SELECT DISTINCT sample_id + 11 AS sample_id FROM pheno) p ON p.sample_id = s.sample_id
    LEFT JOIN (SELECT sample_id + 25 AS sample_id FROM covar) c ON c.sample_id = s.sample_id""")
def j10(t):
    return J.membership(t.geno(), {"expression": shifted(t.pheno(), 11), "covariates": shifted(t.covar(), 25)})


@query("j11_align_design", """
    WITH d AS (SELECT sample_id + 4 AS sample_id, batch, CASE WHEN sample_id % 9 = 4 THEN NULL ELSE rin END AS rin FROM covar),
    k AS (SELECT * FROM d WHERE sample_id IN (SELECT sample_id FROM pheno))
    SELECT sample_id, batch, round(coalesce(rin, (SELECT avg(rin) FROM k)), 6) AS rin FROM k""")
def j11(t):
    d = t.covar().select("sample_id", "batch", F.when(F.col("sample_id") % 9 != 4, F.col("rin")).alias("rin"))
    _, design = J.align_design(t.pheno(), shifted(d, 4), ["rin"])
    return design.select("sample_id", "batch", F.round("rin", 6).alias("rin"))


@query("j12_subset_samples", """
    SELECT variant_id, sample_id, dosage FROM geno WHERE sample_id IN (SELECT sample_id + 20 FROM covar)""")
def j12(t):
    return J.subset_samples(t.geno(), shifted(t.covar(), 20))


@query("j13_genes_in_locus", """
    SELECT l.variant_id, g.gene_id, g.gstart, g.gend
    FROM (SELECT variant_id, chrom, pos - 250000 AS lo, pos + 250000 AS hi FROM variants) l
    JOIN genes g ON g.chrom = l.chrom AND g.gstart <= l.hi AND g.gend >= l.lo""")
def j13(t):
    loci = t.variants().select("variant_id", "chrom", (F.col("pos") - 250000).alias("lo"), (F.col("pos") + 250000).alias("hi"))
    return J.overlapping_genes(loci, t.genes(), width=100_000).select("variant_id", "gene_id", "gstart", "gend")


@query("j14_rename_samples", """
    SELECT g.variant_id, coalesce(m.n, CAST(g.sample_id AS VARCHAR)) AS sample_id, g.dosage
    FROM geno g LEFT JOIN (SELECT CAST(sample_id + 20 AS BIGINT) AS o, 'WGS' || CAST(sample_id AS VARCHAR) AS n FROM covar) m ON m.o = g.sample_id""")
def j14(t):
    m = t.covar().select(
        (F.col("sample_id") + 20).cast("string").alias("old"),
        F.concat(F.lit("WGS"), F.col("sample_id").cast("string")).alias("new"),
    )
    return J.rename_samples(t.geno().withColumn("sample_id", F.col("sample_id").cast("string")), m)


@query("j15_graph_edges", """
    SELECT CAST(variant_id AS VARCHAR) AS source, CAST(gene_id AS VARCHAR) AS target,
           round(-log10(p_value), 6) AS value, round(greatest(1, least(10, -log10(p_value) / 2)), 6) AS width
    FROM assoc WHERE p_value < 1e-5""")
def j15(t):
    e = J.graph_edges(t.assoc().where("p_value < 1e-5")).select("source", "target", "value", "width")
    return e.withColumns({c: F.round(c, 6) for c in ("value", "width")})


@query("j15_edge_statistics", """
    SELECT CAST(variant_id AS VARCHAR) AS source, CAST(gene_id AS VARCHAR) AS target, round(greatest(1, least(10, -log10(p_value) / 2)), 6) AS width,
           round(beta, 6) AS beta, p_value FROM assoc WHERE p_value < 1e-5""")
def j15s(t):
    e = J.graph_edges(t.assoc().where("p_value < 1e-5")).select("source", "target", "width", "beta", "p_value")
    return e.withColumns({c: F.round(c, 6) for c in ("width", "beta")})


@query("u1_common_samples", """
    SELECT sample_id FROM geno INTERSECT SELECT sample_id + 3 FROM pheno INTERSECT SELECT sample_id + 7 FROM covar""")
def u1(t):
    return J.in_all([t.geno(), shifted(t.pheno(), 3), shifted(t.covar(), 7)])


@query("u2_only_left", "SELECT DISTINCT sample_id FROM geno EXCEPT SELECT sample_id + 7 FROM covar")
def u2(t):
    return J.only_left(t.geno(), shifted(t.covar(), 7))


@query("u3_tagged_union", """
    SELECT 'height' AS phenotype, sample_id, round(value, 6) AS value, NULL::DOUBLE AS extra FROM traits WHERE trait = 'height'
    UNION ALL SELECT 'ldl', sample_id, round(value, 6), round(value * 2, 6) FROM traits WHERE trait = 'ldl'""")
def u3(t):
    part = lambda n: t.traits().where(F.col("trait") == n).select("sample_id", F.round("value", 6).alias("value"))
    ldl = t.traits().where("trait = 'ldl'").select(
        "sample_id", F.round("value", 6).alias("value"), F.round(F.col("value") * 2, 6).alias("extra")
    )
    return J.tagged_union({"height": part("height"), "ldl": ldl})


@query("u4_append_covariates", """
    SELECT covariate, sample_id, value FROM covlong
    UNION ALL SELECT 'PC2', sample_id, CAST(round(rin * 3, 4) AS VARCHAR) FROM covar""")
def u4(t):
    pc = t.covar().select(
        F.lit("PC2").alias("covariate"), "sample_id", F.round(F.col("rin") * 3, 4).cast("string").alias("value")
    )
    return J.append_covariates(t.covlong(), pc)


@query("u5_graph_nodes", """
    WITH a AS (SELECT * FROM assoc WHERE p_value < 1e-5)
    SELECT CAST(gene_id AS VARCHAR) AS id, 'gene' AS type, 20 AS size FROM a
    UNION SELECT CAST(variant_id AS VARCHAR), 'variant', 15 FROM a""")
def u5(t):
    return J.graph_nodes(t.assoc().where("p_value < 1e-5"))
