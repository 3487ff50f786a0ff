"""Registered queries: scalar clean-up (P)."""
from __future__ import annotations

from pyspark.sql import functions as F

from allelespark.operators import clean as C
from allelespark.plans.registry import query


@query("p1_sample_id", """
    SELECT s_suppkey, split_part(replace(trim(raw), '.0', ''), '_', 1) AS sample_key,
           replace(trim(raw), '.0', '') AS full_key
    FROM (SELECT s_suppkey, '  ' || s_name || '.0_rep' || CAST(s_nationkey AS VARCHAR) || ' ' AS raw FROM supplier)""")
def p1(t):
    raw = F.concat(F.lit("  "), "s_name", F.lit(".0_rep"), F.col("s_nationkey").cast("string"), F.lit(" "))
    return t.supplier.select(
        "s_suppkey", C.sample_key(raw).alias("sample_key"), C.sample_key(raw, False).alias("full_key")
    )


@query("p2_strip_version", r"""
    SELECT p_partkey, regexp_replace(raw, '\.\d+$', '') AS gene_id
    FROM (SELECT p_partkey, 'ENSG' || CAST(p_partkey AS VARCHAR) ||
                 CASE WHEN p_size % 2 = 0 THEN '.' || CAST(p_size AS VARCHAR) ELSE '' END AS raw FROM part)""")
def p2(t):
    v = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("."), F.col("p_size").cast("string"))).otherwise("")
    raw = F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string"), v)
    return t.part.select("p_partkey", C.strip_version(raw).alias("gene_id"))


@query("p3_count_transform", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           CAST(CASE WHEN abs(h - floor(h) - 0.5) = 0
                     THEN CASE WHEN CAST(floor(h) AS BIGINT) % 2 = 0 THEN floor(h) ELSE floor(h) + 1 END
                     ELSE floor(h + 0.5) END AS BIGINT) AS n
    FROM (SELECT *, l_quantity / 4 + 1 AS h FROM lineitem)""")
def p3(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        C.to_count(F.col("l_quantity") / 4, 1).alias("n"),
    )


_P4 = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'NA' WHEN event_id % 11 = 0 THEN NULL
                ELSE CAST(CAST(value * 100 AS BIGINT) AS VARCHAR) END AS raw_value,
                event_type AS raw_type FROM events"""


def _p4(t):
    e = F.col("event_id")
    raw = F.when(e % 7 == 0, "NA").when(e % 11 != 0, F.round(F.col("value") * 100).cast("bigint").cast("string"))
    return t.events.select("event_id", raw.alias("raw_value"), F.col("event_type").alias("raw_type"))


@query("p4_numeric_coercion", f"""
    WITH raw AS ({_P4})
    SELECT 'raw_value' AS column_name, count(*) FILTER (raw_value IS NOT NULL AND TRY_CAST(raw_value AS DOUBLE) IS NULL) AS n_lost FROM raw
    UNION ALL
    SELECT 'raw_type', count(*) FILTER (raw_type IS NOT NULL AND TRY_CAST(raw_type AS DOUBLE) IS NULL) FROM raw""")
def p4(t):
    return C.coercion_loss(_p4(t), ["raw_value", "raw_type"])


@query("p5_alias_harmonise", """
    SELECT phenotype, "CHR", "BP", "P", "Effect", "FRQ", "CHR" AS chromosome, "BP" AS position,
           "P" AS p_value, "Effect" AS beta, "FRQ" AS maf
    FROM (SELECT phenotype, chrom AS "CHR", pos AS "BP", round(p_value, 6) AS "P",
                 round(beta, 6) AS "Effect", maf AS "FRQ" FROM gwas)""")
def p5(t):
    raw = t.gwas().select(
        "phenotype", F.col("chrom").alias("CHR"), F.col("pos").alias("BP"), F.round("p_value", 6).alias("P"),
        F.round("beta", 6).alias("Effect"), F.col("maf").alias("FRQ"),
    )
    return C.harmonise(raw)


@query("p6_sumstats", """
    SELECT chrom AS chromosome, pos AS position, phenotype || ':' || CAST(variant_id AS VARCHAR) AS variant_id,
           'A' AS effect_allele, 'G' AS other_allele, round(beta, 6) AS beta, round(se, 6) AS standard_error,
           round(p_value, 6) AS p_value,
           round(CASE WHEN zse = 0 THEN NULL ELSE beta / zse END, 6) AS z_score
    FROM (SELECT *, se AS zse FROM gwas)""")
def p6(t):
    raw = t.gwas().select(
        F.col("chrom").alias("CHROM"), F.col("pos").alias("POS"),
        F.concat("phenotype", F.lit(":"), F.col("variant_id").cast("string")).alias("SNP"),
        F.lit("A").alias("A1"), F.lit("G").alias("A2"), F.col("beta").alias("BETA"),
        F.col("se").alias("SE"), F.col("p_value").alias("P"),
    )
    out = C.standardise_sumstats(raw)
    return out.withColumns({c: F.round(c, 6) for c in ("beta", "standard_error", "p_value", "z_score")})


def _locus_ids(t, sep="_"):
    return t.variants().select(
        F.concat_ws(sep, F.concat(F.lit("chr"), "chrom"), F.col("pos").cast("string"), F.lit("A"), F.lit("G")).alias("variant_id")
    )


@query("p7_locus_from_id", """
    SELECT variant_id, replace(split_part(variant_id, sep, 1), 'chr', '') AS chromosome,
           TRY_CAST(split_part(variant_id, sep, 2) AS BIGINT) AS position
    FROM (SELECT variant_id, (SELECT CASE WHEN bool_and(contains(x, '_')) THEN '_'
                                          WHEN bool_and(contains(x, ':')) THEN ':' END
                              FROM (SELECT 'chr' || chrom || ':' || CAST(pos AS VARCHAR) || ':A:G' AS x FROM variants)) AS sep
          FROM (SELECT 'chr' || chrom || ':' || CAST(pos AS VARCHAR) || ':A:G' AS variant_id FROM variants))""")
def p7(t):
    return C.locus_from_id(_locus_ids(t, ":"))


@query("p8_manhattan_input", """
    SELECT phenotype, variant_id, chrom AS chromosome, pos AS position,
           CASE WHEN p = 0 THEN CAST('inf' AS DOUBLE) ELSE round(-log10(p), 6) END AS log10p
    FROM (SELECT *, CASE WHEN variant_id % 50 = 7 THEN 0 ELSE p_value END AS p FROM gwas)
    WHERE chrom IS NOT NULL AND pos IS NOT NULL""")
def p8(t):
    from allelespark.operators.display import manhattan_input

    raw = t.gwas().withColumn("p_value", F.when(F.col("variant_id") % 50 == 7, 0.0).otherwise(F.col("p_value")))
    out = manhattan_input(raw.withColumnsRenamed({"chrom": "chromosome", "pos": "position"}), scored=False)
    return out.select("phenotype", "variant_id", "chromosome", "position", F.round("log10p", 6).alias("log10p"))


@query("p9_log10p", """
    SELECT gene_id, variant_id, round(-log10(p_value), 6) AS log10p,
           round(-log10(p_value) * sign(beta), 6) AS signed_log10p
    FROM (SELECT gene_id, variant_id, p_value, round(beta, 9) AS beta FROM assoc)""")
def p9(t):
    a = t.assoc().withColumn("beta", F.round("beta", 9))
    p = F.col("p_value")
    return a.select(
        "gene_id", "variant_id", F.round(C.neg_log10(p), 6).alias("log10p"),
        (F.round(C.signed_significance(p, F.col("beta")), 6) + F.lit(0.0)).alias("signed_log10p"),
    )


@query("p10_volcano_class", """
    SELECT gene_id, variant_id,
           CASE WHEN p_value < 1e-8 AND abs(b) > 0.2 THEN 'high'
                WHEN p_value < 0.05 AND abs(b) > 0.1 THEN 'medium' ELSE 'none' END AS class
    FROM (SELECT gene_id, variant_id, p_value, round(beta * 10, 6) AS b FROM assoc)""")
def p10(t):
    return t.assoc().select(
        "gene_id", "variant_id", C.volcano_class(F.col("p_value"), F.round(F.col("beta") * 10, 6)).alias("class")
    )


@query("p11_placeholders", """
    SELECT event_id, CASE WHEN b = '.' THEN 0 ELSE TRY_CAST(b AS DOUBLE) END AS beta,
           CASE WHEN b = '.' THEN 1 ELSE TRY_CAST(b AS DOUBLE) END AS p_value
    FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '.' ELSE CAST(user_id AS VARCHAR) END AS b FROM events)""")
def p11(t):
    b = F.when(F.col("event_id") % 5 == 0, ".").otherwise(F.col("user_id").cast("string"))
    return t.events.select("event_id", C.placeholder(b, 0.0).alias("beta"), C.placeholder(b, 1.0).alias("p_value"))


@query("p12_type_map", """
    SELECT event_id, qtl_type,
           CASE qtl_type WHEN 'eqtl' THEN 'expression' WHEN 'pqtl' THEN 'protein' WHEN 'sqtl' THEN 'splicing' END AS data_type,
           CASE WHEN qtl_type = 'gwas' THEN NULL ELSE qtl_type END AS round_trip
    FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'eqtl' WHEN 1 THEN 'pqtl' WHEN 2 THEN 'sqtl' ELSE 'gwas' END AS qtl_type FROM events)""")
def p12(t):
    kinds = F.array(F.lit("eqtl"), F.lit("pqtl"), F.lit("sqtl"), F.lit("gwas"))
    q = t.events.select("event_id", F.get(kinds, (F.col("event_id") % 4).cast("int")).alias("qtl_type"))
    q = q.withColumn("data_type", C.data_type_of(F.col("qtl_type")))
    return q.withColumn("round_trip", C.qtl_type_of(F.col("data_type")))


@query("p13_chrom_name", """
    SELECT variant_id, CASE WHEN starts_with(raw, 'chr') THEN raw ELSE 'chr' || raw END AS with_prefix,
           regexp_replace(raw, '^chr', '') AS bare
    FROM (SELECT variant_id, CASE WHEN pos % 20000 = 0 THEN 'chr' || chrom ELSE chrom END AS raw FROM variants)""")
def p13(t):
    raw = F.when(F.col("pos") % 20000 == 0, F.concat(F.lit("chr"), "chrom")).otherwise(F.col("chrom"))
    return t.variants().select(
        "variant_id", C.chrom_name(raw).alias("with_prefix"), C.chrom_name(raw, "none").alias("bare")
    )


_GT = """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity,
                CASE WHEN l_partkey % 3 = 0 THEN 'C,T' ELSE 'C' END AS alt,
                CASE WHEN l_suppkey % 9 = 0 THEN './.'
                     ELSE CAST(l_linenumber % 3 AS VARCHAR) || CASE WHEN l_partkey % 2 = 0 THEN '|' ELSE '/' END
                          || CAST(l_suppkey % 2 AS VARCHAR) END AS gt FROM lineitem"""


def _gt(t):
    ln, p, s = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    gt = F.when(s % 9 == 0, "./.").otherwise(
        F.concat((ln % 3).cast("string"), F.when(p % 2 == 0, "|").otherwise("/"), (s % 2).cast("string"))
    )
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity",
        F.when(p % 3 == 0, "C,T").otherwise("C").alias("alt"), gt.alias("gt"),
    )


@query("p14_split_multiallelic", f"""
    WITH raw AS ({_GT}),
    one AS (SELECT * EXCLUDE (alt), CAST(0 AS INTEGER) AS alt_index, split_part(alt, ',', 1) AS alt FROM raw
            UNION ALL
            SELECT * EXCLUDE (alt), CAST(1 AS INTEGER), split_part(alt, ',', 2) FROM raw WHERE contains(alt, ','))
    SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, alt_index, alt,
           (CASE WHEN left(gt, 1) = '.' THEN '.' WHEN left(gt, 1) = CAST(alt_index + 1 AS VARCHAR) THEN '1' ELSE '0' END)
           || substr(gt, 2, 1) ||
           (CASE WHEN right(gt, 1) = '.' THEN '.' WHEN right(gt, 1) = CAST(alt_index + 1 AS VARCHAR) THEN '1' ELSE '0' END) AS gt
    FROM one""")
def p14(t):
    return C.split_multiallelic(_gt(t))


@query("p15_unphase", f"""
    WITH raw AS ({_GT}),
    kept AS (SELECT l_orderkey FROM raw GROUP BY l_orderkey HAVING count(*) FILTER (NOT contains(gt, '.')) > 0)
    SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity, replace(gt, '|', '/') AS gt
    FROM raw WHERE l_orderkey IN (SELECT l_orderkey FROM kept)""")
def p15(t):
    kept = C.drop_uncalled_sites(_gt(t), ["l_orderkey"])
    return kept.withColumn("gt", C.unphase(F.col("gt"))).drop("alt")


@query("p16_hover_text", """
    SELECT phenotype, variant_id,
           'Variant: ' || CAST(variant_id AS VARCHAR) || '<br>Position: ' || format('{:,}', pos)
           || CASE WHEN p_value IS NULL THEN '' ELSE '<br>P-value: ' || printf('%.2e', CAST(p_value AS DOUBLE)) END
           || '<br>MAF: ' || printf('%.3f', maf) AS label
    FROM (SELECT phenotype, variant_id, pos, maf, CASE WHEN variant_id % 5 = 0 THEN NULL
                 ELSE (variant_id % 89 + 1) / 1000.0 END AS p_value FROM gwas)""")
def p16(t):
    v = F.col("variant_id")
    raw = t.gwas().select(
        "phenotype", "variant_id", F.col("pos").alias("position"), "maf",
        F.when(v % 5 != 0, (v % 89 + 1) / 1000.0).alias("p_value"),
        *[F.lit(None).cast("double").alias(c) for c in ("log10p", "beta", "se")],
    )
    return raw.select("phenotype", "variant_id", C.hover_text().alias("label"))


@query("p16_hover_text_r2", """
    SELECT gene_id, variant_id, 'Variant: ' || CAST(variant_id AS VARCHAR) || '<br>Position: ' || format('{:,}', variant_id * 10000)
           || '<br>Beta: ' || printf('%.3f', beta) || '<br>SE: ' || printf('%.3f', se)
           || CASE WHEN variant_id % 3 = 0 THEN '' ELSE '<br>R²: ' || printf('%.3f', (variant_id % 89 + 1) / 101.0) END AS label FROM assoc""")
def p16r(t):
    v = F.col("variant_id")
    raw = t.assoc().select(
        "gene_id", "variant_id", (v * 10000).alias("position"), "beta", "se", F.when(v % 3 != 0, (v % 89 + 1) / 101.0).alias("linkage"),
        *[F.lit(None).cast("double").alias(c) for c in ("p_value", "log10p", "maf")],
    )
    return raw.select("gene_id", "variant_id", C.hover_text("linkage").alias("label"))


@query("p17_significance", """
    SELECT gene_id, variant_id, mode,
           CASE WHEN p_value <= (CASE WHEN mode = 'trans' THEN 1e-10 ELSE 5e-8 END) THEN 'significant'
                WHEN p_value <= 1e-5 THEN 'suggestive' ELSE 'none' END AS flag
    FROM (SELECT gene_id, variant_id, p_value, CASE WHEN gene_id % 2 = 0 THEN 'cis' ELSE 'trans' END AS mode FROM assoc)""")
def p17(t):
    a = t.assoc().withColumn("mode", F.when(F.col("gene_id") % 2 == 0, "cis").otherwise("trans"))
    return a.select("gene_id", "variant_id", "mode", C.significance(F.col("p_value"), F.col("mode")).alias("flag"))
