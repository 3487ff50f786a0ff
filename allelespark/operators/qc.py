"""Quality-control aggregates over genotypes, phenotypes, covariates and annotations."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.functions.stats import hwe_exact_udf, hwe_midp_udf
from allelespark.operators.filters import hwe_chi2, variant_stats
from allelespark.operators.joins import overlap_report
from allelespark.operators.ordered import columns_of, exact_quantiles, first_rows, one_row, scalars, with_group_stats
from allelespark.operators.ranking import hash_sample

# Words that mark covariates by kind, and the covariates usually expected.
DEMOGRAPHIC = ("age", "sex", "gender", "bmi", "height", "weight")
STUDY = ("study", "cohort", "center", "site")
EXPECTED = ("age", "sex", "batch")
CHROMOSOMES = [str(i) for i in range(1, 23)] + ["X", "Y", "MT", "M"]



def missing_rate(geno: DataFrame, key: str) -> DataFrame:
    miss = F.count_if(F.col("dosage").isNull())
    return geno.groupBy(key).agg(
        miss.alias("n_missing"), F.count(F.lit(1)).alias("n"), (miss / F.count(F.lit(1))).alias("f_missing")
    )


def maf_summary(geno: DataFrame) -> DataFrame:
    st = variant_stats(geno)
    med = exact_quantiles(st, [], "maf", {"median_maf": 0.5}).select("median_maf")
    return one_row(st.agg(F.count("maf").alias("n_variants"), F.avg("maf").alias("mean_maf")), med)


def hwe(geno: DataFrame, exact: bool = True, midp: bool = True) -> DataFrame:
    """Genotype counts, chi-square and, with ``exact``, the exact p (mid-p, or plain as genotype tools give by default)."""
    st = variant_stats(geno).select("variant_id", "hom_ref", "het", "hom_alt")
    out = st.withColumn("chi2", hwe_chi2(F.col("hom_ref"), F.col("het"), F.col("hom_alt")))
    return out.withColumn("p_hwe", (hwe_midp_udf if midp else hwe_exact_udf)("hom_ref", "het", "hom_alt")) if exact else out


def hwe_summary(tests: DataFrame, threshold: float = 1e-6) -> DataFrame:
    low = F.count_if(F.col("p_hwe") < threshold)
    return tests.agg(
        low.alias("violations"), F.count(F.lit(1)).alias("total_variants"),
        F.coalesce(F.try_divide(low, F.count(F.lit(1))), F.lit(0.0)).alias("violation_rate"),
    )


def heterozygosity(geno: DataFrame) -> DataFrame:
    d = F.col("dosage")
    return geno.groupBy("sample_id").agg(
        F.count(d).alias("n_called"),
        F.coalesce(F.try_divide(F.count_if(d == 1), F.count(d)), F.lit(0.0)).alias("het_rate"),
    )


def heterozygosity_outliers(geno: DataFrame, k: float = 3.0) -> DataFrame:
    """Samples beyond mean +- k sd; none when all rates are equal."""
    het = heterozygosity(geno)
    mean, sd = scalars(het, F.avg("het_rate").alias("mean_het"), F.stddev_samp("het_rate").alias("sd_het"))
    away = F.abs(F.col("het_rate") - F.col("mean_het")) > k * F.col("sd_het")
    return het.select("*", mean, sd).where((F.col("sd_het") > 0) & away)


def genotype_summary(geno: DataFrame, threshold: float = 0.1) -> DataFrame:
    def part(key: str, tag: str) -> list[DataFrame]:
        m = missing_rate(geno, key)
        return [
            m.agg(
                F.avg("f_missing").alias(f"{tag}_mean"), F.max("f_missing").alias(f"{tag}_max"),
                F.count_if(F.col("f_missing") > threshold).alias(f"{tag}_above"),
            ),
            exact_quantiles(m, [], "f_missing", {f"{tag}_median": 0.5}).select(f"{tag}_median"),
        ]

    st = variant_stats(geno)
    low = st.agg(
        F.avg("maf").alias("maf_mean"),
        F.count_if(F.col("maf") < 0.01).alias("maf_lt_01"),
        F.count_if(F.col("maf") < 0.05).alias("maf_lt_05"),
    )
    med = exact_quantiles(st, [], "maf", {"maf_median": 0.5}).select("maf_median")
    return one_row(*part("sample_id", "sample"), *part("variant_id", "variant"), low, med)


def phenotype_summary(df: DataFrame) -> DataFrame:
    v = F.col("value")
    cells = df.agg(
        F.count(F.lit(1)).alias("total_measurements"),
        F.count_if(v.isNull()).alias("total_missing"),
        (100.0 * F.count_if(v.isNull()) / F.count(F.lit(1))).alias("missing_pct"),
        F.when(F.sum(v) > F.count(F.lit(1)), "counts").otherwise("normalized").alias("data_type"),
        F.bool_or(v < 0).alias("has_negative"),
        F.bool_or(v == 0).alias("has_zero"),
    )
    by_sample = df.groupBy("sample_id").agg(F.avg(v).alias("m"), F.stddev_samp(v).alias("s")).agg(
        F.count(F.lit(1)).alias("n_samples"), F.avg("m").alias("mean"), F.avg("s").alias("std")
    )
    by_feature = df.groupBy("feature_id").agg(
        ((F.min(v) == F.max(v)) & (F.count(v) > 1)).alias("c"),
        (F.count(F.lit(1)) > F.count_distinct("sample_id")).alias("d"),
    ).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.bool_or("c").alias("has_constant"),
        F.bool_or("d").alias("has_duplicate"),
    )
    return one_row(cells, by_sample, by_feature)


def covariate_profile(cov: DataFrame, listed: int = 20) -> DataFrame:
    """Type and statistics per covariate; the value list is kept for at most ``listed`` values."""
    num = F.col("value").try_cast("double")
    prof = cov.groupBy("covariate").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(num).alias("n_numeric"),
        F.count_distinct("value").alias("n_distinct"),
        F.avg(num).alias("_mean"), F.stddev_samp(num).alias("_sd"), F.min(num).alias("_min"), F.max(num).alias("_max"),
    )
    kind = F.when(F.col("n_numeric") < F.col("n"), "categorical").when(F.col("n_distinct") == 2, "binary").otherwise("numeric")
    prof = prof.withColumn("type", kind)
    stats = {c: F.when(F.col("type") == "numeric", F.col(f"_{c}")) for c in ("mean", "sd", "min", "max")}
    few = first_rows(cov.where("value IS NOT NULL").select("covariate", "value").distinct(), ["covariate"], [F.col("value")], listed)
    names = few.groupBy("covariate").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("_vals"))
    shown = F.when((F.col("type") != "numeric") & (F.col("n_distinct") <= listed), F.col("_vals"))
    return prof.withColumns(stats).join(names, "covariate", "left").select(
        "covariate", "type", "n_distinct", "mean", "sd", "min", "max", shown.alias("values")
    )


def covariate_patterns(cov: DataFrame) -> DataFrame:
    low = F.lower("covariate")
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return cov.select("covariate").distinct().select(
        "covariate",
        F.rlike("covariate", F.lit(r"(?i)^PC\d+$")).alias("is_pc"),
        F.contains(low, F.lit("batch")).alias("is_batch"),
        has(DEMOGRAPHIC).alias("is_demographic"),
        has(STUDY).alias("is_study"),
    )


def covariate_advice(cov: DataFrame) -> DataFrame:
    pat = covariate_patterns(cov).agg(
        F.count_if("is_pc").alias("n_pcs"), F.count(F.lit(1)).alias("n_covariates"),
        *[F.bool_or(F.lower("covariate") == w).alias(f"has_{w}") for w in EXPECTED],
    )
    kinds = covariate_profile(cov).agg(F.count_if(F.col("type") == "categorical").alias("n_categorical"))
    size = cov.agg(F.count_distinct("sample_id").alias("n_samples"))
    absent = F.array_compact(F.array(*[F.when(~F.col(f"has_{w}"), w) for w in EXPECTED]))
    return one_row(pat, kinds, size).select(
        "n_covariates", "n_samples", "n_pcs", "n_categorical",
        (F.col("n_pcs") < 5).alias("add_pcs"),
        F.array_join(absent, ",").alias("missing_expected"),
        (F.col("n_categorical") > 0).alias("encode_categorical"),
        (F.col("n_covariates") > F.col("n_samples") / 10).alias("too_many"),
    )


def distribution_class(df: DataFrame, qtl_type: str) -> DataFrame:
    v = F.col("value")
    if qtl_type == "eqtl":
        kind = F.when(F.bool_and(v >= 0), F.when(F.bool_or(v == 0), "count_like").otherwise("continuous_positive"))
    elif qtl_type == "sqtl":
        kind = F.when(F.bool_and(v.between(0, 1)), "proportion")
    else:
        kind = F.lit(None).cast("string")
    whole = df.agg(F.coalesce(kind, F.lit("continuous")).alias("distribution_type"))
    feats = df.groupBy("feature_id").agg(F.avg(v).alias("m"), F.var_samp(v).alias("s")).agg(
        F.avg("m").alias("mean_mean"), F.stddev_samp("m").alias("mean_sd"),
        F.avg("s").alias("variance_mean"), F.stddev_samp("s").alias("variance_sd"),
    )
    return one_row(whole, feats)


def normalisation_compatible(df: DataFrame, qtl_type: str, method: str) -> DataFrame:
    v = F.col("value")
    rules = {("eqtl", "vst"): v < 0, ("eqtl", "log2"): v <= 0, ("sqtl", "log2"): (v < 0) | (v > 1)}
    bad = rules.get((qtl_type, method), F.lit(False))
    return df.agg(F.count_if(bad).alias("n_offending")).select(
        F.lit(qtl_type).alias("qtl_type"), F.lit(method).alias("method"), "n_offending",
        (F.col("n_offending") == 0).alias("compatible"),
    )


def fence_outliers(df: DataFrame, k: float, by: str = "sample_id", zero_iqr: float | None = None, min_n: int = 1) -> DataFrame:
    """Values outside the k x IQR fences of their ``by`` group, counted per group.

    ``zero_iqr`` replaces an IQR of 0; with None and ``min_n`` > 1 such groups count none.
    """
    q = exact_quantiles(df, [by], "value", {"_q1": 0.25, "_q3": 0.75})
    iqr = F.col("_q3") - F.col("_q1")
    if zero_iqr is not None:
        iqr = F.when(iqr == 0, zero_iqr).otherwise(iqr)
    out = (F.col("value") < F.col("_q1") - k * iqr) | (F.col("value") > F.col("_q3") + k * iqr)
    usable = (F.col("n") >= min_n) & ((iqr != 0) if min_n > 1 else F.lit(True))
    return df.join(q, by).groupBy(by).agg(F.count_if(out & usable).alias("n_outliers"), F.count("value").alias("n_values"))


def phenotype_issues(df: DataFrame, max_missing: float = 0.2, zero_iqr: float | None = None) -> DataFrame:
    v = F.col("value")
    feats = df.groupBy("feature_id").agg(
        F.count_distinct(v).alias("d"), (F.min(v) == F.max(v)).alias("c"), F.count(v).alias("n"),
        (F.count_if(v.isNull()) / F.count(F.lit(1))).alias("m"),
    ).agg(
        F.count_if(F.col("d") == 1).alias("constant_features"),
        F.count_if(F.col("c") & (F.col("n") > 1)).alias("zero_variance"),
        F.count_if(F.col("m") > max_missing).alias("high_missing"),
    )
    outs = fence_outliers(df, 3.0, zero_iqr=zero_iqr).agg(F.sum("n_outliers").alias("n_outliers"))
    cells = df.agg(F.count(F.lit(1)).alias("n_cells"))
    return one_row(feats, outs, cells).withColumn("outlier_pct", 100.0 * F.col("n_outliers") / F.col("n_cells"))


def covariate_issues(cov: DataFrame, z: float = 10.0) -> DataFrame:
    num = F.col("value").try_cast("double")
    per = cov.groupBy("covariate").agg(
        F.count_distinct("value").alias("d"), (F.count(num) == F.count(F.lit(1))).alias("numeric")
    )
    cells = cov.agg(
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        (100.0 * F.count_if(F.col("value").isNull()) / F.count(F.lit(1))).alias("missing_pct"),
        F.count_distinct("sample_id").alias("n_samples"),
    )
    kinds = per.agg(
        F.count(F.lit(1)).alias("n_covariates"), F.count_if(F.col("d") <= 1).alias("n_constant"),
        F.count_if(~F.col("numeric")).alias("n_non_numeric"),
    )
    rows = cov.join(per.where("numeric").select("covariate"), "covariate", "left_semi").select("sample_id", num.alias("v"))
    rows = with_group_stats(rows, ["sample_id"], F.avg("v").alias("m"), F.stddev_samp("v").alias("s"))
    sd = F.when(F.col("s") == 0, 1.0).otherwise(F.col("s"))
    far = rows.agg(F.count_if(F.abs((F.col("v") - F.col("m")) / sd) > z).alias("n_extreme"))
    return one_row(cells, kinds, far).withColumn("too_many", F.col("n_covariates") > F.col("n_samples") / 2)


def annotation_issues(genes: DataFrame) -> DataFrame:
    length = F.col("gend") - F.col("gstart")
    bare = F.regexp_replace("chrom", "^chr", "")
    found = [F.bool_or(bare == c) for c in CHROMOSOMES]
    absent = F.array_compact(F.array(*[F.when(~f, c) for f, c in zip(found, CHROMOSOMES)]))
    return genes.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("gstart") >= F.col("gend")).alias("bad_ranges"),
        (F.count(F.lit(1)) - F.count_distinct("gene_id")).alias("duplicate_genes"),
        F.array_join(absent, ",").alias("missing_chromosomes"),
        F.sum(length).alias("total_length"),
        F.avg(length).alias("mean_length"),
    )


def plink_table_issues(fam: DataFrame, bim: DataFrame) -> DataFrame:
    dup = lambda c: F.count(F.lit(1)) - F.count_distinct(c)
    return one_row(
        fam.agg(F.count(F.lit(1)).alias("n_samples"), dup("sample_id").alias("duplicate_samples")),
        bim.agg(
            F.count(F.lit(1)).alias("n_variants"), dup("variant_id").alias("duplicate_variants"),
            F.count_if(F.col("pos").isNull() | (F.col("pos") <= 0)).alias("bad_positions"),
        ),
    )


def trait_issues(traits: DataFrame) -> DataFrame:
    num = F.col("value").try_cast("double")
    return traits.groupBy("trait").agg(
        F.count_if(F.col("sample_id").isNull()).alias("missing_ids"),
        F.count_if(F.col("value").isNotNull() & num.isNull()).alias("non_numeric"),
        F.count_distinct("value").alias("n_levels"),
    ).withColumn("logistic_ok", F.col("n_levels") == 2)


def chromosome_naming(df: DataFrame) -> DataFrame:
    pre = F.coalesce(F.bool_or(F.startswith("chrom", F.lit("chr"))), F.lit(False))
    bare = F.coalesce(F.bool_or(F.col("chrom").isin(*CHROMOSOMES)), F.lit(False))
    return df.agg(
        F.when(pre & bare, "mixed").when(pre, "prefixed").when(bare, "bare").otherwise("unknown").alias("naming")
    )


def concordance(geno: DataFrame, other: DataFrame, name: str, warn_below: float = 80.0) -> DataFrame:
    side = F.col("side")
    both = F.count_if(side == "common")
    left, right = F.count_if(side != "right_only"), F.count_if(side != "left_only")
    return overlap_report(geno, other).agg(
        F.lit(name).alias("dataset"), left.alias("genotype_samples"), right.alias("dataset_samples"), both.alias("overlap"),
        (100.0 * both / left).alias("pct_of_genotype"),
        (100.0 * both / F.least(left, right)).alias("pct_of_smaller"),
    ).withColumn("warn", F.col("pct_of_smaller") < warn_below)


def scorecard(checks: DataFrame) -> DataFrame:
    """Checks (dataset, passed) per dataset and overall: above 0.8 PASS, above 0.5 WARNING, else FAIL."""
    got = checks.rollup("dataset").agg(
        F.count_if("passed").alias("checks_passed"), F.count(F.lit(1)).alias("checks_total")
    )
    rate = F.col("checks_passed") / F.col("checks_total")
    status = F.when(rate > 0.8, "PASS").when(rate > 0.5, "WARNING").otherwise("FAIL")
    return got.withColumn("dataset", F.coalesce("dataset", F.lit("overall"))).withColumn("status", status)


def genotype_size(geno: DataFrame) -> DataFrame:
    return geno.agg(F.count_distinct("sample_id").alias("n_samples"), F.count_distinct("variant_id").alias("n_variants"))


def missing_matrix(df: DataFrame, features: int | None = None) -> DataFrame:
    """0/1 missing flags of all features, or of ``features`` of them in hash order."""
    if features is None:
        return df.select("feature_id", "sample_id", F.col("value").isNull().cast("int").alias("missing"))
    ids = hash_sample(df.select("feature_id").distinct(), [], F.col("feature_id"), features)
    return df.join(ids, "feature_id", "left_semi").select(
        "feature_id", "sample_id", F.col("value").isNull().cast("int").alias("missing")
    )


def findings(row: DataFrame, module: str, rules: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Turn a one-row check into (severity, module, message) rows for the rules that hold."""
    items = [
        F.when(cond, F.struct(F.lit(sev).alias("severity"), F.lit(module).alias("module"), F.lit(msg).alias("message")))
        for msg, (sev, cond) in rules.items()
    ]
    return row.select(F.inline(F.array_compact(F.array(*items))))


def findings_summary(parts: Sequence[DataFrame]) -> DataFrame:
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("severity").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("module")), ",").alias("modules")
    ).withColumn("run_fails", F.col("severity") == "error")
