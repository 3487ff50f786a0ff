"""Time the headline queries and print one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from allelespark.plans import catalog
from allelespark.session import local_session

HEADLINE = (
    "p14_split_multiallelic f1_variant_filter f2_genotype_qc f4_first_per_position f6_low_expression f10_significant f12_trait_outliers "
    "j1_align_samples j4_cis_window j6_drop_cis j13_genes_in_locus a2_variant_missing a3_allele_frequency a7_genotype_summary a13_phenotype_issues "
    "a21_lambda_gc a24_gwas_quality a27_histograms a28_ten_statistics a30_normality w1_bh_fdr w1_bh_fdr_global w3_qq_points w7_credible_sets "
    "t3_top_hits_by_phenotype t5_downsample_keep_hits m3_zscore m4_quantile_uniform m9_vst m13_remove_batch m18_genotype_pcs "
    "m20_sample_correlation q1_cis_nominal_covariates q2_cis_permutation q3_trans_scan q5_linear_gwas_covariates q6_logistic_gwas "
    "q8_interaction q13_fine_map s1_vcf_dosage_rows s3_wide_matrix k3_phenotype_bed"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["a2_variant_missing"](spark, sf_dir).count()  # warm the session, not the data
    took = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
