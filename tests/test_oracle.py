"""Registered queries against DuckDB.  ALLELESPARK_ALL=1 checks every query, otherwise one per family member list."""
import os

import pytest

from allelespark.plans import catalog
from oracle import compare, duck

SF = os.environ.get("ALLELESPARK_SF", "/root/testdata/sf0.001")
QUICK = (
    "p5_alias_harmonise p7_locus_from_id p14_split_multiallelic f1_variant_filter f2_genotype_qc f9_validate_phenotypes "
    "f10_significant j1_align_samples j4_cis_window j8_assemble_covariates j13_genes_in_locus t5_downsample_keep_hits "
    "a4_hwe_counts a9_covariate_profile a27_histograms a30_normality w1_bh_fdr w3_qq_points w7_credible_sets "
    "m4_quantile_uniform m9_vst m13_remove_batch m20_sample_correlation q1_cis_nominal_covariates q5_linear_gwas_covariates "
    "q8_interaction s1_vcf_scan s8_gtf_genes k3_phenotype_bed"
).split()
NAMES = list(catalog.ORACLES) if os.environ.get("ALLELESPARK_ALL") else QUICK


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    message, _ = compare(catalog.QUERIES[name](spark, SF), con, catalog.ORACLES[name])
    assert message == "ok"


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
