"""Missing values in scans, and FDR over a source that isn't fixed."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from allelespark.operators import assoc, interaction, multitest, qc
from allelespark.plans import catalog
from allelespark.plans.fixtures import Tables
from allelespark.plans.q_assoc import int_cov, leads
from allelespark.sources import sinks

SF = "/root/testdata/sf0.001"


def plain_bh(p):
    p = np.asarray(p, float)
    order = np.argsort(p)
    q = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
    out = np.empty(len(p))
    out[order] = np.minimum(q, 1)
    return out


def test_fdr_of_a_source_that_changes(spark):
    """Random values differ from run to run; the result must be that of the values it comes with."""
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("k"), F.when(F.col("id") % 5 == 0, 1.0).otherwise(F.rand() ** 2).alias("p_value"))
    got = multitest.bh_fdr(df, ["k"]).toPandas()
    for _, g in got.groupby("k"):
        assert np.allclose(g.fdr, plain_bh(g.p_value), rtol=1e-12)


def test_fdr_with_null_groups_and_invalid_values(spark):
    df = spark.createDataFrame([(None, 0.01), (None, 0.5), ("a", None), ("a", float("nan")), ("a", 2.0), ("a", 0.04), ("a", 0.03)], "k string, p_value double")
    got = sorted((str(r.k), str(r.p_value), round(r.fdr, 6)) for r in multitest.bh_fdr(df, ["k"]).collect())
    assert got == sorted([("None", "0.01", 0.02), ("None", "0.5", 0.5), ("a", "None", 1.0), ("a", "nan", 1.0), ("a", "2.0", 1.0), ("a", "0.04", 0.04), ("a", "0.03", 0.04)])


def test_interaction_fdr_is_bh_of_its_own_p(spark):
    got = catalog.QUERIES["q9_interaction_analysis"](spark, SF).toPandas()
    for _, g in got.groupby("covariate"):
        assert np.allclose(g.fdr, plain_bh(g.interaction_pvalue), rtol=1e-9)
    assert (got.fdr < 1).any()


def test_defaults_keep_all_features_and_covariates(spark):
    t = Tables(spark, SF)
    many = int_cov(t).union(int_cov(t).where("covariate = 'age'").crossJoin(spark.range(7)).select("sample_id", F.concat(F.lit("z"), "id"), F.col("value") * F.rand(3)))
    one = interaction.interaction_scan(t.pheno(), t.geno(), leads(t), many, ["age"])
    capped = interaction.interaction_scan(t.pheno(), t.geno(), leads(t), many, ["age"], others=5)
    assert one.agg(F.avg("r_squared")).first()[0] > capped.agg(F.avg("r_squared")).first()[0]
    wide = spark.range(1500).select(F.col("id").alias("feature_id"), F.lit(1).alias("sample_id"), F.lit(None).cast("double").alias("value"))
    assert qc.missing_matrix(wide).count() == 1500 and qc.missing_matrix(wide, 10).count() == 10


@pytest.fixture(scope="module")
def cohort(spark):
    rng = np.random.default_rng(11)
    n = 60
    g = rng.integers(0, 3, (4, n)).astype(float)
    c = rng.normal(size=n)
    tall, low = 170 + 3 * g[0] + c + rng.normal(size=n), 3 + 0.4 * g[1] + rng.normal(size=n) / 5
    frame = lambda rows, schema: spark.createDataFrame(pd.DataFrame(rows), schema)
    geno = frame([(v, s, g[v, s]) for v in range(4) for s in range(n)], "variant_id long, sample_id long, dosage double")
    return geno, g, c, tall, low, n


def slope(y, *columns):
    x = np.column_stack([np.ones(len(y)), *columns])
    return np.linalg.lstsq(x, y, rcond=None)[0][1]


def test_null_traits_are_left_out(spark, cohort):
    geno, g, _, tall, low, n = cohort
    rows = [("tall", s, float(tall[s])) for s in range(n)] + [("low", s, None if s < 5 else float(low[s])) for s in range(n)]
    traits = spark.createDataFrame(rows, "trait string, sample_id long, value double")
    got = {(r.phenotype, r.variant_id): r for r in assoc.linear_gwas(geno, traits).collect()}
    for v in range(4):
        assert got["tall", str(v) if ("tall", str(v)) in got else v].beta == pytest.approx(slope(tall, g[v]))
        low_row = got["low", str(v) if ("low", str(v)) in got else v]
        assert low_row.beta == pytest.approx(slope(low[5:], g[v, 5:])) and low_row.n_called == n - 5


def test_null_covariates_leave_samples_out(spark, cohort):
    geno, g, c, tall, _, n = cohort
    pheno = spark.createDataFrame([("f1", s, float(tall[s])) for s in range(n)], "feature_id string, sample_id long, value double")
    cov = spark.createDataFrame([("c", s, None if s in (0, 7) else float(c[s])) for s in range(n)], "covariate string, sample_id long, value double")
    variants = spark.createDataFrame([(v, "1", 100 + v) for v in range(4)], "variant_id long, chrom string, pos long")
    genes = spark.createDataFrame([("f1", "1", 100, 200, "+")], "gene_id string, chrom string, gstart long, gend long, strand string")
    prep = assoc.Prepared(geno, pheno, cov)
    keep = np.array([s not in (0, 7) for s in range(n)])
    assert prep.n == n - 2
    for r in assoc.cis_nominal(prep, variants, genes, window=1000).collect():
        v = int(r.variant_id)
        assert r.beta == pytest.approx(slope(tall[keep], g[v, keep], c[keep]))


def test_matrix_lines_place_cells_by_sample(spark):
    """Absent cells, first, middle and last, are NA in their own sample's column."""
    rows = [("c1", "a", 1.0), ("c1", "c", 3.0), ("c2", "b", 2.0), ("c3", "a", 1.0), ("c3", "b", None), ("c3", "c", 4.0), ("c3", "d", 5.0)]
    long = spark.createDataFrame(rows, "covariate string, sample_id string, value double")
    got = [r[0].split("\t") for r in sinks.covariate_matrix(long).collect()]
    assert got == [["id", "a", "b", "c", "d"], ["c1", "1.0", "NA", "3.0", "NA"], ["c2", "NA", "2.0", "NA", "NA"], ["c3", "1.0", "NA", "4.0", "5.0"]]


def test_fdr_writes_only_the_columns_it_was_given(spark, monkeypatch):
    seen, write = [], multitest.materialize
    monkeypatch.setattr(multitest, "materialize", lambda df: seen.append(df.columns) or write(df))
    df = spark.range(200).select("id", (F.col("id") % 3).alias("k"), (F.col("id") * 37 % 101 / 100).alias("p_value"))
    for keys in ([], ["k"]):
        got = multitest.bh_fdr(df, keys).toPandas()
        for _, g in got.groupby(keys or (lambda i: 0)):
            bad = g.p_value <= 0
            assert (g.fdr[bad] == 1).all() and np.allclose(g.fdr[~bad], plain_bh(g.p_value[~bad]), rtol=1e-12)
    assert seen == [["id", "k", "p_value", "_piece"]] * 2
