"""Models against NumPy: planted effects, orthogonality, eigen equations, likelihood maxima."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from allelespark.functions.stats import t_p
from allelespark.operators import assoc as AS
from allelespark.operators import covariates as V
from allelespark.operators import finemap as FM
from allelespark.operators import interaction as I
from allelespark.operators import multitest as MT

N, VARS, GENES = 60, 40, 6


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    g = rng.choice([0.0, 1.0, 2.0], size=(VARS, N), p=[0.4, 0.4, 0.2])
    age = rng.normal(50, 8, N)
    y = rng.normal(10, 1, (GENES, N)) + 0.05 * age
    for k in range(3):
        y[k] += (2 + k) * g[5 * k]  # planted slopes
    miss = rng.random(g.shape) < 0.05
    long = lambda m, a: pd.DataFrame([(i, f"S{j:03d}", float(m[i, j])) for i in range(m.shape[0]) for j in range(N)], columns=a)
    gl = long(g, ["variant_id", "sample_id", "dosage"])
    gl.loc[miss.ravel(), "dosage"] = np.nan
    geno = spark.createDataFrame(gl, "variant_id long, sample_id string, dosage double").withColumn("dosage", F.nanvl("dosage", F.lit(None)))
    pheno = spark.createDataFrame(long(y, ["feature_id", "sample_id", "value"]), "feature_id long, sample_id string, value double")
    cov = spark.createDataFrame([("age", f"S{j:03d}", float(age[j])) for j in range(N)], "covariate string, sample_id string, value double")
    variants = spark.range(VARS).select(F.col("id").alias("variant_id"), F.lit("1").alias("chrom"), (F.col("id") * 1000 + 1000).alias("pos"))
    genes = spark.range(GENES).select(
        F.col("id").alias("gene_id"), F.lit("1").alias("chrom"), (F.col("id") * 5000 + 500).alias("gstart"), (F.col("id") * 5000 + 900).alias("gend"),
        F.lit("+").alias("strand"))
    filled = np.where(miss, np.nan, g)
    filled = np.where(miss, np.nanmean(filled, axis=1)[:, None], filled)
    return dict(geno=geno, pheno=pheno, cov=cov, variants=variants, genes=genes, g=filled, y=y, age=age)


def ols(x, y):
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    res = y - x @ b
    se = np.sqrt(res @ res / (len(y) - x.shape[1]) * np.diag(np.linalg.inv(x.T @ x)))
    return b, se


def test_cis_nominal_equals_ols_and_finds_planted(data):
    prep = AS.Prepared(data["geno"], data["pheno"], data["cov"])
    out = AS.cis_nominal(prep, data["variants"], data["genes"], window=100_000).toPandas()
    assert len(out) == VARS * GENES
    for r in out.sample(40, random_state=1).itertuples():
        b, se = ols(np.column_stack([np.ones(N), data["g"][r.variant_id], data["age"]]), data["y"][r.gene_id])
        assert np.isclose(r.beta, b[1]) and np.isclose(r.se, se[1]) and np.isclose(r.p_value, t_p(b[1] / se[1], N - 3), rtol=1e-6)
    best = out.loc[out.groupby("gene_id")["p_value"].idxmin()].set_index("gene_id")
    for k in range(3):
        assert best.loc[k, "variant_id"] == 5 * k and abs(best.loc[k, "beta"] - (2 + k)) < 0.6


def test_permutation_scan(data):
    prep = AS.Prepared(data["geno"], data["pheno"], data["cov"])
    a = AS.cis_map(prep, data["variants"], data["genes"], lam=0.5, window=100_000, permutations=200).toPandas().set_index("gene_id")
    b = AS.cis_map(prep, data["variants"], data["genes"], lam=0.5, window=100_000, permutations=200).toPandas().set_index("gene_id")
    assert (a["p_perm"].sort_index() == b["p_perm"].sort_index()).all()  # seeded
    assert (a.loc[[0, 1, 2], "p_perm"] < 0.01).all() and (a["p_beta"] >= a["p_value"] * 0.5).all()
    assert np.abs(np.log10(a["p_beta"] / a["p_perm"])[a["p_perm"] > 0.05]).max() < 0.5


def test_trans_equals_nominal_hits(data):
    prep = AS.Prepared(data["geno"], data["pheno"], data["cov"])
    full = AS.cis_nominal(prep, data["variants"], data["genes"], window=10_000_000).toPandas()
    hits = AS.trans_pairs(prep, data["variants"], data["genes"], p=0.05, maf=0.0).toPandas()
    want = full[full["p_value"] <= 0.05]
    assert set(zip(hits["gene_id"], hits["variant_id"])) == set(zip(want["gene_id"], want["variant_id"]))


def test_logistic_is_at_the_maximum(spark, data):
    rng = np.random.default_rng(3)
    eta = -1 + 1.2 * data["g"][0]
    case = (rng.random(N) < 1 / (1 + np.exp(-eta))).astype(float)
    trait = spark.createDataFrame([(f"S{j:03d}", float(case[j])) for j in range(N)], "sample_id string, value double")
    out = AS.logistic_gwas(data["geno"], trait, data["cov"]).toPandas().set_index("variant_id")
    x = np.column_stack([data["g"][0], np.ones(N), data["age"]])
    b = np.zeros(3)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve(x.T @ (x * (mu * (1 - mu))[:, None]), x.T @ (case - mu))
    assert np.isclose(out.loc[0, "beta"], b[0], rtol=1e-6) and out["converged"].any()


def test_interaction_equals_ols(spark, data):
    leads = spark.createDataFrame([(k, 5 * k) for k in range(GENES)], "feature_id long, variant_id long")
    full = data["geno"].where("dosage IS NOT NULL")
    out = I.interaction_scan(data["pheno"], full, leads, data["cov"], ["age"], others=5).toPandas().set_index("gene_id")
    gp = full.toPandas()
    for k in range(GENES):
        d = gp[gp["variant_id"] == 5 * k]
        j = d["sample_id"].str[1:].astype(int).to_numpy()
        g, a = d["dosage"].to_numpy(), data["age"][j]
        b, se = ols(np.column_stack([np.ones(len(j)), g, a, g * a]), data["y"][k][j])
        assert np.isclose(out.loc[k, "interaction_beta"], b[3], rtol=1e-5) and np.isclose(out.loc[k, "main_effect_beta"], b[1], rtol=1e-5)
        assert np.isclose(out.loc[k, "interaction_pvalue"], t_p(b[3] / se[3], len(j) - 4), rtol=1e-5)


def test_removed_effects_are_orthogonal(data):
    out = V.remove_effects(data["pheno"], data["cov"], centre=True).toPandas().pivot(index="feature_id", columns="sample_id", values="value")
    m = out.to_numpy()
    assert np.abs(m @ (data["age"] - data["age"].mean())).max() < 1e-7 and np.abs(m.sum(axis=1)).max() < 1e-9


def test_pcs_satisfy_the_eigen_equation(data):
    pcs = V.phenotype_pcs(data["pheno"], 3).toPandas()
    y = data["y"]
    z = (y - y.mean(axis=1, keepdims=True)) / y.std(axis=1, keepdims=True)
    gram = z.T @ z
    for c, d in pcs.groupby("component"):
        s = d.sort_values("sample_id")["score"].to_numpy()
        assert np.allclose(gram @ s, (s @ s) * s, rtol=1e-6, atol=1e-6)
        assert np.isclose(d["explained"].iloc[0], s @ s / np.trace(gram))


def test_tiled_cross_products(spark, data):
    long = data["pheno"].withColumnRenamed("feature_id", "key_id")
    index = V.sample_index(long)
    out = V.cross_products(V.packed_rows(long, index, "key_id"), N, "key_id", tile=16, chunk=2).toPandas()
    want = data["y"].T @ data["y"]
    assert len(out) == N * (N + 1) // 2 and np.allclose(out["s"], want[out["i"], out["j"]])


def test_posteriors_and_sets(spark):
    rng = np.random.default_rng(5)
    rows = [(g, v, float(10 ** -rng.uniform(5.1, 9)), 0.3) for g in range(5) for v in range(30)]
    df = spark.createDataFrame(rows, "gene_id long, variant_id long, p_value double, maf double")
    for m in ("susie", "finemap", "abf"):
        src = df.withColumns({"beta": F.lit(0.1), "se": F.lit(0.05)})
        post = FM.METHODS[m](src).toPandas()
        assert np.allclose(post.groupby("gene_id")["posterior"].sum(), 1)
        sets = FM.credible_sets(FM.METHODS[m](src)).toPandas()
        first = sets[sets["set_index"] == 0]
        top = first.groupby("gene_id")["cum_posterior"].max()
        assert (top >= 0.95 - 1e-12).all()
        assert (first.groupby("gene_id")["is_lead"].sum() == 1).all()


def test_pi0_of_uniform_p_is_one(spark):
    df = spark.range(4999).select(((F.col("id") * 7919 % 4999 + 1) / 5000.0).alias("p_value"))
    q = MT.qvalues(df).toPandas()
    assert q["qval"].min() > 0.8
