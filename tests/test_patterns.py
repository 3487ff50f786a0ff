"""Scans and covariate removal where features lack samples, against least squares feature by feature."""
import itertools

import numpy as np
import pandas as pd
import pytest

from allelespark.functions.stats import hwe_exact, t_p
from allelespark.operators import assoc, blocks
from allelespark.operators.covariates import remove_effects

N, V, G = 36, 7, 6


def ols(y, g, *cov):
    """Slope, se, dof of g, missing calls at the mean of those samples."""
    g = np.where(np.isnan(g), np.nanmean(g), g)
    x = np.column_stack([np.ones(len(y)), g, *cov])
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    dof = len(y) - np.linalg.matrix_rank(x)
    return b[1], np.sqrt(((y - x @ b) ** 2).sum() / dof * np.linalg.pinv(x.T @ x)[1, 1]), dof


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(5)
    g = rng.integers(0, 3, (V, N)).astype(float)
    g[rng.random((V, N)) < 0.08] = np.nan
    cov = np.stack([rng.normal(size=N), rng.integers(0, 2, N).astype(float)])
    y = rng.normal(size=(G, N)) + 0.8 * np.nan_to_num(g[:G]) + cov[0]
    have = rng.random((G, N)) < np.array([1, 1, 0.9, 0.8, 0.55, 0.9])[:, None]
    have[5] = have[2]  # two features of one class
    cov[1, :8] = 1.0
    have[4, 8:] &= cov[1, 8:] == 1  # a covariate that is constant where the feature is
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    cells = itertools.product(range(V), range(N))
    geno = frame([(v, s, None if np.isnan(g[v, s]) else float(g[v, s])) for v, s in cells], "variant_id long, sample_id long, dosage double")
    pheno = frame([(f, s, float(y[f, s])) for f in range(G) for s in range(N) if have[f, s]], "feature_id long, sample_id long, value double")
    long = frame([(f"c{i}", s, float(cov[i, s])) for i in range(2) for s in range(N)], "covariate string, sample_id long, value double")
    variants = frame([(v, "1", 100 + v) for v in range(V)], "variant_id long, chrom string, pos long")
    genes = frame([(f, "1", 100, 200, "+") for f in range(G)], "gene_id long, chrom string, gstart long, gend long, strand string")
    return {"g": g, "y": y, "cov": cov, "have": have, "geno": geno, "pheno": pheno, "long": long, "variants": variants, "genes": genes}


@pytest.mark.parametrize("with_cov", [False, True])
def test_cis_and_trans_equal_least_squares(spark, world, with_cov):
    w = world
    prep = assoc.Prepared(w["geno"], w["pheno"], w["long"] if with_cov else None)
    near = {(r.gene_id, r.variant_id): r for r in assoc.cis_nominal(prep, w["variants"], w["genes"], window=1000).collect()}
    far = {(r.gene_id, r.variant_id): r for r in assoc.trans_pairs(prep, w["variants"], w["genes"], 0.9999, 0.0).collect()}
    assert len(near) == G * V and len(far) > 0.9 * G * V
    for (f, v), r in near.items():
        at = w["have"][f]
        b, se, dof = ols(w["y"][f, at], w["g"][v, at], *(w["cov"][:, at] if with_cov else []))
        called = w["g"][v, at][~np.isnan(w["g"][v, at])]
        minor = called.mean() <= 1
        assert (r.beta, r.se, r.n) == (pytest.approx(b), pytest.approx(se), at.sum())
        assert r.p_value == pytest.approx(float(t_p(b / se, dof)), rel=1e-6)
        assert r.ma_count == pytest.approx(called.sum() if minor else 2 * len(called) - called.sum())
        assert r.ma_samples == ((called > 0.5) if minor else (called < 1.5)).sum()
        if (f, v) in far:
            assert far[f, v].beta == pytest.approx(b) and far[f, v].se == pytest.approx(se)


def test_twenty_of_thirty_samples(spark):
    """One gene that a third of the samples lack, and a covariate."""
    rng = np.random.default_rng(8)
    g, c = rng.integers(0, 3, 30).astype(float), rng.normal(size=30)
    y = 0.3 * g + c + rng.normal(size=30)
    geno = spark.createDataFrame([("v", s, float(g[s])) for s in range(30)], "variant_id string, sample_id long, dosage double")
    both = [("whole", s, float(y[s])) for s in range(30)] + [("part", s, float(y[s])) for s in range(20)]
    pheno = spark.createDataFrame(both, "feature_id string, sample_id long, value double")
    cov = spark.createDataFrame([("c", s, float(c[s])) for s in range(30)], "covariate string, sample_id long, value double")
    variants = spark.createDataFrame([("v", "1", 5)], "variant_id string, chrom string, pos long")
    genes = spark.createDataFrame([(f, "1", 1, 9, "+") for f in ("whole", "part")], "gene_id string, chrom string, gstart long, gend long, strand string")
    got = {r.gene_id: r for r in assoc.cis_nominal(assoc.Prepared(geno, pheno, cov), variants, genes).collect()}
    for name, n in (("whole", 30), ("part", 20)):
        b, se, _ = ols(y[:n], g[:n], c[:n])
        assert got[name].n == n and got[name].beta == pytest.approx(b) and got[name].se == pytest.approx(se)


def test_permutations_of_a_feature_with_gaps(spark, world):
    w = world
    prep = assoc.Prepared(w["geno"], w["pheno"], w["long"])
    got = {r.gene_id: r for r in assoc.cis_permutation(prep, w["variants"], w["genes"], window=1000, permutations=200).collect()}
    assert len(got) == G
    for f, r in got.items():
        at = w["have"][f]
        t = {v: (lambda b, se, dof: (b / se, dof))(*ols(w["y"][f, at], w["g"][v, at], *w["cov"][:, at])) for v in range(V)}
        best = max(t, key=lambda v: abs(t[v][0]))
        assert r.variant_id == best and r.p_value == pytest.approx(float(t_p(*t[best])), rel=1e-6)
        assert 1 / 201 <= r.p_perm <= 1 and r.p_perm >= r.p_value * 0.5


def test_small_values_are_kept_and_what_is_dropped_is_named(spark, world):
    w = world
    tiny = w["pheno"].withColumn("value", w["pheno"]["value"] * 1e-6)
    flat = spark.createDataFrame([(77, s, 3.0) for s in range(N)] + [(78, s, float(s)) for s in range(3)], tiny.schema)
    fixed = spark.createDataFrame([(50, s, 2.0) for s in range(N)], w["geno"].schema)
    prep = assoc.Prepared(w["geno"].union(fixed), tiny.union(flat), w["long"])
    assert assoc.cis_nominal(prep, w["variants"], w["genes"], window=1000).count() == G * V
    assert {(r.feature_id, r.reason) for r in prep.skipped_features().collect()} == {(77, "no variation beyond the covariates"), (78, "too few samples")}
    assert [r.variant_id for r in prep.skipped_variants().collect()] == [50]
    traits = tiny.withColumnRenamed("feature_id", "trait")
    assert assoc.linear_gwas(w["geno"], traits, w["long"]).count() == G * V


def test_turns_give_what_one_turn_gives(spark, world, monkeypatch):
    w = world
    traits = w["pheno"].withColumnRenamed("feature_id", "trait")
    key = lambda rows: sorted((r.phenotype, r.variant_id, round(r.beta, 10), round(r.se, 10), r.n_called) for r in rows)
    one = key(assoc.linear_gwas(w["geno"], traits, w["long"]).collect())
    monkeypatch.setattr(blocks, "BLOCK_CELLS", 64)
    plain = blocks.in_turns
    monkeypatch.setattr(assoc, "in_turns", lambda *a: plain(*a, turn_bytes=4000))
    assert key(assoc.linear_gwas(w["geno"], traits, w["long"]).collect()) == one and len(one) == G * V


def test_variant_filters(spark, world):
    w = world
    traits = w["pheno"].withColumnRenamed("feature_id", "trait")
    got = {r.variant_id for r in assoc.linear_gwas(w["geno"], traits, missing=0.12, hwe=0.02).collect()}
    want = set()
    for v in range(V):
        called = w["g"][v][~np.isnan(w["g"][v])]
        p = hwe_exact(*[np.array([(called == k).sum()]) for k in range(3)])[0]
        if 1 - len(called) / N <= 0.12 and p >= 0.02:
            want.add(v)
    assert got == want and 0 < len(want) < V


def test_removal_with_gaps(spark, world):
    w = world
    cov = w["long"].where("NOT (covariate = 'c0' AND sample_id = 3)")  # takes the mean
    c0 = w["cov"][0].copy()
    c0[3] = np.delete(c0, 3).mean()
    got = remove_effects(w["pheno"], cov).toPandas().pivot(index="feature_id", columns="sample_id", values="value").to_numpy()
    for f in range(G):
        at = w["have"][f]
        x = np.column_stack([np.ones(at.sum()), c0[at], w["cov"][1, at]])
        if np.linalg.matrix_rank(x) < 3:
            continue  # a covariate that doesn't vary there has no effect of its own
        b = np.linalg.lstsq(x, w["y"][f, at], rcond=None)[0]
        assert np.allclose(got[f, at], w["y"][f, at] - x[:, 1:] @ b[1:])
    kept = remove_effects(w["pheno"], cov, gaps="keep").toPandas().pivot(index="feature_id", columns="sample_id", values="value").to_numpy()
    assert np.allclose(kept[3, w["have"][3]], w["y"][3, w["have"][3]]) and not np.allclose(kept[0], w["y"][0])


def test_exact_hardy_weinberg_at_scale():
    rng = np.random.default_rng(2)
    q = rng.uniform(0.001, 0.5, 2000)
    n = 500_000
    het, hom = rng.binomial(n, 2 * q * (1 - q)), rng.binomial(n, q * q)
    p = hwe_exact(hom, het, n - het - hom)
    assert ((p > 0) & (p <= 1)).all()
    rows = pd.DataFrame({"a": hom, "b": het}).drop_duplicates()
    assert len(rows) > 1900


def test_trans_hits_are_read_not_written(spark, world, monkeypatch):
    """Hits grow with the pairs: turns yield them when they are read, and only features, their numbers and packed variants are written."""
    w, seen = world, []
    plain, write = blocks.in_turns, blocks.materialize
    prep = assoc.Prepared(w["geno"], w["pheno"], w["long"])
    key = lambda d: sorted((r.gene_id, r.variant_id, round(r.beta, 10), round(r.t, 10)) for r in d.collect())
    one = key(assoc.trans_pairs(prep, w["variants"], w["genes"], 0.9, 0.0))
    monkeypatch.setattr(blocks, "materialize", lambda df: seen.append(df.columns) or write(df))
    monkeypatch.setattr(assoc, "in_turns", lambda *a, **kw: plain(*a, **kw, turn_bytes=4000))
    hits = assoc.trans_pairs(prep, w["variants"], w["genes"], 0.9, 0.0)
    assert key(hits) == one and key(hits) == one and len(one) > G
    assert len(seen) >= 3 and not [c for c in seen if "p_value" in c]
