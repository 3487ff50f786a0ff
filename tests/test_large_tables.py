"""What larger tables brought out: scans in tiles, constant statistics, limits of the SQL."""
import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from allelespark.functions.stats import r_threshold
from allelespark.operators import assoc, finemap, summary
from allelespark.plans import catalog


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(21)
    n, nv, nf = 24, 40, 30
    g, c, y = rng.integers(0, 3, (nv, n)), rng.normal(size=n), rng.normal(size=(nf, n))
    have = (np.arange(nf)[:, None] * 3 + np.arange(n)) % (4 + np.arange(nf)[:, None] % 3) != 0
    have[::5] = True
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    geno = frame([(v, s, float(g[v, s])) for v in range(nv) for s in range(n) if (v + s) % 9], "variant_id long, sample_id long, dosage double")
    pheno = frame([(f, s, float(y[f, s])) for f in range(nf) for s in range(n) if have[f, s]], "feature_id long, sample_id long, value double")
    prep = assoc.Prepared(geno, pheno, frame([("c", s, float(c[s])) for s in range(n)], "covariate string, sample_id long, value double"))
    places = frame([(v, "1", v) for v in range(nv)], "variant_id long, chrom string, pos long")
    v = prep.variant_rows(places).toPandas()
    return prep, v, prep.feature_rows().toPandas().assign(_at=lambda d: d["feature_id"])


@pytest.mark.parametrize("p,maf", [(0.05, 0.0), (0.9, 0.3)])
def test_tiles_give_the_hits_of_all_pair_sums(sides, monkeypatch, p, maf):
    prep, v, g = sides
    monkeypatch.setattr(assoc, "TILE", 3)
    monkeypatch.setattr(assoc, "HITS", 50)
    frames = list(assoc._trans_hits(v, assoc.TransSide(g, prep.n, prep.k, p), prep.n, prep.k, maf))
    assert max(map(len, frames)) < 50 + 3 * len(v)
    got = pd.concat(frames).set_index(["_at", "variant_id"]).sort_index()
    sums = assoc.PairSums(v, g, prep.n, prep.k)
    cut = np.array([r_threshold(p, d) ** 2 for d in sums.dof[0]])
    i, j = np.nonzero(sums.usable(maf) & (sums.num**2 >= cut * sums.sg2 * sums.sy2))
    want = pd.DataFrame({"_at": g["feature_id"].to_numpy()[j], "variant_id": v["variant_id"].to_numpy()[i], **sums.rows(i, j)})
    want = want.set_index(["_at", "variant_id"]).sort_index()
    assert len(want) > 20 and got.index.equals(want.index)
    for name in ("maf", "beta", "se", "t", "p_value", "log10p"):
        assert np.allclose(got[name], want[name], rtol=1e-9)


def beside_sql(spark, folder, name, lineitem):
    """Sorted rows of a registered query and of its SQL over one generated table."""
    con = duckdb.connect()
    con.execute(f"COPY ({lineitem}) TO '{folder}/lineitem.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet'")
    df = catalog.QUERIES[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    return sorted(str(tuple(r)) for r in df.collect()), sorted(map(str, want))


def test_correlations_of_hits_with_one_p_value(spark, tmp_path):
    got, want = beside_sql(spark, tmp_path, "a26_statistic_correlations", """
        SELECT 1::BIGINT AS l_suppkey, 99991 * i AS l_partkey, (i * 7 % 11) / 100.0::DOUBLE AS l_discount, (i % 9) / 100.0::DOUBLE AS l_tax FROM range(150) r(i)""")
    assert got == want and sum("nan" in r for r in got) == 3


def test_trend_over_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0)], "a double, b double")
    assert np.isnan(summary.trend(df, "a", "b").first()["r"])


def test_missing_matrix_has_the_features_of_its_sql(spark, tmp_path):
    got, want = beside_sql(spark, tmp_path, "a42_missing_matrix", """
        SELECT f AS l_suppkey, s AS l_orderkey, 10.0::DOUBLE * f + s AS l_extendedprice FROM range(1300) a(f), range(2) b(s)""")
    assert len(want) == 2600 and got == want


def test_permutations_are_judged_some_features_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    b = pd.DataFrame({"gene_id": range(300), "r": rng.uniform(-0.7, 0.7, 300), "null": list(rng.uniform(0.05, 0.7, (300, 40))), "dof": 30.0})
    monkeypatch.setattr(assoc, "FINISH_ROWS", 300)
    whole = pd.concat(assoc._permutation_p([b], 40))
    monkeypatch.setattr(assoc, "FINISH_ROWS", 64)
    seen, fit = [], assoc.fit_beta
    monkeypatch.setattr(assoc, "fit_beta", lambda p: seen.append(len(p)) or fit(p))
    parts = pd.concat(assoc._permutation_p([b, b.iloc[:0]], 40))
    assert seen == [64, 64, 64, 64, 44]
    assert list(parts["gene_id"]) == list(whole["gene_id"])
    for name in ("p_value", "p_perm", "shape1", "shape2", "p_beta"):
        assert np.allclose(parts[name], whole[name], rtol=1e-7)


@pytest.mark.parametrize("method", ["finemap", "susie"])
def test_statistics_of_fine_mapping_dont_pile_up_in_one_plan(spark, method):
    df = spark.range(60).selectExpr("id % 6 AS gene_id", "id AS variant_id", "1e-7D * (1 + id % 13) AS p_value", "0.1D AS maf")
    plan = finemap.METHODS[method](df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # the last statistic's; those before it are written
