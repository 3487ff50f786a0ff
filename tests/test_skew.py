"""Balanced building blocks give the plain answers when one group holds most rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from allelespark.operators import multitest as MT
from allelespark.operators.joins import overlapping_genes, window_pairs
from allelespark.operators.ordered import exact_quantiles, ordered
from allelespark.operators.ranking import hash_sample


@pytest.fixture(scope="module")
def hot(spark):
    """Group 0 holds two thirds of the rows and a fifth of all values are tied."""
    i = F.col("id")
    df = spark.range(30000).select(
        i, F.when(i % 3 < 2, 0).otherwise(i % 40).alias("k"),
        F.when(i % 5 == 0, 0.25).otherwise(((i * 7919) % 29989 + 1) / 29990.0).alias("p"),
    )
    return df.cache()


def test_ordered_rank_and_prefix(hot):
    got = ordered(hot, ["k"], [F.col("p"), F.col("id")], {"before": F.col("p")}, partitions=7).toPandas()
    want = hot.toPandas().sort_values(["k", "p", "id"])
    want["rank"] = want.groupby("k").cumcount() + 1
    want["before"] = want.groupby("k")["p"].cumsum() - want["p"]
    both = got.merge(want, on="id", suffixes=("", "_w"))
    assert len(both) == 30000 and (both["rank"] == both["rank_w"]).all() and np.allclose(both["before"], both["before_w"])


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_quantiles_by_bracket(hot, keys):
    probs = {"a": 0.5, "b": 0.01, "c": 0.999, "d": 0.0, "e": 1.0}
    got = {r["k"] if keys else 0: r for r in exact_quantiles(hot, keys, "p", probs, small=10, accuracy=200).collect()}
    pdf = hot.toPandas()
    for k, g in pdf.groupby("k") if keys else [(0, pdf)]:
        assert np.allclose([got[k][c] for c in probs], np.quantile(g["p"], list(probs.values())), rtol=1e-12)


def test_bh_split_groups(hot):
    got = MT.bh_fdr(hot, ["k"], "p").toPandas()
    for _, g in got.groupby("k"):
        p = g["p"].to_numpy()
        order = np.argsort(p, kind="stable")
        f = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
        want = np.empty(len(p))
        want[order] = np.minimum(f, 1)
        assert np.allclose(g["fdr"], want)


def test_hash_sample_exact_size(hot):
    quotas = hot.groupBy("k").agg(F.least(F.count("*"), F.lit(50)).alias("quota"))
    got = hash_sample(hot, ["k"], F.col("id"), quotas)
    assert {r["count"] for r in got.groupBy("k").count().collect()} == {50}
    assert hash_sample(hot, [], F.col("id"), 777).count() == 777


def test_window_pairs_brute_force(spark):
    rng = np.random.default_rng(1)
    v = [(int(i), str(i % 2), int(x)) for i, x in enumerate(np.r_[rng.integers(0, 5_000_000, 300), np.full(150, 1_234_567)])]
    g = [(int(i), str(i % 2), int(a), int(a + b)) for i, (a, b) in enumerate(zip(rng.integers(0, 5_000_000, 60), rng.integers(1, 3_000_000, 60)))]
    vs = spark.createDataFrame(v, "variant_id long, chrom string, pos long")
    gs = spark.createDataFrame(g, "gene_id long, chrom string, gstart long, gend long")
    got = {(r.variant_id, r.gene_id) for r in window_pairs(vs, gs, 200_000).select("variant_id", "gene_id").collect()}
    assert got == {(a, x) for a, c, pos in v for x, d, s, e in g if c == d and s - 200_000 <= pos <= e + 200_000}
    loci = vs.select("variant_id", "chrom", (F.col("pos") - 50_000).alias("lo"), (F.col("pos") + 50_000).alias("hi"))
    rows = [(r.variant_id, r.gene_id) for r in overlapping_genes(loci, gs, 100_000).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(a, x) for a, c, pos in v for x, d, s, e in g if c == d and s <= pos + 50_000 and e >= pos - 50_000}


def test_block_scan_splits_a_crowded_bin(spark):
    """All variants and genes in one bin, blocks of two rows: every pair once."""
    import pandas as pd

    from allelespark.operators.blocks import gene_bins, scan_blocks, variant_bins

    v = spark.range(37).select(F.col("id").alias("variant_id"), F.lit("1").alias("chrom"), F.lit(5).cast("long").alias("pos"))
    g = spark.range(11).select(F.col("id").alias("feature_id"), F.col("id").alias("gene_id"), F.lit("1").alias("chrom"),
                               F.lit(4).cast("long").alias("gstart"), F.lit(6).cast("long").alias("gend"))

    def pairs(a, b):
        assert len(a) < 15
        return a[["variant_id"]].merge(b[["feature_id"]], how="cross")

    vb, gb = variant_bins(v, 100), gene_bins(g, 1, 100)
    out = scan_blocks(vb, gb, vb, gb.withColumn("feature_id", F.col("gene_id")), ["chrom", "_bin"], 2, pairs, "variant_id long, feature_id long")
    assert out.count() == out.distinct().count() == 37 * 11
