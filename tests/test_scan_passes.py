"""How often a scan reads its inputs, and which pairs of a block it works out."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from allelespark.operators import assoc, prepare
from allelespark.plans import catalog, q_io
from allelespark.plans.fixtures import Tables

SF = "/root/testdata/sf0.001"


def scan_inputs(spark, n=24, nv=30, nf=12):
    rng = np.random.default_rng(8)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    geno = frame([(v, s, float(rng.integers(0, 3))) for v in range(nv) for s in range(n) if (v + s) % 9], "variant_id long, sample_id long, dosage double")
    pheno = frame([(f, s, float(rng.normal())) for f in range(nf) for s in range(n) if (f + s) % 7], "feature_id long, sample_id long, value double")
    cov = frame([("c", s, float(rng.normal())) for s in range(n)], "covariate string, sample_id long, value double")
    variants = frame([(v, "1", v * 100) for v in range(nv)], "variant_id long, chrom string, pos long")
    genes = frame([(f, "1", f * 250, f * 250 + 10, "+") for f in range(nf)], "gene_id long, chrom string, gstart long, gend long, strand string")
    return geno, pheno, cov, variants, genes


def test_the_phenotype_is_computed_once(spark):
    geno, pheno, cov, variants, genes = scan_inputs(spark)
    seen, rows = spark.sparkContext.accumulator(0), pheno.count()

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    prep = assoc.Prepared(geno, pheno.mapInPandas(counted, pheno.schema), cov)
    assert prep.gapped and assoc.cis_nominal(prep, variants, genes, window=400).count()
    assert seen.value == rows


def test_cells_of_a_variant_are_shuffled_once(spark):
    out = Tables(spark, SF).geno().groupBy("variant_id").agg(F.collect_list("dosage"))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_classes_with_gaps_are_worked_out_for_near_variants_only(spark, monkeypatch):
    geno, pheno, cov, variants, genes = scan_inputs(spark)
    prep = assoc.Prepared(geno, pheno, cov)
    v, g = prep.variant_rows(variants).toPandas(), prep.feature_rows(genes).toPandas()
    near = np.abs(v["pos"].to_numpy()[:, None] - g["gstart"].to_numpy()) <= 400
    sizes, without = [], assoc.VariantSums.without

    def counted(self, *args):
        out = without(self, *args)
        sizes.append(len(out[0]))
        return out

    monkeypatch.setattr(assoc.VariantSums, "without", counted)
    some = assoc.PairSums(v, g, prep.n, prep.k, near)
    assert sizes and max(sizes) < len(v)
    every = assoc.PairSums(v, g, prep.n, prep.k)
    i, j = np.nonzero(near & every.usable(0.1))
    assert len(i) > 20 and (near & some.usable(0.1) == near & every.usable(0.1)).all()
    pd.testing.assert_frame_equal(pd.DataFrame(some.rows(i, j)), pd.DataFrame(every.rows(i, j)))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sections_of_a_comparison_share_one_computation(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(240).selectExpr("id % 12 AS feature_id", "id DIV 12 AS sample_id", "CAST(id * 7 % 31 AS DOUBLE) AS value")

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    out = prepare.comparison_bundle(rows.mapInPandas(counted, rows.schema), rows)
    assert out.select("section").distinct().count() == 6 and seen.value == 240


@pytest.mark.parametrize("name", ["m12_dispatch", "m12_dispatch_all"])
def test_methods_share_one_aggregation(spark, name):
    assert "parquet" not in plan(catalog.QUERIES[name](spark, SF))


def test_lines_of_a_vcf_share_one_aggregation(spark, monkeypatch):
    bodies, text = [], q_io.text
    monkeypatch.setattr(q_io, "text", lambda t, name, body, *args: bodies.append(body) or text(t, name, body, *args))
    q_io.vcf_file(Tables(spark, SF))
    assert len(bodies) == 2 and not any("parquet" in plan(b) or "map_from_entries" in plan(b) for b in bodies)
