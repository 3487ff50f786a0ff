"""Alignment, positional and set joins.  Broadcasts are left to the planner's size check."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.operators.clean import sample_key
from allelespark.operators.ordered import first_rows
from allelespark.session import materialize


def sample_ids(df: DataFrame, column: str = "sample_id") -> DataFrame:
    return df.select(F.trim(F.col(column).cast("string")).alias("sample_id")).distinct()


def in_all(sets: Sequence[DataFrame]) -> DataFrame:
    """Ids present in every set."""
    tagged = [s.select("sample_id").distinct() for s in sets]
    return (
        reduce(DataFrame.unionAll, tagged).groupBy("sample_id").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == len(tagged)).select("sample_id")
    )


def shared_samples(*tables: DataFrame) -> DataFrame:
    """Trimmed ids present in every table, fixed once; an empty overlap is an error.

    One id per sample is checkpointed, so the wide scan for ids is not repeated downstream.
    """
    common = materialize(in_all([sample_ids(t) for t in tables]))
    if common.isEmpty():
        raise ValueError("no sample is shared by all tables")
    return common


def restrict(table: DataFrame, samples: DataFrame) -> DataFrame:
    trimmed = table.withColumn("sample_id", F.trim(F.col("sample_id").cast("string")))
    return trimmed.join(samples.select("sample_id"), "sample_id", "left_semi")


def align_samples(*tables: DataFrame) -> list[DataFrame]:
    """Restrict every table to the samples all of them share."""
    common = shared_samples(*tables)
    return [restrict(t, common) for t in tables]


def feature_positions(features: DataFrame, annotation: DataFrame, key: str = "gene_id") -> DataFrame:
    """Position of each feature, first annotation match, with a default for the unmatched."""
    place = first_rows(
        annotation.select(F.col(key).alias("feature_id"), "chrom", "gstart", "gend", "strand"),
        ["feature_id"],
        [F.col("gstart"), F.col("gend")],
    )
    return features.select("feature_id").distinct().join(place, "feature_id", "left").select(
        "feature_id",
        F.coalesce("chrom", F.lit("1")).alias("chrom"),
        F.coalesce("gstart", F.lit(1)).alias("gstart"),
        F.coalesce("gend", F.lit(1000)).alias("gend"),
        F.coalesce("strand", F.lit("+")).alias("strand"),
    )


def with_coordinates(long: DataFrame, genes: DataFrame) -> DataFrame:
    return long.join(genes.withColumnRenamed("gene_id", "feature_id"), "feature_id")


def bins(lo: Column, hi: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))


def window_pairs(variants: DataFrame, genes: DataFrame, window: int = 1_000_000, salts: int = 8) -> DataFrame:
    """Variant-gene pairs with ``pos`` in [gstart - window, gend + window] on one chromosome.

    Both sides are keyed by (chromosome, bin, salt), so the range test becomes an equi-join and a
    crowded bin is spread over ``salts`` keys.
    """
    w = window
    v = variants.withColumns({
        "_bin": F.floor(F.col("pos") / w),
        "_salt": F.pmod(F.xxhash64("variant_id"), F.lit(salts)).cast("int"),
    })
    g = genes.withColumn("_bin", bins(F.col("gstart") - w, F.col("gend") + w, w)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    pairs = v.join(g, ["chrom", "_bin", "_salt"])
    inside = F.col("pos").between(F.col("gstart") - w, F.col("gend") + w)
    return pairs.where(inside).drop("_bin", "_salt")


def overlapping_genes(loci: DataFrame, genes: DataFrame, width: int = 1_000_000, salts: int = 8) -> DataFrame:
    """Genes whose interval overlaps [lo, hi] of a locus on the same chromosome."""
    a = loci.withColumn("_bin", bins(F.col("lo"), F.col("hi"), width)).withColumn(
        "_salt", F.pmod(F.xxhash64("lo", "hi"), F.lit(salts)).cast("int")
    )
    b = genes.withColumn("_bin", bins(F.col("gstart"), F.col("gend"), width)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    hit = (F.col("gstart") <= F.col("hi")) & (F.col("gend") >= F.col("lo"))
    # an overlap spanning several bins is reported from the first bin both intervals share
    first = F.col("_bin") == F.greatest(F.floor(F.col("lo") / width), F.floor(F.col("gstart") / width))
    return a.join(b, ["chrom", "_bin", "_salt"]).where(hit & first).drop("_bin", "_salt")


def drop_cis(pairs: DataFrame, window: int = 5_000_000) -> DataFrame:
    """Keep pairs on different chromosomes or further apart than the window."""
    return pairs.where((F.col("v_chrom") != F.col("g_chrom")) | (F.abs(F.col("pos") - F.col("tss")) > window))


def map_samples(long: DataFrame, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Move rows from one library id to another by normalised id; unmapped rows are dropped."""
    m = mapping.select(sample_key(F.col(old)).alias("_key"), sample_key(F.col(new)).alias("_new")).dropna()
    m = first_rows(m, ["_key"], [F.col("_new").desc()])
    out = long.withColumn("_key", sample_key(F.col("sample_id"))).join(m, "_key")
    return out.withColumn("sample_id", F.col("_new")).drop("_key", "_new")


def assemble_covariates(meta: DataFrame, samples: DataFrame, pcs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Metadata rows of known samples, first per id, complete only, with PCs attached."""
    kept = meta.join(samples.select("sample_id"), "sample_id", "left_semi")
    kept = first_rows(kept, ["sample_id"], [F.col(c) for c in order]).dropna()
    return kept.join(pcs, "sample_id", "left")


def overlap_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every id once, with the side(s) it occurs on."""
    a = left.select("sample_id").distinct().withColumn("_l", F.lit(True))
    b = right.select("sample_id").distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_l") & F.col("_r"), "common").when(F.col("_l"), "left_only").otherwise("right_only")
    return a.join(b, "sample_id", "full_outer").select("sample_id", side.alias("side"))


def membership(genotypes: DataFrame, datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Comma list of the datasets each genotype sample occurs in."""
    tagged = [d.select("sample_id", F.lit(n).alias("dataset")) for n, d in datasets.items()]
    sets = reduce(DataFrame.unionByName, tagged).groupBy("sample_id").agg(
        F.array_join(F.array_sort(F.collect_set("dataset")), ",").alias("datasets")
    )
    return genotypes.select("sample_id").distinct().join(sets, "sample_id", "left").select(
        "sample_id", F.coalesce("datasets", F.lit("")).alias("datasets")
    )


def align_design(long: DataFrame, design: DataFrame, linear: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Data and design over shared samples; missing linear covariates take the column mean."""
    d = design.join(long.select("sample_id").distinct(), "sample_id", "left_semi")
    means = d.agg(*[F.avg(c).alias(c) for c in linear])
    d = d.withColumns({c: F.coalesce(F.col(c).cast("double"), means.select(c).scalar()) for c in linear})
    return long.join(design.select("sample_id").distinct(), "sample_id", "left_semi"), d


def subset_samples(geno: DataFrame, keep: DataFrame) -> DataFrame:
    return geno.join(keep.select("sample_id"), "sample_id", "left_semi")


def rename_samples(geno: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace ids by their mapped name; unmapped ids stay."""
    out = geno.join(mapping.select(F.col("old").alias("sample_id"), "new"), "sample_id", "left")
    return out.withColumn("sample_id", F.coalesce("new", "sample_id")).drop("new")


def graph_nodes(assoc: DataFrame) -> DataFrame:
    genes = assoc.select(F.col("gene_id").cast("string").alias("id"), F.lit("gene").alias("type"), F.lit(20).alias("size"))
    snps = assoc.select(F.col("variant_id").cast("string").alias("id"), F.lit("variant").alias("type"), F.lit(15).alias("size"))
    return genes.unionByName(snps).distinct()


def graph_edges(assoc: DataFrame) -> DataFrame:
    """Variant to gene: strength and line width, with the effect (0 where the table has none) and the p-value."""
    strength = -F.log10("p_value")
    beta = F.coalesce(F.col("beta"), F.lit(0.0)) if "beta" in assoc.columns else F.lit(0.0)
    return assoc.select(
        F.col("variant_id").cast("string").alias("source"),
        F.col("gene_id").cast("string").alias("target"),
        strength.alias("value"),
        F.greatest(F.lit(1.0), F.least(F.lit(10.0), strength / 2)).alias("width"),
        beta.alias("beta"), "p_value",
    )


def only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("sample_id").distinct().join(right.select("sample_id"), "sample_id", "left_anti")


def tagged_union(parts: Mapping[str, DataFrame], tag: str = "phenotype") -> DataFrame:
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [d.withColumn(tag, F.lit(n)) for n, d in parts.items()],
    )


def append_covariates(given: DataFrame, derived: DataFrame) -> DataFrame:
    return given.unionByName(derived, allowMissingColumns=True)
