"""The association data model derived from the given tables.

Every view is stated twice: as a DataFrame (``Tables``) and as a SQL common table expression
(``VIEWS``) for the side-by-side check.  Variants come from parts, features from suppliers,
samples (a cohort of 40) from order keys, so all views grow with the tables.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

COHORT = 40

VIEWS: dict[str, str] = {
    "geno": f"""
        SELECT l_partkey AS variant_id, l_orderkey % {COHORT} AS sample_id,
               CASE WHEN (l_partkey * 31 + (l_orderkey % {COHORT}) * 17) % 23 = 0 THEN NULL
                    ELSE CAST(CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) % 3 AS DOUBLE) END AS dosage
        FROM lineitem GROUP BY l_partkey, l_orderkey % {COHORT}""",
    "variants": """
        SELECT p_partkey AS variant_id, CAST(p_partkey % 22 + 1 AS VARCHAR) AS chrom,
               p_partkey * 10000 AS pos, CAST(p_size AS DOUBLE) AS qual
        FROM part""",
    "pheno": f"""
        SELECT l_suppkey AS feature_id, l_orderkey % {COHORT} AS sample_id,
               avg(l_extendedprice) / 997 AS value
        FROM lineitem GROUP BY l_suppkey, l_orderkey % {COHORT}""",
    "pheno_na": """
        SELECT feature_id, sample_id,
               CASE WHEN (feature_id * 13 + sample_id * 7) % (3 + feature_id % 29) = 0 THEN NULL
                    WHEN feature_id % 17 = 3 THEN 5.0
                    WHEN feature_id % 11 = 2 AND sample_id % 3 = 0 THEN 0.0
                    ELSE value END AS value
        FROM pheno""",
    "counts": f"""
        SELECT l_suppkey AS feature_id, l_orderkey % {COHORT} AS sample_id,
               CAST(greatest(sum(l_quantity) - 200, 0) AS DOUBLE) AS value
        FROM lineitem GROUP BY l_suppkey, l_orderkey % {COHORT}""",
    "genes": """
        SELECT s_suppkey AS gene_id, CAST(s_suppkey % 22 + 1 AS VARCHAR) AS chrom,
               s_suppkey * 200000 AS gstart, s_suppkey * 200000 + 10000 AS gend,
               CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '-' END AS strand
        FROM supplier""",
    "covar": f"""
        SELECT o_orderkey % {COHORT} AS sample_id, avg(o_totalprice) / 4003 AS age,
               CAST(CAST(sum(o_custkey) AS BIGINT) % 2 AS BIGINT) AS sex,
               CAST(CAST(sum(o_custkey) AS BIGINT) % 4 AS BIGINT) AS batch,
               avg(CAST(o_custkey % 1000 AS DOUBLE)) / 101 AS rin
        FROM orders GROUP BY o_orderkey % {COHORT}""",
    "covlong": """
        SELECT sample_id, 'age' AS covariate, CAST(round(age, 4) AS VARCHAR) AS value FROM covar
        UNION ALL SELECT sample_id, 'sex', CAST(sex AS VARCHAR) FROM covar
        UNION ALL SELECT sample_id, 'batch', 'b' || CAST(batch AS VARCHAR) FROM covar
        UNION ALL SELECT sample_id, 'rin', CASE WHEN sample_id % 9 = 4 THEN NULL
                                                ELSE CAST(round(rin, 4) AS VARCHAR) END FROM covar
        UNION ALL SELECT sample_id, 'PC1', CAST(round(age - 10 * rin, 4) AS VARCHAR) FROM covar
        UNION ALL SELECT sample_id, 'study_site', '1' FROM covar""",
    "traits": f"""
        SELECT o_orderkey % {COHORT} AS sample_id, 'height' AS trait, avg(o_totalprice) / 1009 AS value
        FROM orders GROUP BY o_orderkey % {COHORT}
        UNION ALL
        SELECT o_orderkey % {COHORT}, 'weight', stddev_samp(o_totalprice) / 500
        FROM orders GROUP BY o_orderkey % {COHORT}
        UNION ALL
        SELECT o_orderkey % {COHORT}, 'ldl', avg(CAST(o_custkey % 97 AS DOUBLE))
        FROM orders GROUP BY o_orderkey % {COHORT}""",
    "assoc": """
        SELECT l_suppkey AS gene_id, l_partkey AS variant_id,
               pow(((l_partkey * 7919 + l_suppkey * 104729) % 99991 + 1) / 100000.0, 4) AS p_value,
               avg(l_discount) / 1.03 - 0.05 AS beta, 0.01 + avg(l_tax) / 9.7 AS se,
               (l_partkey % 50 + 1) / 100.0 AS maf
        FROM lineitem GROUP BY l_suppkey, l_partkey""",
    "gwas": """
        SELECT l_returnflag AS phenotype, l_partkey AS variant_id,
               CAST(l_partkey % 22 + 1 AS VARCHAR) AS chrom, l_partkey * 10000 AS pos,
               pow(((l_partkey * 7919 + ascii(l_returnflag) * 104729) % 99991 + 1) / 100000.0, 3) AS p_value,
               avg(l_discount) / 1.03 - 0.05 AS beta, 0.01 + avg(l_tax) / 9.7 AS se,
               (l_partkey % 50 + 1) / 100.0 AS maf
        FROM lineitem GROUP BY l_returnflag, l_partkey""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the views it names, dependencies first."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in need:
                visit(VIEWS[name])
                if name not in need:
                    need.append(name)

    visit(sql)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in need]
    body = sql.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ", ".join([*ctes, body[15:]])
    if body[:5].upper() == "WITH ":
        return "WITH " + ", ".join([*ctes, body[5:]]) if ctes else body
    return ("WITH " + ", ".join(ctes) + " " if ctes else "") + body


def sid(col: str = "l_orderkey") -> Column:
    return F.col(col) % COHORT


def whole(col: str) -> Column:
    """A double as a whole number, as the SQL's cast has it: rounded, halves to even, where Spark's own cast cuts."""
    return F.rint(col).cast("bigint")


class Tables:
    """Base tables and derived views of one scale-factor folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        raise AttributeError(name)

    def geno(self) -> DataFrame:
        # a variant's cells are few and scans gather them: shuffled by variant alone, they needn't be shuffled again for that;
        # partial and final sums then meet in one task, so there are more and smaller partitions
        parts = 4 * int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        cells = self.lineitem.select(F.col("l_partkey").alias("variant_id"), sid().alias("sample_id"), whole("l_quantity").alias("q"))
        g = cells.repartition(parts, "variant_id").groupBy("variant_id", "sample_id").agg(F.sum("q").alias("q"))
        missing = (F.col("variant_id") * 31 + F.col("sample_id") * 17) % 23 == 0
        return g.select("variant_id", "sample_id", F.when(~missing, (F.col("q") % 3).cast("double")).alias("dosage"))

    def genotyped(self) -> DataFrame:
        """Sample ids of ``geno``, without its aggregation."""
        return self.lineitem.select(sid().alias("sample_id")).distinct()

    def variants(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("variant_id"),
            (F.col("p_partkey") % 22 + 1).cast("string").alias("chrom"),
            (F.col("p_partkey") * 10000).alias("pos"),
            F.col("p_size").cast("double").alias("qual"),
        )

    def _cells(self, agg: Column) -> DataFrame:
        return self.lineitem.groupBy(F.col("l_suppkey").alias("feature_id"), sid().alias("sample_id")).agg(
            agg.alias("value")
        )

    def pheno(self) -> DataFrame:
        return self._cells(F.avg("l_extendedprice") / 997)

    def pheno_na(self) -> DataFrame:
        f, s = F.col("feature_id"), F.col("sample_id")
        return self.pheno().withColumn(
            "value",
            F.when((f * 13 + s * 7) % (3 + f % 29) == 0, None)
            .when(f % 17 == 3, 5.0)
            .when((f % 11 == 2) & (s % 3 == 0), 0.0)
            .otherwise(F.col("value")),
        )

    def counts(self) -> DataFrame:
        return self._cells(F.greatest(F.sum("l_quantity") - 200, F.lit(0.0)))

    def genes(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.supplier.select(
            s.alias("gene_id"),
            (s % 22 + 1).cast("string").alias("chrom"),
            (s * 200000).alias("gstart"),
            (s * 200000 + 10000).alias("gend"),
            F.when(s % 2 == 0, "+").otherwise("-").alias("strand"),
        )

    def covar(self) -> DataFrame:
        return self.orders.groupBy(sid("o_orderkey").alias("sample_id")).agg(
            (F.avg("o_totalprice") / 4003).alias("age"),
            (F.sum("o_custkey") % 2).alias("sex"),
            (F.sum("o_custkey") % 4).alias("batch"),
            (F.avg((F.col("o_custkey") % 1000).cast("double")) / 101).alias("rin"),
        )

    def covlong(self) -> DataFrame:
        c = self.covar()
        wide = c.select(
            "sample_id",
            F.round("age", 4).cast("string").alias("age"),
            F.col("sex").cast("string").alias("sex"),
            F.concat(F.lit("b"), F.col("batch").cast("string")).alias("batch"),
            F.when(F.col("sample_id") % 9 != 4, F.round("rin", 4).cast("string")).alias("rin"),
            F.round(F.col("age") - 10 * F.col("rin"), 4).cast("string").alias("PC1"),
            F.lit("1").alias("study_site"),
        )
        return wide.unpivot("sample_id", ["age", "sex", "batch", "rin", "PC1", "study_site"], "covariate", "value")

    def traits(self) -> DataFrame:
        wide = self.orders.groupBy(sid("o_orderkey").alias("sample_id")).agg(
            (F.avg("o_totalprice") / 1009).alias("height"),
            (F.stddev_samp("o_totalprice") / 500).alias("weight"),
            F.avg((F.col("o_custkey") % 97).cast("double")).alias("ldl"),
        )
        return wide.unpivot("sample_id", ["height", "weight", "ldl"], "trait", "value")

    def assoc(self) -> DataFrame:
        return self.lineitem.groupBy(
            F.col("l_suppkey").alias("gene_id"), F.col("l_partkey").alias("variant_id")
        ).agg(
            (F.avg("l_discount") / 1.03 - 0.05).alias("beta"),
            (0.01 + F.avg("l_tax") / 9.7).alias("se"),
        ).select(
            "gene_id",
            "variant_id",
            F.pow(((F.col("variant_id") * 7919 + F.col("gene_id") * 104729) % 99991 + 1) / 100000.0, 4.0).alias("p_value"),
            "beta",
            "se",
            ((F.col("variant_id") % 50 + 1) / 100.0).alias("maf"),
        )

    def gwas(self) -> DataFrame:
        v = F.col("variant_id")
        return self.lineitem.groupBy(
            F.col("l_returnflag").alias("phenotype"), F.col("l_partkey").alias("variant_id")
        ).agg(
            (F.avg("l_discount") / 1.03 - 0.05).alias("beta"),
            (0.01 + F.avg("l_tax") / 9.7).alias("se"),
        ).select(
            "phenotype",
            "variant_id",
            (v % 22 + 1).cast("string").alias("chrom"),
            (v * 10000).alias("pos"),
            F.pow(((v * 7919 + F.ascii("phenotype") * 104729) % 99991 + 1) / 100000.0, 3.0).alias("p_value"),
            "beta",
            "se",
            ((v % 50 + 1) / 100.0).alias("maf"),
        )
