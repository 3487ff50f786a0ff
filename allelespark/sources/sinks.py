"""Writers.  Matrices go out as lines, so the number of samples never becomes a number of columns."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespark.operators.ordered import columns_of
from allelespark.operators.ranking import chrom_rank


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder, private only on a local master that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_results(df: DataFrame, base: str, qval: float = 0.05, column: str = "qval") -> tuple[str, str]:
    """Full table and significant subset, tab separated and gzipped; the subset is taken from what was written, so ``df`` runs once."""
    full, hits = f"{base}.all.tsv", f"{base}.significant.tsv"
    opts = {"sep": "\t", "header": True, "compression": "gzip"}
    df.write.mode("overwrite").options(**opts).csv(full)
    again = df.sparkSession.read.schema(df.schema).csv(full, sep="\t", header=True)
    again.where(F.col(column) < qval).write.mode("overwrite").options(**opts).csv(hits)
    return full, hits


def write_nominal(df: DataFrame, path: str) -> str:
    """Nominal pairs partitioned by chromosome; rows of one chromosome stay spread over tasks."""
    df.write.mode("overwrite").partitionBy("chrom").parquet(path)
    return path


def matrix_lines(long: DataFrame, lead: list[str], key_header: str, order: list[Column], text: Column) -> DataFrame:
    """Feature x sample lines in total order, header first: (value).

    Cells are placed by sample, so one that ``long`` lacks is NA.  One line carries one cohort, nothing more.
    """
    ids = long.select("sample_id").distinct().agg(F.array_sort(F.collect_list("sample_id")).alias("s"))
    index = ids.select(F.posexplode("s").alias("_i", "sample_id"))
    (n,) = columns_of(ids.select(F.size("s").alias("n")))
    cell = F.struct("_i", F.coalesce(text, F.lit("NA")).alias("t"))
    rows = long.join(index, "sample_id").groupBy(*lead).agg(F.array_sort(F.collect_list(cell)).alias("_c"))
    gap = lambda x, j: F.repeat(F.lit("NA\t"), x["_i"] - F.coalesce(F.get("_c._i", j - 1), F.lit(-1)) - 1)
    cells = F.transform("_c", lambda x, j: F.concat(gap(x, j), x["t"]))
    tail = F.repeat(F.lit("\tNA"), n - F.element_at("_c._i", -1) - 1)
    row = F.concat_ws("\t", *[F.col(c).cast("string") for c in lead], F.concat(F.array_join(cells, "\t"), tail))
    body = rows.select(F.lit(1).alias("_k"), *[o.alias(f"_o{i}") for i, o in enumerate(order)], row.alias("value"))
    head = ids.select(
        F.lit(0).alias("_k"), *[F.lit(None).alias(f"_o{i}") for i in range(len(order))],
        F.concat_ws("\t", F.lit(key_header), F.array_join(F.transform("s", lambda x: x.cast("string")), "\t")).alias("value"),
    )
    return head.unionByName(body).orderBy("_k", *[f"_o{i}" for i in range(len(order))], "value").select("value")


def phenotype_bed(long: DataFrame, text: Column) -> DataFrame:
    """BED lines ``#chr start end phenotype_id <samples>`` in genome order."""
    lead = ["chrom", "gstart", "gend", "feature_id"]
    return matrix_lines(long, lead, "#chr\tstart\tend\tphenotype_id", [chrom_rank(F.col("chrom")), F.col("gstart"), F.col("gend")], text)


def covariate_matrix(cov: DataFrame) -> DataFrame:
    """Covariate x sample lines with an ``id`` header."""
    return matrix_lines(cov, ["covariate"], "id", [F.col("covariate")], F.col("value").cast("string"))


def write_lines(df: DataFrame, path: str, gzip: bool = True) -> str:
    df.write.mode("overwrite").text(path, compression="gzip" if gzip else "none")
    return path


def write_sample_lists(sets: dict[str, DataFrame], base: str) -> dict[str, str]:
    """One id per line for each dataset and for the ids common to all."""
    from allelespark.operators.joins import in_all

    every = {**sets, "common": in_all(list(sets.values()))}
    out = {}
    for name, df in every.items():
        out[name] = write_lines(df.select(F.col("sample_id").cast("string").alias("value")).distinct(), f"{base}/{name}", gzip=False)
    return out


def write_summary(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_credible_sets(sets: DataFrame, path: str) -> str:
    df = sets.repartitionByRange("gene_id", "set_index", "set_rank").sortWithinPartitions("gene_id", "set_index", "set_rank")
    df.write.mode("overwrite").options(sep="\t", header=True, compression="gzip").csv(path)
    return path
