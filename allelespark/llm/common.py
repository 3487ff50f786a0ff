"""Parts that the operators of this subpackage share."""
from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespark.operators.blocks import spread

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only on a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if "ALLELESPARK_SCRATCH" not in os.environ:
        os.environ["ALLELESPARK_SCRATCH"] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return os.environ["ALLELESPARK_SCRATCH"]


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: computed once, lineage cut, safe if executors go."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside delete their shuffle files at their end, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``rows`` at a time, so that Python objects are made for a few rows only."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_row(
    df: DataFrame, columns: Iterable[str | Column], schema: str, fn: Callable[..., tuple], start: Callable[[], object] | None = None
) -> DataFrame:
    """One output row for each input row: ``fn(*values)`` on Arrow batches; with ``start``, ``fn(start(), *values)``."""
    out = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = () if start is None else (start(),)
        for batch in batches:
            rows = [fn(*first, *row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            columns = zip(*rows) if rows else ([] for _ in out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return df.select(*columns).mapInArrow(run, schema)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def word_count(text: str = "text") -> Column:
    """Number of words of a text, 0 for null, without building them."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


HASHES = ["_h1", "_h2"]


def content_hash(df: DataFrame) -> list[Column]:
    """128 bits of hash of the whole row, in which nulls count, as ``HASHES``."""
    parts = [part for c in df.columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string"))]
    return [F.xxhash64(F.lit(i), *parts).alias(name) for i, name in enumerate(HASHES)]


def repeated(once: DataFrame, times: str, run: int = 4096) -> DataFrame:
    """Each row ``times`` times with its ``turn``; runs of turns are dealt out before they are unrolled."""
    runs = once.where(F.col(times) > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / run))).alias("run"))
    first = F.col("run") * run
    last = F.least(first + run, F.col(times)) - 1
    return spread(runs, *HASHES, "run").select("*", F.explode(F.sequence(first, last)).alias("turn"))
