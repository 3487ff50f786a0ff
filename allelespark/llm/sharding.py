"""Shards in random order by a two-pass external shuffle.

1. First pass: every record goes to a bucket by a seeded hash of its content.  Buckets are as many as it takes for each to fit in a
   task's memory; one shuffle of the records by bucket is the only one.
2. Second pass: a task reads a bucket, brings it into the order of the hash, so that the outcome depends on the rows and the seed alone,
   and shuffles it by Fisher-Yates with a generator of its own (seed, bucket).
3. Buckets one after another are the shuffled dataset.  Shard k has the places from ``k n // shards`` to ``(k + 1) n // shards``: counts
   are at most one apart (the law ``rows``) and slots have no gaps.
4. Shards are written as Parquet, a folder for each, in slot order within a file; ``read_shard`` reads one from any slot on.

Scale: texts cross the network once.  Where each bucket starts comes from counts of a narrow scan.  Rows that are equal in everything, as
one document repeated for a third of the table, have one hash; where their bytes could overfill a bucket, they are counted by partial
aggregation, travel once with their count, and are unrolled with a hash for each turn, so they spread like other rows.  The list of such
contents has at most ``MOST_HEAVY`` hashes by its own bound and is broadcast.  Copies of a text under several doc_ids differ in doc_id.

Defined cases: null texts have size 16; null and repeated doc_ids are rows like others; repeated rows each have a slot; fewer rows than
shards leave some shards empty; an empty table gives no rows; all columns are kept in ``record``, so no name can clash.  The outcome
depends on rows and seed alone, not on how the table is partitioned; equal rows are interchangeable.
"""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from allelespark.llm.common import HASHES, content_hash, repeated, shared_folder, staged
from allelespark.operators.blocks import spread
from allelespark.operators.ordered import ordered

SHARDS = 40
SEED = 20_261
BUCKET_BYTES = 32 << 20
#: Buckets are at least this many for each shard, so that small tables use all machines.
BUCKETS_PER_SHARD = 8
MOST_HEAVY = 1_000_000


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A random order of 0..n-1: from the end, each place swaps with one at or before it."""
    order = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist()):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def scattered(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """(key, bucket, record) for every row, not shuffled yet, and (bucket, n, start): rows in the bucket and before it."""
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    narrow = staged(docs.select(*content_hash(docs), size().alias("size")), "shuffle-sizes")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), BUCKETS_PER_SHARD * shards)
    most = max(bucket_bytes // 8, total // MOST_HEAVY)
    repeats = narrow.groupBy(*HASHES).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("times"))
    repeats = staged(repeats.where((F.col("bytes") > most) & (F.col("times") > 1)).drop("bytes"), "shuffle-repeats")
    heavy = F.broadcast(repeats)  # under total / most rows, so MOST_HEAVY at most
    single = lambda df: _keyed(df.join(heavy.select(*HASHES), HASHES, "left_anti"), seed, buckets)
    rows = docs.select(*content_hash(docs), record)
    once = rows.join(heavy, HASHES, "left_semi").groupBy(*HASHES).agg(F.first("record").alias("record")).join(heavy, HASHES)
    counts = single(narrow).select("bucket").union(_keyed(repeated(repeats, "times"), seed, buckets).select("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = ordered(staged(counts, "shuffle-counts"), [], [F.col("bucket")], {"start": F.col("n")}, "_turn")
    every = single(rows).select("key", "bucket", "record").union(_keyed(repeated(once, "times"), seed, buckets).select("key", "bucket", "record"))
    return every, staged(starts.select("bucket", "n", F.col("start").cast("long").alias("start")), "shuffle-starts")


def _keyed(rows: DataFrame, seed: int, buckets: int) -> DataFrame:
    turn = [F.col("turn")] if "turn" in rows.columns else []
    key = F.xxhash64(F.lit(seed), *HASHES, *turn)
    return rows.withColumn("key", key).withColumn("bucket", F.pmod("key", F.lit(buckets).cast("long")))


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(shard, slot, record) of every row."""
    rows, starts = scattered(docs, shards, seed, bucket_bytes)
    total = starts.agg(F.sum("n")).first()[0] or 0
    kind = StructType([StructField("shard", IntegerType()), StructField("slot", LongType()), StructField("record", docs.schema)])

    def mix(key, bucket: pa.Table, about: pa.Table) -> pa.Table:
        bucket, rng = bucket.sort_by("key"), np.random.Generator(np.random.PCG64([seed, key[0].as_py()]))
        if len(bucket) != about.column("n")[0].as_py():
            raise ValueError("the table changed between two scans: write it first")
        record = bucket.column("record").take(pa.array(fisher_yates(len(bucket), rng)))
        place = np.arange(len(bucket)) + about.column("start")[0].as_py()
        shard = ((place + 1) * shards - 1) // total  # the last k with k * total // shards <= place
        return pa.Table.from_arrays([pa.array(shard.astype(np.int32)), pa.array(place - shard * total // shards), record], names=kind.names)

    return spread(rows, "bucket").groupBy("bucket").cogroup(spread(starts, "bucket").groupBy("bucket")).applyInArrow(mix, kind)


def write(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Folders ``path/shard=K`` of Parquet files with (slot, record)."""
    rows = shuffled(docs, shards, seed, bucket_bytes).sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """(shard, slot, record) of all shards, as written from a table with the columns of ``docs``."""
    kind = StructType([StructField("slot", LongType()), StructField("record", docs.schema), StructField("shard", IntegerType())])
    return spark.read.schema(kind).parquet(path)


def read_shard(spark: SparkSession, path: str, docs: DataFrame, shard: int, from_slot: int = 0) -> DataFrame:
    """One shard in order, from a slot on; other folders aren't opened."""
    return read(spark, path, docs).where((F.col("shard") == shard) & (F.col("slot") >= from_slot)).orderBy("slot")


def written(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Write the shards to a folder that every machine sees (a new one in the shared folder if none is given) and read them again."""
    path = path or f"{shared_folder(docs.sparkSession)}/shuffled-{uuid.uuid4().hex}"
    write(docs, path, shards, seed, bucket_bytes)
    return read(docs.sparkSession, path, docs)
