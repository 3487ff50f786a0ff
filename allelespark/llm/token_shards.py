"""Token output in training order.

1. Texts become token ids with an end mark, cut into sequences of one length; a sequence never crosses documents.  The result is
   a table of the shared folder, so token ids are made once, and each row's place in its partition is fixed.
2. One total for each partition gives every sequence a number 0..n-1.
3. A keyed Feistel permutation with cycle-walking maps the number to a global slot: a bijection, nothing is stored or sorted for it.
4. Slots are dealt in ranges, a shard is ``per_shard`` slots, and every record has one stride, so slot s lies in shard
   s // per_shard at (s % per_shard) * stride: readers start or resume anywhere.
5. ``write_shards`` writes each shard as one file: its n records, then n short lines with the document and sequence of each, so a reader
   knows n from the file's size.  ``written`` returns the rows as read again from the files.

Scale: one shuffle of the tokens, by slot range, in turns whose files go before the next.  Slots are pseudo-random, so a source, a long text or a group of copies is spread over
all shards evenly.  ``write_shards`` writes with Spark's own writer to any file system; a lost executor's task is written again.

Defined cases: null and empty texts have no sequence; repeated rows give their own sequences; a null doc_id is carried; an empty
table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespark.llm.common import shared_folder, shuffles_freed, slices, staged
from allelespark.llm.tokens import VOCABULARY, encoder, id_type, ranks_of
from allelespark.operators.ordered import ordered

LENGTH = 512
PER_SHARD = 4096
KEY = 20_240_229
ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A well-mixed 64-bit function of x and key."""
    x = (x + np.uint64(key & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _half_bits(n: int) -> int:
    return max(1, ((n - 1).bit_length() + 1) // 2)


def slots(number: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slot of each number below n.  The network permutes 2**(2h) >= n values; what lands at n or above walks on."""
    h = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(h)) - 1)
    x = np.asarray(number).astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> h, x[todo] & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key * ROUNDS + r) & mask)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def numbers(slot: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The inverse of ``slots``."""
    h = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(h)) - 1)
    x = np.asarray(slot).astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> h, x[todo] & mask
        for r in reversed(range(ROUNDS)):
            left, right = right ^ (_mix(left, key * ROUNDS + r) & mask), left
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def tokenized(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """(part, first, n_seq, doc_id, tokens): a table in the shared folder; ``first`` counts sequences before the row in its part."""
    ranks = ranks_of(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    kind = np.dtype(id_type(ranks))
    end = np.array([len(ranks)], kind).tobytes()  # the first free id
    names = ["part", "first", "n_seq", "doc_id", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(sent.value), TaskContext.get().partitionId(), 0
        for batch in slices(batches, 1024):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text:
                    ids = encode(text) + end
                    n = -(-len(ids) // (length * kind.itemsize))
                    rows.append((part, before, n, doc_id, ids))
                    before += n
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=names)

    return staged(docs.select("doc_id", "text").mapInArrow(run, "part int, first long, n_seq long, doc_id long, tokens binary"), "token-rows")


def training_order(
    docs: DataFrame, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY, vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per sequence, dealt and sorted by slot: slot, shard, position (byte in the shard), doc_id, sequence, n_tokens, tokens.

    ``tokens`` are little-endian ids without padding.
    """
    width = np.dtype(id_type(ranks_of(vocabulary))).itemsize
    rows = tokenized(docs, length, vocabulary)
    totals = staged(rows.groupBy("part").agg(F.sum("n_seq").alias("n")), "token-parts")
    n = totals.agg(F.sum("n")).first()[0] or 0
    offsets = ordered(totals, [], [F.col("part")], {"before": F.col("n")}, "_turn").select("part", F.col("before").cast("long").alias("before"))
    step = length * width
    stride = step + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            pieces, number, doc, turn = [], [], [], []
            for s, d, t in zip(*(c.to_pylist() for c in batch.columns)):
                own = [t[j : j + step] for j in range(0, len(t), step)]
                pieces += own
                number += range(s, s + len(own))
                doc += [d] * len(own)
                turn += range(len(own))
            slot = slots(np.array(number, np.int64), n, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(doc, pa.int64()), pa.array(turn, pa.int64()), pa.array(pieces, pa.binary())], names=["slot", "doc_id", "sequence", "tokens"]
            )

    numbered = rows.join(offsets, "part").select((F.col("before") + F.col("first")).alias("start"), "doc_id", "tokens")
    cuts = numbered.mapInArrow(cut, "slot long, doc_id long, sequence long, tokens binary")
    out = cuts.select(
        "slot", F.floor(F.col("slot") / per_shard).cast("long").alias("shard"), (F.col("slot") % per_shard * stride).alias("position"),
        "doc_id", "sequence", (F.octet_length("tokens") / width).cast("long").alias("n_tokens"), "tokens",
    )
    shards = -(-n // per_shard)
    parts = max(1, min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    place = F.floor(F.col("shard") * parts / max(shards, 1)).cast("int")  # partition p holds a range of whole shards
    return out.repartitionById(parts, place).sortWithinPartitions("shard", "slot")


#: Bytes after the records for each: a mark of whether doc_id is there, doc_id, sequence, line end.
TAIL = 18
#: Shards are written in so many turns, each with its share of the shuffle.
TURNS = 3


def write_shards(ordered_rows: DataFrame, path: str, length: int = LENGTH, width: int = 2) -> None:
    """Shards ``path/shard=K/part-*``: records of ``length`` ids, padded with zeros, and a line end; stride length * width + 1.

    After the records of a shard come as many lines of ``TAIL`` bytes.  The rows must come from ``training_order``: a shard is
    within one task.  The order is made here, by (shard, kind of line, slot), as the writer would else sort by shard alone.
    """
    step = length * width
    pad = F.repeat(F.lit("\0"), F.lit(step) - F.octet_length("tokens").cast("int")).cast("binary")
    long = lambda c: F.unhex(F.lpad(F.hex(F.coalesce(F.col(c), F.lit(0).cast("long"))), 16, "0"))
    about = F.concat(F.when(F.col("doc_id").isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit("01"))), long("doc_id"), long("sequence"))
    lines = ordered_rows.select("shard", "slot", F.posexplode(F.array(F.concat("tokens", pad), about)).alias("kind", "line"))
    with shuffles_freed(ordered_rows.sparkSession):
        for i in range(TURNS):  # every task has shards of each turn, and a turn's shuffle is gone before the next
            turn = lines.where(F.col("shard") % TURNS == i).sortWithinPartitions("shard", "kind", "slot")
            turn = turn.select("shard", F.col("line").cast("string").alias("value"))  # bytes as they are
            turn.write.mode("append" if i else "error").partitionBy("shard").option("compression", "none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.col("shard").cast("long").alias("shard"), "content")


def read_shards(spark: SparkSession, path: str, from_slot: int = 0, length: int = LENGTH, width: int = 2, per_shard: int = PER_SHARD) -> DataFrame:
    """(slot, tokens with padding) from ``from_slot`` on; earlier shards aren't opened."""
    stride = length * width + 1

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(*batch.columns):
                shard, data = shard.as_py(), data.as_buffer()
                n = len(data) // (stride + TAIL)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard * per_shard + np.arange(n)), pa.array([data[i * stride : (i + 1) * stride - 1].to_pybytes() for i in range(n)], pa.binary())],
                    names=["slot", "tokens"],
                )

    got = _files(spark, path).where(F.col("shard") >= from_slot // per_shard).mapInArrow(records, "slot long, tokens binary")
    return got.where(F.col("slot") >= from_slot)


def written(
    docs: DataFrame, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY, vocabulary: str = VOCABULARY, path: str | None = None
) -> DataFrame:
    """Write the shards and return the rows of ``training_order`` as read from the files.

    ``path`` is a folder that every machine sees; a new one in the shared folder if none is given.
    """
    spark, ranks = docs.sparkSession, ranks_of(vocabulary)
    kind, end = np.dtype(id_type(ranks)), len(ranks)
    path = path or f"{shared_folder(spark)}/token-shards-{uuid.uuid4().hex}"
    rows = training_order(docs, length, per_shard, key, vocabulary)
    write_shards(rows, path, length, kind.itemsize)
    step = length * kind.itemsize
    stride = step + 1

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(*batch.columns):
                shard, data = shard.as_py(), data.as_buffer()
                n, odd = divmod(len(data), stride + TAIL)
                if odd:
                    raise ValueError(f"shard {shard} has {len(data)} bytes, not a multiple of {stride + TAIL}")
                tail = np.frombuffer(data, np.uint8, offset=n * stride).reshape(n, TAIL)
                doc, turn = (np.ascontiguousarray(tail[:, a : a + 8]).view(">i8")[:, 0].astype(np.int64) for a in (1, 9))
                ids = np.ascontiguousarray(np.frombuffer(data, np.uint8, n * stride).reshape(n, stride)[:, :step]).view(kind)
                last = ids == end  # the end mark is in no text
                size = np.where(last.any(axis=1), last.argmax(axis=1) + 1, length)
                for a in range(0, n, 1024):
                    b = min(a + 1024, n)
                    at = np.arange(a, b)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard * per_shard + at), pa.array(np.full(b - a, shard, np.int64)), pa.array(at * stride),
                        pa.array(doc[a:b], mask=tail[a:b, 0] == 0), pa.array(turn[a:b]), pa.array(size[a:b].astype(np.int64)),
                        pa.array([ids[i, : size[i]].tobytes() for i in at], pa.binary()),
                    ], names=["slot", "shard", "position", "doc_id", "sequence", "n_tokens", "tokens"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    if "shard" not in files.columns:  # no sequence, no shard
        return spark.createDataFrame([], rows.schema)
    return _files(spark, path).mapInArrow(records, rows.schema)
