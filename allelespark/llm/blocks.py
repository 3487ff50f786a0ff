"""Whole texts in blocks, and which minimizers recur: the first half of both repeated-span operators.

Documents are written once, in blocks of some MB, as a table of the shared folder that is bucketed by block; later passes meet it by
block without moving a text again.  Inside a block a hot passage is one row, however many documents hold it, so what a key can gather
is one row for each block.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelespark.llm.common import pa_schema, shared_folder, staged

BLOCK_BYTES = 2_000_000
NO_ID = np.iinfo(np.int64).max  # a null doc_id comes after all others


def block_table(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(blk, idx, doc_id, body): every row of ``docs`` with its block and place in it; null texts are empty."""
    spark = docs.sparkSession

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blk, idx, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            places = []
            for n in pa.compute.binary_length(batch.column(1)).to_pylist():
                if size and size + n > block_bytes:
                    blk, idx, size = blk + 1, 0, 0
                places.append((blk, idx))
                idx, size = idx + 1, size + n + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int32()), batch.column(0), batch.column(1)],
                names=["blk", "idx", "doc_id", "body"],
            )

    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    dealt = docs.select(F.col("doc_id").cast("long"), body.alias("body")).mapInArrow(deal, "blk long, idx int, doc_id long, body binary")
    name = f"llm_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt.write.option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}").bucketBy(buckets, "blk").saveAsTable(name)
    return spark.table(name)


class Block:
    """One block's documents, in the order of ``idx``, with their bytes in one array."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("idx")
        self.ids = [i for i in rows.column("doc_id").to_pylist()]
        self.bodies = rows.column("body").to_pylist()
        self.lens = np.array([len(b) for b in self.bodies], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lens)[:-1])).astype(np.int64) if len(self.lens) else np.zeros(0, np.int64)
        self.data = np.frombuffer(b"".join(self.bodies), np.uint8)
        self.order = np.array([NO_ID if i is None else i for i in self.ids], np.int64)
        self.idx = np.array(rows.column("idx").to_pylist(), np.int32)
        self.skip = np.zeros(len(self.idx), bool)  # documents that another pass has settled


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def rolling(x: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``width`` neighbours of a uint64 array, by doubling."""
    base &= 2**64 - 1
    parts, have, power = x, 1, base  # parts hash `have` neighbours; power = base ** have
    out, done = None, 0
    while True:
        if width & have:
            if out is None:
                out, done = parts, have
            else:
                n = len(x) - done - have + 1
                out = out[:n] * np.uint64(power) + parts[done : done + n]
                done += have
        if have * 2 > width:
            return out
        parts = parts[:-have] * np.uint64(power) + parts[have:]
        power = power * power & (2**64 - 1)
        have *= 2


def scramble(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(29))


def copies(blocks: DataFrame) -> DataFrame:
    """(blk, idx): documents whose whole bytes are those of a smaller doc_id, by SHA-256."""
    seen = blocks.select("blk", "idx", F.coalesce("doc_id", F.lit(NO_ID)).alias("own"), F.sha2("body", 256).alias("sha"))
    first = seen.groupBy("sha").agg(F.min("own").alias("first"))
    return staged(seen.join(first, "sha").where("own > first").select("blk", "idx"), "block-copies")


def recurring(blocks: DataFrame, settled: DataFrame, minima: Callable[[Block], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(blk, h): minimizers of a block which more than one owner has, anywhere; documents in ``settled`` don't count.

    ``minima`` gives a block's minimizers (uint64) in text order and their owners; an owner is what may not match itself.
    """

    def gather(block: Block, blk: int, rows: pa.Table) -> list:
        mark(block, rows)
        h, owner = minima(block)
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        last = np.concatenate((first[1:], [len(h)])) - 1 if len(h) else first
        return [np.full(len(first), blk, np.int64), h[first].view(np.int64), (1 + (owner[first] != owner[last])).astype(np.int8)]

    found = with_blocks(blocks, settled, gather, "blk long, h long, n byte")
    everywhere = F.sum("n").over(Window.partitionBy("h"))
    return found.select("blk", "h", everywhere.alias("n")).where("n > 1").select("blk", "h")


def mark(block: Block, rows: pa.Table) -> None:
    """Set ``skip`` for the documents in ``rows`` (their ``idx``; null: none)."""
    if rows.num_rows:
        idx = rows.column("idx").drop_null().to_numpy()
        block.skip[np.searchsorted(block.idx, idx)] = True


def with_blocks(blocks: DataFrame, rows: DataFrame, fn: Callable[[Block, int, pa.Table], list[tuple]], schema: str) -> DataFrame:
    """``fn(block, number, its rows)`` for every block; ``rows`` move to the blocks, which stay."""
    out = pa_schema(blocks.sparkSession, schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out.empty_table()
        columns = fn(Block(left), left.column("blk")[0].as_py(), right)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return blocks.groupBy("blk").cogroup(rows.groupBy("blk")).applyInArrow(run, schema)


def runs(at: np.ndarray, *same: np.ndarray, most: int = 1 << 30) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of maximal runs of consecutive numbers in ``at`` over which the arrays ``same`` don't change."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate(([True], at[1:] != at[:-1] + 1))
    for s in same:
        new[1:] |= s[1:] != s[:-1]
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate((first, [len(at)])))
    if n.max() > most:  # cut very long runs
        times = -(-n // most)
        turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        whole = np.repeat(n, times)
        first, n = np.repeat(first, times) + turn * most, np.minimum(most, whole - turn * most)
    return first, n
