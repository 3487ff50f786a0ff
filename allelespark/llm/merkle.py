"""Merkle manifest of a dataset, its subtrees stored in van Emde Boas order.

1. A row becomes a leaf: the SHA-256 of its named columns, each as byte count, colon and value.  Leaves of one group (``lang``) are
   numbered in doc_id order by a range sort.
2. ``2**height`` consecutive leaves form a block.  A task builds the block's tree level by level and stores it as one row of a table, at
   addresses of the van Emde Boas layout: the tree is split at half its height, the top half comes first, then the bottom subtrees, each
   laid out alike.  So a walk from leaf to root touches few cache lines whatever their size, and addresses are arithmetic.
3. The block roots are the leaves of the next, smaller table, and so on until each group has one node.  The groups' nodes are the leaves
   of a last tree of the same kind.
4. Downwards, a table has for each block the path from its root to the top; a document's path is its own in the block, read from the same
   addresses, and then the block's.  So no row carries a tree and no task holds more than a block.

Scale: texts are read once and hashed in the scan; only (group, doc_id, two digests) are sorted.  A group with a third of all rows is cut
into blocks like any other.  The number of jobs grows with the logarithm to base 2**height of the largest group.

Defined cases: nulls are written ``-``; a null group and an empty one are two groups, null first; within a group null doc_ids come first and
equal doc_ids are ordered by leaf; repeated rows are leaves of their own; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.llm.common import pa_schema, staged
from allelespark.operators.blocks import spread
from allelespark.operators.ordered import columns_of, ordered

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 8
#: A step of a path: which side the sibling is on, and its digest.
RIGHT, LEFT, NONE = b"r", b"l", b"-"
STEP = 65


def digest(*parts: bytes) -> bytes:
    """Lowercase hex SHA-256 of the parts, one after another."""
    return hexlify(hashlib.sha256(b"".join(parts)).digest())


def addresses(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0: the root) in the van Emde Boas layout of a complete tree of ``levels`` levels."""
    index, at = np.asarray(index, np.int64), np.zeros(np.shape(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below, depth = levels - top, depth - top
        at += (1 << top) - 1 + (index >> depth) * ((1 << below) - 1)  # past the top half and the subtrees before this one
        index, levels = index & ((1 << depth) - 1), below
    return at


class Block:
    """The tree of up to 2**height consecutive leaves.

    Only a block with others beside it is as high as ``height``: its root has to be at that level, so single nodes are hashed up to it.
    """

    def __init__(self, n: int, nodes: bytearray | bytes):
        self.n, self.nodes = n, nodes
        self.levels = (n - 1).bit_length() + 1

    @classmethod
    def built(cls, leaves: Sequence[bytes]) -> "Block":
        n = len(leaves)
        block = cls(n, bytearray(64 * ((1 << ((n - 1).bit_length() + 1)) - 1)))
        row = list(leaves)
        for depth in range(block.levels - 1, -1, -1):
            for at, node in zip(addresses(depth, np.arange(len(row)), block.levels).tolist(), row):
                block.nodes[64 * at : 64 * at + 64] = node
            row = [digest(*row[i : i + 2]) for i in range(0, len(row), 2)]
        return block

    def root(self, height: int | None) -> bytes:
        """The top node, hashed up to ``height`` if given."""
        node = bytes(self.nodes[:64])
        for _ in range(0 if height is None else height - self.levels + 1):
            node = digest(node)
        return node

    def paths(self, positions: np.ndarray, height: int | None) -> list[bytes]:
        """For each leaf its steps up to the root."""
        found: list[list[bytes]] = [[] for _ in positions]
        width = self.n
        for depth in range(self.levels - 1, 0, -1):
            other = positions ^ 1
            at = addresses(depth, other, self.levels)
            for steps, mine, there, place in zip(found, positions.tolist(), (other < width).tolist(), at.tolist()):
                steps.append((LEFT if mine & 1 else RIGHT) + self.nodes[64 * place : 64 * place + 64] if there else NONE + b"0" * 64)
            positions, width = positions >> 1, (width + 1) // 2
        alone = (NONE + b"0" * 64) * (0 if height is None else height - self.levels + 1)
        return [b"".join(steps) + alone for steps in found]


def fold(node: bytes, path: bytes) -> bytes:
    for i in range(0, len(path), STEP):
        side, sibling = path[i : i + 1], path[i + 1 : i + STEP]
        node = digest(node) if side == NONE else digest(sibling, node) if side == LEFT else digest(node, sibling)
    return node


def siblings(path: bytes) -> bytes:
    return b"".join(path[i + 1 : i + STEP] for i in range(0, len(path), STEP) if path[i : i + 1] != NONE)


_BLOCKS = "tree string, block long, n int, nodes binary, root binary"
_PATHS = "tree string, number long, node binary, path binary"


def _blocks(nodes: DataFrame, height: int, name: str) -> DataFrame:
    """One level of blocks over ``nodes`` (tree, number, node): a table of the shared folder."""
    out = pa_schema(nodes.sparkSession, _BLOCKS)

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        block = Block.built([x.as_py() for x in rows.column("node")])
        tree, number = (k.as_py() for k in key)
        root = block.root(None if number == 0 and block.n < 1 << height else height)
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip((tree, number, block.n, bytes(block.nodes), root), out)], schema=out)

    keyed = spread(nodes.select("tree", F.shiftright("number", height).alias("block"), "number", "node"), "tree", "block")
    return staged(keyed.groupBy("tree", "block").applyInArrow(build, _BLOCKS), name)


def levels_of(nodes: DataFrame, height: int = HEIGHT, name: str = "merkle") -> tuple[list[DataFrame], DataFrame]:
    """All levels of blocks, lowest first, and the top (tree, node) of each tree."""
    levels, tops = [], None
    while True:
        made = _blocks(nodes, height, f"{name}-{len(levels)}")
        levels.append(made)
        more = made.where("block = 1").select("tree")
        done = made.join(more, "tree", "left_anti").select("tree", F.col("root").alias("node"))
        tops = done if tops is None else tops.union(done)
        if more.isEmpty():
            return levels, tops
        nodes = made.join(more, "tree", "left_semi").select("tree", F.col("block").alias("number"), F.col("root").alias("node"))


def _paths(blocks: DataFrame, above: DataFrame, height: int, name: str) -> DataFrame:
    """(tree, number, node, path): paths to the very top of all leaves of ``blocks``, given those of the blocks (``above``)."""
    out = pa_schema(blocks.sparkSession, _PATHS)

    def walk(batches):
        for batch in batches:
            for tree, number, n, nodes, path in zip(*(c.to_pylist() for c in batch.columns)):
                block, at = Block(n, nodes), np.arange(n)
                own = block.paths(at, None if number == 0 and n < 1 << height else height)
                places = addresses(block.levels - 1, at, block.levels)
                leaves = [nodes[64 * p : 64 * p + 64] for p in places.tolist()]
                columns = [[tree] * n, [(number << height) + i for i in range(n)], leaves, [p + path for p in own]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    joined = _with_path(blocks, above).select("tree", "block", "n", "nodes", "path")
    return staged(joined.mapInArrow(walk, _PATHS), name)


def _with_path(blocks: DataFrame, above: DataFrame) -> DataFrame:
    return blocks.join(above.select("tree", F.col("number").alias("block"), "path"), ["tree", "block"])


def paths_of(levels: list[DataFrame], tops: DataFrame, height: int, name: str) -> DataFrame:
    """Paths of the lowest blocks (tree, number: the block, path), from those of the trees' tops (tree, path)."""
    ends = tops.select("tree", F.lit(0).cast("long").alias("number"), F.lit(None).cast("binary").alias("node"), "path")
    above = None
    for i in range(len(levels) - 1, -1, -1):
        # a tree that ends at this level has one block here; its path is that of the tree
        last = ends.join(levels[i].where("block = 1").select("tree"), "tree", "left_anti").join(levels[i].select("tree").distinct(), "tree", "left_semi")
        above = last if above is None else above.union(last)
        if i:
            above = _paths(levels[i], above, height, f"{name}-paths-{i}")
    return above.select("tree", "number", "path")


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: each value as byte count, colon and text, a null as ``-``."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]).cast("binary"), 256)


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", changed: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``changed`` gives columns other values for the check only: the recomputed root then starts from the leaf of those values, with the
    siblings of the stored tree.
    """
    values = [F.col(c) for c in columns]
    now = [(changed or {}).get(c, F.col(c)) for c in columns]
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # in the order of the group, null first
    differs = F.lit(False)
    for c in changed or {}:
        differs = differs | ~F.col(c).eqNullSafe(changed[c])
    base = docs.select(tree.alias("tree"), "doc_id", leaf(values).alias("leaf"), F.when(differs, leaf(now)).alias("other"))
    rows = ordered(staged(base, "merkle-leaves"), ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], rank="number")
    rows = staged(rows.withColumn("number", F.col("number") - 1), "merkle-rows")

    levels, tops = levels_of(rows.select("tree", "number", F.col("leaf").cast("binary").alias("node")), height)
    tops = staged(tops, "merkle-tops")
    ranked = ordered(tops, [], [F.col("tree")], rank="number")
    upper, root = levels_of(ranked.select(F.lit("").alias("tree"), (F.col("number") - 1).alias("number"), "node"), height, "merkle-groups")
    over = root.select("tree", F.lit(b"").alias("path"))
    heads = _paths(upper[0], paths_of(upper, over, height, "merkle-groups"), height, "merkle-heads")
    place = ranked.select("tree", (F.col("number") - 1).alias("number"))
    ends = staged(place.join(heads.drop("tree"), "number").select("tree", "node", "path"), "merkle-ends")
    above = paths_of(levels, ends, height, "merkle")

    (top,) = columns_of(root.agg(F.first("node").alias("root")))
    blocks = _with_path(levels[0], above).join(ends.select("tree", F.col("node").alias("subroot")), "tree")
    blocks = blocks.select("tree", "block", "n", "nodes", "path", "subroot", top.alias("top"))
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    out = pa_schema(docs.sparkSession, schema)

    def check(key, mine: pa.Table, stored: pa.Table) -> pa.Table:
        number, (n, nodes, path, subroot, top) = key[1].as_py(), (stored.column(c)[0].as_py() for c in ("n", "nodes", "path", "subroot", "top"))
        block, ids, seen = Block(n, nodes), mine.column("number").to_numpy(), {}
        within = block.paths(ids & ((1 << height) - 1), None if number == 0 and n < 1 << height else height)
        result = []
        for doc, own, other, steps in zip(mine.column("doc_id").to_pylist(), mine.column("leaf").to_pylist(), mine.column("other").to_pylist(), within):
            node = fold((other or own).encode(), steps)
            if node not in seen:  # the way up from the block's root is the same for all that reach it
                seen[node] = fold(node, path)
            proof = digest(siblings(steps), siblings(path))
            result.append((doc, own, subroot.decode(), top.decode(), proof.decode(), seen[node].decode(), seen[node] == top))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*result), out)], schema=out)

    asked = spread(rows.select("tree", F.shiftright("number", height).alias("block"), "number", "doc_id", "leaf", "other"), "tree", "block")
    return asked.groupBy("tree", "block").cogroup(spread(blocks, "tree", "block").groupBy("tree", "block")).applyInArrow(check, schema)
