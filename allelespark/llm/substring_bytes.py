"""Substring dedup over bytes: suffixes sorted deep-shallow find every 50-byte string that recurs across documents.

1. Whole copies are settled by their hash: all but the smallest doc_id lose every byte.  Every 50-byte window of the others has a minimizer (the smallest hash of its 16-byte strings).  Equal windows have equal minimizers, so windows whose
   minimizer has one document only are done; about one hash for 18 bytes is shuffled, not the windows.
2. Windows left over are compared inside their block first: one that a smaller doc_id of the block holds is removed at once.  The rest go to
   their minimizer's partition as text segments (neighbours share their bytes).
3. There the suffixes are sorted to 50 bytes: multikey quicksort over 8-byte characters to a depth of 16, then blind tries
   order the groups with longer common prefixes: each node skips to the first byte in which its members differ.  Classes of equal
   suffixes get their smallest doc_id; windows of larger ones are removed.
4. Removed runs return to the blocks, where bytes are cut and hashed.

Scale: a minimizer has one row for each block at most, whatever the number of documents that share a passage; texts are written once
and never shuffled; blocks have a fixed size (a longer text is a block of its own).

Defined cases: null is the empty text; a text under 50 bytes loses nothing; a null doc_id is larger than all others; rows of one doc_id
don't remove each other; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespark.llm.blocks import Block, block_table, copies, mark, recurring, rolling, runs, scramble, sliding_min, with_blocks

WINDOW = 50
GRAM = 16
SHALLOW = 16


def minimizers(block: Block, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows that lie within a document (and aren't skipped), their minimizers and their documents' places."""
    n = len(block.data) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
    least = sliding_min(scramble(rolling(block.data.astype(np.uint64) + np.uint64(1), GRAM, 0x5851F42D4C957F2D)), window - GRAM + 1)
    doc = np.repeat(np.arange(len(block.lens), dtype=np.int32), block.lens)
    at = np.flatnonzero((doc[:n] == doc[window - 1 :]) & ~block.skip[doc[:n]])
    return at, least[at], doc[at]


def _owners(block: Block) -> tuple[np.ndarray, np.ndarray]:
    at, h, doc = minimizers(block)
    first, _ = runs(at, h, doc)
    return h[first], block.order[doc[first]] if len(first) else np.zeros(0, np.int64)


def _take(data: np.ndarray, starts: np.ndarray, a: int, b: int) -> np.ndarray:
    return data[starts[:, None] + np.arange(a, b)]


def _word(data: np.ndarray, starts: np.ndarray, a: int) -> np.ndarray:
    """Eight bytes as one big-endian character."""
    out = np.zeros(len(starts), np.uint64)
    for j in range(a, a + 8):
        out = (out << np.uint64(8)) | data[starts + j]
    return out


def deep_shallow(data: np.ndarray, starts: np.ndarray, depth: int = WINDOW, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted to ``depth`` bytes, and for each place in that order whether a new class begins there."""
    n = len(starts)
    order = np.arange(n)
    new = np.zeros(n + 1, bool)
    new[[0, n]] = True
    for a in range(0, shallow, 8):  # multikey quicksort: only runs that tie so far are sorted by the next character
        group = np.cumsum(new[:n])
        tied = np.flatnonzero(~(new[:n] & new[1:]))
        character = _word(data, starts[order[tied]], a)
        new_order = np.lexsort((character, group[tied]))
        order[tied] = order[tied][new_order]
        character, group = character[new_order], group[tied]
        new[tied[1:]] |= (character[1:] != character[:-1]) | (group[1:] != group[:-1])
    tied = np.flatnonzero(~(new[:n] & new[1:]))
    while len(tied):  # blind tries of all groups at once, one branching node deeper each time
        first = np.flatnonzero(new[tied])
        size = np.diff(np.concatenate((first, [len(tied)])))
        head = np.repeat(order[tied[first]], size)
        skip = np.full(len(tied), depth - shallow)
        for part in range(0, len(tied), 65536):
            rows = slice(part, part + 65536)
            differs = _take(data, starts[order[tied[rows]]], shallow, depth) != _take(data, starts[head[rows]], shallow, depth)
            skip[rows] = np.where(differs.any(axis=1), differs.argmax(axis=1), depth - shallow)
        branch = np.repeat(np.minimum.reduceat(skip, first), size)
        split = branch < depth - shallow  # else the group is one class
        group, tied = np.repeat(np.arange(len(first)), size)[split], tied[split]
        byte = data[starts[order[tied]] + shallow + branch[split]]
        by = np.lexsort((byte, group))
        order[tied] = order[tied][by]
        byte = byte[by]
        new[tied[1:]] |= (byte[1:] != byte[:-1]) | (group[1:] != group[:-1])
        tied = tied[~(new[tied] & new[tied + 1])]
    return order, new[:n]


def _candidates(block: Block, blk: int, hashes: pa.Table) -> list:
    """Segments of windows for the other blocks to see, and runs (without bytes) that this block removes by itself."""
    mark(block, hashes)
    out = [[] for _ in range(7)]
    whole = np.flatnonzero(block.skip & (block.lens >= WINDOW))  # copies lose all bytes
    _add(out, _spread(whole, blk), blk, block, whole, np.zeros(len(whole), np.int64), block.lens[whole] - WINDOW + 1, [b""] * len(whole))
    at, h, doc = minimizers(block)
    known = np.sort(hashes.column("h").drop_null().to_numpy().astype(np.int64).view(np.uint64)) if hashes.num_rows else np.zeros(0, np.uint64)
    if not len(at) or not len(known):
        return out
    first, n = runs(at, h, doc)
    hit = known[np.minimum(np.searchsorted(known, h[first]), len(known) - 1)] == h[first]
    keep = np.repeat(hit, n)
    at, h, doc = at[keep], h[keep], doc[keep]
    if not len(at):
        return out
    own = block.order[doc]
    full = rolling(block.data.astype(np.uint64) + np.uint64(1), WINDOW, 0x2545F4914F6CDD1D)[at]
    order = np.lexsort((own, full, h))
    new = np.concatenate(([True], (full[order][1:] != full[order][:-1]) | (h[order][1:] != h[order][:-1])))
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.flatnonzero(own[order] > own[head])
    for part in range(0, len(later), 65536):  # the hashes agree; so must the bytes
        rows = later[part : part + 65536]
        same = (_take(block.data, at[order[rows]], 0, WINDOW) == _take(block.data, at[head[rows]], 0, WINDOW)).all(axis=1)
        later[part : part + 65536] = np.where(same, rows, -1)
    gone = np.zeros(len(at), bool)
    gone[order[later[later >= 0]]] = True
    for mask, bare in ((~gone, False), (gone, True)):
        a, m, d = at[mask], h[mask], doc[mask]
        first, n = (runs(a, d) if bare else runs(a, m, d, most=1024))
        begin, place = a[first], d[first]
        data = [b""] * len(first) if bare else [block.data[s : s + k + WINDOW - 1].tobytes() for s, k in zip(begin.tolist(), n.tolist())]
        _add(out, _spread(begin, blk) if bare else m[first], blk, block, place, begin - block.starts[place], n, data)
    return out


def _spread(x: np.ndarray, blk: int) -> np.ndarray:
    """Keys that spread rows which only pass through."""
    return scramble(x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(blk))


def _add(out: list, key: np.ndarray, blk: int, block: Block, place: np.ndarray, start: np.ndarray, n: np.ndarray, data: list[bytes]) -> None:
    parts = (key.view(np.int64), np.full(len(place), blk), block.idx[place], block.order[place], start, n)
    for column, part in zip(out, (*(p.tolist() for p in parts), data)):
        column.extend(part)


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by minimizer; windows of one minimizer are judged together."""
    held: list[pa.RecordBatch] = []

    def judged(rows: pa.Table) -> pa.RecordBatch:
        blk, idx, doc, start, n = (rows.column(c).to_numpy() for c in ("blk", "idx", "doc", "start", "n"))
        data = rows.column("data").to_pylist()
        bare = np.array([not d for d in data])
        out = [(blk[bare], idx[bare], start[bare], n[bare])]
        if not bare.all():
            blk, idx, doc, start, n = (x[~bare] for x in (blk, idx, doc, start, n))
            joined = np.frombuffer(b"".join(data), np.uint8)
            size = n + WINDOW - 1
            row = np.repeat(np.arange(len(n)), n)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            order, new = deep_shallow(joined, (np.cumsum(size) - size)[row] + turn)
            first = np.flatnonzero(new)
            own = doc[row][order]
            least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.concatenate((first, [len(own)]))))
            gone = np.zeros(len(row), bool)
            gone[order[own > least]] = True
            at = np.flatnonzero(gone)
            f, k = runs(at, row[at])
            out.append((blk[row[at[f]]], idx[row[at[f]]], start[row[at[f]]] + turn[at[f]], k))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int32)), pa.array(columns[2].astype(np.int64)), pa.array(columns[3].astype(np.int64))],
            names=["blk", "idx", "start", "n"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))  # sorted: the last minimizer may go on
        if cut or held and held[-1].column(0)[-1].as_py() != key[0]:
            done = held + ([batch.slice(0, cut)] if cut else [])
            if done:
                yield judged(pa.Table.from_batches(done))
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield judged(pa.Table.from_batches(held))


def _cut(block: Block, blk: int, rows: pa.Table) -> list:
    """What is left of each document, hashed."""
    idx, start, n = (rows.column(c).to_numpy() for c in ("idx", "start", "n")) if rows.num_rows else (np.zeros(0, np.int64),) * 3
    place = np.searchsorted(block.idx, idx)
    begin = block.starts[place] + start if len(idx) else np.zeros(0, np.int64)
    edge = np.zeros(len(block.data) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + n + WINDOW - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    out = [[], [], [], [], []]
    for doc_id, a, size in zip(block.ids, block.starts.tolist(), block.lens.tolist()):
        mask = gone[a : a + size]
        spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        rest = block.data[a : a + size]
        rest = rest[~mask] if spans else rest
        for column, x in zip(out, (doc_id, size, size - len(rest), spans, hashlib.sha256(rest.tobytes()).hexdigest())):
            column.append(x)
    return out


def removed_runs(blocks: DataFrame) -> DataFrame:
    """(blk, idx, start, n): runs of window starts whose 50 bytes also start in a document with a smaller doc_id."""
    schema = "h long, blk long, idx int, doc long, start long, n long, data binary"
    settled = copies(blocks)
    known = recurring(blocks, settled, _owners).select("blk", "h", F.lit(None).cast("int").alias("idx"))
    known = known.union(settled.select("blk", F.lit(None).cast("long"), "idx"))
    segments = with_blocks(blocks, known, _candidates, schema)
    return segments.repartition("h").sortWithinPartitions("h").mapInArrow(_sorted_out, "blk long, idx int, start long, n long")


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    blocks = block_table(docs)
    return with_blocks(blocks, removed_runs(blocks), _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
