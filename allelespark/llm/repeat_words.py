"""Substring dedup over words: a de Bruijn graph of 20-word windows, compacted.

Nodes are 19-word strings, edges the 20-word windows between two of them.  Only edges that recur matter:

1. Every window has a minimizer (the smallest hash of its 10-word strings); windows whose minimizer occurs once are done.
2. What is left leaves its block as strings of nodes, grouped by minimizer, equal ones of a block once with their places.
3. In a minimizer's partition edges are counted and get their source, the smallest (doc_id, start).  Where every occurrence of an edge is
   followed by one and the same edge and the other way round, the two become one path, so most of the compaction is local.
4. Spark joins glue paths: the places behind one path are those of the next exactly (both sides carry 128 bits of an order-free hash of
   them).  Doubling joins along these links give each chain its first path and its length, so only one row for each long span and block
   goes on, with its places, and the other paths of the chain are dropped.
5. A span's words are read at its source coordinates, and every other place is held against them word by word; places that agree are removed.

Scale: copies of whole texts are settled by their hash; texts are written once and never shuffled; a minimizer has one row for each block
and spelling; joins are on paths, not on windows, and on hashes of places, so a frequent node is no hot key.  The number of doubling joins
is the logarithm of the longest chain.

Defined cases: null and short texts lose nothing; a null doc_id is larger than all others; rows of one doc_id are one document, of which
only later starts are removed; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespark.llm.blocks import Block, block_table, copies, mark, recurring, rolling, runs, scramble, sliding_min, with_blocks
from allelespark.llm.common import staged

WINDOW = 20
GRAM = 10
PLACE = np.dtype([("idx", "<i4"), ("start", "<i8")])


#: Words up to so many bytes are hashed together, eight bytes at a time; longer ones singly.
LONG = 64


def _word_hashes(data: np.ndarray, begin: np.ndarray, blank: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each word; every step is a bijection of what came before, for each next eight bytes."""
    last = np.flatnonzero(~blank & np.concatenate((blank[1:] | (doc[1:] != doc[:-1]), [True])))
    size = last + 1 - begin
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    h = scramble(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for at in range(0, min(int(size.max()), LONG), 8):
        live = np.flatnonzero(size > at)
        piece = np.ascontiguousarray(padded[(begin[live] + at)[:, None] + np.arange(8)]).view("<u8")[:, 0]
        left = size[live] - at
        piece &= np.where(left < 8, (np.uint64(1) << (np.uint64(8) * np.minimum(left, 7).astype(np.uint64))) - np.uint64(1), np.uint64(2**64 - 1))
        h[live] = scramble((h[live] ^ piece) * np.uint64(0x369DEA0F31A53F85) + np.uint64(at))
    for k in np.flatnonzero(size > LONG):
        h[k] = xxhash.xxh64_intdigest(data[begin[k] : last[k] + 1].tobytes(), 7)
    return h


class Words:
    """The words of a block: their hashes, documents and numbers in their documents."""

    def __init__(self, block: Block):
        data = block.data
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        doc = np.repeat(np.arange(len(block.lens), dtype=np.int32), block.lens)
        fresh = np.concatenate(([True], blank[:-1] | (doc[1:] != doc[:-1]))) if len(data) else np.zeros(0, bool)
        begin = np.flatnonzero(~blank & fresh)
        self.block, self.begin, self.doc = block, begin, doc[begin]
        self.first = np.searchsorted(self.doc, np.arange(len(block.lens)))  # number of the first word of each document
        self.count = np.bincount(self.doc, minlength=len(block.lens))
        self.hash = _word_hashes(data, begin, blank, doc) if len(begin) else np.zeros(0, np.uint64)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers at which windows start, their minimizers, and the hashes of all 10-word strings."""
        n = len(self.hash) - WINDOW + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        grams = scramble(rolling(self.hash, GRAM, 0x2545F4914F6CDD1D))
        at = np.flatnonzero((self.doc[:n] == self.doc[WINDOW - 1 :]) & ~self.block.skip[self.doc[:n]])
        return at, sliding_min(grams, WINDOW - GRAM + 1)[at], grams


def _owners(block: Block) -> tuple[np.ndarray, np.ndarray]:
    words = Words(block)
    at, h, grams = words.windows()
    if not len(at):
        return h, np.zeros(0, np.int64)
    spread = WINDOW - GRAM + 1
    first, n = runs(at, h, words.doc[at], most=spread)
    begin, least = at[first], h[first]
    places = np.zeros(len(first), np.int64)  # where in a run the minimizer stands: more than once is a repetition
    for j in range(2 * spread - 1):
        spot = np.minimum(begin + j, len(grams) - 1)
        places += (j < n + spread - 1) & (grams[spot] == least)
    again = places > 1
    return np.concatenate((least, least[again])), np.concatenate((begin, -1 - begin[again]))


def _strings(block: Block, blk: int, hashes: pa.Table) -> list:
    """Node strings of windows with recurring minimizers: one row for each spelling, with all its places in the block."""
    mark(block, hashes)
    words = Words(block)
    at, h, _ = words.windows()
    known = np.sort(hashes.column("h").drop_null().to_numpy().astype(np.int64).view(np.uint64)) if hashes.num_rows else np.zeros(0, np.uint64)
    out = [[] for _ in range(6)]
    if not len(at) or not len(known):
        return out
    keep = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
    at, h = at[keep], h[keep]
    nodes = scramble(rolling(words.hash, WINDOW - 1, 0x369DEA0F31A53F85))
    first, n = runs(at, h, words.doc[at], most=64)
    spelled: dict[bytes, list[int]] = {}
    for k, (s, m) in enumerate(zip(at[first].tolist(), n.tolist())):
        spelled.setdefault(nodes[s : s + m + 1].tobytes(), []).append(k)
    for string, ks in spelled.items():
        begin = at[first[ks]]
        place = words.doc[begin]
        start = begin - words.first[place]
        order = np.lexsort((start, block.order[place]))
        packed = np.empty(len(ks), PLACE)
        packed["idx"], packed["start"] = block.idx[place[order]], start[order]
        row = (int(h[first[ks[0]]].view(np.int64)), blk, int(block.order[place[order[0]]]), int(start[order[0]]), packed.tobytes(), string)
        for column, x in zip(out, row):
            column.append(x)
    return out


def _same_as_before(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns: whether a row equals the one before."""
    same = np.ones(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        same &= c[1:] == c[:-1]
    return np.concatenate(([False], same)) if len(columns[0]) else same


def _totals(keys: tuple[np.ndarray, ...], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each row by its keys, and the sum of weights of each class."""
    order = np.lexsort(keys)
    number = np.cumsum(~_same_as_before(*(k[order] for k in keys))) - 1
    cls = np.empty(len(order), np.int64)
    cls[order] = number
    return cls, np.bincount(number, weights=weight[order]).astype(np.int64)


PRINTS = ["h1", "h2", "t1", "t2"]


def _prints(blk: np.ndarray, spots: np.ndarray, n: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set of places (from ``first`` on): two exclusive-or hashes of it and two of the places ``n`` further on.

    Sets of several blocks are combined by exclusive or.
    """
    if not len(first):
        return np.zeros((0, 4), np.int64)
    at = blk.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + spots["idx"].astype(np.uint64)
    at = scramble(at * np.uint64(0x369DEA0F31A53F85))
    out = []
    for start in (spots["start"], spots["start"] + n):
        place = scramble((at ^ start.astype(np.uint64)) * np.uint64(0xDB4F0B9175AE2165))
        again = scramble((place + np.uint64(0x2545F4914F6CDD1D)) * np.uint64(0xBBE0563303A4615F))
        out += [np.bitwise_xor.reduceat(place, first), np.bitwise_xor.reduceat(again, first)]
    return np.stack(out, axis=1).view(np.int64)


def _paths(rows: pa.Table) -> pa.RecordBatch:
    """Local paths of all edges of some minimizers: one row for each path and node string."""
    blk, doc, start = (rows.column(c).to_numpy() for c in ("blk", "doc", "start"))
    places, strings = rows.column("places").to_pylist(), rows.column("nodes").to_pylist()
    size = np.array([len(s) // 8 - 1 for s in strings])
    nodes = np.frombuffer(b"".join(strings), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    here = (np.cumsum(size + 1) - size - 1)[row] + turn
    a, b = nodes[here], nodes[here + 1]
    times = np.array([len(p) // PLACE.itemsize for p in places])[row]
    edge, total = _totals((a, b), times)
    order = np.lexsort((start[row] + turn, doc[row], edge))
    lead = order[~_same_as_before(edge[order])]  # first occurrence of each edge
    src_doc, src_start = doc[row[lead]], (start[row] + turn)[lead]
    pair = np.flatnonzero(row[1:] == row[:-1])  # edge i is followed by i + 1 in its string
    follow, met = _totals((edge[pair], edge[pair + 1]), times[pair])
    linked = np.zeros(len(row), bool)
    linked[pair + 1] = (met[follow] == total[edge[pair]]) & (met[follow] == total[edge[pair + 1]])
    again = total[edge] > 1
    at = np.flatnonzero(again)
    head = at[~(linked[at] & again[np.maximum(at - 1, 0)])]
    ends = np.concatenate((head[1:], [len(row)])) if len(head) else head
    once = np.concatenate((np.flatnonzero(~again), [len(row)]))
    ends = np.minimum(ends, once[np.searchsorted(once, head)]) if len(head) else ends
    r, t, m, e = row[head], turn[head], ends - head, edge[head]
    counts = np.array([len(p) // PLACE.itemsize for p in places], np.int64)[r] if len(head) else np.zeros(0, np.int64)
    spots = np.frombuffer(b"".join([places[i] for i in r.tolist()]), PLACE).copy()
    spots["start"] += np.repeat(t, counts)
    prints = _prints(np.repeat(blk[r], counts), spots, np.repeat(m, counts), np.cumsum(counts) - counts)
    whole, cuts = spots.tobytes(), (np.concatenate(([0], np.cumsum(counts))) * PLACE.itemsize).tolist()
    packed = [whole[i:j] for i, j in zip(cuts, cuts[1:])]
    own = (doc[row[head]] == src_doc[e]) & (start[row[head]] + turn[head] == src_start[e])
    return pa.RecordBatch.from_arrays([
        pa.array(blk[row[head]].astype(np.int64)), pa.array(packed, pa.binary()), pa.array((ends - head).astype(np.int64)), pa.array(a[head]), pa.array(b[head]),
        pa.array(b[ends - 1] if len(head) else b[:0]), pa.array(total[e]), pa.array(src_doc[e].astype(np.int64)), pa.array(src_start[e].astype(np.int64)),
        *[pa.array(prints[:, i]) for i in range(4)], pa.array(own),
    ], names=["blk", "places", "n", "a", "b", "z", "total", "src_doc", "src_start", *PRINTS, "own"])


def _by_minimizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by minimizer; those of one are judged together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if held and held[-1].column(0)[-1].as_py() == key[0] and not cut:
            held.append(batch)
            continue
        done = held + ([batch.slice(0, cut)] if cut else [])
        if done:
            yield _paths(pa.Table.from_batches(done))
        held = [batch.slice(cut)]
    if held:
        yield _paths(pa.Table.from_batches(held))


def compacted(paths: DataFrame) -> DataFrame:
    """(a, b, length, src_doc, src_start): the long spans, by their first path, with their length in windows and their source."""
    one = paths.groupBy("a", "b").agg(*[F.min(c).alias(c) for c in ("z", "n", "total", "src_doc", "src_start")], *[F.bit_xor(c).alias(c) for c in PRINTS])
    one = staged(one, "word-spans")
    before = one.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("z").alias("a"), F.col("t1").alias("h1"), F.col("t2").alias("h2"), "total", F.col("n").alias("far"))
    links = staged(one.select("a", "b", "n", "h1", "h2", "total").join(before, ["a", "h1", "h2", "total"]).select("a", "b", "n", "pa", "pb", "far"), "word-links")
    done = None
    while True:  # each open link then reaches twice as far; its parent is no other open link's, so no key is hot
        every = links if done is None else links.union(done)
        up = every.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("pa").alias("qa"), F.col("pb").alias("qb"), F.col("far").alias("more"))
        told = links.join(up, ["pa", "pb"], "left")
        step = told.select("a", "b", "n", F.coalesce("qa", "pa").alias("pa"), F.coalesce("qb", "pb").alias("pb"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"), F.col("qa").isNotNull().alias("moved"))
        step = staged(step, "word-links")
        ended, links = step.where("NOT moved").drop("moved"), step.where("moved").drop("moved")
        done = ended if done is None else done.union(ended)
        if links.isEmpty():
            break
    links = done
    ends = links.groupBy("pa", "pb").agg(F.max(F.col("far") + F.col("n")).alias("length")).withColumnsRenamed({"pa": "a", "pb": "b"})
    heads = one.join(links.select("a", "b"), ["a", "b"], "left_anti").join(ends, ["a", "b"], "left")
    return heads.select("a", "b", F.coalesce("length", "n").alias("length"), "src_doc", "src_start")


def _spelled(block: Block, blk: int, rows: pa.Table) -> list:
    """The words of the spans whose source is in this block."""
    out: list[list] = [[], [], []]
    split: dict[int, list[bytes]] = {}
    for place, a, b, n in zip(*(rows.column(c).to_pylist() for c in ("place", "a", "b", "length"))):
        ((idx, start),) = np.frombuffer(place, PLACE).tolist()
        words = _words_of(block, split, idx)
        for column, x in zip(out, (a, b, b" ".join(words[start : start + n + WINDOW - 1]))):
            column.append(x)
    return out


def _words_of(block: Block, split: dict[int, list[bytes]], idx: int) -> list[bytes]:
    if idx not in split:
        split[idx] = block.bodies[int(np.searchsorted(block.idx, idx))].split()
    return split[idx]


def _cut(block: Block, blk: int, rows: pa.Table) -> list:
    """What is left of each document, hashed."""
    edges: dict[int, np.ndarray] = {}
    split: dict[int, list[bytes]] = {}
    order = dict(zip(block.idx.tolist(), block.order.tolist()))
    columns = (rows.column(c).to_pylist() for c in ("places", "length", "src_doc", "src_start", "words")) if rows.num_rows else [[]] * 5
    for places, n, src_doc, src_start, words in zip(*columns):
        size = n + WINDOW - 1
        for idx, start in np.frombuffer(places, PLACE).tolist():
            if order[idx] == src_doc and start == src_start:
                continue
            own = _words_of(block, split, idx)
            if b" ".join(own[start : start + size]) == words:
                edge = edges.setdefault(idx, np.zeros(len(own) + 1, np.int64))
                edge[start] += 1
                edge[start + size] -= 1
    out = [[], [], [], []]
    for k, (doc_id, idx) in enumerate(zip(block.ids, block.idx.tolist())):
        own = _words_of(block, split, idx)
        split.pop(idx)
        whole = bool(block.skip[k]) and len(own) >= WINDOW
        mask = np.cumsum(edges[idx][:-1]) > 0 if idx in edges else np.zeros(len(own), bool)
        mask = mask | whole
        rest = b" ".join([w for w, g in zip(own, mask.tolist()) if not g]) if mask.any() else b" ".join(own)
        for column, x in zip(out, (doc_id, len(own), int(mask.sum()), hashlib.sha256(rest).hexdigest())):
            column.append(x)
    return out


def _finish(block: Block, blk: int, rows: pa.Table) -> list:
    """Rows with ``idx`` are settled copies, the others places of spans."""
    if rows.num_rows:
        mark(block, rows)
        rows = rows.filter(rows.column("idx").is_null())
    return _cut(block, blk, rows)


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_sha256."""
    blocks = block_table(docs)
    settled = copies(blocks)
    known = recurring(blocks, settled, _owners).select("blk", "h", F.lit(None).cast("int").alias("idx"))
    known = known.union(settled.select("blk", F.lit(None).cast("long"), "idx"))
    strings = with_blocks(blocks, known, _strings, "h long, blk long, doc long, start long, places binary, nodes binary")
    schema = "blk long, places binary, n long, a long, b long, z long, total long, src_doc long, src_start long, h1 long, h2 long, t1 long, t2 long, own boolean"
    paths = staged(strings.repartition("h").sortWithinPartitions("h").mapInArrow(_by_minimizer, schema), "word-paths")
    spans = staged(paths.select("blk", "places", "a", "b", "own").join(compacted(paths), ["a", "b"]), "word-places")
    source = spans.where("own").select("blk", F.substring("places", 1, PLACE.itemsize).alias("place"), "a", "b", "length")
    texts = with_blocks(blocks, source, _spelled, "a long, b long, words binary").groupBy("a", "b").agg(F.min("words").alias("words"))
    placed = spans.join(texts, ["a", "b"]).select("blk", F.lit(None).cast("int").alias("idx"), "places", "length", "src_doc", "src_start", "words")
    nothing = [F.lit(None).cast(t) for t in ("binary", "long", "long", "long", "binary")]
    placed = placed.union(settled.select("blk", "idx", *nothing))
    return with_blocks(blocks, placed, _finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")
