"""SimHash near-dedup with pigeonring candidate filtering.

1. Each text becomes a 64-bit fingerprint of its word shingles, inside Arrow tasks; only (doc_id, fingerprint) goes on.
2. Documents of one fingerprint are one class, found by a partial aggregation, so copies meet nobody.
3. The 64 bits are cut into a ring of segments.  With 4 differing bits at least ``segments - 4`` segments are equal, so two
   fingerprints that link share a key made of that many segments.
4. Inside a key, a pair is a candidate only if the ring has a start from which every chain of consecutive segments stays
   within its share of the budget (l segments: at most l * 4 / segments differing bits).  Then the full distance is taken.
5. Only links that join two parts leave a key, so n fingerprints of a key give at most n - 1 rows, not n * n.
6. Links become components by alternating star contraction in DataFrame joins, each round written to the shared folder.

Scale: the number of segments follows the number of fingerprints (a key has 21, 27 or 32 bits), so keys stay small.  Keys with
more than ``pairs_below`` fingerprints are never compared in pairs: their fingerprints are put at every point within 2 bits
(two that differ in 4 bits share such a point), and each point links its members to the smallest.  That is exact and linear.
Rows per document are one join on the fingerprint away from their class, which adaptive skew handling can split.

Defined cases: null and wordless texts have fingerprint zero and link like others; fewer words than a shingle are one shingle;
repeated rows give a row each; a null doc_id is never a component's name unless its component has no other; ``survivors`` keeps a row of every component; empty input gives no
rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespark.llm.common import per_row, staged

SHINGLE = 4
BITS = 64
DISTANCE = 4
PAIRS_BELOW = 8192


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned: bit j is set if it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, ASCII blanks split
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(h), 65536):
        ones += np.unpackbits(h[part : part + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint's bits as a signed long."""

    def one(doc_id, text):
        fp = fingerprint(text, shingle)
        return doc_id, fp - (1 << 64) if fp >> 63 else fp

    return per_row(docs, ["doc_id", "text"], "doc_id long, fp long", one)


def ring(segments: int) -> list[int]:
    """Bit masks of consecutive segments, as equal as possible."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def segments_for(n: int) -> int:
    """So many segments that a key of the equal ones has about as many values as there are fingerprints."""
    return 6 if n <= 1 << 21 else 7 if n <= 1 << 27 else 8


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pigeonring(diff: np.ndarray, segments: int, distance: int = DISTANCE) -> np.ndarray:
    """Which XORs have a start whose chains of 1..segments segments all stay within their share of ``distance``."""
    parts = np.stack([np.bitwise_count(diff & np.uint64(m)) for m in ring(segments)]).astype(np.int16)
    ok = np.zeros(len(diff), bool)
    for start in range(segments):
        chain, total = np.ones(len(diff), bool), np.zeros(len(diff), np.int16)
        for length in range(1, segments + 1):
            total += parts[(start + length - 1) % segments]
            chain &= total * segments <= length * distance
        ok |= chain
    return ok


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each vertex's part, for edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(key: np.ndarray, fp: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by key: each row to the first of its part, where a part is linked within its key."""
    n, froms, tos = len(key), [], []
    run = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    left = np.repeat(np.diff(run), np.diff(run)) - (np.arange(n) - np.repeat(run[:-1], np.diff(run))) - 1  # rows after it
    at, off = np.flatnonzero(left >= 1), 1
    while len(at):
        diff = fp[at] ^ fp[at + off]
        hit = at[pigeonring(diff, segments)]
        hit = hit[np.bitwise_count(fp[hit] ^ fp[hit + off]) <= DISTANCE]
        if len(hit):
            froms.append(hit)
            tos.append(hit + off)
        off += 1
        if off % 64 == 0 and froms:  # keep a forest, not all links
            root = _roots(n, np.concatenate(froms), np.concatenate(tos))
            low = np.flatnonzero(root != np.arange(n))
            froms, tos = [low], [root[low]]
        at = at[left[at] >= off]
    if not froms:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    root = _roots(n, np.concatenate(froms), np.concatenate(tos))
    low = np.flatnonzero(root != np.arange(n))
    return low, root[low]


def links(classes: DataFrame, n: int, pairs_below: int = PAIRS_BELOW) -> DataFrame:
    """(a, b), a > b: enough links between the distinct fingerprints ``fp`` to connect all that are within 4 bits."""
    m = segments_for(n)
    masks = [sum(c) for c in combinations(ring(m), m - DISTANCE)]
    keys = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("bits")) for i, mask in enumerate(masks)
    ])).alias("k")).select("fp", "k.part", "k.bits")
    shared = keys.groupBy("part", "bits").agg(F.count("*").alias("members")).where("members > 1")
    met = staged(keys.join(shared, ["part", "bits"]), "simhash-keys")
    small, large = met.where(F.col("members") <= pairs_below), met.where(F.col("members") > pairs_below)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key cut by a batch's end is carried on (at most ``pairs_below`` rows)."""
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            fresh = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = fresh[-1] + 1 if len(fresh) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield found([c[:cut] for c in cols])
        if held is not None:
            yield found(held)

    def found(cols) -> pa.RecordBatch:
        part, bits, fp = cols
        key = np.cumsum(np.concatenate(([0], (part[1:] != part[:-1]) | (bits[1:] != bits[:-1]))))
        a, b = _links(key, fp.astype(np.int64).view(np.uint64), m)
        x, y = fp[a].astype(np.int64), fp[b].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])

    near = small.select("part", "bits", "fp").repartition("part", "bits").sortWithinPartitions("part", "bits", "fp").mapInArrow(compare, "a long, b long")

    flips = np.array([0, *[1 << i for i in range(BITS)], *[(1 << i) | (1 << j) for i, j in combinations(range(BITS), 2)]], np.uint64)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(0, len(fps), 64):
                some = fps[i : i + 64]
                point = (some.view(np.uint64)[:, None] ^ flips[None, :]).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(point), pa.array(np.repeat(some, len(flips)))], names=["point", "fp"])

    points = large.select("fp").distinct().mapInArrow(around, "point long, fp long")
    stars = points.groupBy("point").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")  # a point has 2081 at most
    far = stars.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a > b")
    return near.union(far).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node reachable.  Alternating large and small stars."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges, before = staged(edges, "simhash-edges"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = staged(small.distinct(), "simhash-edges")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        before = state


def _placed(prints: DataFrame, pairs_below: int) -> DataFrame:
    """(fp, first, root) for each fingerprint: its smallest doc_id and the name of its component."""
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    linked = components(links(classes.select("fp"), classes.count(), pairs_below))
    return staged(classes.join(linked, classes.fp == linked.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-placed")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, pairs_below: int = PAIRS_BELOW) -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = staged(fingerprints(docs, shingle), "simhash-prints")
    placed = _placed(prints, pairs_below)
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    final = placed.join(named, "root").select("fp", "component_id")
    return prints.join(final, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, shingle: int = SHINGLE, pairs_below: int = PAIRS_BELOW) -> DataFrame:
    """One row of each component, with all columns: the least by doc_id (null last), then by hashes of the text and of the other columns.

    A row is known by doc_id and these hashes, so a row without doc_id stays where its component has no other, and rows of
    one doc_id with different texts are told apart.  Of rows that are equal in all columns one stays.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    sha = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    rest = F.xxhash64(*others) if others else F.lit(0).cast("long")

    def one(doc_id, text, sha, rest):
        return doc_id, _signed(fingerprint(text, shingle)), sha, rest

    prints = staged(per_row(docs, ["doc_id", "text", sha.alias("sha"), rest.alias("rest")], "doc_id long, fp long, sha string, rest long", one), "simhash-prints")
    first = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha", "rest")).alias("row"))
    least = first.join(_placed(prints, pairs_below), "fp").groupBy("root").agg(F.min("row").alias("row"))
    stay = least.select(F.col("row.doc_id").alias("_doc"), F.col("row.sha").alias("_sha"), F.col("row.rest").alias("_rest"))
    known = docs.select(F.struct(*docs.columns).alias("all"), F.col("doc_id").alias("doc"), sha.alias("sha"), rest.alias("rest"))
    kept = known.join(stay, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("sha") == F.col("_sha")) & (F.col("rest") == F.col("_rest")), "left_semi")
    return kept.dropDuplicates(["doc", "sha", "rest"]).select("all.*")
