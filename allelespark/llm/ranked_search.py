"""Ranked lexical search: the k highest-scoring documents of each query, by best-first search over document intervals.

1. Queries become term sets, cut into blocks of bounded size; blocks come one after another, so one block at a time is broadcast.
2. One scan of the documents counts all terms of each and keeps those of the block, with frequencies, as a narrow table: nothing is shuffled.
   Document frequencies are partial counts for each task, summed; their number is that of the block's terms.
3. A task cuts its rows into segments of bounded size, in doc_id order, and makes a posting list for each term with the term's impacts (its
   part of the score) and a sparse table of range maxima over them, so the largest impact within any interval of documents takes two
   look-ups.
4. A query starts with the whole segment as one interval, whose bound is the sum of its terms' range maxima.  The intervals with the highest
   bounds go first: each is split at the document of its largest impact, that document gets its exact score, and the two parts get bounds
   of their own.  Intervals that can't reach the k-th best score so far are dropped; when none is left, the segment is done.
5. The best k of a task carry over to its next segment as the score to beat, so most later intervals are dropped at once.  Tasks' bests
   are merged with a rank window, whose limit also works before its shuffle.

Scale: texts are read once for each block of queries.  A task holds one segment (``SEGMENT_DOCS`` documents, ``SEGMENT_POSTINGS`` postings) and
one block (``BLOCK_BYTES``); k rows per query leave it.  Nothing is grouped by term or document, so frequent words and groups of copies are
spread like other rows.  Results are exact: bounds only leave out what can't be among the best.

Defined cases: null and empty texts have no term and don't count as documents; queries without a term have no rows; a null query id is an
id; rows with one query id are one query with the terms of all; repeated document rows are documents of their own; equal scores go by
ascending doc_id, nulls last; a table without documents or queries gives no rows; other columns are ignored.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from allelespark.llm.common import staged
from allelespark.operators.ordered import ordered

BEST = 10
BLOCK_BYTES = 8 << 20
SEGMENT_DOCS = 8192
SEGMENT_POSTINGS = 2_000_000
#: Intervals that are split at a time.
AT_ONCE = 24
#: Bytes that aren't part of a term become blanks; of letters only A-Z are lowered.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_LAST = np.iinfo(np.int64).max


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def query_terms(queries: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(item_id, terms) with the distinct terms of each query, those without terms left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                own = sorted(set(terms_of(text)))
                terms += own
                ids += [at] * len(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary())], names=["item_id", "term"])

    kind = queries.schema[item_id].dataType.simpleString()
    rows = queries.where(F.col("text").isNotNull()).select(F.col(item_id).alias("item_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"item_id {kind}, term binary").distinct().groupBy("item_id").agg(F.collect_list("term").alias("terms"))


def _blocks(queries: DataFrame, item_id: str, limit: int) -> tuple[DataFrame, int]:
    """``query_terms`` with their block number, and the number of blocks."""
    items = query_terms(queries, item_id)
    items = items.withColumn("bytes", F.aggregate("terms", F.lit(64).cast("long"), lambda a, t: a + F.octet_length(t) + 64))
    placed = ordered(items, [], [F.col("item_id").asc_nulls_last()], {"before": F.col("bytes")}, "_turn")
    placed = staged(placed.select("item_id", "terms", F.floor(F.col("before") / limit).cast("long").alias("block")), "search-queries")
    return placed, (placed.agg(F.max("block")).first()[0] or 0) + 1


def _counted(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms counted, those of the vocabulary kept by number; documents without a term left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for batch in batches:
            rows = []
            for at, text in enumerate(batch.column(1)):
                found = terms_of(text.as_py()) if text.is_valid else []
                if found:
                    own = [(number[t], c) for t, c in Counter(found).items() if t in number]
                    both = np.array(own, np.int32).reshape(-1, 2)
                    rows.append((at, len(found), both[:, 0].tobytes(), both[:, 1].tobytes()))
            at, n, terms, tfs = zip(*rows) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                names=["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms binary, tfs binary")


def _frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for terms in batch.column(0).to_pylist():
                df[np.frombuffer(terms, np.int32)] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    got = counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[got.column("term").to_numpy()] = got.column("df").to_numpy()
    return df


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Segment:
    """Posting lists of a run of documents in doc_id order, one after another, with range maxima."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, terms: list[bytes], tfs: list[bytes], weight: np.ndarray, n_docs: int, length: int):
        order = np.argsort(ids, kind="stable")
        self.ids, n = ids[order], n[order]
        counts = np.array([len(terms[i]) // 4 for i in order], np.int64)
        doc = np.repeat(np.arange(len(order)), counts)
        term = np.frombuffer(b"".join(terms[i] for i in order), np.int32).astype(np.int64)
        tf = np.frombuffer(b"".join(tfs[i] for i in order), np.int32).astype(np.int64)
        if int(n.max(initial=0)) * 90 * n_docs < 1 << 62:
            m = 10 + (90 * n * n_docs) // length
        else:
            m = np.array([10 + 90 * int(x) * n_docs // length for x in n], np.int64)
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        by = np.lexsort((doc, term))
        self.stride = np.int64(len(order) + 1)
        self.key = term[by] * self.stride + doc[by]
        self.impact, self.doc = impact[by], doc[by]
        self.best = [np.arange(len(by))]
        longest = int(np.bincount(term, minlength=1).max(initial=0)) if len(term) else 0
        while (2 << (len(self.best) - 1)) <= longest:  # windows over two lists are made but never asked for
            last, half = self.best[-1], 1 << (len(self.best) - 1)
            left, right = last[:-half], last[half:]
            self.best.append(np.where(self.impact[right] > self.impact[left], right, left))
        self.levels = np.array([len(x) for x in self.best], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.levels)[:-1]])
        self.flat = np.concatenate(self.best)

    def maxima(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the largest impact in postings left..right-1 (the first of equal ones), and that impact, 0 if there is none."""
        some = right > left
        if not some.any():
            return np.zeros_like(left), np.zeros_like(left)
        level = np.frexp(np.where(some, right - left, 1))[1].astype(np.int64) - 1
        base = self.base[level]
        a = self.flat[base + np.where(some, left, 0)]
        b = self.flat[base + np.where(some, right - (np.int64(1) << level), 0)]
        va, vb = self.impact[a], self.impact[b]
        return np.where(vb > va, b, a), np.where(some, np.maximum(va, vb), 0)

    def search(self, terms: np.ndarray, k: int, best: list[tuple[int, int]], at_once: int = AT_ONCE) -> list[tuple[int, int]]:
        """The k best (score, -doc_id) of ``best`` and this segment."""
        start = np.searchsorted(self.key, terms * self.stride)
        end = np.searchsorted(self.key, (terms + 1) * self.stride)
        terms, start, end = (x[end > start] for x in (terms, start, end))
        if not len(terms):
            return best
        offset = terms * self.stride
        left, right, first = start[None, :], end[None, :], np.zeros(1, np.int64)  # postings and first document of the open intervals
        place, most = self.maxima(left, right)
        while len(left):
            bound = most.sum(axis=1)
            if len(best) < k:
                go = bound > 0
            else:  # of equal scores only a smaller doc_id counts
                go = (bound > max(best[-1][0], 0)) | ((bound == best[-1][0]) & (bound > 0) & (self.ids[np.minimum(first, len(self.ids) - 1)] < -best[-1][1]))
            left, right, first, place, most, bound = (x[go] for x in (left, right, first, place, most, bound))
            if not len(left):
                break
            turn = np.argsort(-bound, kind="stable")
            now, rest = turn[:at_once], turn[at_once:]
            l, r, f = left[now], right[now], first[now]
            split = self.doc[place[now, most[now].argmax(axis=1)]]
            cut = np.searchsorted(self.key, offset[None, :] + split[:, None])
            inside = np.minimum(cut, len(self.key) - 1)
            hit = self.key[inside] == offset[None, :] + split[:, None]
            score = np.where(hit, self.impact[inside], 0).sum(axis=1)
            new = [(s, -d) for s, d in zip(score.tolist(), self.ids[split].tolist()) if s > 0]
            best = sorted(best + new, reverse=True)[:k]
            l, r = np.concatenate([l, np.maximum(cut + hit, l)]), np.concatenate([np.minimum(cut, r), r])
            p, m = self.maxima(l, r)
            f = np.concatenate([f, split + 1])
            left, right, first = np.concatenate([left[rest], l]), np.concatenate([right[rest], r]), np.concatenate([first[rest], f])
            place, most = np.concatenate([place[rest], p]), np.concatenate([most[rest], m])
        return best


def _searched(counted: DataFrame, sent, k: int) -> DataFrame:
    """(item, doc_id, score): the best k of each task."""

    def segments(batches: Iterator[pa.RecordBatch], weight, n_docs, length) -> Iterator[Segment]:
        ids, n, terms, tfs, postings = [], [], [], [], 0

        def made():
            return Segment(np.array(ids, np.int64), np.array(n, np.int64), terms, tfs, weight, n_docs, length)

        for batch in batches:
            for i, x, t, c in zip(*(col.to_pylist() for col in batch.columns)):
                ids.append(_LAST if i is None else i)
                n.append(x)
                terms.append(t)
                tfs.append(c)
                postings += len(t) // 4
                if len(ids) >= SEGMENT_DOCS or postings >= SEGMENT_POSTINGS:
                    yield made()
                    ids, n, terms, tfs, postings = [], [], [], [], 0
        if ids:
            yield made()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight, n_docs, length = sent.value
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for segment in segments(batches, weight, n_docs, length):
            for i, terms in enumerate(queries):
                best[i] = segment.search(terms, k, best[i])
        rows = [(i, None if d == -_LAST else -d, s) for i, own in enumerate(best) for s, d in own]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return counted.select("doc_id", "n", "terms", "tfs").mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = BEST, item_id: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each query with a score above 0."""
    spark = docs.sparkSession
    placed, blocks = _blocks(queries, item_id, block_bytes)
    found = []
    for b in range(blocks):
        items = placed.where(F.col("block") == b).select("item_id", "terms").toArrow()  # block_bytes and one query at most
        ids, terms = items.column("item_id").to_pylist(), items.column("terms").to_pylist()
        vocabulary = sorted({t for own in terms for t in own})
        number = {t: i for i, t in enumerate(vocabulary)}
        words = spark.sparkContext.broadcast(vocabulary)
        counted = staged(_counted(docs, words), "search-counts")
        totals = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        weight = weights(_frequencies(counted, len(vocabulary)), totals["docs"])
        numbered = [np.array(sorted(number[t] for t in own), np.int64) for own in terms]
        sent = spark.sparkContext.broadcast((numbered, weight, totals["docs"], totals["terms"] or 1))
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        best = _searched(counted, sent, k).withColumn("rank", rank).where(F.col("rank") <= k)
        kind = StructType([StructField("item", LongType()), StructField("item_id", placed.schema["item_id"].dataType)])
        names = spark.createDataFrame(list(enumerate(ids)), kind)
        found.append(staged(best.join(names, "item").select("item_id", "rank", "doc_id", "score"), "search-best"))
        words.destroy()
        sent.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
