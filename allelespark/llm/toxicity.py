"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with marks at its ends) and itself, hashed into a fixed number of buckets.  A text is the
mean of its words' mean vectors, which a linear softmax turns into two classes; vectors and softmax are trained together.  A
misspelling that training never saw shares most n-grams with the word, so it shares its vector.

Scale: training uses a bounded sample of labelled rows (``train_rows``, half of each class where there are as many, chosen
by hash from all of them); features are made in tasks, the driver gets index and weight arrays only.  Scoring reads every
text once, without any shuffle: mean and softmax are linear in the vectors, so a bucket is one number and a word's number is
kept in a bounded cache.  The model is a fixed number of floats, which bounds the broadcast.

Defined cases: null and wordless texts get the score of the bias (the prior); labels of unknown documents and null labels are
unused; a document labelled more than once is toxic if any label says so; without labels of both classes the score is the share
of toxic labels (0 without labels); repeated rows give a row each; other columns are ignored.
"""
from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from allelespark.llm.common import per_row

BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4)
TRAIN_ROWS = 5000
CACHE = 400_000
#: Means of many words are small numbers; a constant factor puts them into the range in which training moves.
GAIN = 30.0


def buckets_of(token: str, buckets: int = BUCKETS) -> list[int]:
    """Buckets of a lower-case token: of itself and of its n-grams, without what isn't a letter or digit at its ends."""
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while b > a and not token[b - 1].isalnum():
        b -= 1
    if a == b:
        return []
    word = f"<{token[a:b]}>"
    crc = zlib.crc32
    if word.isascii():  # bytes are characters then
        word = word.encode()
        return sorted([crc(p) % buckets for p in {word, *(word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1))}])
    parts = {word, *(word[i : i + n] for n in GRAMS for i in range(len(word) - n + 1))}
    return sorted([crc(p.encode("utf-8", "surrogatepass")) % buckets for p in parts])


def bag(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and weights (they sum to at most 1) of a whole text."""
    tokens = (text or "").lower().split()
    counts: dict[str, int] = {}
    for t in tokens:
        counts[t] = counts.get(t, 0) + 1
    at, weight = [], []
    for t, c in counts.items():
        if own := buckets_of(t, buckets):
            at += own
            weight += [c / len(own) / len(tokens)] * len(own)
    where, back = np.unique(np.array(at, np.int32), return_inverse=True)
    return where.astype(np.int32), np.bincount(back, weights=weight, minlength=len(where)).astype(np.float32)


@dataclass
class Model:
    """``value[bucket]`` is what the bucket's vector adds to the log odds; ``bias`` is the rest."""

    value: np.ndarray
    bias: float
    words: dict = field(default_factory=dict)

    def __post_init__(self):
        self.table = self.value.tolist()  # one number at a time is faster from a list

    def word(self, token: str) -> float:
        own = buckets_of(token, len(self.table))
        return sum([self.table[i] for i in own]) / len(own) if own else 0.0

    def score(self, text: str | None) -> float:
        tokens = (text or "").lower().split()
        known = self.words
        if len(known) > CACHE:
            known.clear()
        total = 0.0
        for t in tokens:
            x = known.get(t)
            if x is None:
                known[t] = x = self.word(t)
            total += x
        z = self.bias + (GAIN * total / len(tokens) if tokens else 0.0)
        return 1.0 / (1.0 + math.exp(-z)) if z > -700 else 0.0


def train(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float, epochs: int = 14, batch: int = 128, rate: float = 0.02,
    drop: float = 0.5, decay: float = 0.1, seed: int = 7, buckets: int = BUCKETS,
) -> Model:
    """Adam on bucket vectors and softmax together; the bias is then moved from the sample's share of toxic rows to ``prior``.

    Vectors start near zero, so an n-gram that training never saw says next to nothing.  Each step leaves out a share ``drop`` of
    the n-grams and shrinks the vectors it used, so that no text hangs on a few rare n-grams.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.01, (buckets, DIM)).astype(np.float32)
    params = [vectors, rng.normal(0, 0.3, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        lr = rate * (1 - epoch / epochs)
        for s in range(0, len(order), batch):
            rows = order[s : s + batch]
            used, back = np.unique(np.concatenate([bags[i][0] for i in rows]), return_inverse=True)
            weights = np.zeros((len(rows), len(used)), np.float32)
            shares = np.concatenate([bags[i][1] for i in rows])
            shares = shares * (rng.random(len(shares)) >= drop) * np.float32(GAIN / (1 - drop))
            weights[np.repeat(np.arange(len(rows)), [len(bags[i][0]) for i in rows]), back] = shares
            mean = weights @ vectors[used]
            z = mean @ params[1] + params[2]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p /= np.float32(len(rows))
            slope = np.zeros_like(vectors)
            slope[used] = weights.T @ (p @ params[1].T)
            step += 1
            for q, g, m, v in zip(params, (slope, mean.T @ p, p.sum(axis=0)), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            vectors[used] *= np.float32(1 - lr * decay)
    share = float(labels.mean())
    shift = math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    side = params[1][:, 1] - params[1][:, 0]
    return Model((vectors @ side).astype(np.float64), float(params[2][1] - params[2][0]) + shift)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, buckets: int = BUCKETS) -> Model:
    """Train on labelled documents that aren't held out, at most ``train_rows`` of them; of rows with one doc_id, on that with the least text hash."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
    known = known.where(~held_out()).join(docs.select("doc_id").distinct(), "doc_id")
    counts = {r[0]: r[1] for r in known.groupBy("_toxic").count().collect()}
    n0, n1 = counts.get(0, 0), sum(v for k, v in counts.items() if k != 0)
    if not n0 or not n1:
        share = n1 / max(n0 + n1, 1)
        return Model(np.zeros(buckets), math.log(share / (1 - share)) if 0 < share < 1 else (50.0 if share else -50.0))
    half = train_rows // 2
    take = [min(n0, max(half, train_rows - n1)), min(n1, max(half, train_rows - n0))]
    picked = [known.where(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k) for c, k in zip(("_toxic = 0", "_toxic <> 0"), take)]
    chosen = picked[0].union(picked[1])

    def features(doc_id, text, toxic):
        at, w = bag(text, buckets)
        return doc_id, int(toxic != 0), at.tobytes(), w.tobytes()

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most train_rows ids
    rows = rows.groupBy("doc_id", "_toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one row of each
    got = per_row(rows, ["doc_id", "text", "_toxic"], "doc_id long, toxic int, at binary, w binary", features).toArrow()
    order, bags = np.argsort(got.column("doc_id").to_numpy(), kind="stable"), []
    for at, w in zip(got.column("at"), got.column("w")):  # views of what came, not copies
        bags.append((np.frombuffer(at.as_buffer(), np.int32), np.frombuffer(w.as_buffer(), np.float32)))
    return train([bags[i] for i in order], got.column("toxic").to_numpy()[order], n1 / (n0 + n1), buckets=buckets)


def _shared(docs: DataFrame, labels: DataFrame, train_rows: int):
    """What makes the fitted model in a task; the broadcast is one float for each bucket."""
    model = fit(docs, labels, train_rows)
    sent = docs.sparkSession.sparkContext.broadcast((model.value, model.bias))
    return lambda: Model(*sent.value)


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted."""
    model = _shared(docs, labels, train_rows)
    scored = per_row(docs, ["doc_id", "text"], "doc_id long, score double", lambda m, i, t: (i, m.score(t)), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def acceptable(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Rows of ``docs`` with a score under 0.5, with all their columns; scored in the scan, without a join."""
    start = _shared(docs, labels, train_rows)

    def keep(batches):
        model = start()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([model.score(t) < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
