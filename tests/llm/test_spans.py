"""The graph's joins merge paths to long spans, and only words that repeat are removed."""
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from allelespark.llm import repeat_words
from test_operators import counted


def plain(rows, window=20):
    first, docs = {}, [(d, (t or "").split()) for d, t in rows]
    for d, w in docs:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d, i):
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone)))
    return sorted(out)


def corpus(seed):
    """Long passages shared in whole and in part, twice in one document, and cut differently."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [[word() for _ in range(400)] for _ in range(3)]
    rows = []
    for d in range(24):
        p = passage[d % 3]
        a = rng.randrange(0, 150)
        part = p[a : a + rng.choice([25, 60, 200, 250])] if d > 3 else p
        rows.append((d, " ".join([word() for _ in range(rng.randrange(30))] + part + [word() for _ in range(rng.randrange(30))] + (part[:40] if d % 4 == 0 else []))))
    return rows


def test_random_passages(spark):
    for seed in range(3):
        rows = corpus(seed)
        got = repeat_words.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
        assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got.collect()) == plain(rows)


def test_joins_merge_a_long_passage_to_one_span(spark, monkeypatch):
    """A passage of 400 words in three documents is one span of 381 windows, though its paths come from many minimizers."""
    rng = random.Random(9)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(d, " ".join([f"d{d}x{i}" for i in range(30)] + passage + [f"d{d}y{i}" for i in range(30)])) for d in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    real = repeat_words.compacted
    monkeypatch.setattr(repeat_words, "compacted", lambda paths: (seen.append((paths.select("a", "b").distinct().count(), real(paths).collect())), real(paths))[1])
    got = {r.doc_id: r.n_removed for r in repeat_words.dedup(docs).collect()}
    ((paths, spans),) = seen
    assert paths > 5 and [(s.length, s.src_doc, s.src_start) for s in spans] == [(381, 0, 30)]
    assert got == {0: 0, 1: 400, 2: 400}
    # without the joins only the paths that no link reaches would go on: heads are what the rest of the passage hangs on
    monkeypatch.setattr(repeat_words, "compacted", lambda paths: real(paths).withColumn("length", F.lit(1).cast("long")))
    assert {r.doc_id: r.n_removed for r in repeat_words.dedup(docs).collect()} == {0: 0, 1: 20, 2: 20}


def test_paths_that_part_are_not_merged(spark):
    """P is followed by Q in one document, by something else in another; Q is preceded by P in one: equally frequent, not the same places."""
    p, q = [f"p{i}" for i in range(40)], [f"q{i}" for i in range(40)]
    filler = lambda name: [f"{name}{i}" for i in range(30)]
    rows = [(0, p + q), (1, p + filler("u")), (2, filler("v") + q), (3, None), (4, " ".join(filler("z")))]
    rows = [(d, " ".join(t) if isinstance(t, list) else t) for d, t in rows]
    got = repeat_words.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got.collect()) == plain(rows) == [(0, 80, 0), (1, 70, 40), (2, 70, 40), (3, 0, 0), (4, 30, 0)]


def test_words_that_only_hash_alike_stay(monkeypatch):
    """A place whose words aren't the source's, as a collision of hashes would bring, loses nothing."""
    block = repeat_words.Block.__new__(repeat_words.Block)
    block.bodies, block.idx, block.ids, block.skip = [b"a b c", b"x y z"], np.array([0, 1], np.int32), [1, 2], np.zeros(2, bool)
    block.order = np.array([1, 2])
    place = np.array([(1, 0)], repeat_words.PLACE).tobytes()
    monkeypatch.setattr(repeat_words, "WINDOW", 3)
    table = lambda text: pa.table({"places": [place], "length": [1], "src_doc": [1], "src_start": [0], "words": [text]})
    assert repeat_words._cut(block, 0, table(b"a b c"))[2] == [0, 0] and repeat_words._cut(block, 0, table(b"x y z"))[2] == [0, 3]
