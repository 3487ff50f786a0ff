"""Merkle manifest, two-pass shuffle and ranked search against plain versions, with odd rows."""
import hashlib
import math
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from allelespark.llm import merkle, queries, ranked_search, sharding
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
ROWS = [
    (i, f"Text {i % 7} of the brown fox, number {i % 5}. " * (1 + i % 3), ["en", "de", None, "", "fr"][i % 3 if i < 60 else i % 5], ["a", None, "é"][i % 3], i)
    for i in range(90)
] + [
    (None, "no id at all", "en", "a", 1), (None, "no id at all", "en", "a", 1), (3, "a second row of three", "en", "a", None), (3, None, None, None, None),
    (200, "", "zz", "a", 0), (201, None, "en", None, None), (202, "Ünïcode wörds und 中文 fox FOX", "de", "b", 9), (203, "fox " * 30000, "en", "a", 5),
] + [(300, "the same row over and over again, fox", "en", "a", 7)] * 40
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, number long, shard int, slot long, record string, _h1 long, key long, n long"


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "t", 1, 2, 3, "r", 4, 5, 6) for r in ROWS], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    """Siblings of leaf i level by level, with their sides."""
    steps = []
    for row in tree[:-1]:
        steps.append((row[i ^ 1], i & 1) if i ^ 1 < len(row) else None)
        i >>= 1
    return steps


def up(node, steps):
    for s in steps:
        node = sha(node) if s is None else sha(s[0], node) if s[1] else sha(node, s[0])
    return node


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees[g] = levels([plain_leaf(*r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            steps = path(trees[g], i) + path(top, k)
            seen = plain_leaf(*r[:4], r[4] + 1) if tampered(r[0]) and r[4] is not None else plain_leaf(*r)
            folded = up(seen, steps)
            out.append((r[0], plain_leaf(*r), trees[g][-1][0], top[-1][0], sha(*[s[0] for s in steps if s]), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("height", [1, 2, 8])
def test_manifest(docs, none, height):
    change = {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    got = merkle.manifest(docs, changed=change, height=height)
    assert Counter(map(tuple, got.collect())) == Counter(plain_manifest(ROWS))
    assert merkle.manifest(none, changed=change, height=height).count() == 0


def test_manifest_of_one_row_and_one_group(spark):
    one = spark.createDataFrame([(7, "x", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == sha()


@pytest.mark.parametrize("levels", range(1, 12))
def test_addresses_are_a_layout(levels):
    """Every place once; the top half of the tree comes first, and each bottom subtree is in one piece."""
    at = [merkle.addresses(d, np.arange(1 << d), levels) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range((1 << levels) - 1))
    top = levels // 2
    if top:
        assert max(x.max() for x in at[:top]) == (1 << top) - 2
        for b in range(1 << top):
            own = np.concatenate([at[d][(np.arange(1 << d) >> (d - top)) == b] for d in range(top, levels)])
            assert own.max() - own.min() == len(own) - 1


def test_shards_are_a_shuffle_of_the_rows(docs, none):
    shards = 7
    got = sharding.written(docs, shards).cache()
    rows = Counter(tuple(r) for r in docs.collect())
    assert Counter(tuple(r.record) for r in got.collect()) == rows
    sizes = {r.shard: (r.n, r.a, r.z) for r in got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("z")).collect()}
    assert set(sizes) == set(range(shards)) and max(s[0] for s in sizes.values()) - min(s[0] for s in sizes.values()) <= 1
    assert all(a == 0 and z == n - 1 for n, a, z in sizes.values()) and got.select("shard", "slot").distinct().count() == got.count()
    # the outcome doesn't hang on how the table lies; another seed gives another order
    place = lambda df: Counter((r.shard, r.slot, tuple(r.record)) for r in df.collect())
    assert place(sharding.written(docs.repartition(2, "source"), shards)) == place(got)
    assert place(sharding.written(docs, shards, seed=5)) != place(got)
    assert sharding.written(none, shards).count() == 0


def test_many_equal_rows_spread(spark):
    """A row that makes up a third of the table, more than a bucket holds, goes to all shards evenly."""
    row = (1, "again and again " * 4)
    docs = spark.createDataFrame([row] * 3000 + [(i, f"text {i}") for i in range(6000)], "doc_id long, text string").repartition(6)
    got = sharding.written(docs, 5, bucket_bytes=40_000)
    assert got.count() == 9000
    per = [r["count"] for r in got.where("record.doc_id = 1 AND record.text LIKE 'again%'").groupBy("shard").count().collect()]
    assert sum(per) == 3000 and len(per) == 5 and max(per) < 2 * min(per)
    buckets, _ = sharding.scattered(docs, 5, bucket_bytes=40_000)
    assert max(r["count"] for r in buckets.groupBy("bucket").count().collect()) < 1200


def test_a_shard_is_read_in_order_from_any_slot(docs, tmp_path):
    sharding.write(docs, str(tmp_path / "s"), 4)
    whole = sharding.read_shard(docs.sparkSession, str(tmp_path / "s"), docs, 2).collect()
    assert [r.slot for r in whole] == list(range(len(whole)))
    assert sharding.read_shard(docs.sparkSession, str(tmp_path / "s"), docs, 2, 5).collect() == whole[5:]


def test_fisher_yates_is_even():
    rng = np.random.default_rng(0)
    seen = Counter(tuple(sharding.fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert list(sharding.fisher_yates(0, rng)) == [] and list(sharding.fisher_yates(1, rng)) == [0]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(rows, items, k=10):
    docs = [(r[0], Counter(plain_terms(r[1]))) for r in rows if plain_terms(r[1])]
    n_docs, length = len(docs), sum(sum(c.values()) for _, c in docs)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, c in docs:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // length
            s = 0
            for t in terms & set(c):
                df = sum(t in other for _, other in docs)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id, s))
        out += [(item, r + 1, d[3], d[4]) for r, d in enumerate(sorted(scored)[:k])]
    return out


ITEMS = [(1, "The brown FOX"), (2, "number of 3, again"), (3, None), (4, "!!!"), (5, "absent words"), (6, "ünïcode 中文 no id"), (None, "text second row"), (2, "over and over"),
         (7, "the same row over and over again fox brown number of text")]


@pytest.mark.parametrize("segment, at_once, block_bytes", [(8192, 24, 8 << 20), (16, 2, 200)])
def test_search(spark, docs, none, monkeypatch, segment, at_once, block_bytes):
    """Also with tiny segments, so best scores carry over, and blocks of a query or two."""
    monkeypatch.setattr(ranked_search, "SEGMENT_DOCS", segment)
    items = spark.createDataFrame([(*i, "x", 1) for i in ITEMS], "item_id long, text string, term string, block long")
    key = lambda rows: sorted((str(a), b, str(c), d) for a, b, c, d in rows)
    assert key(tuple(r) for r in ranked_search.search(docs, items, block_bytes=block_bytes).collect()) == key(plain_search(ROWS, ITEMS))
    assert ranked_search.search(none, items).count() == 0 and ranked_search.search(docs, items.where("false")).count() == 0


def test_best_first_leaves_most_documents_out():
    """The bounds prune: on a segment with a few outstanding documents far fewer are scored than there are."""
    rng = np.random.default_rng(3)
    n, terms, tfs = 4000, [], []
    for d in range(n):
        own = np.unique(rng.zipf(1.4, 12) % 50).astype(np.int32)
        terms.append(own.tobytes())
        tfs.append(np.where(d % 400 == 0, 20, 1) * np.ones(len(own), np.int32))
    tfs = [t.astype(np.int32).tobytes() for t in tfs]
    segment = ranked_search.Segment(np.arange(n), rng.integers(20, 200, n), terms, tfs, np.arange(50)[::-1] * 100 + 1, n, 110 * n)
    calls = []
    plain = segment.maxima
    segment.maxima = lambda a, b: calls.append(a.shape[0]) or plain(a, b)
    best = segment.search(np.array([2, 3, 5, 8]), 10, [])
    assert len(best) == 10 and sum(calls) < n / 2


def test_repeated_rows_do_not_shift_a_certified_cutoff(spark):
    from allelespark.llm import quality_rules

    feats = [(i, "en", i % 40, False) for i in range(200)]
    schema = "doc_id long, stratum string, score int, base_failed boolean"
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    once = quality_rules.cutoffs(spark.createDataFrame(feats, schema), labels).collect()
    again = quality_rules.cutoffs(spark.createDataFrame(feats + [feats[5]] * 600, schema), labels).collect()
    assert once == again == []


def test_training_takes_one_row_of_a_document(spark, monkeypatch):
    from allelespark.llm import toxicity

    seen = []
    monkeypatch.setattr(toxicity, "train", lambda bags, labels, *a, **k: seen.append(len(bags)) or toxicity.Model(np.zeros(toxicity.BUCKETS), 0.0))
    rows = [(i, f"text {i}") for i in range(60)] + [(7, f"other {j}") for j in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    toxicity.fit(docs, labels, train_rows=40)
    assert seen and seen[0] <= 40


@pytest.mark.parametrize("most", [1000, 5])
def test_mix_of_repeated_rows_has_the_words_of_the_plan(spark, monkeypatch, most):
    from allelespark.llm import mixing

    monkeypatch.setattr(mixing, "MOST_EQUAL", most)
    rows = [(1, "a " * 11, "s", 1, 2), *[(5, "one two three four five six seven", "s", 1, 2)] * 60, (None, "x y z", "t", 1, 2), ("9", "x y z", None, 1, 2), (None, None, "x", 1, 2)]
    rows = [(int(r[0]) if r[0] else None, *r[1:]) for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row_key long, _cut long").repartition(3)
    taken = {r.source: r.t for r in mixing.plan(docs).groupBy("source").agg(F.sum("taken").alias("t")).collect() if r.t}
    got = mixing.mixed(docs).collect()
    words = Counter()
    for r in got:
        words[r.source] += len(r.text.split())
        assert r.row_key == 1 and r._cut == 2
    assert dict(words) == taken


def test_words_with_equal_polynomial_hashes_are_told_apart(spark):
    """First words are a Thue-Morse string and its complement, whose polynomial hashes modulo 2**64 agree."""
    from allelespark.llm import repeat_words

    bits = [bin(i).count("1") % 2 for i in range(2048)]
    rest = " ".join(f"w{i}" for i in range(19))
    rows = [(1, "".join("ab"[b] for b in bits) + " " + rest), (2, "".join("ba"[b] for b in bits) + " " + rest)]
    got = repeat_words.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_removed for r in got] == [0, 0]


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_ranked_search"])
def test_queries_equal_sql(spark, name):
    status, _ = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name])
    assert status == "ok"


def test_sharding_query(spark):
    got = queries.QUERIES["op12_sharding"](spark, SF).collect()
    want = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(want) and Counter(r.shard for r in got) == Counter({s: len(want) // 40 for s in range(40)})
    for r in got:
        text = (want[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "rows", None)
