"""Operators of allelespark.llm on small planted tables, against plain versions written here."""
import hashlib
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from allelespark.llm import decontaminate, license_rules, mixing, quality_rules, queries, repeat_words, simhash, substring_bytes, token_rollups, token_shards, tokens, toxicity
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
LINE = "the quick brown fox jumps over the lazy dog while seven wizards brew a strange green potion under pale moonlight tonight again"
ROWS = [
    (1, LINE + " alpha beta", "en", "a"), (2, LINE + " alpha beta", "en", "a"), (3, "Prefix text. " + LINE, "en", None), (4, None, None, "b"),
    (5, "", "de", "b"), (6, "   \n\t ", "de", "b"), (7, "word", "de", "c"), (8, "x " * 300, "en", "a"), (9, "été " * 30 + LINE, "fr", "é"),
    (10, LINE.upper(), "en", "c"), (None, LINE + " alpha beta", "en", "a"), (11, LINE + " alpha beta", "en", "a"), (11, LINE + " alpha beta", "en", "a"),
    (12, "long " + " ".join(f"w{i}" for i in range(30000)), "en", "d"), (13, " ".join(f"w{i}" for i in range(100, 160)), "en", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string, _key string, h long, blk long, size long"


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "k", 1, 2, 3) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])[0] == "ok"


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_substring_bytes(docs, none):
    texts = [(i, (t or "").encode()) for i, t, *_ in ROWS]
    key = lambda i: 1 << 62 if i is None else i
    first = {}
    for i, b in texts:
        for s in range(len(b) - 49):
            w = b[s : s + 50]
            first[w] = min(first.get(w, 1 << 63), key(i))
    want = Counter()
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < key(i):
                gone[s : s + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int(np.sum(gone & ~np.concatenate(([False], gone[:-1])))) if len(b) else 0
        want[(i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert counted(substring_bytes.dedup(docs)) == want
    assert substring_bytes.dedup(none).count() == 0


def test_deep_shallow_order():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    data[1000:1400] = data[3000:3400]
    starts = np.arange(0, 4900, 3)
    order, new = substring_bytes.deep_shallow(data, starts)
    got = [data[starts[i] : starts[i] + 50].tobytes() for i in order]
    assert got == sorted(got)
    assert new.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


def test_repeat_words(docs, none):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in ROWS]
    key = lambda i: 1 << 62 if i is None else i
    first = {}
    for i, w in texts:
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            first[k] = min(first.get(k, (1 << 63, 0)), (key(i), s))
    want = Counter()
    for i, w in texts:
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (key(i), s):
                gone[s : s + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[(i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert counted(repeat_words.dedup(docs)) == want
    assert repeat_words.dedup(none).count() == 0


def plain_components(prints, ids):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    some = list(parent)
    for i, a in enumerate(some):
        for b in some[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    least = {}
    for p, i in zip(prints, ids):
        if i is not None:
            least[root(p)] = min(least.get(root(p), i), i)
    return [least.get(root(p)) for p in prints]


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("pairs_below", [8192, 2])
def test_simhash(docs, none, pairs_below):
    prints = [plain_fingerprint(t) for _, t, *_ in ROWS]
    comp = plain_components(prints, [r[0] for r in ROWS])
    want = Counter((r[0], f"{p:016x}", c) for r, p, c in zip(ROWS, prints, comp))
    assert counted(simhash.near_duplicates(docs, pairs_below=pairs_below)) == want
    assert simhash.near_duplicates(none).count() == 0
    if pairs_below > 2:
        assert sorted(r.doc_id for r in simhash.survivors(docs).collect()) == sorted({c for c in comp})


def test_simhash_links_chains(spark):
    """A chain of fingerprints 4 bits apart is one component on both ways of comparing; 5 bits apart is none."""
    chain, x = [], 0x0123456789ABCDEF
    for i in range(12):
        chain.append(x)
        x ^= 0b1111 << (4 * i + 8)
    other = [0x0F0F0F0F0F0F0F0F, 0x0F0F0F0F0F0F0F0F ^ 0b11111 << 20]
    fps = [v - (1 << 64) if v >> 63 else v for v in chain + other]
    df = spark.createDataFrame([(v,) for v in fps], "fp long")
    for below in (8192, 1):
        got = simhash.components(simhash.links(df, len(fps), below)).groupBy("root").count().collect()
        assert [r["count"] for r in got] == [12]
    diff = np.random.default_rng(3).integers(0, 2**64, 2000, dtype=np.uint64) & np.random.default_rng(4).integers(0, 2**64, 2000, dtype=np.uint64)
    for bits in range(5):  # the filter never loses a pair within 4 bits
        d = np.array([sum(1 << int(b) for b in np.random.default_rng(k).choice(64, bits, replace=False)) for k in range(300)], np.uint64)
        assert simhash.pigeonring(d, 6).all() and simhash.pigeonring(d, 8).all()
    assert not simhash.pigeonring(diff, 6).all()


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, "Jumps over the LAZY dog, while seven wizards brew a strange!"), (2, "w105"), (3, None), (4, "..."), (None, "nothing like it"), (5, LINE[:70])], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.scan(docs.where("doc_id is not null"), items).collect()}
    assert got[1]["items"] == ["1", "5"] and got[13]["items"] == ["2"] and got[12]["items"] == ["2"] and got[4]["n_words"] == 0
    text = dict((r[0], r[1]) for r in ROWS)
    span = got[10]["hits"][0]
    assert text[10][span["from"] : span["to"]].lower().startswith("the quick") and not got[7]["hits"]
    flagged = {r.doc_id for r in decontaminate.contamination(docs, items, block_chars=20).where("contaminated").collect()}
    assert flagged == {None, 1, 2, 3, 9, 10, 11, 12, 13}
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {4, 5, 6, 7, 8}
    assert decontaminate.contamination(none, items).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).where("contaminated").count()


def test_mixing(docs, none):
    rows = mixing.plan(docs).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken <= 2 * r["size"] and r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", next(x[1] for x in ROWS if x[0] == r.doc_id) or ""))
    total = sum(r["size"] for r in rows)
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6
    for v in by.values():
        assert sum(r.taken for r in v) == int(v[0].target) and v[0].target <= 2 * v[0].source_size
    assert counted(mixing.plan(docs)) == Counter(tuple(r) for r in rows)
    assert mixing.plan(none).count() == 0
    taken = sum(len((r.text or "").split()) for r in mixing.mixed(docs.where("doc_id <> 11")).collect())
    assert taken == sum(r.taken for r in mixing.plan(docs.where("doc_id <> 11")).collect())


def test_mixing_spreads_excess_in_rounds(spark):
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate([("a", 10), ("b", 400), ("c", 30), (None, 60), ("d", 0), ("e", 200)])], "doc_id long, text string, source string")
    size = {"a": 10, "b": 400, "c": 30, "d": 0, "e": 200, None: 60}
    weight = dict(zip(["a", "b", "c", "d", "e", None], [3, 1, 2, 3, 1, 2]))
    want, left, open_ = {}, 1.5 * sum(size.values()), set(size)
    while True:
        give = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if give[s] > 2 * size[s]}
        if not over:
            want |= give
            break
        want |= {s: 2 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        open_ -= over
    got = {r.source: r.target for r in mixing.plan(docs).collect()}
    assert got == pytest.approx(want)


def test_token_output(spark, docs, none, tmp_path):
    rows = token_shards.training_order(docs, length=16, per_shard=64).cache()
    got = rows.collect()
    n = len(got)
    assert sorted(r.slot for r in got) == list(range(n))
    assert all(r.shard == r.slot // 64 and r.position == r.slot % 64 * 33 and r.n_tokens * 2 == len(r.tokens) for r in got)
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=tokens.ranks_of(), special_tokens={})
    whole = defaultdict(bytes)
    for r in sorted((r for r in got if r.doc_id not in (None, 11)), key=lambda r: (r.doc_id, r.sequence)):
        whole[r.doc_id] += r.tokens
    for i, text, *_ in ROWS:
        if text and i not in (None, 11):
            ids = np.frombuffer(whole[i], "<u2").tolist()
            assert ids[-1] == 50256 and ids[:-1] == enc.encode_ordinary(text)
    path = str(tmp_path / "shards")
    token_shards.write_shards(rows, path, length=16)
    back = {r.slot: r.tokens for r in token_shards.read_shards(spark, path, from_slot=100, length=16, per_shard=64).collect()}
    assert back == {r.slot: bytes(r.tokens) + bytes(32 - len(r.tokens)) for r in got if r.slot >= 100}
    assert token_shards.training_order(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 65537])
def test_feistel_is_a_bijection(n):
    x = np.arange(n)
    s = token_shards.slots(x, n)
    assert sorted(s.tolist()) == x.tolist() and (token_shards.numbers(s, n) == x).all()


def test_encoder_cuts_where_the_pattern_cuts():
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=tokens.ranks_of(), special_tokens={})
    encode = tokens.encoder(tokens.ranks_of())
    for t in ["a b", "a  b", " a", "a ", "a\n b", "a \n\nb's  \t c", "\n\n", "a  b", "x\x1c y", "it's  we're\r\nok  ", "é 日本 12 ab12!?  z"]:
        assert np.frombuffer(encode(t), "<u2").tolist() == enc.encode_ordinary(t), repr(t)
    for gap in (" " * 5000, "\n" * 5000, "\t \u3000" * 2000):  # runs that are encoded apart
        for t in (f"a{gap}b", f"a{gap}", f"{gap}b", f"a{gap}b{gap}c", f"a{gap}\nb"):
            assert np.frombuffer(encode(t), "<u2").tolist() == enc.encode_ordinary(t), repr(t[:9])
    assert len(encode(" " * 3_000_000 + "a")) > 2  # the pattern itself can't take this


def test_rollup(spark, docs, none, tmp_path):
    encode = tokens.encoder(tokens.ranks_of())
    size = lambda t: len(encode(t)) // 2 if t else 0
    least = {}
    for i, t, *_ in ROWS:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    want = defaultdict(lambda: [0, 0])
    for i, t, lang, source in ROWS:
        if i is None or i <= least[t or ""]:
            k = want[(source, lang, "v")]
            k[0] += 1
            k[1] += size("\n".join(dict.fromkeys((t or "").split("\n"))))
    assert counted(token_rollups.rolled_up(docs, "v")) == Counter((*k, *v) for k, v in want.items())
    assert token_rollups.rolled_up(none, "v").count() == 0
    store = token_rollups.Rollup(spark, str(tmp_path / "r"))
    assert store.totals().count() == 0
    one = spark.createDataFrame([("s", "en", "v", 1, 5), ("s", "en", "v", 1, 7)], token_rollups._DELTA)
    assert store.commit("b1", one) and not store.commit("b1", one)
    assert store.commit("b2", spark.createDataFrame([("s", "en", "v", -1, -5)], token_rollups._DELTA))
    assert counted(store.totals()) == counted(store.compact(str(tmp_path / "c")).totals()) == Counter({("s", "en", "v", 1, 7): 1})


def test_binomial_tail(spark):
    from math import comb

    cases = [(k, n) for n in (1, 5, 60, 400) for k in range(0, n + 1, max(1, n // 20))]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.07).alias("p"))
    for r in df.collect():
        want = sum(comb(r.n, i) * 0.07**i * 0.93 ** (r.n - i) for i in range(r.k + 1)) if r.k < r.n * 0.07 else 1
        assert r.p == pytest.approx(want, rel=1e-9)


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 14)] + [(1, None), (99, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_rules.verdicts(docs, labels).collect()}
    assert got[8].n_repeat_words == 300 and got[8].base_failed and not got[8].kept and got[4].n_words == 0 and got[12].kept
    assert quality_rules.verdicts(none, labels).count() == 0
    rows = [(i, (" ".join(f"w{i}x{j}" for j in range(60)) + (" ##" * 30 if i % 4 == 0 else "")), "en", "s") for i in range(2400)]
    many = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(2400)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality_rules.verdicts(many, marks).where("kept").collect()}
    assert kept == {i for i in range(2400) if i % 4}


def test_toxicity(spark, none):
    rng = np.random.default_rng(5)
    clean = ["".join(rng.choice(list("aeioubdfgklmnprst"), 5)) for _ in range(300)]
    bad = ["scoundrel", "blockhead", "nitwit"]
    rows = []
    for i in range(1500):
        words = list(rng.choice(clean, 40))
        if i % 3 == 0:
            words[5] = words[20] = bad[i % 9 // 3]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(2000, None), (2001, ""), (2002, " ".join(clean[:40] + ["scoundrell"] * 2))], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(5000, 1), (1, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[r[0]].held_out == (r in held) for r in rows)
    assert np.mean([got[r[0]].predicted == r[2] for r in held]) > 0.97
    assert got[2002].predicted == 1 and 0 <= got[2000].score == got[2001].score <= 1
    assert toxicity.score(none, labels).count() == 0
    assert toxicity.score(docs, labels.limit(0)).agg(F.max("score")).first()[0] < 1e-9


def test_licences(spark, none):
    apache = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the\nSoftware without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    rows = [(1, "Text.\nReleased under the MIT License.\nAll rights reserved."), (2, mit), (3, None), (4, ""), (5, "my own licence applies."), (6, "Licensed under the Apache License, Version 2.0.\n" + "x " * 50000), (None, "Licensed under CC BY-NC 4.0.")]
    got = {r.doc_id: r for r in license_rules.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].licences == ["MIT", "All-rights-reserved"] and got[2].licences == ["MIT"] and got[2].sentence_ids == ["mit-grant", "mit-notice", "as-is"]
    assert got[3].n_sentences == 0 and got[5].n_unknown == 1 and got[6].licences == ["Apache-2.0"] and got[None].licences == ["CC-BY-NC-4.0"]
    assert rows[0][1][got[1].spans[0]["from"] : got[1].spans[0]["to"]] == "Released under the MIT License."
    assert license_rules.scan(none).count() == 0 and apache


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF)
        kept = kept.cache()
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.collect()}
        if name == "toxicity":
            assert ids == {r.doc_id for r in toxicity.score(before, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 0").collect()}
        elif name == "simhash_near_dedup":
            rows = before.collect()
            assert ids == set(plain_components([plain_fingerprint(r.text) for r in rows], [r.doc_id for r in rows]))
        elif name == "benchmark_decontamination":
            assert ids == {r.doc_id for r in decontaminate.contamination(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("not contaminated").collect()}
        else:
            assert sum(len(r.text.split()) for r in kept.collect()) == before.transform(mixing.plan).agg(F.sum("taken")).first()[0]
    assert corpus_pipeline.run(spark, SF).count() == token_shards.training_order(kept).count()
