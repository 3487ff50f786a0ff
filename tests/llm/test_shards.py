"""Shards written straight from the shuffle, over many full shards, and what is read back."""
import numpy as np

from allelespark.llm import queries, token_shards


def test_written_shards_hold_training_order(spark, tmp_path):
    words = [f"w{i}" for i in range(997)]
    docs = spark.createDataFrame(
        [(i if i % 50 else None, " ".join(words[(i * j) % 997] for j in range(1, 20 + i % 300))) for i in range(1, 1500)] + [(-5, "!!!"), (7, None), (8, "")], "doc_id long, text string"
    ).repartition(5)
    path = str(tmp_path / "s")
    got = sorted(token_shards.written(docs, length=16, per_shard=512, path=path).collect())
    want = sorted(token_shards.training_order(docs, length=16, per_shard=512).collect())
    n = len(want)
    assert n > 6 * 512 and [r.slot for r in got] == list(range(n))
    assert sum(r.doc_id is None for r in got) == sum(r.doc_id is None for r in want) > 0
    key = lambda r: (str(r.doc_id), r.sequence, bytes(r.tokens), r.n_tokens)
    assert sorted(map(key, got)) == sorted(map(key, want))
    for r in got:  # the file itself, at the place that the row names
        (file,) = (tmp_path / "s" / f"shard={r.shard}").glob("part-*")
        with file.open("rb") as f:
            f.seek(r.position)
            assert f.read(33) == bytes(r.tokens) + bytes(32 - len(r.tokens)) + b"\n"
    assert token_shards.written(docs.limit(0)).count() == 0
    # the order of slots inside a shard is the permutation's: sequences of a document stay at the slots of their numbers
    back = token_shards.numbers(np.array([r.slot for r in got]), n)
    by_number = [got[i] for i in np.argsort(back)]
    assert all(b.doc_id == a.doc_id and b.sequence == a.sequence + 1 for a, b in zip(by_number, by_number[1:]) if b.sequence)


def test_query_and_pipeline_write_shards(spark, monkeypatch):
    import corpus_pipeline

    calls, real = [], token_shards.write_shards
    monkeypatch.setattr(token_shards, "write_shards", lambda *a, **k: (calls.append(a[1]), real(*a, **k)))
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for rows in (queries.op1_token_output(spark, sf), corpus_pipeline.STAGES[-1][1](spark, docs, sf)):
        assert rows.count() == token_shards.training_order(docs).count()
    assert len(calls) == 2


def test_shards_are_written_in_turns_whose_shuffles_go(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"w{i} " * (20 + i % 90)) for i in range(1200)], "doc_id long, text string").repartition(4)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {x for x in blocks.getAllFiles().mkString("\n").split("\n") if x.endswith(".data")}
    rows = token_shards.training_order(docs, length=16, per_shard=64)
    rows.count()
    before, path = held(), str(tmp_path / "t")
    token_shards.write_shards(rows, path, 16)
    assert held() - before == set()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    got = token_shards.read_shards(spark, path, length=16, per_shard=64)
    assert sorted(r.slot for r in got.collect()) == list(range(rows.count()))
