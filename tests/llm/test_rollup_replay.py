"""Replays of batches after a commit that was cut off, and on a compacted store."""
from collections import Counter

from allelespark.llm import token_rollups


def test_replays(spark, tmp_path):
    rows = lambda n: spark.createDataFrame([("s", "en", "v", 1, n)], token_rollups._DELTA)
    totals = lambda store: Counter(tuple(r) for r in store.totals().collect())
    store = token_rollups.Rollup(spark, str(tmp_path / "r"))
    (tmp_path / "r" / "commits" / "batch=b1" / "_temporary").mkdir(parents=True)  # what a killed commit leaves
    assert store.commit("b1", rows(5)) and not store.commit("b1", rows(5))
    (tmp_path / "r" / "commits" / "batch=b2").mkdir()
    (tmp_path / "r" / "commits" / "batch=b2" / "part-0.json").touch()
    assert store.commit("b2", rows(7)) and not store.commit("b2", rows(7))
    assert totals(store) == Counter({("s", "en", "v", 2, 12): 1})
    new = store.compact(str(tmp_path / "c"))
    assert not new.commit("b1", rows(5)) and not new.commit("b2", rows(7))
    assert new.commit("b3", rows(1))
    again = new.compact(str(tmp_path / "d"))
    assert not any(again.commit(b, rows(9)) for b in ("b1", "b2", "b3"))
    assert totals(new) == totals(again) == Counter({("s", "en", "v", 3, 13): 1})
    empty = token_rollups.Rollup(spark, str(tmp_path / "e")).compact(str(tmp_path / "f"))
    assert totals(empty) == Counter() and empty.commit("b1", rows(5))
