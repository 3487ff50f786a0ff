"""One row of every component stays, whatever its doc_id."""
from allelespark.llm import simhash

SCHEMA = "doc_id long, text string, lang string"
WORDS = lambda k: " ".join(f"{k}word{i}" for i in range(40))


def test_each_component_keeps_its_least_row(spark):
    rows = [
        (None, WORDS("alone"), "en"), (None, WORDS("other"), "en"), (None, WORDS("other"), "en"),  # without doc_id
        (7, WORDS("seven"), "en"), (7, WORDS("second"), "de"), (8, WORDS("second"), "de"),  # one doc_id, two texts
        (3, WORDS("seven"), "en"), (None, WORDS("seven"), "en"), (20, None, "x"), (20, None, "x"),
    ]
    want = {(None, WORDS("alone"), "en"), (None, WORDS("other"), "en"), (7, WORDS("second"), "de"), (3, WORDS("seven"), "en"), (20, None, "x")}
    for parts in (1, 4):
        got = [tuple(r) for r in simhash.survivors(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()]
        assert len(got) == len(want) and set(got) == want
    assert simhash.survivors(spark.createDataFrame([], SCHEMA)).count() == 0
