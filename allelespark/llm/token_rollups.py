"""Token counts kept by deltas: additive totals by source, language and tokenizer version.

A change is a signed row: +1 document and its tokens for an insert, -1 and minus its tokens for a delete, and a pair of both, or
just the difference, for a revised count.  A batch of changes is summed by key and committed under its id; totals are the sum
of committed batches.  Committing an id again changes nothing, so a batch can be replayed after a failure at any point:
its rows are written to a folder of their own first, and count only once a commit file names that folder.  A commit folder without
such a row, as a killed job leaves it, is no commit and is written anew.  A batch has one writer at a time.

Scale: counts are taken where the texts are read; partial sums go through one small shuffle, so a source with a third of all rows is summed
before it moves.  ``compact`` folds many batches into one.  All files are written by Spark in the shared folder.

Defined cases: null and empty texts have 0 tokens; null source or language is a key of its own; repeated rows are counted each;
an empty batch commits and adds nothing; other columns are ignored.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespark.llm.common import per_row, shared_folder, staged
from allelespark.llm.tokens import VOCABULARY, encoder, id_type, ranks_of

KEYS = ("source", "lang", "tokenizer")
_COMMIT = "attempt string, folded array<string>"
_DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


class Rollup:
    """Totals in a folder: ``data/<attempt>`` holds deltas, ``commits/<batch>`` names the attempt that counts and the batches in it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _commits(self) -> DataFrame:
        """(batch, attempt, folded) of the marks that hold a row."""
        try:
            rows = self.spark.read.schema(_COMMIT + ", batch string").json(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMIT + ", batch string")
        return rows.where("attempt is not null")

    def _committed(self, batch: str) -> bool:
        """Whether ``batch`` has a mark of its own or is folded into a batch that has one."""
        return not self._commits().where((F.col("batch") == batch) | F.coalesce(F.array_contains("folded", batch), F.lit(False))).isEmpty()

    def commit(self, batch: str, changes: DataFrame, folded: DataFrame | None = None) -> bool:
        """Add ``changes`` (keys, documents, tokens; signed) unless ``batch`` is committed; whether it was added.

        ``folded`` (batch) are ids that the changes hold already, which count as committed from then on.
        """
        if self._committed(batch):
            return False
        attempt = f"{batch}-{uuid.uuid4().hex}"
        delta = changes.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        delta.where("documents <> 0 or tokens <> 0").write.parquet(f"{self.path}/data/attempt={attempt}")
        mark = self.spark.range(1).select(F.lit(attempt).alias("attempt"))
        if folded is not None:
            mark = mark.crossJoin(folded.agg(F.array_sort(F.collect_set("batch")).alias("folded")))  # one row
        mark.coalesce(1).write.mode("overwrite").json(f"{self.path}/commits/batch={batch}")  # what stands there holds no row
        if not self._committed(batch):
            raise RuntimeError(f"batch {batch} has no mark after its commit")
        return True

    def deltas(self) -> DataFrame:
        """Rows of all committed batches, with their batch."""
        try:
            data = self.spark.read.schema(_DELTA + ", attempt string").parquet(f"{self.path}/data")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _DELTA + ", batch string")
        return data.join(self._commits().select("attempt", "batch"), "attempt").drop("attempt")

    def totals(self) -> DataFrame:
        rows = self.deltas().groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return rows.where("documents <> 0 or tokens <> 0")

    def compact(self, path: str) -> Rollup:
        """A new rollup whose first batch holds all of this one's totals; its commit lists the batches folded in, also earlier ones."""
        new = Rollup(self.spark, path)
        seen = staged(self._commits(), "rollup-commits")  # totals and list are of the same commits
        rows = self.deltas().join(seen.select("batch"), "batch", "left_semi")
        ids = seen.select("batch").union(seen.select(F.explode("folded").alias("batch")))
        new.commit(f"base-{uuid.uuid4().hex}", rows.select(*KEYS, "documents", "tokens"), ids)
        return new


def counted(docs: DataFrame, vocabulary: str = VOCABULARY, extra: Sequence[str] = ()) -> DataFrame:
    """Per document row: doc_id, source, lang, ``extra`` columns, tokens, and tokens of the text without repeated lines."""
    ranks = ranks_of(vocabulary)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    width = int(id_type(ranks)[-1])

    def count(encode, *row):
        text = row[-1] or ""
        n = revised = len(encode(text)) // width if text else 0
        lines = text.split("\n")
        once = list(dict.fromkeys(lines))
        if len(once) < len(lines):
            short = "\n".join(once)
            revised = len(encode(short)) // width if short else 0
        return *row[:-1], n, revised

    kinds = dict(docs.dtypes) | {"_sha": "string"}
    names = ["doc_id", "source", "lang", *extra]
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", tokens long, revised long"
    return per_row(docs, [*names, "text"], schema, count, lambda: encoder(sent.value))


def history(docs: DataFrame, version: str, vocabulary: str = VOCABULARY) -> dict[str, DataFrame]:
    """Three batches of changes that follow from the documents: every one is inserted; where lines repeat, the count is revised to
    that of the text without the repetitions; of equal texts all but the smallest doc_id are deleted."""
    rows = staged(counted(docs.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)), vocabulary, ["_sha"]), "rollup-counts")
    rows = rows.withColumn("tokenizer", F.lit(version))
    first = rows.groupBy("_sha").agg(F.min("doc_id").alias("_first"))
    gone = rows.join(first, "_sha").where("doc_id > _first")
    change = lambda df, sign, tokens: df.select(*KEYS, F.lit(sign).cast("long").alias("documents"), tokens.cast("long").alias("tokens"))
    return {
        "1-insert": change(rows, 1, F.col("tokens")),
        "2-revise": change(rows.where("revised <> tokens"), 0, F.col("revised") - F.col("tokens")),
        "3-delete": change(gone, -1, -F.col("revised")),
    }


def rolled_up(docs: DataFrame, version: str = "byte_bpe_50k", vocabulary: str = VOCABULARY) -> DataFrame:
    """Totals after the batches of ``history``, each of them sent twice as after a lost answer."""
    spark = docs.sparkSession
    store = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    for batch, changes in history(docs, version, vocabulary).items():
        if not store.commit(batch, changes) or store.commit(batch, changes):
            raise RuntimeError(f"batch {batch} was not added exactly once")
    return store.totals()
