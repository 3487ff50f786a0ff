"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to words; every window of ten words (or the whole item, if it has fewer) becomes a pattern of
one automaton.  Each document is normalised alike and scanned once, whatever the number of patterns; the words of a hit are
mapped to their offsets in the original text.

Scale: documents are only scanned, nothing of them is shuffled, so no key can be hot.  The automaton grows with the
benchmark, a stated query set.  Its size is measured first and items are dealt into blocks of at most ``block_chars``
characters; each block is one automaton and one broadcast, so what is broadcast has a fixed bound at any number of items.

Defined cases: a null or wordless text has no words and no hits; an item without words or with null text never occurs; a
null ``item_id`` counts as the id ``''``; rows of one item_id are one item; repeated document rows each give a row; empty
tables give no rows or no hits; other columns are ignored.
"""
from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelespark.llm.common import per_row

#: What ends a word: ASCII but digits and letters.  Upper-case ASCII becomes lower case, other bytes stay.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WINDOW = 10
BLOCK_CHARS = 8_000_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


def automaton(items: list[tuple[str, str | None]], window: int = WINDOW) -> ahocorasick.Automaton:
    """Patterns are word windows between blanks; each carries its number of words and the items that have it."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(min(len(words), 1), len(words) - window + 1)):
            part = words[i : i + window]
            found.setdefault(" " + b" ".join(part).decode("latin-1") + " ", (len(part), set()))[1].add(item)
    auto = ahocorasick.Automaton()
    for pattern, (n, ids) in found.items():
        auto.add_word(pattern, (n, tuple(sorted(ids))))
    auto.make_automaton()
    return auto


def blocks_of(items: DataFrame, block_chars: int):
    """Lists of (id, text), each of at most about ``block_chars`` characters, one at a time on the driver."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").alias("body"))
    rows = rows.where(F.col("body").isNotNull())
    n = 1 + (rows.agg(F.sum(F.length("body"))).first()[0] or 0) // block_chars
    for k in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k).collect()]


def _hits(auto, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
    """Which words lie inside an occurrence, and whose windows occur."""
    inside = np.zeros(len(words), bool)
    ids: set[str] = set()
    if not words or not len(auto):
        return inside, ids
    ends = None
    for end, (n, items) in auto.iter(" " + b" ".join(words).decode("latin-1") + " "):
        if ends is None:  # only texts with a hit need positions
            ends = np.cumsum([len(w) + 1 for w in words])
        last = int(np.searchsorted(ends, end))
        inside[last - n + 1 : last + 1] = True
        ids.update(items)
    return inside, ids


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row: doc_id, n_words, hits (word runs [first, last] with char offsets), items (ids)."""
    schema = "doc_id long, n_words long, hits array<struct<first:long,last:long,from:long,to:long>>, items array<string>"
    sc = docs.sparkSession.sparkContext

    def look(autos, doc_id, text):
        words = words_of(text)
        inside, ids = np.zeros(len(words), bool), set()
        for auto in autos:
            got, more = _hits(auto.value, words)
            inside |= got
            ids |= more
        hits = []
        if ids:
            spans = [m.span() for m in ORIGINAL_WORD.finditer(text)]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0]))))
            hits = [(int(a), int(b) - 1, spans[a][0], spans[b - 1][1]) for a, b in zip(edge[::2], edge[1::2])]
        return doc_id, len(words), [dict(zip(("first", "last", "from", "to"), h)) for h in hits], sorted(ids)

    shared = [sc.broadcast(automaton(block, window)) for block in blocks_of(items, block_chars)]
    return per_row(docs, ["doc_id", "text"], schema, look, lambda: shared)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The digest of ``scan``: words hit, items found and their hash."""
    found = scan(docs, items, window, block_chars)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["last"] - h["first"] + 1)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs`` without any benchmark window, with all their columns; no join, the flag is taken in the scan."""
    shared = [docs.sparkSession.sparkContext.broadcast(automaton(b, window)) for b in blocks_of(items, block_chars)]

    def keep(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            free = [all(not _hits(a.value, w)[1] for a in shared) for w in map(words_of, texts)]
            yield batch.filter(pa.array(free, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

