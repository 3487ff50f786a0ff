"""Registered queries of this subpackage and the SQL that some are compared with."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespark.llm import (
    decontaminate, license_rules, merkle, mixing, quality_rules, ranked_search, repeat_words, sharding, simhash, substring_bytes, token_rollups,
    token_shards, toxicity,
)
from allelespark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@_query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query()
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


_MIX = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][(k - 1) % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS top FROM s),
f AS (SELECT *, sum(top) OVER o - top AS spent, sum(w) OVER o - w AS settled, (SELECT 1.5::DOUBLE * sum(source_size) FROM w) AS total,
             (SELECT sum(w) FROM w) AS weight FROM w WINDOW o AS (ORDER BY top / w, k ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min((total - spent) / (weight - settled), top / w) AS level FROM f WHERE (total - spent) / (weight - settled) * w <= top),
t AS (SELECT source, source_size, least(level * w, top) AS target FROM f, l),
p AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(whole * size + least(greatest(floor(target) - whole * source_size - before, 0), size) AS BIGINT) AS taken FROM e
"""


@_query(_MIX)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEAKS = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT doc_id, item, i, n FROM o JOIN p USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM h) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)
"""


@_query(_LEAKS)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query()
def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.written(table(spark, sf_dir, "documents"))


@_query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollups.rolled_up(table(spark, sf_dir, "documents"))


_QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (SELECT r, i, w[i:i + 2] AS win FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
a AS (SELECT r, count(DISTINCT spot) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS spot FROM
        (SELECT *, count(*) OVER (PARTITION BY r, win) AS times FROM g) WHERE times > 1) GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (SELECT r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
             coalesce(a.n, 0) AS n_repeat_words, length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper
      FROM w LEFT JOIN a USING (r) LEFT JOIN l USING (r)),
s AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             CAST(least(50, greatest(coalesce(50 * n_symbols // nullif(n_words, 0), 0), coalesce(50 * n_repeat_words // nullif(n_words, 0), 0),
                                     coalesce(50 * n_upper // nullif(word_chars, 0), 0))) AS INTEGER) AS score FROM f),
q AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT lang, score, quality FROM s JOIN q USING (doc_id) WHERE NOT base_failed),
n AS (SELECT lang, count(*) FILTER (quality > 0) AS good, count(*) FILTER (quality <= 0) AS bad FROM h GROUP BY lang HAVING count(*) FILTER (quality > 0) > 0),
c AS (SELECT n.lang, j, good, bad, (SELECT count(*) FROM h WHERE h.lang IS NOT DISTINCT FROM n.lang AND quality > 0 AND score >= j) AS k,
             (SELECT count(*) FROM h WHERE h.lang IS NOT DISTINCT FROM n.lang AND quality <= 0 AND score >= j) AS caught
      FROM n, (SELECT unnest(range(1, 51)) AS j)),
p AS (SELECT *, CASE WHEN k < good * 0.01::DOUBLE THEN list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1)
             + i * ln(0.01::DOUBLE) + (good - i) * ln(0.99::DOUBLE)))) ELSE 1 END AS p FROM c),
v AS (SELECT *, max(CASE WHEN p > 0.05::DOUBLE / (SELECT count(*) FROM n) THEN 1 ELSE 0 END) OVER (PARTITION BY lang ORDER BY j DESC ROWS UNBOUNDED PRECEDING) AS stopped FROM p),
b AS (SELECT lang, arg_max(j, [caught / greatest(bad, 1) - k / good, j]) AS cutoff FROM v WHERE stopped = 0 GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(score < cutoff, true) AS kept, score,
       CAST(cutoff AS INTEGER) AS cutoff
FROM s LEFT JOIN b ON s.lang IS NOT DISTINCT FROM b.lang
"""


@_query(_QUALITY)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(table(spark, sf_dir, "documents"))


_BYTES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS doc_id, i, md5(substr(x, 2 * i + 1, 100)) AS win
      FROM (SELECT *, unnest(range(0, length(x) // 2 - 49)) AS i FROM d WHERE length(x) >= 100)),
g AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY win) AS first FROM w) WHERE doc_id > first),
s AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 50, true) AS fresh FROM g),
p AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM s) GROUP BY r, run),
k AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM p),
j AS (SELECT k.r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM k JOIN d USING (r) GROUP BY k.r)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN tail IS NULL THEN x ELSE kept || substr(x, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN j USING (r)
"""


@_query(_BYTES)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_bytes.dedup(table(spark, sf_dir, "documents"))


_WORDS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS doc, i, md5(array_to_string(w[i:i + 19], ' ')) AS win
      FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) > 19)),
m AS (SELECT r, i FROM (SELECT *, min({'d': doc, 'i': i}) OVER (PARTITION BY win) AS first FROM g) WHERE {'d': doc, 'i': i} > first),
x AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS spot FROM m),
c AS (SELECT r, count(*) AS n, list(spot) AS spots FROM x GROUP BY r),
k AS (SELECT r, string_agg(word, ' ' ORDER BY spot) AS rest FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS spot FROM d)
      ANTI JOIN x USING (r, spot) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""


@_query(_WORDS)
def op8_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_words.dedup(table(spark, sf_dir, "documents"))


def _leaf_sql(n_chars: str) -> str:
    values = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")]
    return f"sha256({' || '.join(values)})"


_MERKLE_IDS = "(SELECT doc_id FROM crc WHERE x % 7 = 0)"
# DuckDB has no CRC-32: it is folded over the digits, bit by bit
_MERKLE = f"""
WITH RECURSIVE c(doc_id, s, x) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, s[2:], list_reduce(list_prepend(xor(x, ascii(s)::BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                   lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END) FROM c WHERE s <> ''),
crc AS (SELECT doc_id, xor(x, 4294967295::BIGINT) AS x FROM c WHERE s = ''),
l AS (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
             CASE WHEN doc_id IN {_MERKLE_IDS} THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS other FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l),
t(lang, lev, i, n, h) AS (
  SELECT lang, 0, i, n, leaf FROM p
  UNION ALL SELECT lang, lev + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY lang, lev, i // 2, n),
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(lev, i, n, h) AS (
  SELECT 0, i, n, subroot FROM s
  UNION ALL SELECT lev + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lev, i // 2, n),
f(r, lang, lev, i, n, h, sibs) AS (
  SELECT r, lang, 0, i, n, other, '' FROM p
  UNION ALL SELECT r, f.lang, f.lev + 1, f.i // 2, (f.n + 1) // 2,
                   sha256(CASE WHEN t.h IS NULL THEN f.h WHEN f.i % 2 = 1 THEN t.h || f.h ELSE f.h || t.h END), sibs || coalesce(t.h, '')
            FROM f LEFT JOIN t ON t.lang IS NOT DISTINCT FROM f.lang AND t.lev = f.lev AND t.i = xor(f.i, 1) WHERE f.n > 1),
g(r, lev, i, n, h, sibs) AS (
  SELECT r, 0, s.i, s.n, f.h, sibs FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL SELECT r, g.lev + 1, g.i // 2, (g.n + 1) // 2,
                   sha256(CASE WHEN u.h IS NULL THEN g.h WHEN g.i % 2 = 1 THEN u.h || g.h ELSE g.h || u.h END), sibs || coalesce(u.h, '')
            FROM g LEFT JOIN u ON u.lev = g.lev AND u.i = xor(g.i, 1) WHERE g.n > 1)
SELECT doc_id, leaf, subroot, top.h AS root, sha256(sibs) AS proof_sha256, g.h AS folded_root, g.h = top.h AS verified
FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN g USING (r), (SELECT h FROM u WHERE n = 1) AS top WHERE g.n = 1
"""


@_query(_MERKLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    return merkle.manifest(table(spark, sf_dir, "documents"), changed={"n_chars": F.col("n_chars") + tampered.cast("long")})


@_query()
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.written(table(spark, sf_dir, "documents")).select("shard", "slot", "record.doc_id", "record.text")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return rows.select("doc_id", sharding.size().alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


_TERMS = rf"regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_RANKED = f"""
WITH q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL),
d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
a AS (SELECT count(*)::BIGINT AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) SEMI JOIN q USING (term) GROUP BY r, term),
g AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, a GROUP BY term, docs),
m AS (SELECT r, doc_id, 10 + (90 * len(w) * docs) // terms AS m FROM d, a WHERE len(w) > 0),
s AS (SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN g USING (term) JOIN m USING (r) GROUP BY item_id, r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""


@_query(_RANKED)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
