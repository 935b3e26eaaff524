"""The registered queries of this subpackage, and the equal SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (decontaminate, fingerprints, jaccard, language, lexical, licenses,
                          merkle, mixing, quality_zstd, substrings, token_files, toxicity,
                          warc)
from tidemark.llm.frames import crc_of_id, read
from tidemark.workspace import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document, its edited text and the next document."""
    return fingerprints.edited_against_next(read(spark, sf_dir, "documents"))


@_query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets reach a Jaccard similarity of 0.75."""
    return jaccard.link(read(spark, sf_dir, "documents"))


@_query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside passages of 13 benchmark words, and whether they are many."""
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL["op8_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0))),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
o AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, s)),
h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM o) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@_query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mixture of the sources by weight takes from each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mixing.plan(docs).select("doc_id", "_mix.*")
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken")))


SQL["op3_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)
           AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
f AS (
  SELECT *, rest * w > 3 * source_size * rest_w AS stops
  FROM (SELECT *, source_size * (6 // w) AS by_weight,
      CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER p, 0) AS BIGINT) AS rest,
      CAST(sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS BIGINT) AS rest_w
    FROM s WINDOW p AS (ORDER BY source_size * (6 // w), source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
v AS (SELECT rest AS level, rest_w AS level_w FROM f WHERE NOT stops
      ORDER BY by_weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(level * w AS DOUBLE) / level_w END AS target FROM f LEFT JOIN v ON TRUE),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|mix-1'), 1, 13) AS BIGINT)
      / 4503599627370496.0 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT)
    AS taken
FROM r
""".replace("\\\\", "\\")


def _scored(scores: DataFrame, held_out) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document, by a compression classifier."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_zstd.fit(docs, read(spark, sf_dir, "labels"))
    return _scored(quality_zstd.score(docs, model), crc_of_id(F.col("doc_id")) % 5 == 0)


@_query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, by the nearest centroid."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs.select("doc_id", "text"), language.fit(docs), "found")
    return found.select("doc_id", (crc_of_id(F.col("doc_id")) % 3 == 1).alias("held_out"),
                        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
                        F.col("found.rejected").alias("rejected"))


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, by hashed logistic regression."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return _scored(toxicity.score(docs, model), crc_of_id(F.col("doc_id")) % 4 == 2)


@_query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids, written to Huffman-coded files and read back."""
    root = new_path(spark, "token-files")
    manifest = token_files.write(read(spark, sf_dir, "documents"), root,
                                 public_tokenizers.path("word_bpe_49k.json"), end=1)
    return token_files.read(manifest, root, with_ids=False)


@_query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back."""
    root = new_path(spark, "warc")
    manifest = warc.write(read(spark, sf_dir, "pages"), root)
    return warc.read(manifest, root).drop("url")


SQL["op6_warc"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
      (CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31)
      AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to
FROM p JOIN g USING (h)
"""


@_query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of each document, by known sentences and ordered rules."""
    return licenses.scan(read(spark, sf_dir, "documents"))


SQL["op4_licenses"] = licenses.sql()


@_query
def op4_licenses_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of each document, also where their sentences are wrapped over lines."""
    return licenses.scan_whole(read(spark, sf_dir, "documents"))


@_query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents; one in seven is checked with a tampered n_chars."""
    tampered = F.when(crc_of_id(F.col("doc_id")) % 7 == 0, F.col("n_chars") + 1).otherwise(
        F.col("n_chars"))
    manifest = merkle.build(read(spark, sf_dir, "documents"), {"n_chars": tampered})
    return merkle.prove(manifest).drop("tree")


SQL["op12_merkle"] = r"""
WITH RECURSIVE
d AS (
  SELECT doc_id, source, lang, n_chars, text,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents),
e AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS m
  FROM d),
l AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(m AS VARCHAR)) || ':' || m, '-') || tail) AS seen
  FROM e),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (
  SELECT lang, 0 AS lev, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n, leaf AS h FROM p
  UNION ALL
  SELECT lang, any_value(lev) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos))
  FROM t WHERE n > 1 GROUP BY lang, pos // 2),
s AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lev, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n, subroot AS h FROM s
  UNION ALL
  SELECT any_value(lev) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos))
  FROM u WHERE n > 1 GROUP BY pos // 2),
f AS (
  SELECT doc_id, lang, leaf, 0 AS lev, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n,
    seen AS folded, '' AS proof
  FROM p
  UNION ALL
  SELECT f.doc_id, f.lang, f.leaf, f.lev + 1, f.pos // 2, (f.n + 1) // 2,
    sha256(CASE WHEN t.h IS NULL THEN folded WHEN f.pos % 2 = 1 THEN t.h || folded
      ELSE folded || t.h END), proof || coalesce(t.h, '')
  FROM f LEFT JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.lev = t.lev
    AND t.pos = xor(f.pos, 1)
  WHERE f.n > 1),
g AS (
  SELECT doc_id, leaf, subroot, 0 AS lev, CAST(s.pos AS BIGINT) AS pos, CAST(s.n AS BIGINT) AS n,
    folded, proof
  FROM f JOIN s ON f.lang IS NOT DISTINCT FROM s.lang WHERE f.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, g.lev + 1, g.pos // 2, (g.n + 1) // 2,
    sha256(CASE WHEN u.h IS NULL THEN folded WHEN g.pos % 2 = 1 THEN u.h || folded
      ELSE folded || u.h END), proof || coalesce(u.h, '')
  FROM g LEFT JOIN u ON g.lev = u.lev AND u.pos = xor(g.pos, 1) WHERE g.n > 1)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = r.h AS verified
FROM g, (SELECT h FROM u WHERE n = 1) r WHERE g.n = 1
"""


@_query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item, by bounds from max-sketches."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL["op13_lexical"] = r"""
WITH w AS (
  SELECT doc_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS r FROM documents)),
d AS (SELECT r, any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY r),
c AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d),
f AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM w GROUP BY r, term),
t AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM f, c GROUP BY term, nn),
q AS (
  SELECT DISTINCT item_id, q, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT item_id, text, row_number() OVER () AS q FROM benchmark)),
s AS (
  SELECT q.q, any_value(item_id) AS item_id, f.r, any_value(d.doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN t USING (term) JOIN d ON d.r = f.r, c GROUP BY q.q, f.r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank
      FROM s WHERE score > 0)
WHERE rank <= 10
"""


@_query
def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the sequences of 35 words that start more than once."""
    found = substrings.remove(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op11_substrings"] = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
o AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
g AS (SELECT s FROM o GROUP BY s HAVING count(*) > 1),
c AS (
  SELECT r, list(DISTINCT p) AS gone
  FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM o JOIN g USING (s)) GROUP BY r),
k AS (
  SELECT d.r, doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed
  FROM d LEFT JOIN c USING (r)),
t AS (
  SELECT x.r, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
  ANTI JOIN (SELECT r, unnest(gone) AS p FROM c) y ON x.r = y.r AND x.p = y.p
  GROUP BY x.r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM k LEFT JOIN t USING (r)
"""
