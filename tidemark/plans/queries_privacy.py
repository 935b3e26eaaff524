"""Queries for redaction, its verifier, residue gates and postal findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators import privacy as P
from tidemark.plans.registry import query
from tidemark.plans.standins import heavy, table

MAIL = K.MAIL.replace("'", "''")
RESIDUE = K.MAIL_RESIDUE.replace("'", "''")
# one address cut at a marker, made from the first address of a text
SQL_SEVERED = r"""regexp_matches(text, '(^|\n)[ \t]*[A-Za-z0-9][A-Za-z0-9._%+\-]{4,63}@[A-Za-z0-9.\-]{0,24}\.\.\.[ \t]*$')"""


@query("addresses_per_document", "V1", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{MAIL}')) AS INT) AS addresses FROM documents
WHERE contains(text, '@') AND len(regexp_extract_all(text, '{MAIL}')) > 0""")
def _(spark, sf):
    rows = heavy(spark, sf, "documents").select("doc_id", F.size(P.addresses(F.col("text")))
                                                .alias("addresses"))
    return rows.filter("addresses > 0")


@query("redacted_documents", "V1 V3", f"""
SELECT doc_id, md5(regexp_replace(text, '{MAIL}', '{K.REDACTION}', 'g')) AS text_md5,
  CAST(len(regexp_extract_all(text, '{MAIL}')) AS INT) AS redactions FROM documents""")
def redacted_documents(spark, sf):
    out = P.scrub(heavy(spark, sf, "documents").select("doc_id", "text"), ["text"])
    return out.select("doc_id", F.md5("text").alias("text_md5"), "redactions")


@query("redacted_turns", "V1", f"""
SELECT conv_id, turn, md5(regexp_replace(text, '{MAIL}', '{K.REDACTION}', 'g')) AS text_md5
FROM conversations""")
def _(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(P.redact(F.col("text"))).alias("text_md5"))


@query("severed_addresses", "V2", f"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '{MAIL}')) AS hit FROM pages
  WHERE contains(html, '@')),
s AS (SELECT page_id, split_part(hit, '@', 1) AS local, split_part(hit, '@', 2) AS domain FROM a)
SELECT page_id, length(local) >= 5 OR (length(local) >= 4 AND regexp_matches(local, '[._%+\\-]'))
  AS found FROM s WHERE regexp_matches(local, '^[A-Za-z0-9][A-Za-z0-9._%+\\-]*$')
  AND regexp_matches(local, '[A-Za-z]')""")
def _(spark, sf):
    """Every address of every page, cut at its domain."""
    return _severed(heavy(spark, sf, "pages").select(
        "page_id", F.explode(P.addresses(F.col("html"))).alias("hit")))


def _severed(rows):
    hit, keys = F.col("hit"), [c for c in rows.columns if c != "hit"]
    local = F.split(hit, "@", 2)[0]
    cut = F.concat(F.lit("Contact:\n  "), local, F.lit("@"), F.substring(
        F.split(hit, "@", 2)[1], 1, 2), F.lit("..."))
    rows = rows.filter(hit.isNotNull()).select(
        *keys, local.alias("local"), P.severed_address(cut).isNotNull().alias("found"))
    return rows.filter(F.col("local").rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+\-]*\z")
                       & F.col("local").rlike("[A-Za-z]")).select(*keys, "found")


@query("all_severed_addresses", "V2", f"""
WITH a AS (SELECT doc_id, unnest(regexp_extract_all(text, '{MAIL}')) AS hit FROM documents
  WHERE contains(text, '@')),
s AS (SELECT doc_id, split_part(hit, '@', 1) AS local, split_part(hit, '@', 2) AS domain FROM a)
SELECT doc_id, length(local) >= 5 OR (length(local) >= 4 AND regexp_matches(local, '[._%+\\-]'))
  AS found FROM s WHERE regexp_matches(local, '^[A-Za-z0-9][A-Za-z0-9._%+\\-]*$')
  AND regexp_matches(local, '[A-Za-z]')""")
def _(spark, sf):
    """Every address of a text, one row each."""
    return _severed(heavy(spark, sf, "documents").select(
        "doc_id", F.explode(P.addresses(F.col("text"))).alias("hit")))


@query("verifier_residue", "V3", f"""
WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '{RESIDUE}')) AS hit FROM documents
  WHERE contains(text, '@'))
SELECT doc_id, count(*) AS residue FROM r WHERE length(substr(hit, strpos(hit, '@') + 1)) <= 40
  AND len(regexp_extract_all(substr(hit, strpos(hit, '@') + 1), '{K.PY_SPACE_CLASS}')) <= 1
GROUP BY 1""")
def _(spark, sf):
    rows = heavy(spark, sf, "documents").select("doc_id", F.size(P.residue(F.col("text")))
                                                .cast("bigint").alias("residue"))
    return rows.filter("residue > 0")


@query("refused_rows", "V3", """
SELECT source, count(*) AS rows, count(*) FILTER (WHERE doc_id % 5 = 0) AS refused FROM documents GROUP BY 1""")
def _(spark, sf):
    """Per source: every fifth row holds what only the verifier takes for an address, and is refused."""
    odd = F.when(F.col("doc_id") % 5 == 0, " ask some_one@ex\u00e4mple.org today").otherwise("")
    rows = heavy(spark, sf, "documents").select("source", F.concat(
        F.coalesce("text", F.lit("")), odd).alias("text"))
    return P.scrub(rows, ["text"]).groupBy("source").agg(
        F.count("*").alias("rows"), F.count_if("refused").alias("refused"))


@query("residue_gate", "V4", f"""
WITH r AS (SELECT source, unnest(regexp_extract_all(text, '{RESIDUE}')) AS hit FROM documents)
SELECT source, count(*) AS residue FROM r WHERE length(substr(hit, strpos(hit, '@') + 1)) <= 40
  AND len(regexp_extract_all(substr(hit, strpos(hit, '@') + 1), '{K.PY_SPACE_CLASS}')) <= 1
GROUP BY 1""")
def _(spark, sf):
    return P.residue_gate(heavy(spark, sf, "documents"), "source", "text")


@query("redaction_totals", "A21 K11", f"""
WITH r AS (SELECT source, lower(unnest(regexp_extract_all(text, '{MAIL}'))) AS hit FROM documents)
SELECT source, substr(hit, strpos(hit, '@') + 1) AS domain, count(*) AS occurrences,
  count(DISTINCT hit) AS unique_addresses FROM r GROUP BY 1, 2""")
def _(spark, sf):
    return P.redaction_totals(heavy(spark, sf, "documents"), "source", "text")


@query("redaction_log", "K11", """
SELECT 'src' || c_nationkey AS file, CASE WHEN c_nationkey % 2 = 0 THEN '2026-02-01'
  ELSE '2026-01-01' END AS at_run, count(*) AS occurrences FROM customer GROUP BY 1, 2""")
def _(spark, sf):
    k = F.col("c_nationkey")
    counts = table(spark, sf, "customer").groupBy(k).agg(F.count("*").alias("occurrences"))
    old = counts.select(F.concat(F.lit("src"), k.cast("string")).alias("file"),
                        F.lit("2026-01-01").alias("at_run"), "occurrences")
    new = old.filter(k % 2 == 0).withColumn("at_run", F.lit("2026-02-01"))
    return P.merge_redaction_log(old.withColumn("occurrences", F.when(
        F.substring("file", 4, 9).cast("int") % 2 == 0, 0).otherwise(F.col("occurrences"))),
        new, "file", "at_run")


@query("postal_findings", "V5 S16")
def _(spark, sf):
    """Findings in texts that each end in one planted line (look-behind: no SQL)."""
    planted = F.element_at(F.array(*[F.lit(x) for x in (
        "call Mobile: 0412 345 678 now", "at -37.8136, 144.9631 by night",
        "12 Long Meadow Road", "Brighton VIC 3186", "Hauptstrasse 12",
        "https://x.example/?at=-37.8136,144.9631", "University of X, 12 Long Road")]),
        (F.col("doc_id") % 7 + 1).cast("int"))
    rows = heavy(spark, sf, "documents").select(
        "doc_id", F.concat("text", F.lit("\n"), planted).alias("text"))
    return P.postal_findings(rows, "doc_id", "text")


@query("postal_label_totals", "A22 V5")
def _(spark, sf):
    rows = heavy(spark, sf, "documents").select(
        F.col("doc_id").alias("file"), F.concat("text", F.lit("\n12 Long Meadow Road"))
        .alias("text"))
    return P.postal_findings(rows, "file", "text").groupBy("label").agg(
        F.count("*").alias("findings"), F.countDistinct("file").alias("files"))
