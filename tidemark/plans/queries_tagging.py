"""Queries that train, apply and measure the domain tagger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators import tagging as TG
from tidemark.plans import candidates as PC
from tidemark.plans.registry import query
from tidemark.plans.standins import heavy, table
from tidemark.workspace import durable

STOP = ", ".join(f"'{w}'" for w in K.TAG_STOPWORDS)
TOKENS = (f"list_filter(regexp_extract_all(lower({{0}}), '[a-z][a-z0-9\\-]+'), "
          f"lambda w: length(w) >= 3 AND NOT list_contains([{STOP}], w))")
HELD = ("CAST('0x' || substr(md5('20260725:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT)"
        " % 10000 < 2000")


def sql_model(source: str) -> str:
    """Weights per (domain, token) from ``source`` (domain, text)."""
    return f"""tok AS (SELECT domain, unnest({TOKENS.replace('{0}', 'text')}) AS token FROM {source}),
  cnt AS (SELECT domain, token, count(*) AS n FROM tok GROUP BY 1, 2),
  tot AS (SELECT domain, sum(n) AS t FROM cnt GROUP BY 1),
  voc AS (SELECT token, sum(n) AS g FROM cnt GROUP BY 1),
  siz AS (SELECT count(*) AS v, (SELECT sum(n) FROM cnt) AS gt FROM voc),
  weights AS (SELECT tot.domain, voc.token,
    ln(((CAST(coalesce(cnt.n, 0) AS DOUBLE) + 0.5) / (CAST(t AS DOUBLE) + 0.5 * v))
     / ((CAST(g - coalesce(cnt.n, 0) AS DOUBLE) + 0.5) / (CAST(gt - t AS DOUBLE) + 0.5 * v))) AS w
    FROM tot CROSS JOIN voc CROSS JOIN siz
    LEFT JOIN cnt ON cnt.domain = tot.domain AND cnt.token = voc.token)"""


def sql_classified(source: str) -> str:
    """domain, margin, tokens and reason for ``source`` (id, text)."""
    return f"""dt AS (SELECT id, unnest({TOKENS.replace('{0}', 'text')}) AS token FROM {source}),
  dn AS (SELECT id, token, count(*) AS n FROM dt GROUP BY 1, 2),
  dl AS (SELECT id, sum(n) AS tokens FROM dn GROUP BY 1),
  sc AS (SELECT dn.id, tot.domain, round(sum(coalesce(w, 0) * n) / any_value(dl.tokens), 12) AS s
    FROM dn JOIN dl ON dn.id = dl.id CROSS JOIN tot
    LEFT JOIN weights ON weights.domain = tot.domain AND weights.token = dn.token GROUP BY 1, 2),
  rk AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, domain) AS r FROM sc),
  best AS (SELECT id, max(domain) FILTER (WHERE r = 1) AS top_domain,
    max(s) FILTER (WHERE r = 1) AS a, max(s) FILTER (WHERE r = 2) AS b FROM rk GROUP BY 1),
  said AS (SELECT {source}.id, CAST(coalesce(dl.tokens, 0) AS BIGINT) AS tokens,
    CASE WHEN coalesce(dl.tokens, 0) < 4 THEN 0.0 ELSE (a - b) /
      CASE WHEN a = 0 THEN 1e-9 ELSE abs(a) END END AS margin, top_domain
    FROM {source} LEFT JOIN dl ON {source}.id = dl.id LEFT JOIN best ON {source}.id = best.id),
  out AS (SELECT *, CASE WHEN tokens < 4 THEN 'too_few_tokens' WHEN margin < 0.15
    THEN 'margin_below_threshold' ELSE 'ok' END AS reason FROM said)"""


def examples(spark, sf):
    return TG.labelled(heavy(spark, sf, "documents").withColumn("body", F.col("text")), "lang",
                       ["body"])


SQL_EXAMPLES = "ex AS (SELECT lang AS domain, doc_id, text FROM documents WHERE trim(text) <> '')"


@query("log_odds_weights", "A12 C12", f"""
WITH {SQL_EXAMPLES}, {sql_model('ex')}
SELECT domain, token, round(w, 9) AS weight FROM weights""")
def _(spark, sf):
    weights, domains = TG.train(TG.token_counts(examples(spark, sf), ["lang"], "text"), "lang")
    return TG.long_weights(weights, domains).select("domain", "token",
                                                    F.round("weight", 9).alias("weight"))


def heads(spark, sf):
    """The benchmark and document texts that are classified, whole."""
    docs = heavy(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        "text")
    return docs.unionByName(table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), "text"))


SQL_HEADS = """heads AS (SELECT 'd' || doc_id AS id, text FROM documents
  UNION ALL SELECT 'b' || item_id, text FROM benchmark)"""


@query("classified_heads", "A13 J17 F38", f"""
WITH {SQL_EXAMPLES}, {sql_model('ex')}, {SQL_HEADS}, {sql_classified('heads')}
SELECT id, CASE WHEN reason = 'ok' THEN top_domain END AS domain, round(margin, 6) AS margin,
  tokens, reason, CASE WHEN tokens >= 25 AND margin >= 0.35 THEN 'medium'
    WHEN tokens >= 12 AND margin >= 0.25 THEN 'low' ELSE 'very_low' END AS confidence FROM out""")
def _(spark, sf):
    weights, domains = TG.train(TG.token_counts(examples(spark, sf), ["lang"], "text"), "lang")
    said = TG.classify(heads(spark, sf), "id", "text", durable(weights, "weights"), domains)
    return said.select("id", "domain", F.round("margin", 6).alias("margin"), "tokens", "reason",
                       TG.tag_confidence(F.col("tokens"), F.col("margin")).alias("confidence"))


@query("abstention_reasons", "A20 C12 S20", f"""
WITH {SQL_EXAMPLES}, {sql_model('ex')}, {SQL_HEADS}, {sql_classified('heads')}
SELECT reason, CASE WHEN reason = 'ok' THEN top_domain END AS domain, count(*) AS n FROM out
GROUP BY 1, 2""")
def _(spark, sf):
    docs = heavy(spark, sf, "documents").withColumn("none", F.lit(None).cast("string"))
    feed = heads(spark, sf).select("id", F.col("text").alias("title"), F.lit("").alias("summary"),
                                   F.array().cast("array<string>").alias("forum_tags"))
    _, outcomes = PC.tag_feed(docs.withColumnRenamed("text", "body"), "lang", ["body", "none"],
                              feed)
    return outcomes


@query("tagger_holdout", "A14", f"""
WITH {SQL_EXAMPLES}, seen AS (SELECT * FROM ex WHERE NOT ({HELD})),
  held AS (SELECT doc_id AS id, domain AS truth, text FROM ex WHERE {HELD}),
  {sql_model('seen')}, {sql_classified('held')},
  j AS (SELECT held.truth, CASE WHEN reason = 'ok' THEN top_domain END AS guess FROM held
    JOIN out ON held.id = out.id),
  b AS (SELECT max(n) AS largest, sum(n) AS train_size FROM (SELECT count(*) AS n FROM seen
    GROUP BY domain))
SELECT CAST(any_value(train_size) AS BIGINT) AS train_size, count(*) AS test_size,
  count(guess) AS attempted, count(*) - count(guess) AS abstained,
  round(CAST(count(guess) AS DOUBLE) / count(*), 4) AS coverage,
  round(CAST(sum(CASE WHEN guess = truth THEN 1 ELSE 0 END) AS DOUBLE) / count(guess), 4)
    AS accuracy_when_attempted,
  round(CAST(any_value(largest) AS DOUBLE) / any_value(train_size), 4) AS majority_class_baseline
FROM j, b""")
def _(spark, sf):
    return TG.evaluate(examples(spark, sf), "doc_id", "lang", "text")


@query("labelled_examples", "S20", """
SELECT p_partkey, concat_ws(' ', nullif(p_name, ''), CASE WHEN p_partkey % 3 = 0 THEN p_brand END,
  p_type) AS text FROM part WHERE p_partkey % 7 <> 0""")
def _(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        "p_partkey", F.when(k % 7 != 0, F.col("p_type")).otherwise("").alias("domain"), "p_name",
        F.when(k % 3 == 0, F.col("p_brand")).alias("brand"), "p_type")
    return TG.labelled(rows, "domain", ["p_name", "brand", "p_type"]).select("p_partkey", "text")
