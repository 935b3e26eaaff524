"""Collections derived from the shared tables.

Each is a table name and a list of expressions that mean the same in Spark SQL
and in the SQL used for comparison, so both sides start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.workspace import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heavy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for heavy per-row work: spread when it is a single split."""
    return spread(table(spark, sf_dir, name))


def _padded(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 2, '0')"


_Y = "CAST(2012 + doc_id % 14 AS STRING)"
_M = _padded("1 + (doc_id * 7) % 12")
_D = _padded("1 + (doc_id * 11) % 28")
_TITLE = ("(CASE doc_id % 11 WHEN 0 THEN 'Alignment Newsletter ' "
          "WHEN 1 THEN 'Existential doom and x-risk ' WHEN 2 THEN 'Safety, bias and robustness ' "
          "WHEN 3 THEN 'GPT scaling ' WHEN 4 THEN 'AI policy and governance ' "
          "WHEN 5 THEN 'Links for May ' WHEN 6 THEN 'Interpretability tutorial ' "
          "WHEN 7 THEN 'Weekly safety digest ' WHEN 8 THEN 'In memoriam ' ELSE '' END)")

STANDINS: dict[str, tuple[str, list[str]]] = {
    # research records with mixed date shapes, tracked URLs and list text
    "research": ("documents", [
        "doc_id", "'r' || CAST(doc_id AS STRING) AS id",
        "CASE source WHEN 'src0' THEN 'arxiv' WHEN 'src1' THEN 'distill' "
        "WHEN 'src2' THEN 'lesswrong' WHEN 'src3' THEN 'alignmentforum' "
        "WHEN 'src4' THEN 'eaforum' ELSE source END AS source",
        f"{_TITLE} || CASE lang WHEN 'fr' THEN '\u00c9tude ' WHEN 'de' THEN ' \u00dcber  ' "
        "WHEN 'es' THEN 'El a\u00f1o ' ELSE '' END || source || ' note ' || CAST(doc_id AS STRING) AS title",
        "text", "lang",
        "'https://' || source || '.example.org/p/' || CAST(doc_id AS STRING) || "
        "CASE doc_id % 3 WHEN 0 THEN '?utm_source=feed&id=' || CAST(doc_id % 100 AS STRING) "
        "WHEN 1 THEN '?utm_source=a&utm_medium=b' ELSE '' END AS url",
        f"CASE doc_id % 6 WHEN 0 THEN {_Y} || '-' || {_M} || '-' || {_D} "
        f"WHEN 1 THEN {_Y} || '/' || {_M} || '/' || {_D} "
        f"WHEN 2 THEN {_M} || '/' || {_D} || '/' || {_Y} "
        f"WHEN 3 THEN {_Y} || '-' || {_M} || '-' || {_D} || 'T10:00:00Z' "
        f"WHEN 4 THEN '' ELSE 'circa ' || {_Y} END AS date_published",
        "lang || '|' || source || '| ' || CASE WHEN doc_id % 3 = 0 THEN 'Alignment' "
        "ELSE upper(lang) END AS tags_text",
        "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'Ada ' || lang || '| Bo|| Bo' END "
        "AS authors_text",
    ]),
    # candidate records with signals, clocks and titles
    "candidates": ("orders", [
        "o_orderkey", "o_custkey",
        "'feed' || CAST(o_orderkey % 6 AS STRING) || ':' || CAST(o_orderkey AS STRING) AS id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'model_release' "
        "WHEN '2-HIGH' THEN 'publication' WHEN '5-LOW' THEN 'incident' "
        "ELSE 'forum_post' END AS kind",
        "CASE WHEN o_orderkey % 17 = 0 THEN NULL "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS published_at",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS main_value",
        "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS citations",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'True' ELSE '' END AS frontier_model",
        "(CASE o_orderkey % 9 WHEN 0 THEN 'AI alignment funding' WHEN 1 THEN 'The board resigns' "
        "WHEN 2 THEN 'In memoriam of a colleague' WHEN 3 THEN 'Scaling LLMs with compute' "
        "WHEN 4 THEN 'Interpretability' WHEN 5 THEN 'Grant budget and salary costs' "
        "WHEN 6 THEN 'Oversight and regulation' ELSE 'Notes' END) || ' ' || o_orderstatus "
        "AS title",
        "CASE WHEN o_orderkey % 23 = 0 THEN 'not a link' "
        "ELSE 'https://a.example/' || CAST(o_orderkey AS STRING) || ', b.example/' || "
        "CAST(o_custkey AS STRING) || ';' END AS link_cell",
    ]),
    # timeline events with up to three impacts
    "events_v": ("orders", [
        "o_orderkey", "'ev_' || CAST(o_orderkey AS STRING) AS id",
        "'Order event ' || CAST(o_custkey AS STRING) AS title",
        "CAST(year(o_orderdate) AS INT) AS year",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'organizational_crisis' "
        "WHEN '2-HIGH' THEN 'funding_catastrophe' WHEN '5-LOW' THEN 'institutional_decay' "
        "ELSE 'technical_research_breakthrough' END AS category",
        "CASE o_orderstatus WHEN 'F' THEN 'common' WHEN 'O' THEN 'rare' ELSE 'legendary' END "
        "AS rarity",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'Introduction to order' ELSE 'Order' END || ' ' || "
        "CAST(o_orderkey AS STRING) || CASE WHEN o_custkey % 2 = 0 THEN "
        "' with a long description of everything that happened on that day' ELSE '' END "
        "AS description",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 90 - 40 AS DOUBLE) END "
        "AS research_change",
        "CAST(o_orderkey % 60 AS DOUBLE) AS papers_change",
        "CASE WHEN o_orderkey % 5 = 0 THEN CAST(0 - o_custkey % 90 AS DOUBLE) END "
        "AS ethics_change",
        "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 - o_custkey % 9 - 1 WHEN 2 THEN 0 "
        "ELSE o_custkey % 9 + 1 END AS doom_impact",
        "CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'https://ev.example/' || "
        "CAST(o_custkey AS STRING) || '|https://arc.example/x' END AS sources_text",
        "'order|' || lower(o_orderstatus) || '|c' || CAST(o_custkey % 7 AS STRING) AS tags_text",
    ]),
    # two review layers over research ids
    "reviews": ("labels", [
        "'r' || CAST(doc_id AS STRING) AS id", "doc_id",
        "CASE WHEN toxic = 1 THEN 'privacy' WHEN quality = 1 THEN 'accept' "
        "WHEN doc_id % 5 = 0 THEN 'reject' ELSE 'unsure' END AS verdict",
        "CASE WHEN doc_id % 3 = 0 THEN 'ada' ELSE 'bo' END AS reviewer",
        "'2026-01-' || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') AS said_at",
    ]),
}


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, expressions = STANDINS[name]
    read = heavy if name in ("research", "candidates") else table
    return read(spark, sf_dir, source).selectExpr(*expressions)


def cte(*names: str) -> str:
    """WITH clause that defines the named stand-ins."""
    parts = [f"{n} AS (SELECT {', '.join(STANDINS[n][1])} FROM {STANDINS[n][0]})"
             for n in names]
    return "WITH " + ", ".join(parts) + " "
