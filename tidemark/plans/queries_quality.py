"""Queries that yield violations: schema, admission, files, evidence, claims, maturity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators import dump_checks, maturity
from tidemark.operators import quality as Q
from tidemark.operators import rules as RU
from tidemark.plans import checks as C
from tidemark.plans import collections as PL
from tidemark.plans import queries_candidates as QC
from tidemark.plans import queries_collections as QL
from tidemark.plans.queries_research import research
from tidemark.plans.registry import query
from tidemark.plans.standins import cte, heavy, table
from tidemark.sinks import publish
from tidemark.workspace import new_path, spread

_STRINGS = "array<string>"
EV = cte("events_v")

EVENT_SCHEMA = {
    "type": "object",
    "additionalProperties": False,
    "required": ["id", "title", "year", "category", "impacts"],
    "properties": {
        "id": {"type": "string", "pattern": "^[a-z0-9_]+$", "maxLength": 8},
        "title": {"type": "string", "minLength": 5},
        "year": {"type": "integer", "minimum": 1996, "maximum": 2000},
        "category": {"enum": ["organizational_crisis", "funding_catastrophe",
                              "technical_research_breakthrough"]},
        "impacts": {"type": "array", "minItems": 2, "items": {
            "type": "object", "required": ["variable", "change"],
            "properties": {"variable": {"enum": ["research", "papers"]},
                           "change": {"type": "number", "minimum": -30}}}},
        "doom_impact": {"type": ["integer", "null"], "maximum": 5},
    },
    "if": {"properties": {"category": {"const": "funding_catastrophe"}}},
    "then": {"required": ["doom_impact"]},
}


def shown(found):
    return found.select("id", "rule", "severity")


def event_documents(spark, sf):
    """Events as raw JSON; every tenth one carries an extra key."""
    ev = spread(QL.timeline_events(spark, sf)).withColumn(
        "extra", F.when(F.col("o_orderkey") % 10 == 0, F.lit(1)))
    return ev.select("id", F.to_json(F.struct(
        "id", F.when(F.col("o_orderkey") % 13 != 0, F.col("title")).alias("title"), "year",
        "category", F.transform("impacts", lambda i: F.struct(i["variable"].alias("variable"),
                                                              i["change"].alias("change")))
        .alias("impacts"), "doom_impact", "extra")).alias("raw"))


@query("schema_violations", "Q1 Q23", EV + """
, r AS (SELECT *, CAST(research_change IS NOT NULL AS INT) + 1
    + CAST(ethics_change IS NOT NULL AS INT) AS n FROM events_v)
SELECT id, '$.id: maxLength' AS rule, 'error' AS severity FROM r WHERE length(id) > 8
UNION ALL SELECT id, '$.title: required', 'error' FROM r WHERE o_orderkey % 13 = 0
UNION ALL SELECT id, '$.year: minimum', 'error' FROM r WHERE year < 1996
UNION ALL SELECT id, '$.year: maximum', 'error' FROM r WHERE year > 2000
UNION ALL SELECT id, '$.category: enum', 'error' FROM r WHERE category = 'institutional_decay'
UNION ALL SELECT id, '$.impacts: minItems', 'error' FROM r WHERE n < 2
UNION ALL SELECT id, '$.impacts[].variable: enum', 'error' FROM r WHERE ethics_change IS NOT NULL
UNION ALL SELECT id, '$.impacts[].change: minimum', 'error' FROM r
  WHERE research_change < -30 OR ethics_change < -30
UNION ALL SELECT id, '$.doom_impact: maximum', 'error' FROM r WHERE doom_impact > 5
UNION ALL SELECT id, '$: additionalProperties', 'error' FROM r WHERE o_orderkey % 10 = 0
UNION ALL SELECT id, '$.doom_impact: required', 'error' FROM r
  WHERE category = 'funding_catastrophe' AND doom_impact IS NULL""")
def _(spark, sf):
    return shown(RU.schema_violations(event_documents(spark, sf), "events", "id", "raw",
                                      EVENT_SCHEMA))


def raw_candidates(spark, sf):
    k = F.col("o_orderkey")
    rows = QC.candidates(spark, sf).select(
        "o_orderkey", F.when(k % 37 != 0, F.col("id")).otherwise("").alias("id"), "title",
        F.when(k % 41 == 0, "rumour").otherwise(F.col("kind")).alias("kind"),
        F.lit("2026-01-01").alias("ingested_at"), F.struct(
            F.when(k % 43 == 0, "CC-BY-SA-4.0").when(k % 47 == 0, "").otherwise("CC-BY-4.0")
            .alias("spdx"), F.lit("a").alias("attribution"), F.lit("t").alias("source_terms_url"),
            F.lit("2026-01-01").alias("verified_at")).alias("license"),
        F.col("published_at").alias("occurred_at"), "published_at",
        F.lit(None).cast("string").alias("source_available_at"),
        F.when(k % 53 == 0, F.lit(0.5)).alias("salience"))
    clocks = F.to_json(F.struct("occurred_at", "published_at", "source_available_at"),
                       {"ignoreNullFields": "false"})
    part = F.to_json(F.struct("id", "salience"))
    raw = F.concat(F.left(part, F.length(part) - 1), F.lit(","), F.substring(clocks, 2, 10_000))
    return rows.withColumn("raw", F.when(k % 59 == 0, part).otherwise(raw))


@query("candidate_admission", "Q2 Q4 Q7", """
SELECT CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE 'feed' || (o_orderkey % 6) || ':' || o_orderkey END
  AS id, rule, count(*) AS n FROM orders, LATERAL (VALUES
  ('missing id', o_orderkey % 37 = 0), ('unknown kind', o_orderkey % 41 = 0),
  ('license missing spdx', o_orderkey % 47 = 0 AND o_orderkey % 43 <> 0),
  ('share-alike licence', o_orderkey % 43 = 0),
  ('clock occurred_at absent', o_orderkey % 59 = 0),
  ('clock published_at absent', o_orderkey % 59 = 0),
  ('clock source_available_at absent', o_orderkey % 59 = 0)) v(rule, broken)
WHERE broken GROUP BY 1, 2""")
def _(spark, sf):
    return Q.admission(raw_candidates(spark, sf)).groupBy("id", "rule").agg(
        F.count("*").alias("n"))


@query("bare_opinions", "Q5", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'bare salience' AS rule, 'error' AS severity
FROM orders WHERE o_orderkey % 53 = 0""")
def _(spark, sf):
    return shown(Q.bare_opinions(raw_candidates(spark, sf), "candidates", "o_orderkey", "raw"))


@query("licence_rules", "Q4", """
SELECT rule, count(*) AS n FROM orders, LATERAL (VALUES ('share-alike licence', o_orderkey % 43 = 0),
  ('no licence', o_orderkey % 47 = 0 AND o_orderkey % 43 <> 0)) v(rule, broken)
WHERE broken GROUP BY 1""")
def _(spark, sf):
    return Q.licences(raw_candidates(spark, sf)).groupBy("rule").agg(F.count("*").alias("n"))


@query("clock_presence", "Q7", """
SELECT 'clock ' || c || ' absent' AS rule, count(*) AS n FROM orders,
  (VALUES ('occurred_at'), ('published_at'), ('source_available_at')) v(c)
WHERE o_orderkey % 59 = 0 GROUP BY 1""")
def _(spark, sf):
    return Q.clocks_present(raw_candidates(spark, sf), "raw").groupBy("rule").agg(
        F.count("*").alias("n"))


@query("repeated_ids", "Q3", """
SELECT CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber AS id, CAST(count(*) AS VARCHAR) AS detail
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("id"))
    return Q.unique_ids(rows, "lines", "id").select("id", "detail")


@query("unattributed_reviews", "Q6", cte("reviews") + """
SELECT id, 'unattributed review' AS rule, 'error' AS severity FROM reviews WHERE doc_id % 7 = 0""")
def _(spark, sf):
    from tidemark.plans import candidates as PC
    from tidemark.plans.standins import standin
    rows = standin(spark, sf, "reviews").select(
        "id", F.when(F.col("doc_id") % 7 != 0, F.col("reviewer")).otherwise("").alias("reviewer"),
        "verdict", F.col("said_at").alias("at"), F.lit("a.json").alias("layer"))
    return shown(Q.reviews_attributed(PC.reviews_by_id(rows)))


@query("leaked_tombstones", "Q8", cte("candidates") + f""", {QC.SQL_TOMBSTONES}
SELECT id, 'tombstoned record present' AS rule, 'error' AS severity FROM candidates
WHERE id IN (SELECT id FROM tomb)""")
def _(spark, sf):
    return shown(Q.tombstones_honoured(QC.candidates(spark, sf), QC.tombstones(spark, sf)))


@query("manifest_reconciliation", "J14 Q9", """
WITH f AS (SELECT CAST(doc_id AS VARCHAR) AS file, doc_id AS k, sha256(text) AS h FROM documents)
SELECT file, CASE WHEN k % 11 = 0 THEN 'unlisted' WHEN k % 13 = 0 THEN 'missing'
  WHEN k % 7 <> 0 THEN 'ok' WHEN k % 5 = 0 THEN 'redacted' WHEN k % 5 = 1 THEN 'tombstone disagrees'
  ELSE 'mismatch' END AS outcome FROM f WHERE NOT (k % 11 = 0 AND k % 13 = 0)""")
def _(spark, sf):
    k = F.col("doc_id")
    files = table(spark, sf, "documents").select(
        k, k.cast("string").alias("file"), F.sha2("text", 256).alias("sha256"))
    manifest = files.filter(k % 11 != 0).select("file", F.when(k % 7 == 0, F.sha2("file", 256))
                                                .otherwise(F.col("sha256")).alias("sha256"))
    actual = files.filter(k % 13 != 0).select("file", "sha256")
    tombs = files.filter((k % 5 <= 1) & (k % 11 != 0)).select("file", F.when(
        k % 5 == 0, F.col("sha256")).otherwise("0").alias("sha256"))
    return Q.reconcile_manifest(manifest, actual, tombs)


@query("catalogue_divergence", "Q10", """
SELECT 'c' || c_nationkey AS collection, 'f' || c_nationkey AS id,
  CASE WHEN c_nationkey = 3 THEN 'warning' ELSE 'error' END AS severity FROM customer
GROUP BY c_nationkey HAVING count(*) <> 60""")
def _(spark, sf):
    actual = table(spark, sf, "customer").groupBy(
        F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("collection")).agg(
        F.count("*").alias("actual"))
    claimed = actual.select("collection", F.concat(F.lit("f"), F.substring("collection", 2, 9))
                            .alias("file"), F.lit(60).cast("bigint").alias("claimed"))
    known = claimed.filter("file = 'f3'").select("file")
    return Q.catalogue_counts(claimed, actual, known).select("collection", "id", "severity")


@query("registry_evidence", "Q11", """
SELECT 's' || s_suppkey AS id, 'date without evidence' AS rule, 'error' AS severity FROM supplier
WHERE s_suppkey % 2 = 0 AND s_suppkey % 3 = 0""")
def _(spark, sf):
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), k.cast("string")).alias("source_id"),
        F.when(k % 2 == 0, "2020-01-01").alias("source_available_at"),
        F.when(k % 3 != 0, F.array("s_name")).alias("evidence"))
    return shown(Q.registry_evidence(rows))


@query("research_record_rules", "Q12", cte("research") + r"""
, r AS (SELECT *, 'r' || (doc_id % 900) AS rid FROM research)
SELECT rid AS id, 'missing date_published' AS rule, 'error' AS severity FROM r WHERE date_published = ''
UNION ALL SELECT rid, 'non-ascii title', 'error' FROM r WHERE regexp_matches(title, '[^\x00-\x7F]')
UNION ALL SELECT rid, 'non-ascii text', 'error' FROM r WHERE regexp_matches(text, '[^\x00-\x7F]')
UNION ALL SELECT rid, 'date shape', 'error' FROM r WHERE date_published <> ''
  AND NOT regexp_matches(date_published, '^.{4}-.{2}-.{2}')
UNION ALL SELECT rid, 'unknown source', 'error' FROM r WHERE source NOT IN ('arxiv', 'distill', 'src7')
UNION ALL SELECT rid, 'duplicate id', 'error' FROM r WHERE doc_id >= 900
UNION ALL SELECT rid, 'missing text', 'error' FROM r WHERE text = ''""")
def _(spark, sf):
    rows = research(spark, sf).withColumns({
        "id": F.concat(F.lit("r"), (F.col("doc_id") % 900).cast("string")),
        "_ord": F.col("doc_id")})
    return shown(Q.research_records(rows, ["arxiv", "distill", "src7"]))


RESEARCH_SCHEMA = {
    "type": "object", "required": ["id", "url"],
    "properties": {"id": {"type": "string", "maxLength": 4}, "url": {"type": "string"},
                   "notes": {"type": "array", "maxItems": 2}}}


def research_dump_lines(spark, sf):
    """Documents as lines of dumps, one per language, with faults of every kind."""
    k, text = F.col("doc_id"), F.col("text")
    raw = F.to_json(F.struct(
        F.concat(F.lit("r"), (k % 900).cast("string")).alias("id"), "source",
        F.when(k % 31 == 0, "").otherwise("a title").alias("title"), text,
        F.concat(F.when(k % 17 == 0, "ftp").otherwise("https"), F.lit("://x/")).alias("url"),
        F.when(k % 19 == 0, "2024/01/02").otherwise("2024-01-02").alias("date_published"),
        F.array(F.struct(F.when(k % 7 == 0, "n\u00e9").otherwise("ne").alias("who")),
                F.struct(F.lit("ok").alias("who"))).alias("notes")))
    raw = F.when(k % 29 == 0, F.regexp_replace(raw, r'"notes":\[', '"notes":[null,null,')).otherwise(raw)
    return table(spark, sf, "documents").select(
        F.col("lang").alias("dump"), k.alias("line_no"),
        F.when(k % 23 == 0, F.left(raw, F.length(raw) - 2)).otherwise(raw).alias("raw"))


SQL_DUMPS = r"""
WITH d AS (SELECT *, 'r' || (doc_id % 900) AS id FROM documents),
g AS (SELECT * FROM d WHERE doc_id % 23 <> 0),
f AS (
  SELECT lang AS dump, doc_id AS line_no, NULL AS id, 'does not parse as JSON' AS rule, NULL AS detail
  FROM d WHERE doc_id % 23 = 0
  UNION ALL SELECT lang, doc_id, id, rule, detail FROM g, LATERAL (VALUES
    ('schema', '$.id: maxLength', length(id) > 4), ('schema', '$.notes: maxItems', doc_id % 29 = 0),
    ('missing title', NULL, doc_id % 31 = 0), ('missing text', NULL, text = '' OR text IS NULL),
    ('date shape', '2024/01/02', doc_id % 19 = 0), ('url scheme', 'ftp://x/', doc_id % 17 = 0),
    ('unknown source', source, source NOT IN ('src1', 'src2', 'src7')),
    ('missing source', NULL, source IS NULL), ('non-ascii', '/text', regexp_matches(text, '[^\x00-\x7F]')),
    ('non-ascii', CASE WHEN doc_id % 29 = 0 THEN '/notes[2]/who' ELSE '/notes[0]/who' END,
      doc_id % 7 = 0)) v(rule, detail, broken) WHERE broken
  UNION ALL SELECT lang, doc_id, id, 'duplicate id', NULL FROM (SELECT *, min(doc_id) OVER (
    PARTITION BY lang, id) AS first FROM g) WHERE doc_id > first)"""


@query("research_dump_rules", "Q12 Q19", SQL_DUMPS + """
SELECT dump, line_no, id, rule, 'error' AS severity, detail FROM f""")
def _(spark, sf):
    return dump_checks.research_lines(research_dump_lines(spark, sf), RESEARCH_SCHEMA,
                                      ["src1", "src2", "src7"])


@query("research_dump_counts", "Q12", SQL_DUMPS + """
, t AS (SELECT lang AS dump, count(*) AS total FROM documents GROUP BY 1),
c AS (SELECT dump, count(DISTINCT line_no) AS invalid,
    count(DISTINCT CASE WHEN rule = 'schema' THEN line_no END) AS schema_errors,
    count(*) FILTER (WHERE rule LIKE 'missing %') AS missing_fields,
    count(DISTINCT CASE WHEN rule = 'duplicate id' THEN line_no END) AS duplicate_ids,
    count(DISTINCT CASE WHEN rule = 'non-ascii' THEN line_no END) AS ascii_errors FROM f GROUP BY 1)
SELECT dump, total, total - invalid AS valid, invalid, schema_errors, missing_fields, duplicate_ids,
  ascii_errors, CASE WHEN dump <> 'es' THEN total + CASE WHEN dump = 'fr' THEN 1 ELSE 0 END END AS expected,
  CASE dump WHEN 'es' THEN 'no metadata' WHEN 'fr' THEN 'missing metadata field source_url; record count mismatch'
    ELSE '' END AS problems FROM t JOIN c USING (dump)
UNION ALL SELECT 'xx', 0, 0, 0, 0, 0, 0, 0, 5, 'record count mismatch; no data'""")
def _(spark, sf):
    """Counts observed in the dumps against the counts their metadata states."""
    lines = research_dump_lines(spark, sf)
    found = dump_checks.research_lines(lines, RESEARCH_SCHEMA, ["src1", "src2", "src7"])
    fields = [F.lit("x").alias(f) for f in K.RESEARCH_METADATA if f not in ("record_count", "source_url")]
    counted = (lines.groupBy("dump").agg(F.count("*").alias("n")).filter("dump <> 'es'")
               .unionByName(spark.createDataFrame([("xx", 5)], "dump string, n long")))
    fr = F.col("dump") == "fr"
    metadata = counted.select("dump", F.to_json(F.struct(
        *fields, F.when(~fr, "u").alias("source_url"),
        (F.col("n") + F.when(fr, 1).otherwise(0)).alias("record_count"))).alias("raw"))
    return dump_checks.reconciled(lines, found, metadata)


@query("grant_rules", "Q13", """
SELECT CAST(k AS VARCHAR) AS grant_id, rule, severity FROM (SELECT o_orderkey AS k FROM orders),
LATERAL (VALUES ('missing source', 'error', k % 17 = 0), ('empty source', 'warning', k % 17 = 1),
  ('invalid amount', 'error', k % 5 = 0), ('odd date', 'warning', k % 7 = 0),
  ('empty date', 'warning', k % 7 = 1)) v(rule, severity, broken) WHERE broken""")
def _(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        k.cast("string").alias("grant_id"),
        F.when(k % 5 == 0, "a lot").otherwise(F.concat(F.lit("$1,"), F.lpad(
            (k % 1000).cast("string"), 3, "0"))).alias("amount"),
        F.when(k % 7 == 0, "Spring 2020").when(k % 7 == 1, "").when(k % 7 == 2, "2020/01/02")
        .when(k % 7 == 3, "13/02/2020").otherwise("2020-01-02").alias("date"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 17 == 1, "").otherwise("sff").alias("source"))
    rows = rows.withColumn("raw", F.to_json(F.struct("grant_id", "amount", "date", "source")))
    return Q.grants(rows, raw="raw").select(F.col("id").alias("grant_id"), "rule", "severity")


@query("csv_file_rules", "Q13 S5", """
SELECT event_type || '.csv' AS id, 'missing column ' || c AS rule, 'error' AS severity
FROM (SELECT DISTINCT event_type FROM events), (VALUES ('date'), ('source')) v(c)
WHERE event_type IN ('click', 'view') OR (event_type = 'error' AND c = 'source')""")
def _(spark, sf):
    e = F.col("event_id")
    rows = table(spark, sf, "events")
    heads = rows.select("event_type").distinct().select(
        F.concat("event_type", F.lit(".csv")).alias("file"), F.lit(0).cast("bigint")
        .alias("line_no"), F.when(F.col("event_type").isin("click", "view"), "grant_id, amount")
        .when(F.col("event_type") == "error", "grant_id,amount,date")
        .otherwise("grant_id, amount, date ,source").alias("value"))
    body = rows.select(F.concat("event_type", F.lit(".csv")).alias("file"),
                       (e + 1).alias("line_no"), F.concat_ws(",", "props", "event_type")
                       .alias("value"))
    return shown(Q.csv_files(heads.unionByName(body), ["grant_id", "amount", "date", "source"]))


@query("dump_metadata_rules", "Q14 K14", """
WITH d AS (SELECT c_custkey AS k, count(o_orderkey) AS n FROM customer LEFT JOIN orders
  ON c_custkey = o_custkey GROUP BY 1)
SELECT 'd' || k AS id, rule, severity FROM d, LATERAL (VALUES
  ('missing source_url', 'error', k % 5 = 0), ('source mismatch', 'error', k % 6 = 0),
  ('bad method', 'error', k % 7 = 0), ('bad status', 'error', k % 8 = 0),
  ('empty data_format', 'warning', k % 9 = 0), ('zero records', 'warning', k % 10 = 0),
  ('no data', 'warning', n = 0),
  ('count mismatch', 'warning', n > 0 AND n <> CASE WHEN k % 10 = 0 THEN 0 ELSE 10 END)
  ) v(rule, severity, broken) WHERE broken""")
def _(spark, sf):
    k = F.col("c_custkey")
    dump = F.concat(F.lit("d"), k.cast("string"))
    meta = table(spark, sf, "customer").select(
        dump.alias("dump"), F.lit("sff").alias("source"), F.lit("2026-01-01")
        .alias("extraction_date"), F.when(k % 6 == 0, "other").otherwise("sff")
        .alias("source_name"), F.when(k % 5 != 0, "https://x").alias("source_url"),
        F.when(k % 7 == 0, "magic").otherwise("api").alias("extraction_method"),
        F.when(k % 9 == 0, "").otherwise("json").alias("data_format"),
        F.when(k % 8 == 0, "done").otherwise("complete").alias("extraction_status"),
        F.when(k % 10 == 0, 0).otherwise(10).alias("record_count"))
    meta = meta.withColumn("raw", F.to_json(F.struct(*meta.columns)))
    counts = table(spark, sf, "orders").groupBy(
        F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("dump")).agg(
        F.count("*").alias("rows"))
    return shown(Q.dump_metadata(meta, counts))


@query("lab_evidence_rules", "Q15 F17 U7", """
WITH l AS (SELECT s_suppkey AS k, 'org_' || s_suppkey AS id FROM supplier)
SELECT id, 'quote lacks date' AS rule, 'month' AS detail, 'error' AS severity FROM l
  WHERE k % 6 <> 0 AND k % 9 = 0
UNION ALL SELECT id, 'undated with precision', 'month', 'error' FROM l WHERE k % 6 = 0 AND k % 4 = 0
UNION ALL SELECT id, 'grade differs', CASE k % 5 WHEN 0 THEN 'secondary' WHEN 1 THEN 'registry'
  WHEN 2 THEN 'first_party' ELSE 'press' END, 'error' FROM l WHERE k % 6 <> 0 AND k % 7 = 0
  AND k % 5 <> 1
UNION ALL SELECT id, 'cited url not in sources', 'https://e.example/' || k, 'error' FROM l
  WHERE k % 6 <> 0 AND k % 10 = 1""")
def _(spark, sf):
    k = F.regexp_extract("name", r"(\d+)", 1).cast("bigint")
    labs = QL.built_labs(spark, sf).withColumns({
        "evidence_strength": F.when((k % 7 == 0) & F.col("founded").isNotNull(), "registry")
        .otherwise(F.col("evidence_strength")),
        "sources": F.when(k % 10 == 1, F.array(F.lit("https://x.example/0")))
        .otherwise(F.col("sources"))})
    return Q.lab_evidence(labs).select("id", "rule", "detail", "severity")


@query("lab_sanity_rules", "Q16", f"""
WITH {QL.SQL_LABS}
SELECT id, 'model before founding' AS rule, 'error' AS severity FROM labs
  WHERE substr(first, 1, 7) < founded
UNION ALL SELECT id, 'status before founding', 'error' FROM labs
  WHERE k % 10 = 0 AND founded IS NOT NULL AND '1975' < substr(founded, 1, 4)
UNION ALL SELECT id, 'undated with precision', 'error' FROM labs WHERE k % 6 = 0 AND k % 4 = 0""")
def _(spark, sf):
    return shown(Q.lab_sanity(QL.built_labs(spark, sf)))


@query("names_in_several_files", "Q26", """
SELECT 'p' || p_size AS id, CAST(count(DISTINCT p_brand) AS VARCHAR) AS detail FROM part
GROUP BY p_size HAVING count(DISTINCT p_brand) > 1""")
def _(spark, sf):
    rows = table(spark, sf, "part").select(
        F.concat(F.lit("p"), F.col("p_size").cast("string")).alias("name"), "p_brand")
    return Q.names_in_one_file(rows, "name", "p_brand").select("id", "detail")


@query("mechanical_basis", "Q27", f"""
WITH {QL.SQL_LABS}
SELECT id, 'mechanical basis without match' AS rule, 'error' AS severity FROM labs
WHERE k % 3 = 0 AND (n IS NULL OR k % 2 = 0)""")
def _(spark, sf):
    labs = QL.built_labs(spark, sf)
    k = F.regexp_extract("name", r"(\d+)", 1).cast("bigint")
    return shown(Q.mechanical_basis(labs.withColumn("epoch_frontier_models", F.when(
        k % 2 != 0, F.col("epoch_frontier_models")))))


def claims(spark, sf):
    """Scan claims with one defect each, by the remainder of their number."""
    k = F.col("event_id")
    m = k % 20
    rows = heavy(spark, sf, "events").select(
        F.concat(F.lit("scan_"), F.col("user_id").cast("string")).alias("scan_id"),
        F.when(m == 0, F.concat(F.lit("Bad-"), k.cast("string"))).otherwise(
            F.concat(F.lit("ev_"), (k - k % 500 % 2).cast("string"))).alias("slug"),
        F.when(m == 2, " ").otherwise("A title").alias("title"),
        F.when(m == 4, "soon").when(m == 6, F.lit(None)).otherwise("2026-01-02").alias("date"),
        F.when(m == 8, "contested").when(m == 10, "guess").otherwise("action").alias("date_kind"),
        F.when(m == 12, "short").otherwise(F.repeat(F.lit("long enough "), F.lit(5)))
        .alias("description"),
        F.when(m == 14, F.array().cast(_STRINGS)).when(m == 16, F.array(F.lit("ftp://x")))
        .otherwise(F.array(F.lit("https://x"))).alias("sources"),
        F.lit("because").alias("why_it_matters"),
        F.when(m == 18, "low").when(m == 19, "sure").otherwise("high").alias("confidence"),
        F.array().cast(_STRINGS).alias("flags"), (m == 14).alias("primary_source_retrieved"))
    keys = ["slug", "title", "date_kind", "description", "sources", "why_it_matters",
            "confidence", "flags"]
    body = F.to_json(F.struct(*keys, "primary_source_retrieved"))
    dated = F.concat(F.lit('{"date":'), F.coalesce(F.concat(F.lit('"'), "date", F.lit('"')),
                                                  F.lit("null")), F.lit(","),
                     F.substring(body, 2, 100_000))
    return rows.withColumn("raw", dated)


SQL_CLAIMS = """c AS (SELECT event_id % 20 AS m, 'scan_' || user_id || '/' || CASE WHEN event_id % 20 = 0
    THEN 'Bad-' || event_id ELSE 'ev_' || (event_id - event_id % 500 % 2) END AS id,
    'scan_' || user_id AS scan_id FROM events)"""


@query("scan_claim_rules", "Q17", f"""
WITH {SQL_CLAIMS}
SELECT id, rule, 'error' AS severity FROM c, LATERAL (VALUES ('slug shape', m = 0),
  ('empty title', m = 2), ('date shape', m = 4), ('date kind needs null date', m = 8),
  ('bad date kind', m = 10), ('short description', m = 12), ('date without source', m = 14),
  ('unsourced without flag', m = 14), ('retrieved without source', m = 14),
  ('source not a url', m = 16), ('low confidence without flag', m = 18),
  ('bad confidence', m = 19)) v(rule, broken) WHERE broken
UNION ALL SELECT id, 'duplicate id', 'error' FROM c GROUP BY id HAVING count(*) > 1""")
def _(spark, sf):
    rows = claims(spark, sf)
    return shown(Q.scan_records(rows).unionByName(Q.repeated_slugs(rows)))


@query("scan_payload_rules", "Q17", f"""
WITH {SQL_CLAIMS}, p AS (SELECT scan_id, CAST(substr(scan_id, 6) AS INT) AS u,
    max(CAST(m = 14 AS INT)) AS unsourced FROM c GROUP BY 1)
SELECT scan_id AS id, rule, 'error' AS severity FROM p, LATERAL (VALUES
  ('missing operator', u % 3 = 0), ('scanned_at shape', u % 4 = 0), ('non-ascii', u % 5 = 0),
  ('unsourced without accounting', unsourced = 1 AND u % 2 = 0)) v(rule, broken) WHERE broken""")
def _(spark, sf):
    rows = claims(spark, sf)
    u = F.substring("scan_id", 6, 9).cast("int")
    payloads = rows.select("scan_id").distinct().select(
        "scan_id", F.lit("s").alias("scan_scope"),
        F.when(u % 4 == 0, "today").otherwise("2026-01-02T03:04:05Z").alias("scanned_at"),
        F.when(u % 5 == 0, "né").otherwise("x").alias("scanner"),
        F.when(u % 3 != 0, "ada").alias("operator"), F.lit("i").alias("instruction_summary"),
        F.array(F.lit(1)).alias("records"),
        F.when(u % 2 != 0, F.struct(F.lit(1).alias("n"))).alias("retrieval_accounting"))
    payloads = payloads.withColumn("raw", F.to_json(F.struct(*payloads.columns)))
    return shown(Q.scan_payloads(payloads.select("scan_id", "scanned_at", "raw"), rows))


@query("mojibake_rules", "Q19 F7", r"""
SELECT CAST(doc_id AS VARCHAR) AS id, 'mojibake in broken' AS rule, 'error' AS severity FROM documents
WHERE regexp_matches(text, '[^\x00-\x7F]') AND NOT regexp_matches(
  text, '[\x{c1}\x{cd}\x{cf}\x{d0}\x{dd}]')""")
def _(spark, sf):
    from tidemark.functions import text as X
    latin = F.translate(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"), X._C1_CHARS,
                        X._CP1252_CHARS)
    rows = table(spark, sf, "documents").select(
        "doc_id", latin.alias("broken"), F.lit("plain").alias("clean"))
    return shown(Q.mojibake(rows, "documents", "doc_id", ["broken", "clean"]))


BROKEN = r"""(regexp_matches(text, '[^\x00-\x7F]') AND NOT regexp_matches(text,
  '[\x{c1}\x{cd}\x{cf}\x{d0}\x{dd}]'))"""


def latin_of(text):
    """The text as it looks when its UTF-8 bytes are read as Windows-1252."""
    from tidemark.functions import text as X
    return F.translate(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), X._C1_CHARS, X._CP1252_CHARS)


@query("mojibake_paths", "Q19 F7", f"""
WITH d AS (SELECT doc_id, source, {BROKEN} AS broken FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS id, 'mojibake' AS rule,
  CASE WHEN source IN ('src0', 'src1') THEN 'report' ELSE 'error' END AS severity, detail
FROM d, LATERAL (VALUES ('/text', doc_id % 3 = 0), ('/deep/list[1]/note', doc_id % 3 = 1),
  ('/named/<key>', doc_id % 3 = 2), ('/deep/list[0]/items[0]', doc_id % 3 <> 1)) v(detail, here)
WHERE here AND broken AND doc_id % 40 <> 0
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'does not parse as JSON',
  CASE WHEN source IN ('src0', 'src1') THEN 'report' ELSE 'error' END, NULL FROM d WHERE doc_id % 40 = 0""")
def _(spark, sf):
    """Damaged strings and keys of nested documents by path; two sources are raw zones."""
    k, broken = F.col("doc_id"), latin_of(F.coalesce("text", F.lit("")))
    at = lambda here, other="plain": F.when(here, broken).otherwise(other)
    entry = lambda items, note: F.struct(items.alias("items"), note.alias("note"))
    listed = F.array(entry(F.array(at(k % 3 != 1)), F.lit(None).cast("string")),
                     entry(F.lit(None).cast("array<string>"), at(k % 3 == 1)))
    raw = F.to_json(F.struct(k.alias("doc_id"), at(k % 3 == 0).alias("text"),
                             F.struct(listed.alias("list")).alias("deep"),
                             F.create_map(at(k % 3 == 2, "name"), F.lit("x")).alias("named")))
    rows = table(spark, sf, "documents").select(
        "doc_id", (~F.col("source").isin("src0", "src1")).alias("gates"),
        F.when(k % 40 == 0, F.left(raw, F.length(raw) - 2)).otherwise(raw).alias("raw"))
    return Q.mojibake_leaves(rows, "documents", "doc_id", "raw", F.col("gates")).select(
        "id", "rule", "severity", "detail")


@query("taxonomy_rules", "Q20 U5", """
WITH h AS (SELECT p_partkey AS k, p_name || ' ' || (p_partkey - p_partkey % 100 % 2) AS term FROM part),
e AS (SELECT s_suppkey AS k, 's' || s_suppkey AS term FROM supplier
  UNION ALL SELECT p_partkey, p_name || ' ' || p_partkey FROM part WHERE p_partkey % 50 = 0)
SELECT term AS id, 'no definition' AS rule, 'error' AS severity FROM h WHERE k % 5 = 0
UNION ALL SELECT term, 'bad status', 'error' FROM h WHERE k % 7 = 0
UNION ALL SELECT term, 'ruled without authority', 'error' FROM h WHERE k % 7 = 1
UNION ALL SELECT term, 'no note', 'error' FROM e WHERE k % 3 = 0
UNION ALL SELECT DISTINCT h.term, 'claimed on both sides', 'error' FROM h JOIN e ON h.term = e.term
UNION ALL SELECT term, 'duplicate id', 'error' FROM h GROUP BY 1 HAVING count(*) > 1""")
def _(spark, sf):
    k = F.col("p_partkey")
    here = table(spark, sf, "part").select(
        F.concat_ws(" ", "p_name", (k - k % 100 % 2).cast("string")).alias("term"),
        F.when(k % 5 == 0, " ").otherwise("means").alias("definition"),
        F.when(k % 7 == 0, "maybe").when(k % 7 == 1, "ruled").otherwise("proposed")
        .alias("status"), F.lit(None).cast("string").alias("authority"))
    other = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("term"),
        F.col("s_suppkey").alias("k")).unionByName(table(spark, sf, "part").filter(
            "p_partkey % 50 = 0").select(F.concat_ws(" ", "p_name", k.cast("string"))
                                         .alias("term"), k.alias("k")))
    elsewhere = other.select("term", F.lit("them").alias("minted_by"), F.when(
        F.col("k") % 3 == 0, "").otherwise("why").alias("note"), F.lit("ruled").alias("status"))
    return shown(Q.taxonomy(here, elsewhere))


@query("event_health", "Q21 A7", EV + """
SELECT id, rule, 'error' AS severity FROM events_v, LATERAL (VALUES
  ('missing title', o_orderkey % 13 = 0), ('empty sources', sources_text = ''),
  ('non-ascii', o_orderkey % 17 = 0), ('missing tags', o_orderkey % 19 = 0),
  ('empty tags', o_orderkey % 19 = 0)) v(rule, broken) WHERE broken""")
def _(spark, sf):
    k = F.col("o_orderkey")
    rows = QL.timeline_events(spark, sf).withColumns({
        "title": F.when(k % 13 != 0, F.col("title")),
        "tags": F.when(k % 19 != 0, F.col("tags")),
        "description": F.when(k % 17 == 0, F.lit("déjà")).otherwise(F.col("description"))})
    rows = rows.withColumn("raw", F.to_json(F.struct(
        "id", "title", "year", "category", "description", "impacts", "sources", "tags")))
    return shown(Q.event_health(rows, "raw"))


@query("legacy_event_rules", "Q25", EV + """
SELECT 'k' || o_orderkey AS id, rule, 'error' AS severity FROM events_v, LATERAL (VALUES
  ('key differs from id', o_orderkey % 6 = 0), ('no sources', sources_text = ''),
  ('missing title or description', o_orderkey % 13 = 0)) v(rule, broken) WHERE broken""")
def _(spark, sf):
    k = F.col("o_orderkey")
    key = F.concat(F.lit("k"), k.cast("string"))
    rows = QL.timeline_events(spark, sf).withColumns({
        "key": key, "id": F.when(k % 6 == 0, F.col("id")).otherwise(key),
        "title": F.when(k % 13 != 0, F.col("title")).otherwise("")})
    return shown(Q.legacy_events(rows))


@query("ascii_purity", "Q22", r"""
SELECT CAST(doc_id AS VARCHAR) AS id, 'non-ascii' AS rule, 'error' AS severity FROM documents
WHERE regexp_matches(text, '[^\x00-\x7F]')""")
def _(spark, sf):
    return shown(Q.ascii_rows(table(spark, sf, "documents"), "documents", "doc_id"))


@query("bare_opinion_names", "Q5 Q24", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'bare ' || f AS rule, 'error' AS severity FROM customer,
  LATERAL (VALUES ('importance', c_custkey % 9 = 0), ('rarity', c_custkey % 10 = 1),
    ('verdict', c_custkey % 15 = 2)) v(f, here) WHERE here""")
def _(spark, sf):
    """Every record against the nine names that promise a judgement without saying whose."""
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k, F.to_json(F.struct(
        F.when(k % 9 == 0, 1).alias("importance"), F.when(k % 10 == 1, "rare").alias("rarity"),
        F.when(k % 15 == 2, "yes").alias("verdict"), F.lit(3).alias("ada_rating"))).alias("raw"))
    return shown(Q.bare_opinions(rows, "customers", "c_custkey", "raw", K.BARE_OPINIONS))


MATURITY_SCHEMA = {"type": "object", "required": ["id"], "properties": {
    "id": {"type": "string"}, "balance": {"type": "number", "minimum": -995}}}
SQL_MATURITY = """
WITH r AS (SELECT c_nationkey AS k, 'col_' || c_nationkey AS collection, c_custkey AS i, c_acctbal
  FROM customer),
m AS (SELECT collection, k, count(*) AS n, count(*) FILTER (WHERE c_acctbal < -995) AS invalid,
    count(*) FILTER (WHERE i % 31 = 0) AS unsourced, count(*) FILTER (WHERE i % 29 = 0) AS unproven,
    max(CASE WHEN i % 37 = 0 THEN 1 ELSE 0 END) AS bare FROM r GROUP BY 1, 2),
p AS (SELECT collection, unnest([
    {'i': 0, 'rung': 'wood', 'predicate': 'exists', 'ok': true, 'detail': NULL},
    {'i': 1, 'rung': 'bronze', 'predicate': 'has schema', 'ok': k % 10 <> 9, 'detail': 'no schema declared'},
    {'i': 2, 'rung': 'bronze', 'predicate': 'validates', 'ok': k % 10 <> 9 AND invalid = 0,
      'detail': CASE WHEN k % 10 = 9 THEN 0 ELSE invalid END || ' of ' || n || ' fail the schema'},
    {'i': 3, 'rung': 'bronze', 'predicate': 'every record sourced', 'ok': unsourced = 0,
      'detail': unsourced || ' of ' || n || ' have none of sources, source_urls'},
    {'i': 4, 'rung': 'silver', 'predicate': 'lineage names inputs', 'ok': k % 4 <> 0 AND k % 3 <> 1,
      'detail': 'lineage without inputs or projected_from'},
    {'i': 5, 'rung': 'gold', 'predicate': 'schema versioned', 'ok': k % 2 = 1 AND k % 10 <> 9,
      'detail': 'the schema declares no version'},
    {'i': 6, 'rung': 'gold', 'predicate': 'dates carry evidence', 'ok': unproven = 0,
      'detail': unproven || ' of ' || n || ' dated without provenance'},
    {'i': 7, 'rung': 'gold', 'predicate': 'no bare opinion', 'ok': bare = 0, 'detail': 'tier'},
    {'i': 8, 'rung': 'iridium', 'predicate': 'declared cadence', 'ok': k % 4 <> 0, 'detail':
      'lineage without cadence'},
    {'i': 9, 'rung': 'iridium', 'predicate': 'self reports', 'ok': false, 'detail': 'lineage without maturity'}
  ]) AS v FROM m)"""


def maturity_predicates(spark, sf):
    """Customers by nation as collections: records, schemas and lineage that pass and fail."""
    k, i = F.col("c_nationkey"), F.col("c_custkey")
    name = F.concat(F.lit("col_"), k.cast("string"))
    records = table(spark, sf, "customer").select(name.alias("collection"), F.to_json(F.struct(
        i.cast("string").alias("id"), F.col("c_acctbal").alias("balance"),
        F.when(i % 31 != 0, F.array(F.lit("https://s"))).alias("sources"),
        F.lit("2026-01-01").alias("published_at"), F.when(i % 37 == 0, "A").alias("tier"),
        F.struct(F.when(i % 29 != 0, "x").alias("published_at")).alias("_provenance"))).alias("raw"))
    nations = [r[0] for r in table(spark, sf, "customer").select("c_nationkey").distinct().collect()]
    schemas = {f"col_{n}": None if n % 10 == 9 else MATURITY_SCHEMA | ({"version": "1"} if n % 2 else {})
               for n in sorted(nations)}  # at most one per nation
    lineage = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey").filter(
        k % 4 != 0).select(name.alias("collection"), F.to_json(F.struct(
            F.when(k % 3 == 0, F.array(F.lit("a"))).alias("inputs"),
            F.when(k % 3 == 2, "b").alias("projected_from"), F.lit("weekly").alias("cadence"),
            F.lit("").alias("maturity"))).alias("raw"))
    return maturity.measured(records, schemas, lineage)


@query("maturity_predicates", "Q24", SQL_MATURITY + """
SELECT collection, v.predicate AS predicate, v.ok AS ok, CASE WHEN NOT v.ok THEN v.detail END AS detail
FROM p""")
def _(spark, sf):
    return maturity_predicates(spark, sf)


@query("maturity_ladder", "Q24", SQL_MATURITY + """
, f AS (SELECT collection, min(v.i) AS i FROM p WHERE NOT v.ok GROUP BY 1)
SELECT f.collection, CASE v.rung WHEN 'bronze' THEN 'wood' WHEN 'silver' THEN 'bronze' WHEN 'gold'
    THEN 'silver' WHEN 'iridium' THEN 'gold' END AS rung, v.predicate AS next_task
FROM f JOIN p ON f.collection = p.collection AND f.i = v.i""")
def _(spark, sf):
    return maturity.assess(maturity_predicates(spark, sf)).select("collection", "rung", "next_task")


@query("all_checks", "C15 Q1 Q3 Q11", EV + """
SELECT 'events' AS collection, '$.year: minimum' AS rule, count(*) AS n, true AS gating FROM events_v
  WHERE year < 1996 HAVING count(*) > 0
UNION ALL SELECT 'events', '$.year: maximum', count(*), true FROM events_v WHERE year > 2000
  HAVING count(*) > 0
UNION ALL SELECT 'lines', 'duplicate id', count(*), false FROM (SELECT 1 FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _(spark, sf):
    schema = {"properties": {"year": EVENT_SCHEMA["properties"]["year"]}}
    docs = RU.schema_violations(event_documents(spark, sf), "events", "id", "raw", schema)
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("id"))
    _, summary = PL.run_checks(docs, Q.unique_ids(lines, "lines", "id"), reporting=["lines"])
    return summary.select("collection", "rule", "n", "gating")


def check_tables(spark, sf):
    """The tables that the rule jobs read."""
    k = F.col("o_orderkey")
    feed = raw_candidates(spark, sf).withColumn("reviews", F.array(F.struct(
        F.when(k % 61 == 0, "").otherwise("ada").alias("reviewer"))))
    supplier = F.col("s_suppkey")
    return {
        "feed": feed, "events": event_documents(spark, sf),
        "lines": table(spark, sf, "lineitem").select(F.concat_ws(
            "/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id")),
        "tombstones": table(spark, sf, "orders").filter(k % 97 == 0).select(F.concat(
            F.lit("feed"), (k % 6).cast("string"), F.lit(":"), k.cast("string")).alias("id")),
        "registry": table(spark, sf, "supplier").select(
            F.concat(F.when(supplier % 7 == 0, "_").otherwise(""), F.lit("s"), supplier.cast("string"))
            .alias("source_id"), F.when(supplier % 2 == 0, "2026").alias("source_available_at"),
            F.when(supplier % 3 != 0, F.array(F.lit("e"))).alias("evidence"))}


def rule_jobs():
    """Rule jobs of five tables; those of the feed share its scan."""
    return [
        C.RowJob("candidates", "feed", "id", tuple(Q.admission_rules()), unique=True),
        C.RowJob("opinions", "feed", "id", tuple(Q.opinion_rules("raw", ("salience", "salience_tier",
                                                                     "game_facing")))),
        C.RowJob("reviews", "feed", "id", tuple(Q.attribution_rules())),
        C.RowJob("events", "events", "id", schema={"properties": {"year": EVENT_SCHEMA["properties"]["year"]}},
             unique=True),
        C.RowJob("ascii", "events", "id", (RU.Rule("non-ascii", F.col("raw").rlike(r"[^\x00-\x7F]")),),
             gates=False),
        C.RowJob("lines", "lines", "id", unique=True, gates=False),
        C.TableJob(("feed", "tombstones"), Q.tombstones_honoured),
        C.TableJob(("registry",), Q.registry_evidence)]


@query("all_rule_jobs", "C15 Q1 Q2 Q3 Q4 Q5 Q6 Q7 Q8 Q11 Q22", EV + """
, c AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE 'feed' || (o_orderkey % 6)
    || ':' || o_orderkey END AS id FROM orders),
r AS (
  SELECT collection, rule, gates FROM c, LATERAL (VALUES
    ('candidates', 'missing id', k % 37 = 0, true), ('candidates', 'unknown kind', k % 41 = 0, true),
    ('candidates', 'license missing spdx', k % 47 = 0 AND k % 43 <> 0, true),
    ('candidates', 'share-alike licence', k % 43 = 0, true),
    ('candidates', 'clock occurred_at absent', k % 59 = 0, true),
    ('candidates', 'clock published_at absent', k % 59 = 0, true),
    ('candidates', 'clock source_available_at absent', k % 59 = 0, true),
    ('opinions', 'bare salience', k % 53 = 0, true), ('reviews', 'unattributed review', k % 61 = 0, true),
    ('candidates', 'tombstoned record present', k % 97 = 0 AND k % 37 <> 0, true))
    v(collection, rule, broken, gates) WHERE broken
  UNION ALL SELECT 'candidates', 'duplicate id', true FROM (SELECT id FROM c GROUP BY id HAVING count(*) > 1)
  UNION ALL SELECT 'events', '$.year: minimum', true FROM events_v WHERE year < 1996
  UNION ALL SELECT 'events', '$.year: maximum', true FROM events_v WHERE year > 2000
  UNION ALL SELECT 'events', 'duplicate id', true FROM (SELECT id FROM events_v GROUP BY id HAVING count(*) > 1)
  UNION ALL SELECT 'lines', 'duplicate id', false FROM (SELECT 1 FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'registry', 'date without evidence', true FROM supplier
    WHERE s_suppkey % 7 <> 0 AND s_suppkey % 2 = 0 AND s_suppkey % 3 = 0),
t AS (SELECT count(*) FILTER (WHERE gates) AS gating, count(*) FILTER (WHERE NOT gates) AS reporting FROM r)
SELECT collection, rule, gates, count(*) AS n, gating AS all_gating, reporting AS all_reporting
FROM r, t GROUP BY ALL""")
def _(spark, sf):
    report = C.run_jobs(rule_jobs(), check_tables(spark, sf))
    return report.verdicts.select("collection", "rule", "gates", "n", F.lit(report.gating).alias(
        "all_gating"), F.lit(report.reporting).alias("all_reporting"))


@query("published_versions", "Q23", EV + """
SELECT 'first' AS attempt, false AS refused, count(*) AS readable, 'old' AS version FROM events_v
UNION ALL SELECT 'one bad row', true, count(*), 'old' FROM events_v
UNION ALL SELECT 'cleaning breaks a row', true, count(*), 'old' FROM events_v
UNION ALL SELECT 'mended', false, count(*), 'new' FROM events_v""")
def _(spark, sf):
    """Each attempt publishes all events or nothing; readers see the old version or the new one."""
    schema = {"type": "object", "required": ["title"], "properties": {
        "title": {"type": "string", "minLength": 5}, "year": {"type": "integer"}}}
    rows = spread(QL.timeline_events(spark, sf)).select("id", "title", "year", F.lit("old").alias("version"))
    newer, root = rows.withColumn("version", F.lit("new")), new_path(spark, "published")
    first = rows.agg(F.min("id")).first()[0]
    broken = F.when(F.col("id") == first, "bad").otherwise(F.col("title"))
    attempts = [("first", rows, lambda d: d), ("one bad row", newer.withColumn("title", broken), lambda d: d),
                ("cleaning breaks a row", newer, lambda d: d.withColumn("title", broken)),
                ("mended", newer, lambda d: d.withColumn("title", F.trim("title")))]
    out = None
    for name, df, clean in attempts:
        refused = False
        try:
            publish.publish_version(df, root, lambda d: PL.event_errors(d, schema), clean)
        except publish.RefusedWrite:
            refused = True
        part = publish.read_version(spark, root).groupBy("version").agg(F.count("*").alias("readable")).select(
            F.lit(name).alias("attempt"), F.lit(refused).alias("refused"), "readable", "version")
        out = part if out is None else out.unionByName(part)
    return out
