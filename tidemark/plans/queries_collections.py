"""Queries over events, watch atoms, labs, terms, grants and catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import evidence as E
from tidemark.functions import research as R
from tidemark.functions import text as X
from tidemark.operators import aggregates as A
from tidemark.operators import dedup, filters, joins, setops, similarity
from tidemark.plans import collections as PL
from tidemark.plans import research as PR
from tidemark.plans.registry import QUERIES, query
from tidemark.plans.standins import cte, heavy, standin, table
from tidemark.sinks import publish
from tidemark.sources import overlays
from tidemark.workspace import durable

_STRINGS = "array<string>"


def timeline_events(spark, sf):
    """Timeline events with their impact, source and tag arrays."""
    base = standin(spark, sf, "events_v")
    some = lambda name, c: F.when(F.col(c).isNotNull(), R.impact(name, F.col(c)))
    return base.withColumns({
        "impacts": F.array_compact(F.array(some("research", "research_change"),
                                           some("papers", "papers_change"),
                                           some("ethics_risk", "ethics_change"))),
        "sources": F.when(F.col("sources_text") == "", F.array().cast(_STRINGS))
        .otherwise(F.split("sources_text", r"\|")),
        "tags": F.split("tags_text", r"\|")})


EV = cte("events_v")
SQL_VARIABLES = """(SELECT id, 'research' AS variable FROM events_v WHERE research_change IS NOT NULL
  UNION ALL SELECT id, 'papers' FROM events_v
  UNION ALL SELECT id, 'ethics_risk' FROM events_v WHERE ethics_change IS NOT NULL)"""


# --- counts ------------------------------------------------------------------------

@query("event_tallies", "A1 A7 C10 A3b", EV + """
SELECT 'year' AS field, CAST(year AS VARCHAR) AS value, count(*) AS n FROM events_v GROUP BY year
UNION ALL SELECT 'category', category, count(*) FROM events_v GROUP BY category
UNION ALL SELECT 'rarity', rarity, count(*) FROM events_v GROUP BY rarity
UNION ALL SELECT 'doom_impact', coalesce(CAST(doom_impact AS VARCHAR), 'None'), count(*)
  FROM events_v GROUP BY 2""")
def _(spark, sf):
    return A.tally(timeline_events(spark, sf), "year", "category", "rarity", "doom_impact",
                   as_text=True)


@query("impact_variables", "A2 T6", EV + f"""
SELECT variable, count(*) AS n FROM {SQL_VARIABLES} GROUP BY 1 ORDER BY n DESC LIMIT 10""")
def _(spark, sf):
    return A.impact_variables(timeline_events(spark, sf)).orderBy(F.desc("n")).limit(10)


@query("sign_buckets", "A3", EV + """
SELECT CAST(sum(CAST(doom_impact IS NULL AS INT)) AS BIGINT) AS "null",
  CAST(sum(CAST(doom_impact < 0 AS INT)) AS BIGINT) AS negative,
  CAST(sum(CAST(doom_impact = 0 AS INT)) AS BIGINT) AS zero,
  CAST(sum(CAST(doom_impact > 0 AS INT)) AS BIGINT) AS positive FROM events_v""")
def _(spark, sf):
    return A.sign_buckets(timeline_events(spark, sf), "doom_impact")


@query("value_distribution", "A3b", EV + """
SELECT coalesce(CAST(doom_impact AS VARCHAR), 'None') AS value, count(*) AS n FROM events_v
GROUP BY 1""")
def _(spark, sf):
    return A.value_distribution(timeline_events(spark, sf), "doom_impact")


@query("year_range", "A4", EV + "SELECT min(year) AS year_min, max(year) AS year_max FROM events_v")
def _(spark, sf):
    return A.year_range(timeline_events(spark, sf))


@query("legacy_summary", "A23", EV + """
SELECT count(*) AS total_events,
  CAST(sum(CAST(category = 'organizational_crisis' AS INT)) AS BIGINT) AS organizational_crises,
  CAST(sum(CAST(category = 'technical_research_breakthrough' AS INT)) AS BIGINT)
    AS technical_breakthroughs,
  CAST(sum(CAST(rarity = 'legendary' AS INT)) AS BIGINT) AS legendary_events,
  CAST(sum(CAST(doom_impact > 0 AS INT)) AS BIGINT) AS doom_increasing,
  min(year) || '-' || max(year) AS year_range FROM events_v""")
def _(spark, sf):
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    return timeline_events(spark, sf).agg(
        F.count("*").alias("total_events"),
        is_("category", "organizational_crisis").alias("organizational_crises"),
        is_("category", "technical_research_breakthrough").alias("technical_breakthroughs"),
        is_("rarity", "legendary").alias("legendary_events"),
        F.count_if(F.col("doom_impact") > 0).alias("doom_increasing"),
        F.concat_ws("-", F.min("year").cast("string"), F.max("year").cast("string"))
        .alias("year_range"))


@query("events_newest_first", "A27 T8", EV + """
SELECT id, year, title FROM events_v ORDER BY year DESC, id LIMIT 50 OFFSET 100""")
def _(spark, sf):
    return filters.page(timeline_events(spark, sf).select("id", "year", "title"),
                        [F.desc("year"), F.col("id")], 2, 50)


@query("events_by_year", "A27", EV + """
SELECT id, year, CAST(row_number() OVER (PARTITION BY year ORDER BY id) AS BIGINT) AS place,
  count(*) OVER (PARTITION BY year) AS in_year FROM events_v""")
def _(spark, sf):
    """Every year's events in order, each with its place and the number of the year's events."""
    return A.ordered_groups(timeline_events(spark, sf).select("id", "year"), "year", [F.col("id")],
                            "place", "in_year")


@query("description_quality", "A6 C14", EV + """
SELECT count(*) AS total, CAST(sum(CAST(length(description) < 60 AS INT)) AS BIGINT) AS under_60_chars,
  CAST(sum(CAST(lower(description) LIKE 'introduction%' AS INT)) AS BIGINT)
    AS starts_with_introduction,
  CAST(sum(CAST(lower(description) LIKE '%introduction%' AS INT)) AS BIGINT)
    AS contains_introduction_anywhere,
  CAST(sum(CAST(trim(description) = '' AS INT)) AS BIGINT) AS empty,
  round(CAST(100 AS DOUBLE) * sum(CAST(length(description) < 60 AS INT)) / count(*), 1)
    AS under_60_chars_pct,
  round(CAST(100 AS DOUBLE) * sum(CAST(lower(description) LIKE 'introduction%' AS INT))
    / count(*), 1) AS starts_with_introduction_pct,
  round(CAST(100 AS DOUBLE) * sum(CAST(lower(description) LIKE '%introduction%' AS INT))
    / count(*), 1) AS contains_introduction_anywhere_pct,
  CAST(min(length(description)) AS INT) AS length_min,
  CAST(floor(median(length(description))) AS BIGINT) AS length_median,
  CAST(floor(avg(length(description))) AS BIGINT) AS length_mean,
  CAST(max(length(description)) AS INT) AS length_max FROM events_v""")
def _(spark, sf):
    return PL.quality_report(timeline_events(spark, sf))[0]


@query("import_families", "F50 A6", cte("research") + """
SELECT CASE WHEN source LIKE 'arxiv%' THEN 'arxiv' WHEN source LIKE 'distill%' THEN 'distill'
  WHEN source LIKE 'alignmentforum%' THEN 'alignmentforum' ELSE 'hand_authored' END AS family,
  count(*) AS n FROM research GROUP BY 1""")
def _(spark, sf):
    rows = standin(spark, sf, "research").select(F.concat_ws("_", "source", "id").alias("id"))
    return A.import_families(rows, "id")


@query("field_profile", "A7 S3", """
WITH e AS (SELECT event_id, unnest(json_keys(props)) AS field, props FROM events)
SELECT field, string_agg(DISTINCT CASE json_type(props, '$.' || field) WHEN 'UBIGINT' THEN 'int'
    WHEN 'BIGINT' THEN 'int' WHEN 'VARCHAR' THEN 'str' ELSE json_type(props, '$.' || field) END,
    ', ') AS types, count(*) AS present,
  round(CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM events), 1) AS present_pct
FROM e GROUP BY 1""")
def _(spark, sf):
    return A.field_profile(table(spark, sf, "events"), "props")


# --- exports ---------------------------------------------------------------------------

@query("collection_manifest", "K4", EV + """
SELECT count(*) AS total_events, (SELECT string_agg(y, '|' ORDER BY y) FROM (SELECT DISTINCT
    CAST(year AS VARCHAR) AS y FROM events_v)) AS years,
  (SELECT string_agg(c, '|' ORDER BY c) FROM (SELECT DISTINCT category AS c FROM events_v))
    AS categories FROM events_v""")
def _(spark, sf):
    return publish.collection_manifest(timeline_events(spark, sf)).select(
        "total_events", F.array_join(F.col("years").cast(_STRINGS), "|").alias("years"),
        F.array_join("categories", "|").alias("categories"))


@query("dataset_catalogue", "K5", """
WITH o AS (SELECT CAST(year(o_orderdate) AS INT) AS y FROM orders),
l AS (SELECT CAST(year(l_shipdate) AS INT) AS y FROM lineitem)
SELECT 'orders' AS dataset, count(*) AS count, (SELECT string_agg(CAST(y AS VARCHAR), '|' ORDER BY y)
  FROM (SELECT DISTINCT y FROM o)) AS years FROM o
UNION ALL SELECT 'shipments', count(*), (SELECT string_agg(CAST(y AS VARCHAR), '|' ORDER BY y)
  FROM (SELECT DISTINCT y FROM l)) FROM l
UNION ALL SELECT '(total)', (SELECT count(*) FROM o) + (SELECT count(*) FROM l),
  (SELECT string_agg(CAST(y AS VARCHAR), '|' ORDER BY y) FROM
    (SELECT y FROM o UNION SELECT y FROM l))""")
def _(spark, sf):
    sets = {"orders": table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")),
            "shipments": table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"))}
    return publish.catalogue(sets).select(
        "dataset", "count", F.array_join(F.col("years").cast(_STRINGS), "|").alias("years"))


@query("light_index", "K3", EV + "SELECT id, title, year, category, rarity FROM events_v")
def _(spark, sf):
    return publish.light_index(timeline_events(spark, sf))


# --- filters ----------------------------------------------------------------------------

@query("event_filter", "P12", EV + """
SELECT id, year, category, rarity FROM events_v
WHERE category IN ('organizational_crisis', 'funding_catastrophe') AND year >= 1996
  AND year <= 1999 AND ethics_change IS NOT NULL AND (o_orderkey IS NOT NULL AND
  (contains(tags_text, 'c3') OR contains(tags_text, '|f|'))) AND rarity = 'common'
ORDER BY year DESC, id LIMIT 200""")
def _(spark, sf):
    return _filtered(spark, sf).orderBy(F.desc("year"), "id").limit(200)


def _filtered(spark, sf):
    found = filters.events(timeline_events(spark, sf),
                           categories=["organizational_crisis", "funding_catastrophe"],
                           year_min=1996, year_max=1999, variables=["ethics_risk", "unknown"],
                           tags=["c3", "f"], rarity="common")
    return found.select("id", "year", "category", "rarity")


@query("event_filter_whole", "P6 P11",
       QUERIES["event_filter"].sql.removesuffix("\nORDER BY year DESC, id LIMIT 200"))
def _(spark, sf):
    """The filter without the limit, which is of P12 alone."""
    return _filtered(spark, sf)


SQL_OVERLAY = """overlay AS (SELECT DISTINCT 'ev_' || l_orderkey AS id, CASE l_orderkey % 3
  WHEN 0 THEN 'High' WHEN 1 THEN 'Low' ELSE '' END AS impact_level FROM lineitem
  WHERE l_discount > 0.09)"""


def overlay(spark, sf):
    k = F.col("l_orderkey")
    return table(spark, sf, "lineitem").filter("l_discount > 0.09D").select(
        F.concat(F.lit("ev_"), k.cast("string")).alias("id"),
        F.when(k % 3 == 0, "High").when(k % 3 == 1, "Low").otherwise("").alias("impact_level")
    ).distinct()


@query("browser_filter", "P7", EV + f""", {SQL_OVERLAY}
SELECT e.id, 'High' AS picked FROM events_v e JOIN overlay o USING (id)
WHERE o.impact_level = 'High' AND (contains(lower(title), 'event 7') OR contains(lower(description), 'event 7'))
UNION ALL SELECT e.id, 'unset' FROM events_v e LEFT JOIN overlay o USING (id)
WHERE coalesce(o.impact_level, '') = ''
  AND (contains(lower(title), 'event 7') OR contains(lower(description), 'event 7'))""")
def _(spark, sf):
    found = filters.events(timeline_events(spark, sf), text="Event 7")
    levels = overlay(spark, sf)
    return filters.by_overlay_level(found, levels, "id", "High").select(
        "id", F.lit("High").alias("picked")).unionByName(
        filters.by_overlay_level(found, levels, "id", "unset").select(
            "id", F.lit("unset").alias("picked")))


@query("overlay_presence", "J6 P6", EV + f""", {SQL_OVERLAY}
SELECT id, id IN (SELECT id FROM overlay) AS has_overlay FROM events_v""")
def _(spark, sf):
    ev, ov = timeline_events(spark, sf), overlay(spark, sf)
    return filters.has_overlay(ev, ov, "id", True).select("id", F.lit(True).alias("has_overlay")) \
        .unionByName(filters.has_overlay(ev, ov, "id", False).select(
            "id", F.lit(False).alias("has_overlay")))


@query("overlay_coverage", "A25", EV + f""", {SQL_OVERLAY}
SELECT count(o.id) AS with_overlay, count(*) AS total,
  round(CAST(100 AS DOUBLE) * count(o.id) / count(*), 1) AS coverage_pct
FROM events_v e LEFT JOIN overlay o ON e.id = o.id""")
def _(spark, sf):
    return A.overlay_coverage(timeline_events(spark, sf), overlay(spark, sf), "id")


@query("overlay_export", "K8", EV + f""", {SQL_OVERLAY}
SELECT e.id, o.impact_level FROM events_v e LEFT JOIN overlay o ON e.id = o.id
WHERE e.rarity = 'rare'""")
def _(spark, sf):
    out = publish.with_overlay(filters.events(timeline_events(spark, sf), rarity="rare"),
                               overlay(spark, sf), "id")
    return out.select("id", F.col("_custom_metadata.impact_level").alias("impact_level"))


@query("display_projection", "P21 P14", EV + """
SELECT title, CAST(year AS VARCHAR) AS year, description,
  CASE category WHEN 'organizational_crisis' THEN 'Organizational Crisis'
    WHEN 'funding_catastrophe' THEN 'Funding Catastrophe'
    WHEN 'institutional_decay' THEN 'Institutional Decay'
    ELSE 'Technical Research Breakthrough' END AS category,
  upper(substr(rarity, 1, 1)) || substr(rarity, 2) AS rarity,
  replace(sources_text, '|', ', ') AS sources FROM events_v""")
def _(spark, sf):
    marked = timeline_events(spark, sf).withColumn("_source_file", F.lit("x"))
    return PR.display(filters.without_metadata(marked))


@query("factual_projection", "P15", EV + """
SELECT id, 'pending_peer_review' AS verification_status, 'To be determined' AS methodology,
  CAST(CASE WHEN sources_text = '' THEN 0 ELSE len(string_split(sources_text, '|')) END AS INT)
    AS n_sources,
  CASE WHEN sources_text = '' THEN NULL ELSE 'requires_proper_citation' END AS citation_status
FROM events_v""")
def _(spark, sf):
    out = PR.factual_only(timeline_events(spark, sf), F.lit("2026-01-01"), "doom_impact")
    return out.select("id", "verification_status", "probability_impact_analysis.methodology",
                      F.size("sources").alias("n_sources"),
                      F.get("sources", F.lit(0))["citation_status"].alias("citation_status"))


@query("clean_event_fields", "F39 C1", EV + """
SELECT id, array_to_string(list_sort(list_distinct(string_split(tags_text, '|'))), '|') AS tags,
  CASE WHEN sources_text = '' THEN '' ELSE array_to_string(list_sort(list_distinct(
    string_split(sources_text, '|'))), '|') END AS sources, title FROM events_v""")
def _(spark, sf):
    doubled = timeline_events(spark, sf).withColumns({
        "tags": F.concat("tags", F.transform("tags", F.upper)),
        "title": F.concat(F.lit(" "), "title", F.lit("\n"))})
    out = PR.clean_event_fields(doubled)
    return out.select("id", F.array_join("tags", "|").alias("tags"),
                      F.array_join("sources", "|").alias("sources"), "title")


# --- timeline precedence -------------------------------------------------------------------

FILES = ("historical.json", "funding.json", "crisis.json", "policy.json", "labs.json",
         "people.json")


def event_files(spark, sf):
    """One event in several files: the same id with another text per file."""
    k = F.col("l_linenumber")
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("p")).select(
        F.concat(F.lit("ev_"), F.col("l_orderkey").cast("string")).alias("id"),
        F.when(k < 7, F.get(F.array(*map(F.lit, FILES)), (k - 1).cast("int")))
        .otherwise("enriched").alias("file"),
        F.concat(F.lit("text “"), F.col("p").cast("string"), F.lit("”")).alias("title"))


SQL_FILES = """files AS (SELECT 'ev_' || l_orderkey AS id, CASE l_linenumber WHEN 1 THEN
    'historical.json' WHEN 2 THEN 'funding.json' WHEN 3 THEN 'crisis.json' WHEN 4 THEN
    'policy.json' WHEN 5 THEN 'labs.json' WHEN 6 THEN 'people.json' ELSE 'enriched' END
    AS file, l_linenumber AS rank, 'text "' || max(l_partkey) || '"' AS title
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


@query("precedence_merge", "C10 W7 U2 F3", f"""
WITH {SQL_FILES}
SELECT id, arg_max(title, rank) AS title, coalesce(arg_max(file, rank) FILTER (WHERE rank < 7),
  'enriched') AS provenance FROM files GROUP BY id""")
def _(spark, sf):
    rows = event_files(spark, sf)
    out = PL.timeline(rows.filter("file <> 'enriched'"),
                      rows.filter("file = 'enriched'").drop("file"), FILES)
    return out.select("id", "title", "provenance")


@query("last_file_wins", "W6 S4", f"""
WITH {SQL_FILES} SELECT id, arg_max(title, file) AS title, max(file) AS file FROM files GROUP BY id""")
def _(spark, sf):
    rows = event_files(spark, sf).withColumn("title", F.translate("title", "“”", '""'))
    return dedup.keep_last_file(rows, "id", "file").select("id", "title", "file")


@query("undeclared_files", "Q28", """
SELECT DISTINCT 'file' || l_linenumber AS file FROM lineitem WHERE l_linenumber > 3""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("file"), F.col("l_linenumber").cast("string")).alias("file"))
    return dedup.undeclared_files(rows, "file", ["file1", "file2", "file3"])


@query("build_difference", "U3 U4", EV + """
SELECT id, CASE WHEN o_orderkey % 50 = 0 THEN 'added' ELSE 'changed' END AS change FROM events_v
WHERE o_orderkey % 50 = 0 OR o_orderkey % 50 = 1
UNION ALL SELECT 'gone_' || p_partkey, 'removed' FROM part""")
def _(spark, sf):
    fresh = timeline_events(spark, sf).select("id", "title", "o_orderkey")
    old = fresh.filter("o_orderkey % 50 <> 0").withColumn(
        "title", F.when(F.col("o_orderkey") % 50 == 1, F.lit("old")).otherwise(F.col("title")))
    gone = table(spark, sf, "part").select(
        F.concat(F.lit("gone_"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("title"), F.lit(-1).cast("bigint").alias("o_orderkey"))
    return setops.build_diff(fresh, old.unionByName(gone), "id")


@query("rebuild_check", "U4", EV + """
SELECT id, side FROM events_v, (VALUES ('fresh'), ('committed')) s(side)
WHERE o_orderkey % 40 = 0""")
def _(spark, sf):
    fresh = timeline_events(spark, sf).select("id", "title", "rarity", "o_orderkey")
    old = fresh.withColumn("title", F.when(F.col("o_orderkey") % 40 == 0, F.lit("edited"))
                           .otherwise(F.col("title"))).withColumn("rarity", F.lit("volatile"))
    return setops.rebuild_differences(fresh, old, ["id", "title"]).select("id", "side")


@query("terms_on_both_sides", "U5 C11", """
SELECT DISTINCT c_nationkey AS term FROM customer INTERSECT
SELECT DISTINCT s_nationkey FROM supplier""")
def _(spark, sf):
    return setops.claimed_on_both(
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("term")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("term")), "term")


@query("upsert_events", "K12", EV + """
, fresh AS (SELECT id, 'new ' || title AS title, 'changed' AS category FROM events_v
    WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'new_' || p_partkey, p_name, 'part' FROM part)
SELECT coalesce(e.id, f.id) AS id, coalesce(f.title, e.title) AS title,
  coalesce(e.category, f.category) AS category FROM events_v e FULL JOIN fresh f ON e.id = f.id""")
def _(spark, sf):
    current = timeline_events(spark, sf).select("id", "title", "category", "o_orderkey")
    fresh = current.filter("o_orderkey % 3 = 0").select(
        "id", F.concat(F.lit("new "), "title").alias("title"), F.lit("changed").alias("category"))
    added = table(spark, sf, "part").select(
        F.concat(F.lit("new_"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("title"), F.lit("part").alias("category"))
    return publish.upsert(current.drop("o_orderkey"), fresh.unionByName(added), "id", ["title"])


# --- watch list ---------------------------------------------------------------------------------

def titles(spark, sf):
    """Names, kinds and brands of parts as titles: short by nature, read whole."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("d"), F.col("p_partkey").cast("string")).alias("id"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("title"))


SQL_TITLE = """t AS (SELECT 'd' || p_partkey AS id, concat_ws(' ', p_name, p_type, p_brand) AS title FROM part),
  toks AS (SELECT id, list_sort(list_distinct(list_filter(regexp_extract_all(lower(title),
    '[a-z0-9]+'), lambda w: length(w) > 2 AND NOT list_contains([{stop}], w)))) AS tokens
    FROM t)""".format(stop=", ".join(f"'{w}'" for w in K.TITLE_STOPWORDS))


def part_titles(spark, sf):
    """Names of parts, short by nature, as titles."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("title"))


SQL_PART_TITLE = "t AS (SELECT 'p' || p_partkey AS id, p_name AS title FROM part)" + SQL_TITLE[
    SQL_TITLE.index(",\n  toks AS"):]


@query("near_duplicate_titles", "J11 F12", f"""
WITH {SQL_TITLE}, x AS (SELECT id, len(tokens) AS n, unnest(tokens) AS token FROM toks),
shared AS (SELECT a.id AS ia, b.id AS ib, a.n AS na, b.n AS nb, count(*) AS s
  FROM x a JOIN x b ON a.token = b.token AND a.id <> b.id GROUP BY ALL)
SELECT t.id, count(s.ib) AS duplicates FROM toks t LEFT JOIN shared s ON t.id = s.ia
  AND CAST(s AS DOUBLE) / (na + nb - s) >= 0.5 WHERE len(t.tokens) > 0 GROUP BY t.id""")
def near_duplicates(spark, sf):
    members, edges = similarity.near_duplicate_titles(titles(spark, sf), "id", "title")
    return similarity.duplicate_counts(members, edges, "id").select("id", "duplicates")


@query("near_duplicate_part_names", "J11 F12",
       QUERIES["near_duplicate_titles"].sql.replace(SQL_TITLE, SQL_PART_TITLE))
def _(spark, sf):
    """The same over whole titles."""
    members, edges = similarity.near_duplicate_titles(part_titles(spark, sf), "id", "title")
    return similarity.duplicate_counts(members, edges, "id").select("id", "duplicates")


def cited_rows(spark, sf):
    """Events whose flags name other events by slug, some of them unknown."""
    i = F.col("event_id")
    slug = lambda n: F.concat(F.lit("ev_of_"), n.cast("string"))
    return table(spark, sf, "events").select(
        slug(i).alias("id"), F.concat(F.lit("Same matter as "), slug(i * 7 % 11000),
                                      F.lit(", see "), slug(i), F.lit(" and no_such_"),
                                      (i % 3).cast("string")).alias("flags"))


SQL_CITES = """c AS (SELECT DISTINCT 'ev_of_' || event_id AS id, unnest(['ev_of_' || (event_id * 7 % 11000),
    'ev_of_' || event_id, 'no_such_' || (event_id % 3)]) AS cited FROM events),
  k AS (SELECT 'ev_of_' || event_id AS id FROM events), cc AS (SELECT * FROM c WHERE cited <> id)"""


@query("citation_links", "J12", f"""
WITH {SQL_CITES}, hit AS (SELECT id, cited FROM cc WHERE cited IN (SELECT id FROM k))
SELECT id, cited AS other FROM hit UNION SELECT cited, id FROM hit""")
def _(spark, sf):
    rows = cited_rows(spark, sf)
    return similarity.citation_edges(similarity.citations(rows, "id", F.col("flags")), rows, "id")


@query("unresolved_citations", "J13 Q18", f"""
WITH {SQL_CITES}, served AS (SELECT 'ev_of_' || o_orderkey AS id FROM orders)
SELECT id, cited, CASE WHEN cited IN (SELECT id FROM served) THEN 'external' ELSE 'problem' END
  AS outcome FROM cc WHERE cited NOT IN (SELECT id FROM k)""")
def _(spark, sf):
    rows = cited_rows(spark, sf)
    served = table(spark, sf, "orders").select(
        F.concat(F.lit("ev_of_"), F.col("o_orderkey").cast("string")).alias("id"))
    cites = similarity.citations(rows, "id", F.col("flags"))
    bad, external = similarity.unresolved_citations(cites, rows, served, "id")
    return bad.withColumn("outcome", F.lit("problem")).unionByName(
        external.withColumn("outcome", F.lit("external"))).select("id", "cited", "outcome")


def scan_rows(spark, sf):
    """Claims of several scans: one slug per user and day, first record wins."""
    return table(spark, sf, "events").select(
        F.concat_ws("_", F.lit("user"), F.col("user_id").cast("string"),
                    F.date_format("ts", "yyyyMMdd")).alias("slug"),
        F.col("event_type").alias("scans"), "event_id",
        F.concat(F.lit("claim "), F.col("event_id").cast("string")).alias("title"),
        F.array(F.concat(F.lit("https://s.example/"), F.col("event_type")),
                F.concat(F.lit("https://s.example/"), (F.col("event_id") % 4).cast("string")))
        .alias("sources"))


@query("merge_by_slug", "A18 S15", """
WITH r AS (SELECT 'user_' || user_id || '_' || strftime(ts, '%Y%m%d') AS slug, event_type, event_id,
  'https://s.example/' || event_type AS s0, 'https://s.example/' || (event_id % 4) AS s1 FROM events),
u AS (SELECT slug, src, min(event_id * 2 + p) AS place FROM (SELECT slug, s0 AS src, event_id, 0 AS p FROM r
  UNION ALL SELECT slug, s1, event_id, 1 FROM r) GROUP BY 1, 2),
us AS (SELECT slug, string_agg(src, '|' ORDER BY place) AS sources FROM u GROUP BY 1)
SELECT r.slug, 'claim ' || min(event_id) AS title, array_to_string(list_sort(list_distinct(
  list(event_type))), '|') AS scans, any_value(us.sources) AS sources
FROM r JOIN us ON r.slug = us.slug GROUP BY r.slug""")
def _(spark, sf):
    merged = dedup.merge_first_seen(scan_rows(spark, sf), "slug", "event_id", ["title"],
                                    sorted_sets=["scans"], ordered_sets=["sources"])
    return merged.select("slug", "title", F.array_join("scans", "|").alias("scans"),
                         F.array_join("sources", "|").alias("sources"))


@query("merged_sources", "A18", """
WITH r AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'user_' || user_id END AS slug, event_id,
  'https://s.example/' || event_type AS s0, 'https://s.example/' || event_id AS s1 FROM events),
u AS (SELECT slug, item, min(event_id * 2 + p) AS seen FROM (SELECT slug, s0 AS item, event_id, 0 AS p FROM r
  UNION ALL SELECT slug, s1, event_id, 1 FROM r) GROUP BY 1, 2)
SELECT slug, item, row_number() OVER (PARTITION BY slug ORDER BY seen) AS place FROM u""")
def _(spark, sf):
    """Sources of merged claims as rows with places; one slug has a third of all of them."""
    k = F.col("event_id")
    rows = table(spark, sf, "events").select(
        F.when(k % 3 == 0, "hot").otherwise(F.concat(F.lit("user_"), F.col("user_id").cast("string")))
        .alias("slug"), k, F.array(F.concat(F.lit("https://s.example/"), "event_type"),
                                   F.concat(F.lit("https://s.example/"), k.cast("string"))).alias("sources"))
    return dedup.merged_children(rows, "slug", "event_id", "sources")


def flagged_claims(spark, sf):
    """Parts as claims of two scans; some flags name other claims, some name nothing known."""
    k = F.col("p_partkey")
    slug = lambda n: F.concat(F.lit("part_no_"), n.cast("string"))
    flags = F.when(k % 4 == 0, F.array(
        F.concat(F.lit("same event as "), slug(k * 7 % 1501 + 1)), F.lit("not in_any_list"),
        F.concat(F.lit("see "), slug(k)))).when(k % 4 == 1, F.array(F.concat(
            F.lit("compare "), slug(k + 1), F.lit(" and "), slug(k + 2)))).otherwise(
        F.array().cast(_STRINGS))
    claim = table(spark, sf, "part").select(
        F.lit("a.json").alias("file"), k.alias("pos"), F.lit("scan_a").alias("scan_id"),
        slug(k).alias("slug"), F.col("p_name").alias("title"),
        F.when(k % 10 != 0, F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (
            k % 60).cast("int")), "yyyy-MM-dd")).alias("date"),
        F.lit("action").alias("date_kind"), F.lit("d").alias("description"),
        F.array(F.concat(F.lit("https://s.example/"), slug(k))).alias("sources"),
        F.lit("w").alias("why_it_matters"), F.lit("high").alias("confidence"),
        flags.alias("flags"), F.lit(True).alias("primary_source_retrieved"))
    again = claim.filter("pos % 3 = 0").withColumns({"file": F.lit("b.json"), "scan_id": F.lit("scan_b")})
    return durable(claim.unionByName(again), "claims")


SQL_LINKS = SQL_PART_TITLE.replace("'p' ||", "'part_no_' ||") + """,
  dd AS (SELECT 'part_no_' || p_partkey AS id, CASE WHEN p_partkey % 10 <> 0
    THEN DATE '2026-01-01' + CAST(p_partkey % 60 AS INT) END AS d FROM part),
  x AS (SELECT toks.id, d, len(tokens) AS n, unnest(tokens) AS token FROM toks JOIN dd ON toks.id = dd.id),
  shared AS (SELECT a.id AS ia, b.id AS ib, a.n AS na, b.n AS nb, abs(a.d - b.d) AS gap, count(*) AS s
    FROM x a JOIN x b ON a.token = b.token AND a.id <> b.id GROUP BY ALL),
  near AS (SELECT ia AS id, ib AS other FROM shared WHERE CAST(s AS DOUBLE) / (na + nb - s) >= 0.5
    OR (CAST(s AS DOUBLE) / (na + nb - s) >= 0.3 AND gap <= 3)),
  c AS (SELECT p_partkey AS k, unnest(CASE p_partkey % 4 WHEN 0 THEN [p_partkey * 7 % 1501 + 1]
    WHEN 1 THEN [p_partkey + 1, p_partkey + 2] ELSE [] END) AS o FROM part),
  named AS (SELECT 'part_no_' || k AS id, 'part_no_' || o AS other FROM c
    WHERE k <> o AND o IN (SELECT p_partkey FROM part)),
  cited AS (SELECT id, other FROM named UNION SELECT other, id FROM named)"""


@query("watch_links", "C7 J11 J12", f"""
WITH {SQL_LINKS} SELECT id, other FROM near UNION SELECT id, other FROM cited""")
def _(spark, sf):
    """All pairs that the factored relations of the watch list stand for."""
    found = PL.watch_relations(PL.watch_atoms(flagged_claims(spark, sf)))
    return similarity.possible_duplicates(found.members, found.edges, found.cited, "id")


@query("watch_attention", "C7 J11 J12", f"""
WITH {SQL_LINKS}, n AS (SELECT id, count(*) AS n FROM near GROUP BY 1),
  o AS (SELECT id, count(*) AS n FROM (SELECT * FROM cited EXCEPT SELECT * FROM near) GROUP BY 1)
SELECT t.id, coalesce(n.n, 0) AS duplicates, coalesce(o.n, 0) AS cross_references,
  coalesce(n.n, 0) + coalesce(o.n, 0) > 0 AS needs_attention
FROM t LEFT JOIN n USING (id) LEFT JOIN o USING (id)""")
def _(spark, sf):
    """The same relations as counts: what each atom asks a reviewer to look at, without pairs."""
    found = PL.watch_relations(PL.watch_atoms(flagged_claims(spark, sf)))
    return PL.attention(found).select("id", "duplicates", "cross_references", "needs_attention")


@query("watch_list", "C7 J9 J12 A18", f"""
WITH {SQL_TITLE}, dd AS (SELECT t.id, DATE '2026-01-01' + CAST(substr(t.id, 2) AS INT) % 60 AS d
    FROM t), x AS (SELECT toks.id, d, len(tokens) AS n, unnest(tokens) AS token FROM toks
    JOIN dd ON toks.id = dd.id),
shared AS (SELECT a.id AS ia, b.id AS ib, a.n AS na, b.n AS nb, abs(a.d - b.d) AS gap,
  count(*) AS s FROM x a JOIN x b ON a.token = b.token AND a.id <> b.id GROUP BY ALL),
near AS (SELECT ia, count(*) AS n FROM shared WHERE CAST(s AS DOUBLE) / (na + nb - s) >= 0.5
  OR (CAST(s AS DOUBLE) / (na + nb - s) >= 0.3 AND gap <= 3) GROUP BY 1)
SELECT t.id, md5(t.title) AS title_md5, 'https://s.example/' || t.id AS sources,
  CASE WHEN len(tokens) > 0 THEN coalesce(near.n, 0) END AS duplicates,
  CASE WHEN CAST(substr(t.id, 2) AS INT) % 3 = 0 THEN 'watching' END AS watch_status
FROM t JOIN toks ON t.id = toks.id LEFT JOIN near ON t.id = near.ia""")
def _(spark, sf):
    return _watched(titles(spark, sf))


def _watched(named):
    """Titles as claims of two scans, with a prior list of decisions."""
    n = F.substring("id", 2, 12).cast("bigint")
    claim = named.select(
        F.lit("a.json").alias("file"), n.alias("pos"), F.lit("scan_a").alias("scan_id"),
        F.col("id").alias("slug"), "title", F.date_format(F.date_add(
            F.lit("2026-01-01").cast("date"), (n % 60).cast("int")), "yyyy-MM-dd").alias("date"),
        F.lit("action").alias("date_kind"), F.lit("d").alias("description"),
        F.array(F.concat(F.lit("https://s.example/"), "id")).alias("sources"),
        F.lit("w").alias("why_it_matters"), F.lit("high").alias("confidence"),
        F.array().cast(_STRINGS).alias("flags"), F.lit(True).alias("primary_source_retrieved"))
    again = claim.withColumns({"file": F.lit("b.json"), "scan_id": F.lit("scan_b"),
                               "title": F.lit("another title")})
    prior = claim.select(F.col("slug").alias("id"), F.when(F.col("pos") % 3 == 0, "watching")
                         .alias("watch_status"), *[
        F.lit(None).cast(_STRINGS if c == "cleared_for" else "string").alias(c)
        for c in K.WATCH_HUMAN_FIELDS if c != "watch_status"])
    out = PL.watch_list(durable(claim.unionByName(again), "claims"), prior, expand=False)
    return out.select("id", F.md5("title").alias("title_md5"),
                      F.array_join("sources", " ").alias("sources"), "duplicates", "watch_status")


@query("part_watch_list", "C7 J9 J12 A18",
       QUERIES["watch_list"].sql.replace(SQL_TITLE, SQL_PART_TITLE))
def _(spark, sf):
    """The same over whole titles."""
    return _watched(part_titles(spark, sf))


def atoms(spark, sf):
    """Watch atoms with human fields."""
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("atom_"), k.cast("string")).alias("id"), F.col("c_name").alias("title"),
        F.when(k % 5 != 0, F.concat(F.lit("2026-01-"), F.lpad((1 + k % 28).cast("string"), 2, "0")))
        .alias("date"), F.lit("action").alias("date_kind"), F.lit("text").alias("description"),
        F.lit(None).cast("string").alias("why_it_matters"),
        F.when(k % 7 == 0, F.array().cast(_STRINGS)).otherwise(F.array(F.lit("https://w.example")))
        .alias("sources"), F.lit(True).alias("primary_source_retrieved"),
        F.lit("high").alias("scan_confidence"), F.array().cast(_STRINGS).alias("scan_flags"),
        F.array("c_mktsegment").alias("scans"),
        F.when(k % 6 == 0, F.array(F.lit("atom_1"))).alias("possible_duplicate_of"),
        F.when(k % 3 == 0, "accepted").when(k % 3 == 1, "watching").alias("watch_status"),
        F.lit(None).cast("string").alias("watching_since"),
        F.lit("2026-02-01").alias("decided_on"),
        F.when(k % 11 != 0, "ada").alias("decided_by"), F.lit(None).cast("string")
        .alias("decision_note"), F.when(k % 2 == 0, "A").otherwise("B").alias("rating"),
        F.when(k % 4 == 0, F.array(F.lit("site"))).when(k % 4 == 1, F.array(F.lit("game")))
        .alias("cleared_for"))


SQL_ATOMS = """atoms AS (SELECT 'atom_' || c_custkey AS id, c_custkey AS k, c_mktsegment AS scan,
  CASE WHEN c_custkey % 5 <> 0 THEN '2026-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END
    AS date, CASE c_custkey % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'watching' END AS watch_status
  FROM customer)"""


@query("accepted_atoms", "C8 P16 P17 T3", f"""
WITH {SQL_ATOMS}
SELECT id, date AS occurred_at, 'ada' AS accepted_by, '' AS reasons FROM atoms
WHERE watch_status = 'accepted' AND date IS NOT NULL AND k % 7 <> 0 AND k % 11 <> 0
UNION ALL SELECT id, NULL, NULL, concat_ws('; ', CASE WHEN date IS NULL THEN 'no date' END,
  CASE WHEN k % 7 = 0 THEN 'no source' END, CASE WHEN k % 11 = 0 THEN 'no named decider' END)
FROM atoms WHERE watch_status = 'accepted' AND (date IS NULL OR k % 7 = 0 OR k % 11 = 0)""")
def _(spark, sf):
    served, blocked, _ = PL.accepted(atoms(spark, sf))
    null = F.lit(None).cast("string")
    return served.orderBy(F.coalesce("occurred_at", F.lit("")), "id").select(
        "id", "occurred_at", "accepted_by", F.lit("").alias("reasons")).unionByName(
        blocked.select("id", null.alias("occurred_at"), null.alias("accepted_by"),
                       F.array_join("reasons", "; ").alias("reasons")))


@query("watch_status_counts", "A10", f"""
WITH {SQL_ATOMS} SELECT coalesce(watch_status, 'undecided') AS watch_status, count(*) AS n
FROM atoms GROUP BY 1""")
def _(spark, sf):
    return PL.accepted(atoms(spark, sf))[2]


@query("watch_selectors", "P8 P9 T3", f"""
WITH {SQL_ATOMS}
SELECT id, 'cleared' AS pick FROM atoms WHERE k % 4 = 0 AND k % 2 = 0 AND date IS NOT NULL AND k % 7 <> 0
UNION ALL SELECT id, 'attention' FROM atoms WHERE k % 7 = 0 OR date IS NULL OR k % 6 = 0
UNION ALL SELECT id, 'queue' FROM atoms WHERE watch_status IN ('watching', 'accepted', 'rejected')
  AND scan = 'BUILDING'
UNION ALL SELECT * FROM (SELECT id, 'first' FROM atoms WHERE watch_status IS NULL
  ORDER BY coalesce(date, '9999'), id LIMIT 25)""")
def _(spark, sf):
    rows = atoms(spark, sf)
    picks = {
        "cleared": filters.watch(rows, platform="site", rating="A", dated=True, sourced=True),
        "attention": filters.watch(rows, needs_attention=True),
        "queue": filters.watch(rows, statuses=("watching", "accepted", "rejected"),
                               scan="BUILDING"),
        "first": filters.watch_order(filters.watch(rows, undecided=True), 25)}
    out = None
    for name, df in picks.items():
        part = df.select("id", F.lit(name).alias("pick"))
        out = part if out is None else out.unionByName(part)
    return out


@query("carried_fields", "J9 J10", f"""
WITH {SQL_ATOMS}, fresh AS (SELECT 'atom_' || c_custkey AS id FROM customer WHERE c_custkey % 10 <> 0
  UNION ALL SELECT 'atom_s' || s_suppkey FROM supplier)
SELECT f.id, a.watch_status, 'fresh' AS side FROM fresh f LEFT JOIN atoms a ON f.id = a.id
UNION ALL SELECT id, NULL, 'orphan' FROM atoms WHERE k % 10 = 0 AND (watch_status IS NOT NULL)""")
def _(spark, sf):
    prior = atoms(spark, sf).withColumn("note", F.lit(None).cast("string"))
    fresh = prior.filter("NOT id LIKE '%0'").select("id").unionByName(
        table(spark, sf, "supplier").select(
            F.concat(F.lit("atom_s"), F.col("s_suppkey").cast("string")).alias("id")))
    carried = joins.carry_forward(fresh, prior, "id", ["watch_status"])
    lost = joins.orphans(fresh, prior, "id", ["watch_status", "note"])
    return carried.select("id", "watch_status", F.lit("fresh").alias("side")).unionByName(
        lost.select("id", F.lit(None).cast("string").alias("watch_status"),
                    F.lit("orphan").alias("side")))


# --- labs -------------------------------------------------------------------------------------------

@query("name_completeness", "J7 U6", """
SELECT coalesce(c, s) AS nationkey, CASE WHEN c IS NULL THEN 'left' ELSE 'right' END AS missing_on
FROM (SELECT DISTINCT c_custkey AS c FROM customer) FULL JOIN
  (SELECT DISTINCT o_custkey * 2 AS s FROM orders) ON c = s WHERE c IS NULL OR s IS NULL""")
def _(spark, sf):
    return joins.unmatched(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("nationkey")),
        table(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("nationkey")),
        "nationkey")


def organisation_rows(spark, sf):
    k = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 8 == 0, "True").otherwise("").alias("flag"),
        F.when(F.col("o_orderkey") % 31 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date"),
        F.concat(F.lit("Org "), (k % 40).cast("string"), F.lit(", Org "),
                 (k % 7 + 100).cast("string"), F.lit(",")).alias("orgs"))


SQL_ORGS = """stats AS (SELECT org, count(*) AS n, min(d) AS first, max(d) AS last FROM (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, unnest(['Org ' || (o_custkey % 40),
    'Org ' || (o_custkey % 7 + 100)]) AS org FROM orders
  WHERE o_orderkey % 8 = 0 AND o_orderkey % 31 <> 0 AND year(o_orderdate) >= 1997) GROUP BY org)"""


@query("organisation_stats", "A8", f"WITH {SQL_ORGS} SELECT org, n, first, last FROM stats")
def _(spark, sf):
    return A.organisation_stats(organisation_rows(spark, sf), flag="flag", date="date",
                                organisations="orgs", since="1997")


def lab_research(spark, sf):
    k = F.col("s_suppkey")
    evidence = F.when(k % 6 != 0, F.struct(
        F.when(k % 5 == 0, "Wikipedia").when(k % 5 == 1, "Companies House")
        .when(k % 5 == 2, "Official blog").otherwise("Daily News").alias("publisher"),
        F.concat(F.lit("https://e.example/"), k.cast("string")).alias("url"),
        F.concat(F.lit("Founded in March "), (1980 + k % 40).cast("string")).alias("quote"),
        F.lit(None).cast("boolean").alias("date_in_quote")))
    founded = F.when(k % 6 != 0, F.concat((1980 + k % 40).cast("string"), F.lit("-"),
                                          F.when(k % 9 == 0, "04").otherwise("03")))
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("Org "), k.cast("string")).alias("name"), founded.alias("founded"),
        F.when((k % 6 != 0) | (k % 4 == 0), "month").alias("founded_precision"),
        evidence.alias("founded_evidence"), (k % 8 == 0).alias("founded_contested"),
        F.array().cast("array<struct<date:string,url:string,quote:string>>")
        .alias("founded_alternatives"), F.lit(None).cast(
            "struct<publisher:string,url:string,quote:string,date_in_quote:boolean>")
        .alias("status_evidence"), F.when(k % 10 == 0, "1975").alias("status_date"),
        F.lit("active").alias("status"),
        F.array(F.concat(F.lit("https://x.example/"), (k % 3).cast("string")))
        .alias("sources_extra"))


def lab_curation(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("Org "), k.cast("string")).alias("name"),
        F.array(F.concat(F.lit("Org "), (k % 7 + 100).cast("string")),
                F.concat(F.lit("Org "), k.cast("string"))).alias("aliases"),
        F.when(k % 2 == 0, "company").otherwise("university").alias("lab_kind"),
        F.when(k % 3 == 0, "epoch_frontier_model").otherwise("editorial")
        .alias("inclusion_basis"))


def built_labs(spark, sf):
    stats = A.organisation_stats(organisation_rows(spark, sf), flag="flag", date="date",
                                 organisations="orgs", since="1997")
    return PL.labs(lab_research(spark, sf), lab_curation(spark, sf), stats)


SQL_LABS = f"""{SQL_ORGS}, names AS (SELECT s_suppkey AS k, 'Org ' || s_suppkey AS name,
    unnest(['Org ' || s_suppkey, 'Org ' || (s_suppkey % 7 + 100), 'Org ' || s_suppkey]) AS org
    FROM supplier),
  tot AS (SELECT k, CAST(sum(n) AS BIGINT) AS n, min(first) AS first, max(last) AS last
    FROM names JOIN stats USING (org) GROUP BY k),
  labs AS (SELECT s_suppkey AS k, 'org_' || s_suppkey AS id, tot.n, tot.first, tot.last,
    CASE WHEN s_suppkey % 6 <> 0 THEN (1980 + s_suppkey % 40) || '-' ||
      CASE WHEN s_suppkey % 9 = 0 THEN '04' ELSE '03' END END AS founded,
    CASE WHEN s_suppkey % 6 = 0 THEN 'none' ELSE CASE s_suppkey % 5 WHEN 0 THEN 'secondary'
      WHEN 1 THEN 'registry' WHEN 2 THEN 'first_party' ELSE 'press' END END AS grade,
    CASE WHEN s_suppkey % 6 <> 0 THEN 'https://e.example/' || s_suppkey || ' ' ELSE '' END
      || 'https://x.example/' || (s_suppkey % 3) AS sources FROM supplier
    LEFT JOIN tot ON s_suppkey = tot.k)"""


@query("labs", "C9 J7 J8 F41 F47 F6", f"""
WITH {SQL_LABS}
SELECT id, n AS epoch_frontier_models, first AS epoch_first_frontier_model,
  last AS epoch_last_frontier_model, grade AS evidence_strength, sources FROM labs""")
def _(spark, sf):
    return built_labs(spark, sf).select(
        "id", "epoch_frontier_models", "epoch_first_frontier_model", "epoch_last_frontier_model",
        "evidence_strength", F.array_join("sources", " ").alias("sources"))


@query("lab_counts", "A9 A19", f"""
WITH {SQL_LABS}
SELECT 'inclusion_basis' AS field, CASE WHEN k % 3 = 0 THEN 'epoch_frontier_model' ELSE 'editorial'
  END AS value, count(*) AS n FROM labs GROUP BY 2
UNION ALL SELECT 'lab_kind', CASE WHEN k % 2 = 0 THEN 'company' ELSE 'university' END, count(*)
  FROM labs GROUP BY 2
UNION ALL SELECT 'evidence_strength', grade, count(*) FROM labs GROUP BY 2
UNION ALL SELECT 'status', 'active', count(*) FROM labs
UNION ALL SELECT 'undated', CAST(founded IS NULL AS VARCHAR), count(*) FROM labs GROUP BY 2
UNION ALL SELECT 'contested', CAST(k % 8 = 0 AS VARCHAR), count(*) FROM labs GROUP BY 2""")
def _(spark, sf):
    return PL.lab_counts(built_labs(spark, sf))


# --- taxonomy, grants, sheets ------------------------------------------------------------------------

@query("term_counts", "C11 A19", """
SELECT CASE p_size % 3 WHEN 0 THEN 'ruled' WHEN 1 THEN 'proposed' ELSE 'contested' END AS status,
  count(*) AS n FROM part GROUP BY 1""")
def _(spark, sf):
    return PL.taxonomy(part_terms(spark, sf), part_terms(spark, sf))[1]


def part_terms(spark, sf):
    s = F.col("p_size") % 3
    return table(spark, sf, "part").select(
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("term"),
        F.when(s == 0, "ruled").when(s == 1, "proposed").otherwise("contested").alias("status"))


@query("normalised_grants", "C13 F26 F29 F48", """
WITH g AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d FROM orders)
SELECT 'GR-' || coalesce(strftime(CASE WHEN k % 5 <> 4 THEN d END, '%Y'), 'UNKN') || '-'
    || CASE WHEN k < 999 THEN lpad(CAST(k + 1 AS VARCHAR), 3, '0') ELSE CAST(k + 1 AS VARCHAR) END
    AS grant_id,
  CASE k % 4 WHEN 0 THEN 1200 + c WHEN 1 THEN 12000 WHEN 2 THEN 3500000 END AS amount,
  CASE WHEN k % 5 <> 4 THEN strftime(d, '%Y-%m-%d') END AS grant_date,
  CASE k % 3 WHEN 0 THEN 'organization' WHEN 1 THEN 'individual' ELSE 'unknown' END AS recipient_type,
  CASE k % 5 WHEN 0 THEN 'Individual Fellowship' WHEN 1 THEN 'Research Grant'
    WHEN 2 THEN 'General Support' WHEN 3 THEN 'Project Grant' ELSE 'General Grant' END AS grant_type
FROM g""")
def _(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    rows = table(spark, sf, "orders").select(
        (k + 1).alias("position"),
        F.when(k % 3 == 0, "Deep Institute").when(k % 3 == 1, "Ada Byron").otherwise("")
        .alias("recipient"),
        F.when(k % 4 == 0, F.concat(F.lit("$"), F.format_number(F.col("o_custkey") + 1200, 0)))
        .when(k % 4 == 1, "12K").when(k % 4 == 2, " 3.5M").otherwise("abc").alias("amount_text"),
        F.when(k % 5 == 0, F.date_format(d, "MMMM d, yyyy")).when(k % 5 == 1, F.date_format(
            d, "d MMM yyyy")).when(k % 5 == 2, F.date_format(d, "yyyy/MM/dd")).when(
            k % 5 == 3, F.date_format(d, "MMM dd, yyyy")).otherwise("soon").alias("date_text"),
        F.when(k % 5 == 0, "A Fellowship").when(k % 5 == 1, "Safety research")
        .when(k % 5 == 2, "operational costs").otherwise(None).alias("description"),
        F.when(k % 5 == 3, "Project X").alias("focus_area"), F.lit("https://g").alias("source_url"))
    out = PL.grants(rows, "GR", "gr", F.lit("2026-01-01T00:00:00Z"))
    return out.select("grant_id", "amount", "grant_date", "recipient_type", "grant_type")


@query("evidence_grades", "F47", """
SELECT page_id, CASE WHEN contains(url, 'blog.') THEN 'first_party' WHEN contains(url, 'spam-farm')
  THEN 'secondary' ELSE 'press' END AS grade FROM pages""")
def _(spark, sf):
    url = F.col("url")
    publisher = F.when(F.contains(url, F.lit("blog.")), "Official blog").when(
        F.contains(url, F.lit("spam-farm")), "Wikipedia mirror").otherwise("Paper")
    return table(spark, sf, "pages").select(
        "page_id", E.grade(publisher, F.lit("https://n.example"), F.lit(True)).alias("grade"))


def sheet_rows(spark, sf):
    """Each order is a sheet block: a category on its first line only."""
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        F.col("event_type").alias("sheet"), k.alias("row_no"),
        F.when(k % 10 == 0, F.array(
            F.when(k % 20 == 0, "Entity").otherwise("Intent"), F.lit(" Level é "),
            F.col("props")))
        .otherwise(F.array(F.lit(None).cast("string"), F.concat(F.lit("L"), (k % 10).cast("string")),
                           F.col("props"))).alias("cells"))


@query("sheet_fill_down", "S13 W8 F51", """
WITH e AS (SELECT event_type AS sheet, event_id, props, CASE WHEN event_id % 10 = 0 THEN
    CASE WHEN event_id % 20 = 0 THEN 'Entity' ELSE 'Intent' END END AS head FROM events),
f AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS category FROM e)
SELECT sheet, event_id AS row_no, category, CASE WHEN head IS NULL THEN 'L' || (event_id % 10)
  ELSE 'Level e' END AS level, props AS description FROM f WHERE category IS NOT NULL""")
def _(spark, sf):
    return overlays.sectioned_levels(sheet_rows(spark, sf), ["Entity", "Intent", "Timing"])


@query("sheet_header_located", "S14", """
WITH h AS (SELECT event_type, min(event_id) AS head FROM events WHERE event_id % 9 = 0 GROUP BY 1)
SELECT e.event_type AS sheet, event_id AS row_no, CASE WHEN event_id % 9 = 0 THEN 'Title'
  ELSE 'x' || user_id END AS title FROM events e JOIN h USING (event_type) WHERE event_id > head""")
def _(spark, sf):
    """Rows under the first header of each sheet; a later header is a row of the table too."""
    k = F.col("event_id")
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("sheet"), k.alias("row_no"),
        F.when(k % 9 == 0, F.array(F.lit("Name"), F.lit("Title "))).otherwise(
            F.array(F.lit(""), F.concat(F.lit("x"), F.col("user_id").cast("string"))))
        .alias("cells"))
    return overlays.headed_table(rows).select("sheet", "row_no", F.col("record")["Title"].alias("title"))


@query("stripped_titles", "F4 F27", """
SELECT p_partkey, md5(trim(p_name, ' ' || chr(10))) AS title_md5,
  CAST(coalesce(TRY_CAST(substr(p_brand, 7, 2) AS INT), 2020) AS INT) AS year FROM part""")
def _(spark, sf):
    from tidemark.functions.dates import year_or
    padded = F.concat(F.lit(" \n"), "p_name", F.lit("\n  "))
    return table(spark, sf, "part").select(
        "p_partkey", F.md5(X.strip(padded)).alias("title_md5"),
        year_or(F.substring("p_brand", 7, 2)).alias("year"))


@query("stripped_texts", "F4 F27", """
SELECT doc_id, substr(md5(trim(text, ' ' || chr(10))), 1, 8) AS head,
  CAST(coalesce(TRY_CAST(substr(source, 4, 2) AS INT), 2020) AS INT) AS year FROM documents""")
def _(spark, sf):
    from tidemark.functions.dates import year_or
    return heavy(spark, sf, "documents").select(
        "doc_id", F.substring(F.md5(X.strip(F.col("text"))), 1, 8).alias("head"),
        year_or(F.substring("source", 4, 2)).alias("year"))
