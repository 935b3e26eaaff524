"""Queries over research records: clean, enrich, score, events, extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import research as R
from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.operators import dedup, filters
from tidemark.operators import ranking as RK
from tidemark.plans import research as PR
from tidemark.plans.registry import query
from tidemark.plans.standins import cte, heavy, standin, table
from tidemark.sinks import publish
from tidemark.streaming import incremental as INC
from tidemark.workspace import new_path

S = K.PY_SPACE_CLASS


def sql_trim(expr: str) -> str:
    return rf"regexp_replace({expr}, '^{S}+|{S}+$', '', 'g')"


WORD = K.WORD_CLASS


def research(spark, sf):
    """Research records with tags and authors as arrays."""
    return standin(spark, sf, "research").withColumns({
        "tags": F.split("tags_text", r"\|"), "authors": F.split("authors_text", r"\|")})


def sql_replace(expr: str, table_: dict[str, str]) -> str:
    for a, b in table_.items():
        expr = f"replace({expr}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return expr


def sql_ascii(expr: str, table_: dict[str, str], unknown: str) -> str:
    return (f"regexp_replace(strip_accents({sql_replace(expr, table_)}), "
            f"'[^\\x00-\\x7F]', '{unknown}', 'g')")


def sql_clean_text(col: str) -> str:
    lines = f"replace(replace({sql_trim(col)}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return sql_ascii(lines, K.CLEANING_SUBSTITUTIONS, "?")


def sql_any(hay: str, words) -> str:
    return "(" + " OR ".join(f"contains({hay}, '{w.replace(chr(39), chr(39) * 2)}')"
                             for w in words) + ")"


def sql_count(hay: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({hay}, '{w.replace(chr(39), chr(39) * 2)}') AS INT)"
                            for w in words) + ")"


SQL_DATE = r"""CASE WHEN date_published = '' OR regexp_matches(date_published,
  '^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})?)?$') THEN date_published
  ELSE coalesce(strftime(try_strptime(date_published,
    ['%Y-%m-%d', '%Y/%m/%d', '%m/%d/%Y', '%d/%m/%Y']), '%Y-%m-%d'), date_published) END"""
SQL_URL = r"""CASE WHEN contains(url, '?') THEN split_part(url, '?', 1) ||
  CASE WHEN len(list_filter(string_split(substr(url, strpos(url, '?') + 1), '&'),
      lambda p: NOT regexp_matches(p, '^utm_(source|medium|campaign|content|term)(=|$)'))) > 0
  THEN '?' || array_to_string(list_filter(string_split(substr(url, strpos(url, '?') + 1), '&'),
      lambda p: NOT regexp_matches(p, '^utm_(source|medium|campaign|content|term)(=|$)')), '&')
  ELSE '' END ELSE url END"""


@query("clean_documents", "C1 F1 F4 F20 F23 F39", cte("research") + f"""
SELECT id, md5({sql_clean_text('title')}) AS title_md5, md5({sql_clean_text('text')}) AS text_md5,
  {SQL_DATE} AS date_published, {SQL_URL} AS url,
  array_to_string(list_sort(list_distinct(list_transform(list_filter(
    string_split(tags_text, '|'), lambda t: t <> ''), lambda t: trim(lower(t))))), '|') AS tags,
  array_to_string(list_sort(list_distinct(list_transform(list_filter(
    string_split(authors_text, '|'), lambda t: t <> ''), lambda t: trim(t)))), '|') AS authors
FROM research""")
def _(spark, sf):
    rows = research(spark, sf).withColumns({"_file": F.col("lang"), "_ord": F.col("doc_id")})
    return PR.clean(rows).select(
        "id", F.md5("title").alias("title_md5"), F.md5("text").alias("text_md5"),
        "date_published", "url", F.array_join("tags", "|").alias("tags"),
        F.array_join("authors", "|").alias("authors"))


@query("keep_first_by_id", "W5 A24", """
SELECT lang, doc_id, id FROM (
  SELECT lang, doc_id, CAST(doc_id % 97 AS VARCHAR) AS id,
    row_number() OVER (PARTITION BY lang, doc_id % 97 ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1 OR CAST(id AS INT) = 5""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        "lang", "doc_id", F.when(F.col("doc_id") % 97 != 5, (F.col("doc_id") % 97).cast("string"))
        .alias("id"))
    kept = dedup.keep_first(docs, ["lang"], "id", "doc_id")
    return kept.withColumn("id", F.coalesce("id", F.lit("5")))


@query("summary_of_text", "F2 F5 F51", f"""
WITH a AS (SELECT doc_id, trim(regexp_replace({sql_ascii('text', K.INGEST_SUBSTITUTIONS, '')},
    '{S}+', ' ', 'g')) AS t FROM documents),
b AS (SELECT doc_id, t, substr(t, 1, 400) AS h FROM a),
c AS (SELECT doc_id, t, h, strpos(reverse(h), ' ') AS p FROM b)
SELECT doc_id, CASE WHEN length(t) <= 400 THEN t ELSE rtrim(CASE WHEN p > 0 AND 400 - p > 240
    THEN substr(h, 1, 400 - p) ELSE h END, ' ,;:.-') || '...' END AS summary FROM c""")
def _(spark, sf):
    return heavy(spark, sf, "documents").select("doc_id", X.summary(F.col("text")).alias("summary"))


SQL_METRICS = f"""
  CAST(CASE WHEN text = '' THEN 0 ELSE len(regexp_extract_all(text, '{WORD}+')) END AS INT)
    AS word_count,
  CAST(CASE WHEN text = '' THEN 0 ELSE len(list_filter(string_split_regex(text, '\\n{S}*\\n'),
    lambda p: {sql_trim('p')} <> '')) END AS INT) AS paragraph_count,
  text <> '' AND regexp_matches(text, '{K.CODE_PATTERN}') AS has_code"""
SQL_RELEVANCE = f"""CASE WHEN {sql_count("lower(title || ' ' || text)", K.HIGH_RELEVANCE)} >= 2
  THEN 'High' WHEN {sql_count("lower(title || ' ' || text)", K.HIGH_RELEVANCE)} >= 1 OR
  {sql_count("lower(title || ' ' || text)", K.MEDIUM_RELEVANCE)} >= 3 THEN 'Medium'
  ELSE 'Low' END"""
SQL_LEVEL = f"""CASE WHEN source = 'arxiv' THEN 'Research'
  WHEN {sql_count('lower(text)', K.RESEARCH_MARKS)} > {sql_count('lower(text)', K.TUTORIAL_MARKS)}
    AND {sql_count('lower(text)', K.RESEARCH_MARKS)} >= 2 THEN 'Research'
  WHEN {sql_count('lower(text)', K.TUTORIAL_MARKS)} > {sql_count('lower(text)', K.RESEARCH_MARKS)}
    AND {sql_count('lower(text)', K.TUTORIAL_MARKS)} >= 2 THEN 'Tutorial' ELSE 'Overview' END"""
SQL_TOPICS = "list_slice(list_sort(list_distinct(list_concat(list_slice(tags, 1, 5), list_filter([" \
    + ", ".join(f"CASE WHEN {sql_any('lower(text)', w)} THEN '{t}' END"
                for t, w in K.TOPIC_KEYWORDS.items()) \
    + "], lambda t: t IS NOT NULL)))), 1, 10)"
SQL_ENRICHED = f"""r AS (SELECT *, string_split(tags_text, '|') AS tags,
    coalesce(try_strptime(date_published, '%Y-%m-%d'),
             try_strptime(date_published, '%Y-%m-%dT%H:%M:%SZ')) AS d FROM research),
  enriched AS (SELECT *, CAST(year(d) AS INT) AS year, 'Q' || quarter(d) AS quarter,
    CAST(month(d) AS INT) AS month, CAST(year(d) - year(d) % 10 AS VARCHAR) || 's' AS decade,
    {SQL_METRICS}, {SQL_RELEVANCE} AS safety_relevance, {SQL_LEVEL} AS technical_level,
    {SQL_TOPICS} AS topics FROM r)"""


@query("enrich_documents", "C2 F13 F14 F15 F16 F25", cte("research") + f""", {SQL_ENRICHED}
SELECT id, year, quarter, month, decade, word_count, paragraph_count, has_code,
  CASE WHEN text = '' THEN 0 ELSE CAST(greatest(1, round_even(CAST(word_count AS DOUBLE) / 225, 0))
    AS INT) END AS reading_time_minutes,
  safety_relevance, technical_level, array_to_string(topics, '|') AS topics FROM enriched""")
def _(spark, sf):
    return PR.enrich(research(spark, sf)).select(
        "id", "year", "quarter", "month", "decade", "word_count", "paragraph_count", "has_code",
        "reading_time_minutes", "safety_relevance", "technical_level",
        F.array_join("primary_topics", "|").alias("topics"))


SQL_NEWS = f"""(regexp_matches(lower(title), '{"|".join(K.NEWSLETTER_TITLE)}') OR
  regexp_matches(lower(substr(text, 1, 500)), '{"|".join(K.NEWSLETTER_TEXT)}'))"""
SQL_SCORED = f"""points AS (SELECT *, {SQL_NEWS} AS is_newsletter,
    CAST((CASE WHEN source IN ('arxiv', 'distill') THEN 3 ELSE 0 END)
    + (CASE WHEN authors_text IS NOT NULL THEN 1 ELSE 0 END)
    + (CASE WHEN {SQL_NEWS} THEN 0 ELSE 2 END)
    + (CASE WHEN length(text) > 5000 THEN 1 ELSE 0 END)
    + (CASE WHEN length(text) > 10000 THEN 1 ELSE 0 END)
    + (CASE WHEN coalesce(TRY_CAST(CASE WHEN regexp_matches(substr(date_published, 1, 4),
        '^[0-9]+$') THEN substr(date_published, 1, 4) END AS INT), 9999) <= 2019 THEN 1 ELSE 0 END)
    + 0.5 AS DOUBLE) AS score FROM research),
  scored AS (SELECT *, CASE WHEN score >= 7 THEN 'A' WHEN score >= 4 THEN 'B'
    WHEN score >= 2 THEN 'C' ELSE 'D' END AS tier FROM points)"""


@query("score_documents", "C3 F10 F34", cte("research") + f""", {SQL_SCORED}
SELECT id AS source_id, score AS quality_score, tier AS quality_tier, is_newsletter,
  CAST(length(text) AS INT) AS text_length, substr(title, 1, 80) AS title_preview FROM scored""")
def _(spark, sf):
    return PR.score(research(spark, sf)).select(
        "source_id", "quality_score", "quality_tier", "signals.is_newsletter",
        "signals.text_length", "title_preview")


@query("quality_tier_counts", "C3 A15 K10", cte("research") + f""", {SQL_SCORED}
SELECT tier AS quality_tier, count(*) AS count FROM scored GROUP BY 1""")
def quality_tier_counts(spark, sf):
    return publish.tier_listing(PR.score(research(spark, sf)), "quality_tier", "source_id")


@query("quality_tier_ids", "K10 A15", cte("research") + f""", {SQL_SCORED}
SELECT tier AS quality_tier, id AS source_id FROM scored""")
def _(spark, sf):
    """The ids of each tier, as the table that the listing writes."""
    path = new_path(spark, "tiers")
    publish.tier_listing(PR.score(research(spark, sf)), "quality_tier", "source_id", path)
    return spark.read.parquet(path).select(F.col("quality_tier").cast("string").alias("quality_tier"),
                                           "source_id")


@query("tier_samples", "T9", cte("research") + f""", {SQL_SCORED}
SELECT tier AS quality_tier, id AS source_id, rn AS rank FROM (SELECT *, CAST(row_number() OVER (
  PARTITION BY tier ORDER BY id) AS INT) AS rn FROM scored) WHERE rn <= 3""")
def _(spark, sf):
    return RK.top_per_group(PR.score(research(spark, sf)), ["quality_tier"], [F.col("source_id")],
                            3).select("quality_tier", "source_id", "rank")


def sql_pick(options, key: str) -> str:
    items = ", ".join("'" + o.replace("'", "''") + "'" for o in options)
    return (f"([{items}])[1 + CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) "
            f"% {len(options)} AS INT)]")


SQL_SLUG = "substr(trim(regexp_replace(lower(source || '_' || substr(id, 1, 16)), " \
    "'[^a-z0-9]+', '_', 'g'), '_'), 1, 100)"


def sql_description(body: str, unknown: str) -> str:
    return (f"CASE WHEN length(CASE WHEN length({body}) > 1000 THEN substr({body}, 1, 997) || "
            f"'...' ELSE {body} END) < 20 THEN 'Research publication: ' || title "
            f"WHEN length({body}) > 1000 THEN substr({body}, 1, 997) || '...' ELSE {body} END")


SQL_PARAGRAPH = sql_trim("split_part(text, chr(10) || chr(10), 1)")
SQL_MEDIA = "CASE source " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in K.MEDIA_BY_SOURCE.items()) \
    + f" ELSE '{K.MEDIA_DEFAULT}' END"


@query("timeline_from_enriched", "C4 F6 F8 F18 F19 F43 F44 F45 F46", cte("research")
       + f""", {SQL_ENRICHED}
SELECT {SQL_SLUG} AS id, substr(title, 1, 200) AS title, coalesce(year, 2020) AS year,
  CASE WHEN source = 'arxiv' OR technical_level = 'Research' THEN 'technical_research_breakthrough'
    WHEN list_contains(topics, 'governance') OR contains(lower(title), 'policy')
      OR contains(lower(substr(text, 1, 500)), 'regulation') THEN 'policy_development'
    WHEN source IN ('lesswrong', 'alignmentforum', 'eaforum') THEN 'public_awareness'
    WHEN list_contains(topics, 'capabilities') OR contains(lower(title), 'gpt')
      OR contains(lower(title), 'claude') THEN 'capability_advance'
    ELSE 'technical_research_breakthrough' END AS category,
  CASE WHEN safety_relevance = 'High' AND source = 'arxiv' AND word_count > 3000 THEN 'legendary'
    WHEN safety_relevance = 'High' OR source = 'arxiv' THEN 'rare' ELSE 'common' END AS rarity,
  md5({sql_description(SQL_PARAGRAPH, 'Unknown title')}) AS description_md5,
  'research=' || CASE technical_level WHEN 'Research' THEN '15' WHEN 'Tutorial' THEN '10'
    ELSE '5' END || CASE WHEN source = 'arxiv' THEN ' papers=10' ELSE '' END
  || CASE safety_relevance WHEN 'High' THEN ' vibey_doom=5' WHEN 'Medium' THEN ' vibey_doom=2'
    ELSE '' END || CASE WHEN list_contains(topics, 'alignment')
    OR list_contains(topics, 'interpretability') THEN ' ethics_risk=-5' ELSE '' END AS impacts,
  CASE safety_relevance WHEN 'High' THEN {sql_pick(K.REACTIONS_BY_RELEVANCE['High'], 'id')}
    WHEN 'Medium' THEN {sql_pick(K.REACTIONS_BY_RELEVANCE['Medium'], 'id')}
    ELSE {sql_pick(K.REACTIONS_BY_RELEVANCE['Low'], 'id')} END AS safety_researcher_reaction,
  {SQL_MEDIA} AS media_reaction FROM enriched""")
def _(spark, sf):
    return event_columns(PR.enriched_to_timeline(PR.enrich(research(spark, sf))))


def event_columns(events, *extra):
    return events.select(
        "id", "title", "year", "category", "rarity", F.md5("description").alias("description_md5"),
        F.array_join(F.transform("impacts", lambda i: F.concat_ws(
            "=", i["variable"], i["change"].cast("int").cast("string"))), " ").alias("impacts"),
        "safety_researcher_reaction", "media_reaction", *extra)


def sql_mask(expr: str) -> str:
    return f"regexp_replace({expr}, '[^\\x00-\\x7F]', '?', 'g')"


@query("timeline_from_tiers", "C4 J5 P20 F6 F8 F18 F27 F43 F44 F45 F46", cte("research")
       + f""", {SQL_SCORED}
SELECT {SQL_SLUG} AS id, {sql_mask('substr(title, 1, 200)')} AS title,
  coalesce(TRY_CAST(CASE WHEN regexp_matches(substr(date_published, 1, 4), '^[0-9]{{1,4}}$')
    THEN substr(date_published, 1, 4) END AS INT), 2020) AS year,
  CASE WHEN source IN ('arxiv', 'distill') THEN 'technical_research_breakthrough'
    WHEN contains(lower(substr(text, 1, 500)), 'governance') OR contains(lower(title), 'policy')
      OR contains(lower(substr(text, 1, 500)), 'regulation') THEN 'policy_development'
    WHEN {sql_any('lower(title)', ('gpt', 'claude', 'language model'))} THEN 'capability_advance'
    WHEN source IN ('lesswrong', 'alignmentforum', 'eaforum') THEN 'public_awareness'
    ELSE 'technical_research_breakthrough' END AS category,
  CASE WHEN source = 'distill' THEN 'legendary' WHEN source = 'arxiv' THEN
    CASE WHEN length(text) > 20000 THEN 'rare' ELSE 'common' END
    WHEN length(text) > 10000 THEN 'rare' ELSE 'common' END AS rarity,
  md5({sql_description(sql_mask(SQL_PARAGRAPH), 'Unknown')}) AS description_md5,
  CASE WHEN source = 'arxiv' THEN 'research=15 papers=10 vibey_doom=3'
    WHEN source = 'distill' THEN 'research=15 papers=10 vibey_doom=5'
    ELSE 'research=10' END AS impacts,
  {sql_pick(K.TIERED_SAFETY_REACTIONS, 'id')} AS safety_researcher_reaction,
  CASE source WHEN 'arxiv' THEN {sql_pick(K.TIERED_MEDIA_REACTIONS['arxiv'], "id || 'm'")}
    WHEN 'distill' THEN {sql_pick(K.TIERED_MEDIA_REACTIONS['distill'], "id || 'm'")}
    ELSE {sql_pick(K.TIERED_MEDIA_DEFAULT, "id || 'm'")} END AS media_reaction,
  id AS source_id FROM scored WHERE tier IN ('A', 'B')""")
def _(spark, sf):
    rows = research(spark, sf)
    return event_columns(PR.tiered_to_timeline(rows, PR.score(rows)), "source_id")


@query("research_prefilter", "P1 P22 T10", cte("research") + """
SELECT id, source, date_published FROM research
WHERE date_published <> '' AND date_published >= '2014-01-01' AND date_published > '2015-06-30'
  AND source IN ('arxiv', 'lesswrong', 'src7', 'src8', 'src9') AND length(text) >= 100
  AND (contains(lower(text) || ' ' || lower(title), 'safety')
    OR contains(lower(text) || ' ' || lower(title), 'the'))""")
def _(spark, sf):
    return (filters.research(research(spark, sf), min_date="2014-01-01", after="2015-06-30",
                             sources=("arxiv", "lesswrong", "src7", "src8", "src9"),
                             keywords=("Safety", "the"))
            .select("id", "source", "date_published"))


@query("research_prefilter_first", "T10", cte("research") + """
SELECT id, source, date_published FROM research
WHERE date_published <> '' AND date_published >= '2014-01-01' AND length(text) >= 100
  AND contains(lower(text) || ' ' || lower(title), 'safety') ORDER BY id LIMIT 500""")
def _(spark, sf):
    """The first records of the filter, in order of id: the limit is the feature."""
    return (filters.research(research(spark, sf), min_date="2014-01-01", keywords=("safety",))
            .select("id", "source", "date_published").orderBy("id").limit(500))


@query("extraction_counts", "A24 K14 P4", cte("research") + """
SELECT 'landed documents' AS source_name, 'complete' AS extraction_status, count(*) AS fetched,
  CAST(sum(CASE WHEN date_published >= '2015-01-01' AND length(text) >= 100 THEN 0 ELSE 1 END)
    AS BIGINT) AS filtered,
  CAST(sum(CASE WHEN date_published >= '2015-01-01' AND length(text) >= 100 THEN 1 ELSE 0 END)
    AS BIGINT) AS written FROM research""")
def _(spark, sf):
    """Counted while the kept rows are written, then joined into one metadata row."""
    from tidemark.workspace import new_path
    rows, fetched = publish.observed(research(spark, sf), "fetched", n=F.count(F.lit(1)))
    kept, written = publish.observed(filters.research(rows, min_date="2015-01-01"), "written",
                                     n=F.count(F.lit(1)))
    kept.select("id", "text").write.parquet(new_path(spark, "extraction"))
    n, w = fetched.get["n"], written.get["n"]
    return publish.metadata_row(
        spark, {"fetched": n, "filtered": n - w, "written": w},
        source_name="landed documents", extraction_status="complete").select(
        "source_name", "extraction_status", "fetched", "filtered", "written")


@query("standard_records", "P2 K14", cte("research") + """
SELECT id, source, title, url, date_published, coalesce(authors_text, '') AS authors,
  'landed documents' AS source_system, '2026-01-01' AS ingestion_date FROM research""")
def _(spark, sf):
    rows = PR.standard_record(research(spark, sf), {"source_system": "landed documents"},
                              F.lit("2026-01-01"))
    return rows.select("id", "source", "title", "url", "date_published",
                       F.coalesce(F.array_join("authors", "|"), F.lit("")).alias("authors"),
                       "_provenance.source_system", "_provenance.ingestion_date")


@query("tracked_page_urls", "F20", r"""
SELECT page_id, """ + SQL_URL + " AS url FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.drop_tracking(F.col("url")).alias("url"))


@query("high_water_ingest", "R1", cte("research") + """
, mark AS (SELECT max(date_published) AS at FROM research WHERE regexp_matches(date_published,
  '^\\d{4}-\\d{2}-\\d{2}$') AND date_published < '2020')
SELECT id, date_published FROM research, mark WHERE date_published > mark.at""".replace(
    "\\\\", "\\"))
def _(spark, sf):
    rows = research(spark, sf)
    mark = (rows.filter(F.col("date_published").rlike(r"^\d{4}-\d{2}-\d{2}\z")
                        & (F.col("date_published") < "2020"))
            .agg(F.max("date_published")).first()[0])
    return INC.after_high_water(rows, mark).select("id", "date_published")


@query("unseen_records", "R1", cte("research", "reviews") + """
SELECT id FROM research WHERE id NOT IN (SELECT id FROM reviews)""")
def _(spark, sf):
    return INC.unseen(research(spark, sf), standin(spark, sf, "reviews"), "id").select("id")


@query("mojibake_round_trip", "F7 C10", r"""
SELECT doc_id, md5(text) AS repaired_md5 FROM documents""")
def _(spark, sf):
    """Corrupt every text the usual way, then repair it.

    Bytes that Windows-1252 leaves undefined cannot come back from it, so a text with such bytes
    is not corrupted at all and must pass through the repair as it is.
    """
    from pyspark.sql import Column
    docs = table(spark, sf, "documents")
    # UTF-8 bytes read as Latin-1, then as Windows-1252 where the two differ
    latin: Column = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    chars, controls = X._CP1252_CHARS, X._C1_CHARS
    undefined = latin.rlike("[\x81\x8d\x8f\x90\x9d]")
    broken = F.when(undefined, F.col("text")).otherwise(F.translate(latin, controls, chars))
    return docs.select("doc_id", F.md5(X.repair_mojibake(broken)).alias("repaired_md5"))


@query("unfixed_characters", "F3 F40", f"""
SELECT doc_id, CAST(len(regexp_extract_all({sql_replace('text', K.PUBLISHING_SUBSTITUTIONS)},
  '[^\\x00-\\x7F]')) AS INT) AS left_over FROM documents WHERE regexp_matches(
  {sql_replace('text', K.PUBLISHING_SUBSTITUTIONS)}, '[^\\x00-\\x7F]')""")
def _(spark, sf):
    fixed = X.ascii_publish(F.col("text"))
    return (table(spark, sf, "documents").filter(X.has_non_ascii(fixed))
            .select("doc_id", F.regexp_count(fixed, F.lit(K.NON_ASCII)).alias("left_over")))


@query("impact_levels", "A5 F35", cte("events_v") + """
, s AS (SELECT id, abs(coalesce(research_change, 0)) + abs(papers_change)
  + abs(coalesce(ethics_change, 0)) AS score FROM events_v)
SELECT id, score, CASE WHEN score >= 150 THEN 'Critical' WHEN score >= 80 THEN 'High'
  WHEN score >= 30 THEN 'Medium' ELSE 'Low' END AS impact_level FROM s""")
def _(spark, sf):
    from tidemark.plans.queries_collections import timeline_events
    scored = timeline_events(spark, sf).select("id", R.impact_score(F.col("impacts"))
                                               .alias("score"))
    return scored.withColumn("impact_level", R.impact_level(F.col("score")))
