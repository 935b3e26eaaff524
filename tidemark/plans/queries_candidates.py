"""Queries over candidate records: sources, overlays, salience, selection."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.ranking import global_position
from tidemark.functions import candidates as C
from tidemark.functions import text as X
from tidemark.operators import aggregates as A
from tidemark.operators import filters, joins, privacy, setops
from tidemark.operators import ranking as RK
from tidemark.plans import candidates as PC
from tidemark.plans.registry import query
from tidemark.plans.standins import cte, standin, table
from tidemark.sinks import publish
from tidemark.sources import overlays, snapshots
from tidemark.sources.documents import from_listed
from tidemark.workspace import durable, new_path

PROFILE = K.DEFAULT_PROFILE
SEEN = "2026-01-01"
_STRINGS = "array<string>"


def candidates(spark, sf):
    base = standin(spark, sf, "candidates")
    kind, value = F.col("kind"), F.col("main_value")
    return base.withColumns({
        "signals": C.signals_map(
            F.lit(SEEN), training_compute_flop=F.when(kind == "model_release", value),
            karma=F.when(kind == "forum_post", value), citations=F.col("citations")),
        "extra": F.create_map(F.lit("frontier_model"), F.col("frontier_model")),
        "forum_tags": F.array().cast(_STRINGS), "summary": F.lit(""),
        "occurred_at": F.col("published_at"), "source_urls": F.array("link_cell"),
        "archive_urls": F.array().cast(_STRINGS),
        "source_available_at": F.lit(None).cast("string"),
        "_provenance": F.create_map(F.lit("title"), C.provenance("raw", "upstream_field", "high")),
        "_ord": F.col("o_orderkey")})


def registry(spark, sf):
    return table(spark, sf, "region").select(
        F.concat(F.lit("feed"), F.col("r_regionkey").cast("string")).alias("source_id"),
        F.concat(F.lit("https://data.example/"), "r_name").alias("url"),
        F.when(F.col("r_regionkey") != 3, F.lit("2020-05-01")).alias("source_available_at"),
        F.lit("high").alias("confidence"),
        F.array_repeat(F.col("r_name"), F.col("r_regionkey").cast("int")).alias("evidence"))


def tombstone_rows(spark, sf):
    return table(spark, sf, "lineitem").filter("l_returnflag = 'R' and l_quantity >= 49").select(
        F.concat(F.lit("feed"), (F.col("l_orderkey") % 6).cast("string"), F.lit(":"),
                 F.col("l_orderkey").cast("string")).alias("id"),
        F.col("l_linestatus").alias("_file"), F.col("l_partkey").alias("_ord"),
        F.concat_ws("-", "l_linestatus", F.col("l_partkey").cast("string")).alias("category"),
        F.lit(SEEN).alias("tombstoned_at"))


def tombstones(spark, sf):
    return overlays.last_tombstones(tombstone_rows(spark, sf))


def _cand_id(doc_id):
    return F.concat(F.lit("feed"), (doc_id % 6).cast("string"), F.lit(":"), doc_id.cast("string"))


def reviews(spark, sf):
    """Two review layers over the first candidates."""
    labels = standin(spark, sf, "reviews")
    first = labels.select(_cand_id(F.col("doc_id")).alias("id"), "reviewer", "verdict",
                          F.lit(None).cast("string").alias("note"),
                          F.col("said_at").alias("at"),
                          F.lit("a.json").alias("layer"))
    second = labels.filter("doc_id % 2 = 0").select(
        _cand_id(F.col("doc_id")).alias("id"), F.lit("cy").alias("reviewer"),
        F.when(F.col("doc_id") % 4 == 0, "accept").otherwise("unsure").alias("verdict"),
        F.lit("second look").alias("note"), F.col("said_at").alias("at"), F.lit("b.json").alias("layer"))
    return first.unionByName(second)


def tags(spark, sf):
    return table(spark, sf, "documents").select(
        F.lit("machine_v1").alias("layer_id"), _cand_id(F.col("doc_id")).alias("id"),
        F.struct(F.col("lang").alias("domain"), F.col("n_chars").alias("tokens_used"))
        .alias("tag"))


def projected(spark, sf):
    kept, dropped = PC.project(
        candidates(spark, sf), tombstones=tombstones(spark, sf), registry=registry(spark, sf),
        profiles=[PROFILE], reviews=reviews(spark, sf), tags=tags(spark, sf))
    return kept, dropped


PID = PROFILE["profile_id"]
SQL_PRIVATE = r"regexp_matches(title, '(?i)\b(" + "|".join(K.PRIVACY_PHRASES) + r")\b')"
SQL_HITS = "len(list_distinct(regexp_extract_all(lower(title), '" + "|".join(
    rf"\b(?:{t})\b" for t in PROFILE["relevance"]["terms"]) + "')))"


def sql_salience(source: str) -> str:
    """Salience and tiers over ``source``, a CTE with the candidate columns.

    The shortest decimal text of a double is rounded, which is exact; a direct
    cast of a double to a decimal loses digits.
    """
    return f"""raw AS (SELECT *, CASE kind
      WHEN 'model_release' THEN coalesce(log10(main_value)
        + CASE WHEN frontier_model = 'True' THEN 1.0 ELSE 0.0 END,
        log10(citations + 1.0), 0.0)
      WHEN 'forum_post' THEN coalesce(main_value, 0.0)
      WHEN 'publication' THEN coalesce(log10(citations + 1.0), 0.0) ELSE 0.0 END AS score,
    CASE WHEN kind = 'model_release' AND main_value IS NOT NULL THEN 'training_compute_flop:log10'
        || CASE WHEN frontier_model = 'True' THEN '+frontier_model' ELSE '' END
      WHEN kind = 'model_release' AND citations IS NOT NULL THEN 'fallback:citations'
      WHEN kind = 'forum_post' AND main_value IS NOT NULL THEN 'karma:identity'
      WHEN kind = 'publication' AND citations IS NOT NULL THEN 'citations:log10_plus1'
      ELSE 'no_signal_available' END AS method,
    substr(coalesce(published_at, '____'), 1, 4) AS yr,
    CASE WHEN kind = 'model_release' OR {SQL_HITS} >= 2 THEN 1.0
      WHEN {SQL_HITS} = 1 THEN 0.75 ELSE 0.25 END::DOUBLE AS relevance FROM {source}),
  ranked AS (SELECT *, dense_rank() OVER (PARTITION BY kind, yr ORDER BY score) - 1 AS place,
    count(*) OVER (PARTITION BY kind, yr) AS group_size FROM raw),
  placed AS (SELECT *, max(place) OVER (PARTITION BY kind, yr) AS top FROM ranked),
  salient AS (SELECT *, CAST(round_even(CAST(CAST((CAST(0.5 AS DOUBLE) + (CASE WHEN top = 0
      THEN CAST(0.5 AS DOUBLE) ELSE CAST(place AS DOUBLE) / CAST(top AS DOUBLE) END
      - CAST(0.5 AS DOUBLE)) * (CAST(group_size AS DOUBLE) / CAST(group_size + 12 AS DOUBLE)))
      * relevance AS VARCHAR) AS DECIMAL(30, 20)), 4) AS DOUBLE) AS salience FROM placed),
  ordered AS (SELECT *, row_number() OVER (ORDER BY salience DESC, o_orderkey) AS pos,
    count(*) OVER () AS n FROM salient),
  tiered AS (SELECT *, CASE WHEN pos <= greatest(1, round_even(CAST(0.05 AS DOUBLE) * n, 0)) THEN 'A'
    WHEN pos <= greatest(1, round_even(CAST(0.05 AS DOUBLE) * n, 0))
      + greatest(1, round_even(CAST(0.2 AS DOUBLE) * n, 0)) THEN 'B'
    WHEN pos <= greatest(1, round_even(CAST(0.05 AS DOUBLE) * n, 0))
      + greatest(1, round_even(CAST(0.2 AS DOUBLE) * n, 0))
      + greatest(1, round_even(CAST(0.5 AS DOUBLE) * n, 0)) THEN 'C' ELSE 'D' END AS tier FROM ordered)"""


@query("salience_and_tiers", "W2 W3 W4 F30 F31 F32 F33", cte("candidates")
       + f""", {sql_salience('candidates')}
SELECT id, salience, tier, method, relevance, CAST(group_size AS INT) AS group_size FROM tiered""")
def _(spark, sf):
    return PC.score_profile(candidates(spark, sf), PROFILE).select(
        "id", "salience", "tier", "basis.method", F.col("basis.topical_relevance")
        .alias("relevance"), "basis.group_size")


STEEP = {**PROFILE, "profile_id": "steep_v1", "version": "2.0.0", "shrinkage_k": 3,
         "tier_quantiles": [["A", 0.01], ["B", 0.3], ["C", 0.5]]}


def _steep(sql: str) -> str:
    """The salience SQL with the other profile's shrinkage and tiers, its tables named apart."""
    sql = (sql.replace("group_size + 12 ", "group_size + 3 ").replace("0.05 AS", "0.01 AS")
           .replace("0.2 AS", "0.3 AS"))
    return re.sub(r"\b(raw|ranked|placed|salient|ordered|tiered)\b", r"\1_2", sql)


@query("profiles_side_by_side", "S12 C5 W2 W3 W4", cte("candidates")
       + f""", {sql_salience('candidates')}, {_steep(sql_salience('candidates'))}
SELECT id, 'default_v1' AS profile, salience, tier, method, CAST(group_size AS INT) AS group_size FROM tiered
UNION ALL SELECT id, 'steep_v1', salience, tier, method, CAST(group_size AS INT) FROM tiered_2""")
def _(spark, sf):
    """Two profile files, scanned from a folder and applied together."""
    path = new_path(spark, "profiles")
    for profile in (STEEP, PROFILE):
        (spark.createDataFrame([(json.dumps(profile),)], "value string").coalesce(1)
         .write.text(f"{path}/{profile['profile_id']}"))
    # a profile is a file here below its own folder, because Spark names the files
    found = [p for name in (PROFILE, STEEP) for p in overlays.profiles(
        spark, f"{path}/{name['profile_id']}", "*")]
    scored = PC.score_all(candidates(spark, sf), found)
    return scored.select("id", F.explode("salience_by_profile").alias("profile", "salience"),
                         "salience_tier_by_profile", "salience_basis_by_profile").select(
        "id", "profile", "salience", F.col("salience_tier_by_profile")[F.col("profile")].alias("tier"),
        F.col("salience_basis_by_profile")[F.col("profile")]["method"].alias("method"),
        F.col("salience_basis_by_profile")[F.col("profile")]["group_size"].alias("group_size"))


@query("tier_cut_points", "A16", cte("candidates") + f""", {sql_salience('candidates')}
SELECT tier, count(*) AS count, max(salience) AS salience_max, min(salience) AS salience_min
FROM tiered GROUP BY tier""")
def _(spark, sf):
    return RK.tier_cuts(PC.score_profile(candidates(spark, sf), PROFILE), "tier", "salience")


@query("percentile_of_distinct_values", "W2", """
WITH r AS (SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value,
  dense_rank() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY value) - 1 AS place,
  count(*) OVER (PARTITION BY event_type, CAST(ts AS DATE)) AS group_size FROM events),
t AS (SELECT *, max(place) OVER (PARTITION BY event_type, day) AS top FROM r)
SELECT event_id, group_size, CASE WHEN top = 0 THEN CAST(0.5 AS DOUBLE)
  ELSE CAST(place AS DOUBLE) / CAST(top AS DOUBLE) END AS percentile FROM t""")
def _(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    return RK.distinct_percentile(events, ["event_type", "day"], "value").select(
        "event_id", "group_size", "percentile")


@query("rank_within_type", "W1", """
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type
  ORDER BY value DESC, event_id) AS rank FROM events""")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return RK.rank_within(events, ["event_type"], [F.desc("value"), F.col("event_id")]).select(
        "event_id", "event_type", "rank")


@query("top_per_type_and_day", "T11", """
SELECT event_id, CAST(rank AS INT) AS rank FROM (SELECT event_id, row_number() OVER (
  PARTITION BY event_type, CAST(ts AS DATE) ORDER BY value DESC, event_id) AS rank FROM events)
WHERE rank <= 5""")
def _(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("day"), "value")
    return RK.top_per_group(events, ["event_type", "day"], [F.desc("value"), F.col("event_id")],
                            5).select("event_id", "rank")


SQL_REGISTRY = """registry AS (SELECT 'feed' || r_regionkey AS source_id,
  'https://data.example/' || r_name AS url,
  CASE WHEN r_regionkey <> 3 THEN '2020-05-01' END AS source_available_at,
  r_regionkey AS evidence FROM region)"""
SQL_TOMBSTONES = """tomb AS (SELECT 'feed' || (l_orderkey % 6) || ':' || l_orderkey AS id,
  arg_max(l_linestatus || '-' || l_partkey, (l_linestatus, l_partkey)) AS category
  FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49 GROUP BY 1)"""
SQL_REVIEWS = """rv AS (SELECT 'feed' || (doc_id % 6) || ':' || doc_id AS id, reviewer, verdict,
    'a.json' AS layer FROM reviews
  UNION ALL SELECT 'feed' || (doc_id % 6) || ':' || doc_id, 'cy',
    CASE WHEN doc_id % 4 = 0 THEN 'accept' ELSE 'unsure' END, 'b.json' FROM reviews
  WHERE doc_id % 2 = 0)"""


@query("registry_facts", "J2 F21 F22 S12 F42", cte("candidates") + f""", {SQL_REGISTRY}
SELECT c.id, r.source_available_at, CASE WHEN link_cell <> 'not a link' THEN
    'https://a.example/' || o_orderkey || ' https://b.example/' || o_custkey
    ELSE coalesce(r.url, '') END AS source_urls,
  CASE WHEN r.source_id IS NULL THEN 'source_not_in_registry' ELSE 'source_registry' END
    AS clock_method,
  CASE WHEN r.source_available_at IS NULL THEN 'low' ELSE 'high' END AS clock_confidence,
  CAST(r.evidence AS INT) AS evidence_count,
  CASE WHEN link_cell = 'not a link' AND r.url IS NOT NULL THEN 'aggregator_fallback' END
    AS url_method
FROM candidates c LEFT JOIN registry r ON split_part(c.id, ':', 1) = r.source_id""")
def _(spark, sf):
    out = PC.with_registry(candidates(spark, sf), registry(spark, sf))
    clock = F.try_element_at("_provenance", F.lit("source_available_at"))
    return out.select(
        "id", "source_available_at", F.array_join("source_urls", " ").alias("source_urls"),
        clock["method"].alias("clock_method"), clock["confidence"].alias("clock_confidence"),
        clock["evidence_count"].alias("evidence_count"),
        F.try_element_at("_provenance", F.lit("source_urls"))["method"].alias("url_method"))


@query("url_cells", "F21", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN url || ' https://x.example/a'
  WHEN 1 THEN url || ' https://x.example/' || page_id ELSE url END AS urls FROM pages""")
def _(spark, sf):
    p = F.col("page_id")
    cell = (F.when(p % 3 == 0, F.concat(F.col("url"), F.lit(",\nx.example/a; "), F.col("url")))
            .when(p % 3 == 1, F.concat(F.col("url"), F.lit(" (mirror) x.example/"),
                                       p.cast("string"), F.lit(",")))
            .otherwise(F.concat(F.lit("see "), F.col("url"), F.lit(" was withdrawn, vs.it"))))
    from tidemark.functions.urls import split_cell
    return table(spark, sf, "pages").select("page_id", F.array_join(split_cell(cell), " ")
                                            .alias("urls"))


@query("tombstone_split", "J1 S11", cte("candidates") + f""", {SQL_TOMBSTONES}
SELECT c.id, coalesce(t.category, '') AS category,
  CASE WHEN t.id IS NULL THEN 'kept' ELSE 'tombstoned' END AS outcome
FROM candidates c LEFT JOIN tomb t ON c.id = t.id""")
def _(spark, sf):
    kept, dropped = joins.split_by(candidates(spark, sf).select("id"), tombstones(spark, sf), "id")
    return kept.select("id", F.lit("").alias("category"), F.lit("kept").alias("outcome")) \
        .unionByName(dropped.select("id", "category", F.lit("tombstoned").alias("outcome")))


@query("reviews_nested", "J3 Q6", cte("reviews") + f""", {SQL_REVIEWS}
SELECT id, string_agg(layer || ':' || reviewer || ':' || verdict, ' ' ORDER BY layer) AS reviews
FROM rv GROUP BY id""")
def _(spark, sf):
    return PC.reviews_by_id(reviews(spark, sf)).select("id", F.array_join(F.transform(
        "reviews", lambda r: F.concat_ws(":", r["layer"], r["reviewer"], r["verdict"])), " ")
        .alias("reviews"))


@query("tags_nested", "J4 S10", """
SELECT 'feed' || (doc_id % 6) || ':' || doc_id AS id, lang AS domain FROM documents""")
def _(spark, sf):
    return PC.tags_by_id(tags(spark, sf)).select(
        "id", F.col("airr_tags_by_layer")["machine_v1"]["domain"].alias("domain"))


SQL_PROJECTED = f"""{SQL_TOMBSTONES}, {SQL_REGISTRY}, {SQL_REVIEWS},
  live AS (SELECT * FROM candidates WHERE id NOT IN (SELECT id FROM tomb)),
  {sql_salience('live')},
  per AS (SELECT id, count(*) AS n_reviews, bool_or(verdict = 'privacy') AS private,
    bool_or(verdict = 'accept') AS accepted, arg_min(verdict, layer) AS first_verdict
    FROM rv GROUP BY id),
  feed AS (SELECT t.*, coalesce(p.n_reviews, 0) AS n_reviews, coalesce(p.private, false) AS private,
    coalesce(p.accepted, false) AS accepted, p.first_verdict, {SQL_PRIVATE} AS flagged
    FROM tiered t LEFT JOIN per p ON t.id = p.id)"""


@query("candidate_feed", "C5 P19 F11 V6 T1 K1 U1", cte("candidates", "reviews")
       + f""", {SQL_PROJECTED}
SELECT f.id, f.salience, f.tier, f.flagged AS privacy_review_required,
  CAST(n_reviews AS INT) AS n_reviews,
  CASE WHEN n_reviews > 0 THEN 'reviewed' WHEN flagged THEN 'needs_privacy_review'
    ELSE 'unreviewed' END AS review_status, r.source_available_at, d.lang AS domain
FROM feed f LEFT JOIN registry r ON split_part(f.id, ':', 1) = r.source_id
LEFT JOIN documents d ON f.o_orderkey = d.doc_id""")
def candidate_feed(spark, sf):
    kept, _ = projected(spark, sf)
    return kept.select(
        "id", F.col("salience_by_profile")[PID].alias("salience"),
        F.col("salience_tier_by_profile")[PID].alias("tier"), "privacy_review_required",
        F.size("reviews").alias("n_reviews"), "review_status", "source_available_at",
        F.col("airr_tags_by_layer")["machine_v1"]["domain"].alias("domain")
    ).orderBy(F.desc("salience"), "id")


@query("feed_counters", "A17 K6", cte("candidates", "reviews") + f""", {SQL_PROJECTED}
SELECT substr(coalesce(published_at, 'unknown'), 1, 4) AS year, count(*) AS kept,
  CAST(sum(CAST(flagged AS INT)) AS BIGINT) AS flagged,
  CAST(sum(CAST(n_reviews > 0 AS INT)) AS BIGINT) AS reviewed FROM feed GROUP BY 1""")
def _(spark, sf):
    return PC.feed_counters(projected(spark, sf)[0])


SQL_INCLUDED = "n_reviews > 0 AND NOT flagged AND NOT private"


@query("reviewed_feed", "C6 P18 T2", cte("candidates", "reviews") + f""", {SQL_PROJECTED}
SELECT id, published_at, CAST(n_reviews AS INT) AS n_reviews FROM feed WHERE {SQL_INCLUDED}""")
def _(spark, sf):
    return (PC.reviewed(projected(spark, sf)[0]).orderBy(*PC.reviewed_order())
            .select("id", "published_at", F.size("reviews").alias("n_reviews")))


def sql_verdict(v: str) -> str:
    return (f"CAST(sum(CAST({SQL_INCLUDED} AND CASE WHEN accepted THEN 'accept' ELSE "
            f"first_verdict END = '{v}' AS INT)) AS BIGINT) AS verdict_{v}")


@query("reviewed_counts", "A11 C6", cte("candidates", "reviews") + f""", {SQL_PROJECTED}
SELECT count(*) AS scanned, CAST(sum(CAST({SQL_INCLUDED} AS INT)) AS BIGINT) AS included,
  CAST(sum(CAST(n_reviews > 0 AND (flagged OR private) AS INT)) AS BIGINT) AS withheld_privacy,
  {', '.join(sql_verdict(v) for v in ('accept', 'unsure', 'reject', 'unknown'))} FROM (
  SELECT * REPLACE (coalesce(first_verdict, '') AS first_verdict) FROM feed)""")
def _(spark, sf):
    return PC.reviewed_counts(projected(spark, sf)[0])


@query("reviewer_verdicts", "A11", cte("candidates", "reviews") + f""", {SQL_PROJECTED}
SELECT rv.reviewer, rv.verdict, count(*) AS n FROM feed JOIN rv ON feed.id = rv.id
WHERE {SQL_INCLUDED} GROUP BY 1, 2""")
def _(spark, sf):
    return PC.reviewer_verdicts(projected(spark, sf)[0])


def _sql_found(cat: str) -> str:
    return "(" + " + ".join(f"CAST(contains(' ' || lower(title) || ' ', '{t}') AS INT)"
                            for t in K.SHORTLIST_TERMS[cat]) + ")"


SQL_SHORT = "short AS (SELECT *, " + ", ".join(
    f"{_sql_found(c)} AS n{i}" for i, c in enumerate(K.SHORTLIST_TERMS)) \
    + """ FROM feed WHERE kind = 'forum_post' AND n_reviews = 0 AND NOT flagged),
  chosen AS (SELECT *, n0 + n1 + n2 AS n_terms, CASE WHEN greatest(n0, n1, n2) = 0 THEN NULL """ \
    + " ".join(f"WHEN n{i} = greatest(n0, n1, n2) THEN '{c}'"
               for i, c in enumerate(K.SHORTLIST_TERMS)) \
    + " END AS category, CAST(trunc(main_value) AS BIGINT) AS karma FROM short)"


@query("review_shortlist", "T4 F37", cte("candidates", "reviews") + f""", {SQL_PROJECTED}, {SQL_SHORT}
SELECT id, published_at AS date, karma, category AS suggested_category,
  CAST(n_terms AS INT) AS n_terms FROM chosen WHERE category IS NOT NULL
ORDER BY n_terms DESC, coalesce(karma, 0) DESC, id LIMIT 40""")
def _(spark, sf):
    return PC.shortlist(projected(spark, sf)[0], 40).select(
        "id", "date", "karma", "suggested_category", "n_terms")


@query("scan_view", "T5", cte("candidates", "reviews") + f""", {SQL_PROJECTED}, {SQL_SHORT}
SELECT id, karma, coalesce(category, 'no term match') AS category,
  CASE WHEN category IS NULL THEN 'karma' ELSE 'term' END AS basis FROM chosen
ORDER BY category IS NULL, CASE WHEN category IS NULL THEN 0 ELSE n_terms END DESC,
  coalesce(karma, 0) DESC, id LIMIT 1000""")
def _(spark, sf):
    return PC.scan_view(projected(spark, sf)[0], 1000).select("id", "karma", "category", "basis")


@query("queue_by_disagreement", "T7 F36 J16", cte("candidates") + f"""
, {sql_salience('candidates')}, parts AS (SELECT id, list_filter([salience,
    CAST(relevance AS DOUBLE), CASE WHEN kind = 'forum_post' AND main_value IS NOT NULL
      THEN least(1.0, main_value / 600.0) END,
    CASE WHEN citations IS NOT NULL THEN least(1.0, log10(citations + 1.0) / 4.0) END],
    lambda v: v IS NOT NULL) AS p FROM tiered)
SELECT id, round(list_stddev_pop(p), 6) AS spread FROM parts
ORDER BY round(list_stddev_pop(p), 6) DESC, id""".replace(
    "list_stddev_pop(p)", "list_aggregate(p, 'stddev_pop')"))
def _(spark, sf):
    scored = PC.score_profile(candidates(spark, sf), PROFILE)
    spread = C.signal_disagreement(
        F.col("salience"), F.col("basis.topical_relevance"),
        C.latest(F.col("signals"), "karma"), C.latest(F.col("signals"), "citations"))
    return (scored.select("id", F.round(spread, 6).alias("spread"))
            .orderBy(F.desc("spread"), "id"))


@query("review_queue_filters", "P10", cte("candidates", "reviews") + f""", {SQL_PROJECTED}
SELECT 'undecided' AS mode, count(*) AS n FROM feed WHERE n_reviews = 0
UNION ALL SELECT 'A', count(*) FROM feed WHERE tier = 'A'
UNION ALL SELECT 'AB', count(*) FROM feed WHERE tier IN ('A', 'B')
UNION ALL SELECT 'flagged', count(*) FROM feed WHERE flagged
UNION ALL SELECT 'all', count(*) FROM feed""")
def _(spark, sf):
    kept = durable(projected(spark, sf)[0].select(
        "id", "salience_tier_by_profile", "privacy_review_required"), "feed")
    said, out = reviews(spark, sf), None
    for mode in ("undecided", "A", "AB", "flagged", "all"):
        n = filters.review_queue(kept, said, mode, PID).agg(F.count("*").alias("n")).select(
            F.lit(mode).alias("mode"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("review_queue_orders", "T7", cte("candidates", "reviews") + f""", {SQL_PROJECTED}
SELECT 'salience' AS mode, row_number() OVER (ORDER BY salience DESC, id) AS place, id FROM feed
UNION ALL SELECT 'privacy', row_number() OVER (ORDER BY flagged DESC, salience DESC, id), id
  FROM feed
UNION ALL SELECT 'date', row_number() OVER (ORDER BY coalesce(published_at, '') DESC, id), id
  FROM feed""")
def _(spark, sf):
    """The whole queue in each order, with places."""
    modes, kept, out = ("salience", "privacy", "date"), projected(spark, sf)[0], None
    # the orders' own columns, without the records
    orders = {m: PC.queue_keys(m, PID) for m in modes}
    kept = durable(kept.select("id", *[c.alias(f"_{m}_{i}") for m in modes
                                       for i, (c, _) in enumerate(orders[m])]), "feed")
    for mode in modes:
        keys = [(f"_{mode}_{i}", down) for i, (_, down) in enumerate(orders[mode])]
        placed = global_position(kept.select("id", *[c for c, _ in keys]),
                                 [*[F.desc(c) if down else F.col(c) for c, down in keys], F.col("id")],
                                 "place").select(F.lit(mode).alias("mode"), "place", "id")
        out = placed if out is None else out.unionByName(placed)
    return out


@query("clock_gates", "P13 Q7", cte("candidates") + f""", {SQL_REGISTRY}
SELECT CASE WHEN published_at IS NULL OR published_at <= '1998-06-30' THEN true ELSE false END
    AS fact_visible, CASE WHEN r.source_available_at IS NULL
    OR r.source_available_at <= '1998-06-30' THEN true ELSE false END AS dataset_unlocked,
  count(*) AS n FROM candidates c LEFT JOIN registry r
  ON split_part(c.id, ':', 1) = r.source_id GROUP BY 1, 2""")
def _(spark, sf):
    rows = PC.with_registry(candidates(spark, sf), registry(spark, sf))
    at = F.lit("1998-06-30")
    return rows.groupBy(C.visible(F.col("published_at"), at).alias("fact_visible"),
                        C.visible(F.col("source_available_at"), at).alias("dataset_unlocked")
                        ).agg(F.count("*").alias("n"))


@query("date_window", "P4", cte("candidates") + """
SELECT CAST(sum(CASE WHEN published_at IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS skipped_no_date,
  CAST(sum(CASE WHEN published_at < '1996-01-01' OR published_at > '1999-12-31' THEN 1 ELSE 0 END)
    AS BIGINT) AS skipped_window FROM candidates""")
def _(spark, sf):
    rows = candidates(spark, sf)
    _, counters = PC.in_window(rows, "1996-01-01", "1999-12-31")
    return rows.agg(*[c.alias(k) for k, c in counters.items()])


@query("signal_as_of", "J15", """
SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events
WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2""")
def _(spark, sf):
    seen = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return joins.as_of(seen.filter(F.col("ts") <= F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")),
                       ["user_id", "event_type"], "at", "value",
                       F.struct(F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'").alias("ts"),
                                F.lit(9223372036854775807).alias("event_id"))
                       ).select("user_id", "event_type", "value")


@query("as_of_per_row", "J15", """
WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
r AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
SELECT l.event_id, r.value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    left = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.filter("event_type = 'view'").select("user_id", "ts", "value")
    return joins.as_of_join(left, right, "user_id", "ts", "value",
                            F.date_trunc("minute", "ts")).select(
        "event_id", "value")


@query("latest_signal", "J16 F42", cte("candidates") + """
SELECT id, citations FROM candidates""")
def _(spark, sf):
    return candidates(spark, sf).select("id", C.latest(F.col("signals"), "citations")
                                        .alias("citations"))


@query("model_candidates", "P3 F6 F9 F24 F28 F52 F49 S5", """
WITH m AS (SELECT p_partkey, p_brand || CASE p_partkey % 4 WHEN 0 THEN '++' WHEN 1 THEN '+'
    WHEN 2 THEN '#' ELSE ' v2' END || ' ' || p_name || ' ' || p_partkey AS model, p_brand, p_type,
  CASE p_partkey % 3 WHEN 0 THEN '2020' WHEN 1 THEN '2020-06' ELSE '2020-06-07' END AS pub,
  p_retailprice, p_size FROM part)
SELECT 'models:' || trim(regexp_replace(replace(replace(replace(lower(model), '++', '_plusplus'),
    '+', '_plus'), '#', '_sharp'), '[^a-z0-9]+', '_', 'g'), '_') AS id, model AS title,
  rpad(pub, 10, '-01-01') AS published_at, p_brand || '|Labs' AS actors,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(1000 + p_size AS DOUBLE) END AS citations,
  CASE WHEN p_partkey % 2 = 0 THEN 'Type ' || p_type ELSE 'Released by ' || p_brand ||
    ', Labs. domain: ' || p_type || '...' END AS summary,
  'https://m.example/' || p_partkey AS urls FROM m""".replace(
    "rpad(pub, 10, '-01-01')",
    "CASE length(pub) WHEN 4 THEN pub || '-01-01' WHEN 7 THEN pub || '-01' ELSE pub END").replace(
    "|| p_type || '...' END", "|| p_type || '.' END"))
def _(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        F.concat("p_brand", F.when(k % 4 == 0, "++").when(k % 4 == 1, "+").when(k % 4 == 2, "#")
                 .otherwise(" v2"), F.lit(" "), "p_name", F.lit(" "), k.cast("string"))
        .alias("Model"),
        F.concat("p_brand", F.lit(", Labs")).alias("Organization"),
        F.when(k % 3 == 0, "2020").when(k % 3 == 1, "2020-06").otherwise("2020-06-07")
        .alias("Publication date"),
        F.col("p_type").alias("Domain"), F.lit("").alias("Task"),
        F.when(k % 2 == 0, F.concat(F.lit(" Type  "), "p_type")).otherwise("").alias("Abstract"),
        F.concat(F.lit("m.example/"), k.cast("string"), F.lit(" (code)")).alias("Link"),
        F.concat(F.lit("https://m.example/"), k.cast("string")).alias("Reference"),
        F.when(k % 5 == 0, "n/a").otherwise(F.concat(F.lit("1,"), F.lpad(
            F.col("p_size").cast("string"), 3, "0"))).alias("Citations"),
        F.lit("").alias("Parameters"), F.lit("").alias("Training compute (FLOP)"),
        *[F.lit("").alias(c) for c in (
            "Frontier model", "Organization categorization", "Country (of organization)",
            "Notability criteria", "Open model weights?", "Model accessibility", "Confidence")])
    out = PC.from_models(rows, "models", F.lit(SEEN), {"spdx": "CC-BY-4.0"})
    return out.select("id", "title", "published_at", F.array_join("actors", "|").alias("actors"),
                      C.latest(F.col("signals"), "citations").alias("citations"), "summary",
                      F.array_join("source_urls", " ").alias("urls"))


@query("post_candidates", "P5 W1 W9 T11", cte("research") + """
, p AS (SELECT id, title, length(text) AS score, substr(date_published, 1, 4) AS year,
    source, row_number() OVER (PARTITION BY substr(date_published, 1, 4)
    ORDER BY length(text) DESC, id) AS rank FROM research)
SELECT 'forum:' || id AS id, CAST(rank AS DOUBLE) AS karma_rank_in_year,
  CAST(score AS DOUBLE) AS karma, source AS actors FROM p WHERE rank <= 25""")
def _(spark, sf):
    from tidemark.plans.queries_research import research
    posts = research(spark, sf).select(
        F.col("id").alias("_id"), "title", F.col("date_published").alias("postedAt"),
        F.length("text").alias("baseScore"), F.lit(None).cast("int").alias("commentCount"),
        F.col("url").alias("pageUrl"), F.col("source").alias("author"), "tags")
    # overlapping pages land a post again, with the score of a later time
    later = posts.withColumn("baseScore", F.col("baseScore") * 2 + 1)
    landed = posts.withColumn("_page", F.lit(1)).unionByName(later.withColumn("_page", F.lit(2)))
    out = PC.from_posts(landed, "forum", "Forum", F.lit(SEEN), {"spdx": None}, "_page",
                        top_per_year=25)
    return out.select("id", C.latest(F.col("signals"), "karma_rank_in_year")
                      .alias("karma_rank_in_year"),
                      C.latest(F.col("signals"), "karma").alias("karma"),
                      F.array_join("actors", "|").alias("actors"))


@query("decision_tally", "A26 K13", cte("reviews") + """
SELECT verdict, count(*) AS n FROM reviews GROUP BY 1""")
def _(spark, sf):
    said = standin(spark, sf, "reviews").withColumnRenamed("said_at", "at").withColumns(
        {"tier_override": F.lit(None).cast("string"), "note": F.lit("")})
    layer = publish.review_layer(said, "ada")
    return layer.groupBy("verdict").agg(F.count("*").alias("n"))


@query("proposed_tombstones", "V7", cte("reviews") + """
SELECT id, 'privacy' AS category, said_at AS tombstoned_at, reviewer AS decided_by FROM reviews
WHERE verdict = 'privacy'""")
def _(spark, sf):
    return privacy.propose_tombstones(
        standin(spark, sf, "reviews").withColumnRenamed("said_at", "at"))


@query("privacy_screen", "F11 V6", r"""
SELECT item_id, true AS flagged FROM benchmark""" + r"""
UNION ALL SELECT doc_id, false FROM documents WHERE NOT regexp_matches(text,
  '(?i)\b(""" + "|".join(K.PRIVACY_PHRASES) + r""")\b')""")
def _(spark, sf):
    phrase = X.privacy_phrase(F.concat(F.lit("A court CASE about "), F.col("text")))
    marked = table(spark, sf, "benchmark").select("item_id", phrase.alias("flagged"))
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("item_id"), X.privacy_phrase(F.col("text")).alias("flagged"))
    return marked.unionByName(docs.filter(~F.col("flagged")))


@query("newest_dump_per_source", "S7 S8 S18", """
SELECT l_shipmode AS source_id, dump_ts, count(*) AS n FROM (SELECT 's' || (l_suppkey % 10)
    AS l_shipmode, strftime(l_shipdate, '%Y-%m') AS dump_ts FROM lineitem) l
WHERE l_shipmode IN ('s1', 's2', 's3') AND dump_ts = (SELECT max(strftime(x.l_shipdate, '%Y-%m'))
  FROM lineitem x WHERE 's' || (x.l_suppkey % 10) = l.l_shipmode) GROUP BY 1, 2""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("s"), (F.col("l_suppkey") % 10).cast("string")).alias("source_id"),
        F.date_format("l_shipdate", "yyyy-MM").alias("dump_ts"))
    newest = snapshots.newest(from_listed(rows, "source_id", ["s1", "s2", "s3"]))
    return newest.groupBy("source_id", "dump_ts").agg(F.count("*").alias("n"))


@query("union_of_sources", "U1", """
SELECT kind, count(*) AS n, count(score) AS scored FROM (
  SELECT 'document' AS kind, NULL AS score FROM documents
  UNION ALL SELECT 'event', value FROM events) GROUP BY 1""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.lit("document").alias("kind"), "doc_id")
    events = table(spark, sf, "events").select(F.lit("event").alias("kind"),
                                               F.col("value").alias("score"))
    return setops.union_sources(docs, events).groupBy("kind").agg(
        F.count("*").alias("n"), F.count("score").alias("scored"))


@query("reviewer_outcomes", "A11 A26", cte("reviews") + """
SELECT reviewer, verdict, count(*) AS n FROM reviews GROUP BY 1, 2""")
def _(spark, sf):
    return A.review_outcomes(standin(spark, sf, "reviews"))
