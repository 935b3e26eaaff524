"""Expressions over research records: metrics, categories, score, event fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import text as X


def _present(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


# --- content metrics ---------------------------------------------------------

def word_count(text: Column) -> Column:
    return F.regexp_count(_present(text), F.lit(K.WORD_CLASS + "+"))


def paragraph_count(text: Column) -> Column:
    return F.size(F.filter(F.split(_present(text), r"\n" + K.PY_SPACE_CLASS + r"*\n"),
                           lambda p: ~X.is_blank(p)))


def reading_minutes(words: Column) -> Column:
    return F.greatest(F.lit(1), F.bround(words / K.WORDS_PER_MINUTE).cast("int"))


def has_code(text: Column) -> Column:
    return _present(text).rlike(K.CODE_PATTERN)


def relevance_counts(low: Column) -> dict[str, Column]:
    """Keyword counts of lower-case title and text; make them columns, they are used twice."""
    return {"_high": X.count_present(low, K.HIGH_RELEVANCE),
            "_medium": X.count_present(low, K.MEDIUM_RELEVANCE)}


def level_counts(low: Column) -> dict[str, Column]:
    return {"_research": X.count_present(low, K.RESEARCH_MARKS),
            "_tutorial": X.count_present(low, K.TUTORIAL_MARKS)}


def safety_relevance(high: Column, medium: Column) -> Column:
    return (F.when(high >= 2, "High").when((high >= 1) | (medium >= 3), "Medium")
            .otherwise("Low"))


def technical_level(source: Column, research: Column, tutorial: Column) -> Column:
    return (F.when(_present(source) == "arxiv", "Research")
            .when((research > tutorial) & (research >= 2), "Research")
            .when((tutorial > research) & (tutorial >= 2), "Tutorial")
            .otherwise("Overview"))


def topics(low: Column, tags: Column) -> Column:
    """First five tags and the keyword groups hit; distinct, sorted, first ten."""
    hits = F.array_compact(F.array(*[
        F.when(X.any_present(low, words), F.lit(topic))
        for topic, words in K.TOPIC_KEYWORDS.items()]))
    first = F.slice(F.coalesce(tags, F.array().cast("array<string>")), 1, 5)
    return F.slice(F.array_sort(F.array_union(first, hits)), 1, 10)


# --- quality score -----------------------------------------------------------

def is_newsletter(title: Column, text: Column) -> Column:
    in_title = F.lower(_present(title)).rlike("(?i)" + "|".join(K.NEWSLETTER_TITLE))
    in_text = F.lower(F.left(_present(text), F.lit(500))).rlike(
        "(?i)" + "|".join(K.NEWSLETTER_TEXT))
    return in_title | in_text


def quality_score(*, source: Column, title: Column, text: Column, authors: Column,
                  tags: Column, date_published: Column) -> Column:
    w = K.QUALITY_WEIGHTS
    length = F.length(_present(text))
    year = F.left(_present(date_published), F.lit(4))
    parts = (
        (_present(source).isin(*K.LEADING_VENUES), w["venue"]),
        (F.coalesce(F.size(authors), F.lit(0)) > 0, w["authors"]),
        (~is_newsletter(title, text), w["not_newsletter"]),
        (length > 5000, w["over_5k"]),
        (length > 10000, w["over_10k"]),
        (F.coalesce(F.when(year.rlike(r"^[0-9]+\z"), year.try_cast("int")) <= 2019,
                    F.lit(False)), w["before_2020"]),
        (F.coalesce(F.size(tags), F.lit(0)) > 0, w["tags"]),
    )
    total = F.lit(0.0)
    for hit, points in parts:
        total = total + F.when(hit, points).otherwise(0.0)
    return total


def quality_tier(score: Column) -> Column:
    out = F
    for tier, bound in K.QUALITY_TIERS:
        out = out.when(score >= bound, tier)
    return out.otherwise("D")


# --- event fields ------------------------------------------------------------

def stable_pick(options: tuple[str, ...], key: Column) -> Column:
    """One option per key, the same on every run."""
    number = F.conv(F.substring(F.md5(_present(key)), 1, 8), 16, 10).cast("bigint")
    return F.element_at(F.array(*[F.lit(o) for o in options]),
                        (number % len(options) + 1).cast("int"))


def pick_by(table: dict[str, tuple[str, ...]], selector: Column, key: Column,
            default: tuple[str, ...]) -> Column:
    out = F
    for name, options in table.items():
        out = out.when(selector == name, stable_pick(options, key))
    return out.otherwise(stable_pick(default, key))


def media_reaction(source: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in K.MEDIA_BY_SOURCE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, _present(source)), F.lit(K.MEDIA_DEFAULT))


def _opening(text: Column) -> Column:
    return F.lower(F.left(_present(text), F.lit(500)))


def category_enriched(source, topics_, title, text, level) -> Column:
    """Category rules of the enriched records; the first match wins."""
    src, low = _present(source), F.lower(_present(title))
    has = lambda t: F.coalesce(F.array_contains(topics_, t), F.lit(False))
    return (F.when((src == "arxiv") | F.contains(F.lower(_present(level)), F.lit("research")),
                   "technical_research_breakthrough")
            .when(has("governance") | F.contains(low, F.lit("policy"))
                  | F.contains(_opening(text), F.lit("regulation")), "policy_development")
            .when(src.isin(*K.FORUM_SOURCES), "public_awareness")
            .when(has("capabilities") | X.any_present(low, ("gpt", "claude")),
                  "capability_advance")
            .otherwise("technical_research_breakthrough"))


def category_tiered(source, title, text) -> Column:
    """Category rules of the tier-selected records; the first match wins."""
    src, low = _present(source), F.lower(_present(title))
    return (F.when(src.isin(*K.LEADING_VENUES), "technical_research_breakthrough")
            .when(X.any_present(_opening(text), ("governance", "regulation"))
                  | F.contains(low, F.lit("policy")), "policy_development")
            .when(X.any_present(low, ("gpt", "claude", "language model")),
                  "capability_advance")
            .when(src.isin(*K.FORUM_SOURCES), "public_awareness")
            .otherwise("technical_research_breakthrough"))


def rarity_enriched(relevance, source, word_count) -> Column:
    high = F.coalesce(relevance, F.lit("Low")) == "High"
    paper = _present(source) == "arxiv"
    return (F.when(high & paper & (F.coalesce(word_count, F.lit(0)) > 3000), "legendary")
            .when(high | paper, "rare").otherwise("common"))


def rarity_tiered(source, text) -> Column:
    src, n = _present(source), F.length(_present(text))
    return (F.when(src == "distill", "legendary")
            .when(src == "arxiv", F.when(n > 20000, "rare").otherwise("common"))
            .when(n > 10000, "rare").otherwise("common"))


def impact(variable: str, change: Column) -> Column:
    return F.struct(F.lit(variable).alias("variable"),
                    change.cast("double").alias("change"),
                    F.lit(None).cast("string").alias("condition"))


def _impacts(*entries: tuple[Column | None, str, Column]) -> Column:
    return F.array_compact(F.array(*[
        impact(name, change) if when is None else F.when(when, impact(name, change))
        for when, name, change in entries]))


def impacts_enriched(relevance, level, source, topics_) -> Column:
    base = F.when(level == "Research", 15).when(level == "Tutorial", 10).otherwise(5)
    doom = F.when(relevance == "High", 5).when(relevance == "Medium", 2)
    has = lambda t: F.coalesce(F.array_contains(topics_, t), F.lit(False))
    return _impacts((None, "research", base),
                    (_present(source) == "arxiv", "papers", F.lit(10)),
                    (doom.isNotNull(), "vibey_doom", doom),
                    (has("alignment") | has("interpretability"), "ethics_risk", F.lit(-5)))


def impacts_tiered(source) -> Column:
    src = _present(source)
    venue = src.isin(*K.LEADING_VENUES)
    return _impacts((None, "research", F.when(venue, 15).otherwise(10)),
                    (venue, "papers", F.lit(10)),
                    (venue, "vibey_doom", F.when(src == "arxiv", 3).otherwise(5)))


def impact_score(impacts: Column) -> Column:
    """Sum of absolute changes over an event's impact array."""
    return F.aggregate(F.coalesce(impacts, F.array().cast(
        "array<struct<variable:string,change:double,condition:string>>")),
        F.lit(0.0), lambda a, i: a + F.abs(F.coalesce(i["change"], F.lit(0.0))))


def impact_level(score: Column) -> Column:
    out = F
    for level, bound in K.IMPACT_LEVELS:
        out = out.when(score >= bound, level)
    return out.otherwise("Low")


def import_family(record_id: Column) -> Column:
    return (F.when(record_id.startswith("arxiv"), "arxiv")
            .when(record_id.startswith("distill"), "distill")
            .when(record_id.startswith("alignmentforum"), "alignmentforum")
            .otherwise("hand_authored"))
