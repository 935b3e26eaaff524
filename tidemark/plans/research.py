"""Clean, enrich, score and turn research records into timeline events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates as D
from tidemark.functions import research as R
from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.operators.dedup import keep_first

TEXT_FIELDS = ("title", "text", "abstract", "description")


def _tidy(items: Column, each) -> Column:
    kept = F.filter(items, lambda s: ~X.empty(s))
    return F.array_sort(F.array_distinct(F.transform(kept, each)))


def clean_records(df: DataFrame) -> DataFrame:
    """Normalise the text, date, URL and list fields that the table has."""
    changes: dict[str, Column] = {}
    for name in TEXT_FIELDS:
        if name in df.columns:
            changes[name] = X.normalise_text(F.col(name))
    if "date_published" in df.columns:
        changes["date_published"] = D.normalise(F.col("date_published"))
    if "url" in df.columns:
        changes["url"] = U.drop_tracking(F.col("url"))
    lists = {"sources": U.drop_tracking, "tags": lambda t: X.strip(F.lower(t)),
             "authors": X.strip}
    for name, each in lists.items():
        if name in df.columns:
            changes[name] = _tidy(F.col(name), each)
    return df.withColumns(changes)


def clean(df: DataFrame, *, file: str = "_file", order: str = "_ord",
          key: str = "id") -> DataFrame:
    """Keep the first row of each id per file, then normalise the fields."""
    return clean_records(keep_first(df, [file], key, order))


def clean_metrics() -> dict[str, Column]:
    """Counters to observe on the cleaned rows."""
    return {"total_records": F.count(F.lit(1)),
            "missing_id": F.count_if(X.empty(F.col("id")))}


def clean_event_fields(df: DataFrame) -> DataFrame:
    """Simpler list and string rules of hand-authored events."""
    changes = {c: X.strip(F.col(c)) for c in ("title", "description",
               "safety_researcher_reaction", "media_reaction") if c in df.columns}
    changes["sources"] = F.array_sort(F.array_distinct("sources"))
    changes["tags"] = F.array_sort(F.array_distinct(F.transform("tags", F.lower)))
    return df.withColumns(changes)


def enrich(df: DataFrame, enriched_at: Column | None = None) -> DataFrame:
    """Add temporal fields, content metrics, relevance, level and topics.

    Lower-case text, word and keyword counts are columns of their own first,
    so that each is computed once per row.
    """
    text, title = F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))
    has_text, has_title = ~X.empty(F.col("text")), ~X.empty(F.col("title"))
    low = F.col("_low")
    df = df.withColumns({"_low": F.lower(text), "_words": R.word_count(text)})
    df = df.withColumns({
        **R.relevance_counts(F.concat(F.lower(title), F.lit(" "), low)), **R.level_counts(low),
        "_topics": R.topics(low, F.col("tags"))})
    out = dict(D.temporal_fields(F.col("date_published")))
    metrics = {"word_count": F.col("_words"),
               "reading_time_minutes": R.reading_minutes(F.col("_words")),
               "paragraph_count": R.paragraph_count(text), "has_code": R.has_code(text)}
    # a record without text gets no metrics
    out.update({n: F.when(has_text, c) for n, c in metrics.items()})
    out["safety_relevance"] = F.when(has_text | has_title, R.safety_relevance(
        F.col("_high"), F.col("_medium")))
    out["technical_level"] = F.when(has_text, R.technical_level(
        F.col("source"), F.col("_research"), F.col("_tutorial")))
    out["primary_topics"] = F.when(F.size("_topics") > 0, F.col("_topics"))
    if "_enriched" not in df.columns:
        at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") \
            if enriched_at is None else enriched_at
        out["_enriched"] = F.struct(at.alias("enrichment_date"),
                                    F.lit("1.0.0").alias("enrichment_version"))
    return df.withColumns(out).drop("_low", "_words", "_high", "_medium", "_research",
                                    "_tutorial", "_topics")


def score(df: DataFrame) -> DataFrame:
    """(source_id, quality_score, quality_tier, signals, title_preview)."""
    text, title, date = F.col("text"), F.col("title"), F.col("date_published")
    points = R.quality_score(source=F.col("source"), title=title, text=text,
                             authors=F.col("authors"), tags=F.col("tags"), date_published=date)
    size = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    return df.select(
        F.col("id").alias("source_id"), F.bround(points, 1).alias("quality_score"),
        R.quality_tier(points).alias("quality_tier"),
        F.struct(F.col("source"), size("authors").alias("has_authors"),
                 R.is_newsletter(title, text).alias("is_newsletter"),
                 F.length(F.coalesce(text, F.lit(""))).alias("text_length"),
                 F.left(F.coalesce(date, F.lit("")), F.lit(4)).alias("year"),
                 size("tags").alias("has_tags")).alias("signals"),
        F.left(F.coalesce(title, F.lit("")), F.lit(80)).alias("title_preview"))


def _event(df: DataFrame, score_column: str, title: Column, fields: dict[str, Column],
           extra: list[Column]) -> DataFrame:
    url = F.col("url")
    return df.select(
        X.event_slug(F.col("source"), F.col("id")).alias("id"), title.alias("title"),
        fields["year"].alias("year"), fields["category"].alias("category"),
        fields["description"].alias("description"), fields["impacts"].alias("impacts"),
        F.when(X.empty(url), F.array().cast("array<string>")).otherwise(F.array(url))
        .alias("sources"),
        F.slice(F.coalesce("tags", F.array().cast("array<string>")), 1, 10).alias("tags"),
        fields["rarity"].alias("rarity"), F.lit(None).cast("double").alias(score_column),
        fields["safety"].alias("safety_researcher_reaction"),
        fields["media"].alias("media_reaction"), *extra)


def _optional(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def enriched_to_timeline(df: DataFrame, score_column: str = "doom_impact") -> DataFrame:
    """Timeline events from enriched records."""
    source, title, text = F.col("source"), F.col("title"), F.col("text")
    relevance = F.coalesce("safety_relevance", F.lit("Low"))
    level = F.col("technical_level")
    topics = F.coalesce("primary_topics", F.array().cast("array<string>"))
    key = F.col("id")
    return _event(df, score_column, F.left(F.coalesce(title, F.lit("Unknown")), F.lit(200)), {
        "year": F.coalesce("year", F.lit(2020)),
        "category": R.category_enriched(source, topics, title, text, level),
        "description": X.description(_optional(df, "abstract"), text, title,
                                     unknown="Unknown title"),
        "impacts": R.impacts_enriched(relevance, F.coalesce(level, F.lit("Overview")), source,
                                      topics),
        "rarity": R.rarity_enriched(relevance, source, F.col("word_count")),
        "safety": R.pick_by({k: R.K.REACTIONS_BY_RELEVANCE[k] for k in ("High", "Medium")},
                            relevance, key, R.K.REACTIONS_BY_RELEVANCE["Low"]),
        "media": R.media_reaction(source)}, [])


def tiered_to_timeline(df: DataFrame, scores: DataFrame, tiers: tuple[str, ...] = ("A", "B"),
                       score_column: str = "doom_impact") -> DataFrame:
    """Timeline events from the records whose id is in the selected tiers."""
    chosen = scores.filter(F.col("quality_tier").isin(list(tiers))).select(
        F.col("source_id").alias("id"))
    df = df.join(chosen, "id", "left_semi")
    source, title, text, key = F.col("source"), F.col("title"), F.col("text"), F.col("id")
    shown = X.ascii_mask(F.left(F.coalesce(title, F.lit("Unknown")), F.lit(200)))
    return _event(df, score_column, shown, {
        "year": D.year_or(F.coalesce("date_published", F.lit(""))),
        "category": R.category_tiered(source, title, text),
        "description": X.description(_optional(df, "abstract"), text, title, unknown="Unknown",
                                     ascii_only=True),
        "impacts": R.impacts_tiered(source),
        "rarity": R.rarity_tiered(source, text),
        "safety": R.stable_pick(R.K.TIERED_SAFETY_REACTIONS, key),
        "media": R.pick_by(R.K.TIERED_MEDIA_REACTIONS, source, F.concat(key, F.lit("m")),
                           R.K.TIERED_MEDIA_DEFAULT)}, [F.col("id").alias("source_id")])


def standard_record(df: DataFrame, provenance: dict[str, str], ingested_at: Column) -> DataFrame:
    """Required fields always, optional ones as they are, and a provenance struct."""
    required = ("id", "source", "title", "text", "url", "date_published")
    optional = ("authors", "abstract", "doi", "primary_category", "categories", "tags",
                "source_type", "converted_with", "alignment_text", "confidence_score",
                "journal_ref", "author_comment", "citation_level")
    fields = [F.lit(v).alias(k) for k, v in provenance.items()]
    return df.select(
        *[F.coalesce(F.col(c) if c in df.columns else F.lit(None), F.lit("")).alias(c)
          for c in required],
        *[c for c in optional if c in df.columns],
        F.struct(*fields, ingested_at.alias("ingestion_date"), F.array(
            F.lit("schema_standardization"), F.lit("provenance_addition"))
            .alias("transformations")).alias("_provenance"))


def factual_only(df: DataFrame, at: Column, score_column: str, dropped: tuple[str, ...] = (
        "game_impacts", "rarity", "gameplay_weight", "unlock_conditions",
        "player_choices")) -> DataFrame:
    """Drop the game fields and the score, fill three scholarly defaults, structure the sources."""
    out = df.drop(*dropped, score_column)
    defaults = {"research_notes": "Detailed analysis pending scholarly review",
                "verification_status": "pending_peer_review"}
    for name, text in defaults.items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(text))
    if "probability_impact_analysis" not in out.columns:
        out = out.withColumn("probability_impact_analysis", F.struct(
            F.lit("To be determined").alias("methodology"),
            F.lit("Analysis pending").alias("p_doom_change_estimate"),
            F.lit("To be calculated").alias("confidence_interval"), at.alias("analysis_date"),
            F.lit("requires_scholarly_review").alias("status")))
    return out.withColumn("sources", F.transform("sources", lambda s: F.struct(
        s.alias("url"), F.lit("web_resource").alias("type"), at.alias("accessed_date"),
        F.lit("requires_proper_citation").alias("citation_status"))))


def display(df: DataFrame) -> DataFrame:
    """Title-cased category and rarity, first two sources joined."""
    return df.select(
        "title", F.col("year").cast("string").alias("year"), "description",
        F.initcap(F.replace("category", F.lit("_"), F.lit(" "))).alias("category"),
        F.initcap("rarity").alias("rarity"),
        F.array_join(F.slice("sources", 1, 2), ", ").alias("sources"))
