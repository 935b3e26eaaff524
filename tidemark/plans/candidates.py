"""The candidate feed: normalised sources, overlays, salience and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import candidates as C
from tidemark.functions import dates as D
from tidemark.functions import numbers as N
from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.operators.dedup import keep_first
from tidemark.operators import aggregates as A
from tidemark.operators import ranking as RK
from tidemark.operators.dedup import row_fingerprint
from tidemark.operators.joins import is_small, lookup_join, split_by
from tidemark.workspace import durable

_STRINGS = "array<string>"


def _text(name: str) -> Column:
    return X.strip(F.coalesce(F.col(f"`{name}`"), F.lit("")))


# --- normalised sources -----------------------------------------------------------

def model_summary(df: DataFrame) -> tuple[Column, Column]:
    """(summary, method): the abstract, else the stated facts."""
    compute = N.parse_number(F.col("`Training compute (FLOP)`"))
    facts = F.array_compact(F.array(
        F.when(_text("Organization") != "", F.concat(
            F.lit("Released by "), X.ascii_ingest(_text("Organization")))),
        F.when(_text("Domain") != "", F.concat(F.lit("domain: "),
                                               X.ascii_ingest(_text("Domain")))),
        F.when(_text("Task") != "", F.concat(F.lit("task: "), X.ascii_ingest(_text("Task")))),
        F.when(compute != 0, F.format_string("training compute approx %.1e FLOP", compute))))
    stated = F.when(F.size(facts) > 0, X.summary(
        F.concat(F.array_join(facts, ". "), F.lit(".")))).otherwise("")
    has = _text("Abstract") != ""
    return (F.when(has, X.summary(_text("Abstract"))).otherwise(stated),
            F.when(has, "upstream_abstract").otherwise("derived"))


def from_models(df: DataFrame, source_id: str, ingested_at: Column,
                licence: dict[str, str | None]) -> DataFrame:
    """Candidate records from a model table of string columns; blank names dropped."""
    name = _text("Model")
    summary, method = model_summary(df)
    published = D.pad_partial(F.coalesce(F.col("`Publication date`"), F.lit("")))
    actors = F.filter(F.transform(F.split(X.ascii_ingest(_text("Organization")), "[,;]"),
                                  X.strip), lambda a: a != "")
    urls = F.array_distinct(F.concat(U.split_cell(F.col("Link")), U.split_cell(F.col("Reference"))))
    prov = C.provenance
    extra = {"organization_categorization": "Organization categorization",
             "country": "Country (of organization)", "frontier_model": "Frontier model",
             "notability_criteria": "Notability criteria", "open_weights": "Open model weights?",
             "model_accessibility": "Model accessibility", "epoch_confidence": "Confidence"}
    return df.withColumn("_hash", row_fingerprint(df)).filter(name != "").select(
        F.concat(F.lit(source_id + ":"), X.model_slug(name)).alias("id"),
        X.ascii_ingest(name).alias("title"), summary.alias("summary"),
        F.lit("model_release").alias("kind"), published.alias("occurred_at"),
        published.alias("published_at"), F.lit(None).cast("string").alias("source_available_at"),
        ingested_at.alias("ingested_at"), actors.alias("actors"), urls.alias("source_urls"),
        F.array().cast(_STRINGS).alias("archive_urls"), F.col("_hash").alias("content_sha256"),
        _licence(licence).alias("license"),
        C.signals_map(ingested_at, citations=N.parse_number(F.col("Citations")),
                      training_compute_flop=N.parse_number(F.col("`Training compute (FLOP)`")),
                      parameters=N.parse_number(F.col("Parameters"))).alias("signals"),
        X.ascii_ingest(name).alias("source_raw_key"),
        F.create_map(*[x for k, c in extra.items()
                       for x in (F.lit(k), X.ascii_ingest(F.col(f"`{c}`")))]).alias("extra"),
        F.array().cast(_STRINGS).alias("forum_tags"),
        F.create_map(
            F.lit("title"), prov("raw", "upstream_field", "high"),
            F.lit("summary"), prov("raw", method, F.when(
                method == "upstream_abstract", "high").otherwise("medium")),
            F.lit("occurred_at"), prov("raw", "upstream_publication_date", "high"),
            F.lit("published_at"), prov("raw", "upstream_publication_date", "high"),
            F.lit("source_available_at"), prov("raw", "unverified_null", "low"),
            F.lit("actors"), prov("raw", "split_upstream_organization", "medium"),
            F.lit("signals"), prov("raw", "upstream_field", "high")).alias("_provenance"))


def _licence(facts: dict[str, str | None]) -> Column:
    return F.struct(*[F.lit(v).cast("string").alias(k) for k, v in facts.items()])


def from_posts(df: DataFrame, source_id: str, forum: str, ingested_at: Column,
               licence: dict[str, str | None], page: str, top_per_year: int = 300) -> DataFrame:
    """Candidate records from landed forum posts: the first seen of each, top n per year ranked.

    ``page`` numbers the landed pages; one page holds a post once.
    Columns: _id, title, postedAt, baseScore, commentCount, pageUrl, author, tags.
    """
    posts = (keep_first(df, ["_id"], "_id", page)
             .withColumn("posted", F.nullif(F.left("postedAt", F.lit(10)), F.lit("")))
             .withColumn("year", F.left("posted", F.lit(4))))
    ranked = RK.top_per_group(posts, ["year"], [F.desc("baseScore"), F.col("_id")], top_per_year)
    title = X.ascii_ingest(_text("title"))
    tags = F.filter(X.ascii_ingest_items(F.coalesce("tags", F.array().cast(_STRINGS))),
                    lambda t: ~X.empty(t))
    prov = C.provenance
    one = lambda c, v: F.when(X.empty(c), F.array().cast(_STRINGS)).otherwise(F.array(v))
    return ranked.filter(title != "").select(
        F.concat(F.lit(source_id + ":"), "_id").alias("id"), title.alias("title"),
        F.lit("").alias("summary"), F.lit("forum_post").alias("kind"),
        F.col("posted").alias("occurred_at"), F.col("posted").alias("published_at"),
        F.lit(None).cast("string").alias("source_available_at"),
        ingested_at.alias("ingested_at"),
        one(F.col("author"), X.ascii_ingest(F.col("author"))).alias("actors"),
        one(F.col("pageUrl"), F.col("pageUrl")).alias("source_urls"),
        F.array().cast(_STRINGS).alias("archive_urls"),
        F.lit(None).cast("string").alias("content_sha256"), _licence(licence).alias("license"),
        C.signals_map(ingested_at, karma=F.col("baseScore"), comment_count=F.col("commentCount"),
                      karma_rank_in_year=F.col("rank")).alias("signals"),
        F.col("_id").alias("source_raw_key"),
        F.create_map(F.lit("forum"), F.lit(forum), F.lit("rank_year"), F.col("year"))
        .alias("extra"), tags.alias("forum_tags"),
        F.create_map(
            F.lit("title"), prov("raw", "upstream_field", "high"),
            F.lit("summary"), prov("raw", "not_collected", "low"),
            F.lit("occurred_at"), prov("raw", "upstream_postedAt", "high"),
            F.lit("published_at"), prov("raw", "upstream_postedAt", "high"),
            F.lit("source_available_at"), prov("raw", "unverified_null", "low"),
            F.lit("actors"), prov("raw", "upstream_display_name", "medium"),
            F.lit("signals"), prov("raw", "upstream_field", "high")).alias("_provenance"))


def in_window(df: DataFrame, since: str | None, until: str | None) -> tuple[DataFrame, dict]:
    """(kept, counters to observe): undated and out-of-window rows are skipped."""
    when = F.col("published_at")
    inside = F.lit(True)
    if since:
        inside = inside & (when >= since)
    if until:
        inside = inside & (when <= until)
    return (df.filter(when.isNotNull() & inside),
            {"skipped_no_date": F.count_if(when.isNull()),
             "skipped_window": F.count_if(when.isNotNull() & ~inside)})


# --- projection ---------------------------------------------------------------------

def with_registry(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Source facts by id prefix, URL cells split, dataset URL as the last resort."""
    facts = registry.select(
        F.col("source_id").alias("_source"), F.lit(True).alias("_known"),
        F.nullif("url", F.lit("")).alias("_url"),
        F.col("source_available_at").alias("_available"), F.col("confidence").alias("_conf"),
        F.coalesce(F.size("evidence"), F.lit(0)).alias("_evidence"))
    df = lookup_join(df.withColumn("_source", F.split("id", ":", 2)[0]), facts, ["_source"],
                     "left", unique=["id"])
    urls = U.split_cells(F.col("source_urls"))
    fallback = (F.size(urls) == 0) & F.col("_url").isNotNull()
    envelope = lambda method, confidence, count: F.struct(
        F.lit("registry").alias("layer"), method.alias("method"),
        confidence.alias("confidence"), count.cast("int").alias("evidence_count"))
    none = F.lit(None)
    dated = F.when(X.empty(F.col("_available")), "low").otherwise(
        F.coalesce("_conf", F.lit("low")))
    clock = F.when(F.col("_known"), envelope(F.lit("source_registry"), dated,
                                             F.col("_evidence"))).otherwise(
        envelope(F.lit("source_not_in_registry"), F.lit("low"), none))
    kept = F.transform_values(F.map_filter("_provenance", lambda k, _: k != "source_available_at"),
                              lambda _, v: F.struct(v["layer"].alias("layer"),
                                                    v["method"].alias("method"),
                                                    v["confidence"].alias("confidence"),
                                                    none.cast("int").alias("evidence_count")))
    kept = F.when(fallback, F.map_filter(kept, lambda k, _: k != "source_urls")).otherwise(kept)
    added = F.map_concat(kept, F.create_map(F.lit("source_available_at"), clock))
    added = F.when(fallback, F.map_concat(added, F.create_map(
        F.lit("source_urls"), envelope(F.lit("aggregator_fallback"), F.lit("low"), none)))
    ).otherwise(added)
    return df.withColumns({
        "source_available_at": F.when(F.col("_known"), F.col("_available"))
        .otherwise(F.col("source_available_at")),
        "source_urls": F.when(fallback, F.array("_url")).otherwise(urls),
        "archive_urls": U.split_cells(F.col("archive_urls")),
        "_provenance": added,
    }).drop("_source", "_known", "_url", "_available", "_conf", "_evidence")


def _haystack() -> Column:
    """The text in which a record's topic is looked for."""
    return F.array_join(F.concat(
        F.array(F.coalesce("title", F.lit(""))), F.coalesce("forum_tags", F.array().cast(_STRINGS)),
        F.array(F.coalesce(F.try_element_at("extra", F.lit("notability_criteria")), F.lit("")))), " ")


def _year() -> Column:
    return F.left(F.coalesce(F.nullif("published_at", F.lit("")), F.lit("____")), F.lit(4))


def _basis(version: Column, weight: Column) -> Column:
    """How a salience came about."""
    return F.struct(
        version.alias("profile_version"), "method", F.bround("score", 4).alias("raw_score"),
        F.col("relevance").alias("topical_relevance"),
        F.concat(F.lit("kind="), "kind", F.lit(",year="), "year").alias("percentile_within"),
        F.col("group_size").cast("int").alias("group_size"), F.bround(weight, 3).alias("shrinkage"))


def score_profile(df: DataFrame, profile: dict) -> DataFrame:
    """Add ``salience``, ``tier`` and ``basis`` of one profile.

    ``_ord`` is the input order that breaks ties between equal saliences;
    (id, _ord) must identify a row.  Ranks are worked out on a narrow written
    table and joined back, so the records themselves are never written.
    """
    kind, haystack = F.col("kind"), _haystack()
    k = float(profile.get("shrinkage_k", 0))
    raw, method = C.raw_salience(profile, kind, F.col("signals"), F.col("extra"))
    narrow = durable(df.select(
        "id", "_ord", F.coalesce(kind, F.lit("None")).alias("kind"), _year().alias("year"),
        raw.alias("score"), method.alias("method"),
        C.topical_relevance(profile, kind, haystack).alias("relevance")), "signals")
    placed = RK.distinct_percentile(narrow, ["kind", "year"], "score")
    shrunk = RK.shrink(F.col("percentile"), F.col("group_size"), k)
    weight = F.col("group_size") / (F.col("group_size") + F.lit(k)) if k else F.lit(1.0)
    placed = placed.select(
        "id", "_ord", F.bround(shrunk * F.col("relevance"), 4).alias("salience"),
        _basis(F.lit(profile.get("version")), weight).alias("basis"))
    tiered = RK.quantile_tiers(durable(placed, "scored"), "salience", [F.col("_ord")],
                               profile["tier_quantiles"])
    return lookup_join(df, durable(tiered, "tiered"), ["id", "_ord"], unique=["id", "_ord"])


def score_all(df: DataFrame, profiles: list[dict]) -> DataFrame:
    """Every profile side by side: maps keyed by profile id.

    Profiles are rows here: each record has one narrow row per profile, percentiles and tiers are worked
    out for all of them together, and one join brings the maps to the records.  So neither the shuffles
    nor the writes grow with the number of profiles.  Null ids are keys like any other.
    """
    kind, haystack = F.col("kind"), _haystack()
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("profile"))
    scores = []
    for p in profiles:
        raw, _ = C.raw_salience(p, kind, F.col("signals"), F.col("extra"))
        scores.append(F.struct(raw.cast("double").alias("score"),
                               C.topical_relevance(p, kind, haystack).cast("double").alias("relevance")))
    narrow = durable(df.select("id", "_ord", F.coalesce(kind, F.lit("None")).alias("kind"),
                               _year().alias("year"), F.posexplode(F.array(*scores)).alias("profile", "s"))
                     .select("id", "_ord", "kind", "year", "profile", "s.*"), "signals")
    placed = RK.distinct_percentile(narrow, ["profile", "kind", "year"], "score")
    size = F.col("group_size")
    weight = size / (size + pick([float(p.get("shrinkage_k", 0)) for p in profiles]))
    shrunk = F.lit(0.5) + (F.col("percentile") - F.lit(0.5)) * weight
    placed = durable(placed.select(
        "id", "_ord", "profile", "score", "relevance", "group_size",
        F.bround(shrunk * F.col("relevance"), 4).alias("salience")), "scored")
    tiered = RK.quantile_tiers_by_group(placed, "profile", "salience", [F.col("_ord")],
                                        {i: p["tier_quantiles"] for i, p in enumerate(profiles)})
    tiers = list(dict.fromkeys([t for p in profiles for t, _ in p["tier_quantiles"]] + ["D"]))
    tiered = tiered.withColumn("tier", F.array_position(F.array(*map(F.lit, tiers)), F.col("tier")))
    ranked = ("salience", "tier", "score", "relevance", "group_size")
    # numbers only: they are aggregated by hash, without sorting the rows
    if len(profiles) == 1:
        wide = tiered.select("id", "_ord", *[F.col(c).alias(f"_{c}_0") for c in ranked])
    else:
        wide = tiered.groupBy("id", "_ord").agg(*[
            F.max(F.when(F.col("profile") == i, F.col(c))).alias(f"_{c}_{i}")
            for i in range(len(profiles)) for c in ranked])
    out = lookup_join(df, wide, ["id", "_ord"], known_small=is_small(narrow.select("id", "_ord")),
                      unique=["id", "_ord"])
    entries = []
    for i, p in sorted(enumerate(profiles), key=lambda x: x[1]["profile_id"]):
        _, method = C.raw_salience(p, kind, F.col("signals"), F.col("extra"))
        k, size = float(p.get("shrinkage_k", 0)), F.col(f"_group_size_{i}")
        basis = F.struct(
            F.lit(p.get("version")).cast("string").alias("profile_version"), method.alias("method"),
            F.bround(f"_score_{i}", 4).alias("raw_score"),
            F.col(f"_relevance_{i}").alias("topical_relevance"),
            F.concat(F.lit("kind="), F.coalesce(kind, F.lit("None")), F.lit(",year="), _year())
            .alias("percentile_within"), size.cast("int").alias("group_size"),
            F.bround(size / (size + F.lit(k)), 3).alias("shrinkage"))
        entries.append((F.lit(p["profile_id"]), F.col(f"_salience_{i}"),
                        F.get(F.array(*map(F.lit, tiers)), F.col(f"_tier_{i}").cast("int") - 1), basis))
    by = lambda at: F.create_map(*[x for e in entries for x in (e[0], e[at])])
    return out.withColumns({"salience_by_profile": by(1), "salience_tier_by_profile": by(2),
                            "salience_basis_by_profile": by(3)}).select(
        *df.columns, "salience_by_profile", "salience_tier_by_profile", "salience_basis_by_profile")


def reviews_by_id(reviews: DataFrame) -> DataFrame:
    """id -> array of reviews in layer order.

    A layer holds one entry per id, so an array is as long as the number of
    layers at most; repeats inside a layer are reduced first.
    """
    fields = [c for c in reviews.columns if c not in ("id", "layer")]
    one = reviews.groupBy("id", "layer").agg(
        F.max_by(F.struct(*fields), F.coalesce("at", F.lit(""))).alias("r"))
    entry = F.struct("layer", *[F.col(f"r.{f}").alias(f) for f in fields])
    return one.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("reviews"))


def tags_by_id(tags: DataFrame) -> DataFrame:
    """id -> map of layer to tag; one tag per layer and id."""
    one = tags.groupBy("id", "layer_id").agg(F.max("tag").alias("tag"))
    return one.groupBy("id").agg(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("layer_id", "tag")))).alias("airr_tags_by_layer"))


def project(records: DataFrame, *, tombstones: DataFrame, registry: DataFrame,
            profiles: list[dict], reviews: DataFrame,
            tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): every record is in one of them, dropped with its reason."""
    removed = durable(tombstones.select("id", F.lit("tombstoned").alias("reason"), "category",
                                        "tombstoned_at"), "tombstones")
    kept, dropped = split_by(records, removed, "id")
    kept = score_all(with_registry(kept, registry), profiles).drop("airr_tags")
    kept = (kept.join(tags_by_id(tags), "id", "left").join(reviews_by_id(reviews), "id", "left"))
    flagged = X.privacy_phrase(F.col("title"))
    return kept.withColumns({
        "reviews": F.coalesce("reviews", F.array().cast(dict(kept.dtypes)["reviews"])),
        "privacy_review_required": flagged,
        "review_status": C.review_status(F.size("reviews"), flagged)}), dropped


def feed_order(profile: str) -> list[Column]:
    return [F.desc(F.element_at("salience_by_profile", F.lit(profile))), F.col("id")]


def feed_counters(kept: DataFrame) -> DataFrame:
    """(year, kept, flagged, reviewed); undated rows count under ``unknown``."""
    year = F.left(F.coalesce(F.nullif("published_at", F.lit("")), F.lit("unknown")), F.lit(4))
    return kept.groupBy(year.alias("year")).agg(
        F.count("*").alias("kept"), F.count_if("privacy_review_required").alias("flagged"),
        F.count_if(F.size("reviews") > 0).alias("reviewed"))


# --- reviewed collection ----------------------------------------------------------------

def reviewed(df: DataFrame) -> DataFrame:
    """Reviewed records without a privacy flag or a privacy verdict."""
    return df.filter((F.size("reviews") > 0) & ~F.col("privacy_review_required")
                     & ~F.exists("reviews", lambda r: F.coalesce(
                         r["verdict"] == "privacy", F.lit(False))))


def reviewed_counts(df: DataFrame) -> DataFrame:
    """One row: scanned, included, withheld and the verdict of each included record."""
    has = F.size("reviews") > 0
    private = F.col("privacy_review_required") | F.exists("reviews", lambda r: F.coalesce(
        r["verdict"] == "privacy", F.lit(False)))
    kept = has & ~private
    verdict = F.when(F.exists("reviews", lambda r: r["verdict"] == "accept"), "accept").otherwise(
        F.coalesce(F.nullif(F.try_element_at("reviews", F.lit(1))["verdict"], F.lit("")),
                   F.lit("unknown")))
    return df.agg(F.count("*").alias("scanned"), F.count_if(kept).alias("included"),
                  F.count_if(has & private).alias("withheld_privacy"),
                  *[F.count_if(kept & (verdict == v)).alias(f"verdict_{v}")
                    for v in ("accept", "unsure", "reject", "unknown")])


def reviewer_verdicts(df: DataFrame) -> DataFrame:
    return A.review_outcomes(reviewed(df).select(F.explode("reviews").alias("r"))
                             .select("r.reviewer", "r.verdict"))




def reviewed_order() -> list[Column]:
    return [F.coalesce("published_at", F.lit("")), F.coalesce("id", F.lit(""))]


# --- review selection ----------------------------------------------------------------------

def open_posts(df: DataFrame) -> DataFrame:
    """Forum posts nobody has ruled on and the privacy screen did not flag."""
    return df.filter((F.col("kind") == "forum_post") & (F.size("reviews") == 0)
                     & ~F.col("privacy_review_required"))


def shortlist(df: DataFrame, limit: int) -> DataFrame:
    """Posts with category terms: most terms first, then karma."""
    posts = open_posts(df).filter(C.has_shortlist_term(F.col("title")))
    rows = C.with_shortlist_score(posts, "title").select(
        "id", "title", F.coalesce(F.nullif("published_at", F.lit("")), "occurred_at")
        .alias("date"), C.max_signal(F.col("signals"), "karma").alias("karma"),
        F.col("category").alias("suggested_category"), "terms", "n_terms",
        F.get("source_urls", F.lit(0)).alias("url"))
    return rows.orderBy(F.desc("n_terms"), F.desc(F.coalesce("karma", F.lit(0))),
                        "id").limit(limit)


def scan_view(df: DataFrame, limit: int) -> DataFrame:
    """Term rows first, then by karma, up to ``limit``; each row says which."""
    hit = F.col("category").isNotNull()
    rows = C.with_shortlist_score(open_posts(df), "title").select(
        "id", "title", F.left(F.coalesce(F.nullif("published_at", F.lit("")), "occurred_at",
                                         F.lit("")), F.lit(10)).alias("date"),
        C.max_signal(F.col("signals"), "karma").alias("karma"),
        F.coalesce("category", F.lit("no term match")).alias("category"),
        F.when(hit, F.col("n_terms")).otherwise(0).alias("n"),
        F.when(hit, "term").otherwise("karma").alias("basis"))
    return rows.orderBy(F.col("basis") == "karma", F.desc("n"),
                        F.desc(F.coalesce("karma", F.lit(0))), "id").limit(limit)


def queue_keys(mode: str, profile: str) -> list[tuple[Column, bool]]:
    """The keys of a review queue order before the id, each with whether it descends."""
    salience = F.coalesce(F.try_element_at("salience_by_profile", F.lit(profile)), F.lit(0.0))
    signals = F.col("signals")
    relevance = F.try_element_at("salience_basis_by_profile",
                                 F.lit(profile))["topical_relevance"]
    orders = {
        "salience": [salience],
        "spread": [C.signal_disagreement(salience, relevance, C.latest(signals, "karma"),
                                         C.latest(signals, "citations"))],
        "privacy": [F.col("privacy_review_required"), salience],
        "date": [F.coalesce("published_at", F.lit(""))]}
    return [(c, True) for c in orders[mode]]


def queue_order(mode: str, profile: str) -> list[Column]:
    """Review queue orders: salience, spread, privacy, date."""
    return [*[F.desc(c) if down else c for c, down in queue_keys(mode, profile)], F.col("id")]


def tag_feed(train_df: DataFrame, label: str, parts: list[str],
             feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tags, outcomes): the tagger trained on labelled rows, applied to the feed."""
    from tidemark.operators import tagging as TG
    examples = TG.labelled(train_df, label, parts)
    weights, domains = TG.train(TG.token_counts(examples, [label], "text"), label)
    text = F.concat_ws(" ", F.nullif("title", F.lit("")), F.nullif("summary", F.lit("")),
                       F.nullif(F.array_join("forum_tags", " "), F.lit("")))
    said = durable(TG.classify(feed.select("id", text.alias("text")), "id", "text",
                               durable(weights, "weights"), domains), "tags")
    tags = said.filter("domain is not null").select(
        "id", F.struct("domain", F.bround("margin", 4).alias("margin"),
                       F.col("tokens").alias("tokens_used"),
                       TG.tag_confidence(F.col("tokens"), F.col("margin")).alias("confidence"))
        .alias("tag"))
    outcomes = said.groupBy("reason", "domain").agg(F.count("*").alias("n"))
    return tags, outcomes
