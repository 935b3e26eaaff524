"""Row filters of the collections. Every filter is a plain predicate Spark can push down."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import empty


def research(df: DataFrame, *, min_date: str, after: str | None = None,
             sources: Sequence[str] = (), keywords: Sequence[str] = (),
             min_chars: int = 100) -> DataFrame:
    """Dated, recent enough, from a listed source, on a keyword and long enough.

    ``after`` is the delta bound, read once before the job starts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keep = ~empty(F.col("date_published")) & (F.col("date_published") >= min_date)
    if after is not None:
        keep = keep & (F.col("date_published") > after)
    if sources:
        keep = keep & F.col("source").isin(list(sources))
    keep = keep & (F.length(text) >= min_chars)
    if keywords:
        hay = F.concat(F.lower(text), F.lit(" "), F.lower(F.coalesce("title", F.lit(""))))
        keep = keep & reduce(lambda a, b: a | b,
                             [F.contains(hay, F.lit(k.lower())) for k in keywords])
    return df.filter(keep)


def events(df: DataFrame, *, categories: Sequence[str] = (), year_min: int = 0,
           year_max: int = 0, variables: Sequence[str] = (), tags: Sequence[str] = (),
           rarity: str | None = None, text: str = "") -> DataFrame:
    """Event filter; a bound of 0 is no bound, and a missing year fails a set bound."""
    strings = lambda xs: F.array(*[F.lit(x) for x in xs])
    if categories:
        df = df.filter(F.col("category").isin(list(categories)))
    if year_min:
        df = df.filter((F.col("year") != 0) & (F.col("year") >= year_min))
    if year_max:
        df = df.filter((F.col("year") != 0) & (F.col("year") <= year_max))
    if variables:
        df = df.filter(F.arrays_overlap(F.transform("impacts", lambda i: i["variable"]),
                                        strings(variables)))
    if tags:
        df = df.filter(F.arrays_overlap("tags", strings(tags)))
    if rarity:
        df = df.filter(F.col("rarity") == rarity)
    if text:
        needle = F.lit(text.lower())
        df = df.filter(F.contains(F.lower(F.coalesce("title", F.lit(""))), needle)
                       | F.contains(F.lower(F.coalesce("description", F.lit(""))), needle))
    return df


def has_overlay(df: DataFrame, overlay: DataFrame, key: str, wanted: bool) -> DataFrame:
    return df.join(overlay.select(key), key, "left_semi" if wanted else "left_anti")


def by_overlay_level(df: DataFrame, overlay: DataFrame, key: str, level: str) -> DataFrame:
    """Overlay ``impact_level`` equals ``level``; ``unset`` means none recorded."""
    rated = overlay.filter(~empty(F.col("impact_level")))
    if level == "unset":
        return df.join(rated.select(key), key, "left_anti")
    return df.join(rated.filter(F.col("impact_level") == level).select(key), key, "left_semi")


def missing_list(col: Column) -> Column:
    return F.coalesce(F.size(col), F.lit(0)) <= 0


def watch(df: DataFrame, *, status: str | None = None, statuses: Sequence[str] = (),
          undecided: bool = False, rating: str | None = None, platform: str | None = None,
          scan: str | None = None, dated: bool = False, sourced: bool = False,
          needs_attention: bool = False) -> DataFrame:
    """Watch-list selector. A null ``cleared_for`` is not consent."""
    if status:
        df = df.filter(F.col("watch_status") == status)
    if statuses:
        df = df.filter(F.col("watch_status").isin(list(statuses)))
    if undecided:
        df = df.filter(empty(F.col("watch_status")))
    if rating:
        df = df.filter(F.col("rating") == rating)
    if platform:
        df = df.filter(F.col("cleared_for").isNotNull()
                       & F.array_contains("cleared_for", platform))
    if scan:
        df = df.filter(F.array_contains("scans", scan))
    if dated:
        df = df.filter(~empty(F.col("date")))
    if sourced:
        df = df.filter(~missing_list(F.col("sources")))
    if needs_attention:
        df = df.filter(missing_list(F.col("sources")) | empty(F.col("date"))
                       | ~missing_list(F.col("possible_duplicate_of")))
    return df


def watch_order(df: DataFrame, limit: int = 0) -> DataFrame:
    """Dated first, then id; ``limit`` 0 keeps all."""
    df = df.orderBy(F.coalesce(F.nullif("date", F.lit("")), F.lit("9999")), "id")
    return df.limit(limit) if limit else df


def review_queue(df: DataFrame, decisions: DataFrame, mode: str, profile: str) -> DataFrame:
    """Undecided, tier A, tiers A and B, flagged, or all."""
    tier = F.coalesce(F.try_element_at("salience_tier_by_profile", F.lit(profile)), F.lit("D"))
    if mode == "undecided":
        return df.join(decisions.filter(~empty(F.col("verdict"))).select("id"), "id", "left_anti")
    if mode == "A":
        return df.filter(tier == "A")
    if mode == "AB":
        return df.filter(tier.isin("A", "B"))
    if mode == "flagged":
        return df.filter("privacy_review_required")
    return df


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 0) of an ordered listing."""
    return df.orderBy(*order).offset(number * size).limit(size)


def without_metadata(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])
