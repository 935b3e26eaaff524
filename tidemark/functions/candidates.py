"""Expressions over candidate records: signals, salience, relevance, review."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import numbers as N


def signal(observed_at: Column, value: Column) -> Column:
    """A one-entry dated series; a signal is never a bare number."""
    return F.array(F.struct(observed_at.alias("observed_at"),
                            value.cast("double").alias("value")))


def signals_map(observed_at: Column, **values: Column) -> Column:
    """name -> series, holding only the signals that have a value."""
    full = F.create_map(*[x for name, v in values.items()
                          for x in (F.lit(name), signal(observed_at, v))])
    return F.map_filter(full, lambda _, series: series[0]["value"].isNotNull())


def provenance(layer: Column | str, method: Column | str, confidence: Column | str) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_col(layer).alias("layer"), as_col(method).alias("method"),
                    as_col(confidence).alias("confidence"))


def latest(signals: Column, name: str | None) -> Column:
    """The last value of a signal series, null when there is none."""
    if not name:
        return F.lit(None).cast("double")
    series = F.try_element_at(signals, F.lit(name))
    return F.try_element_at(series, F.lit(-1))["value"].cast("double")


def value_as_of(signals: Column, name: str, at: Column) -> Column:
    """The last observation of a signal at or before ``at``."""
    series = F.filter(F.try_element_at(signals, F.lit(name)), lambda o: o["observed_at"] <= at)
    return F.try_element_at(F.array_sort(series), F.lit(-1))["value"].cast("double")


def max_signal(signals: Column, name: str) -> Column:
    """Largest whole value of a series; null when empty or when any value is bad."""
    series = F.try_element_at(signals, F.lit(name))
    values = F.transform(series, lambda o: F.coalesce(o["value"], F.lit(0)).try_cast("bigint"))
    bad = F.exists(values, lambda v: v.isNull())
    return F.when((F.size(series) > 0) & ~bad, F.array_max(values))


def raw_salience(profile: dict, kind: Column, signals: Column,
                 extra: Column) -> tuple[Column, Column]:
    """(score, method) of one profile: main signal with bonus, else the fallback, else 0."""
    score, method = F, F
    for name, spec in profile.get("kind_scoring", {}).items():
        rule, main = spec.get("transform", "identity"), spec.get("primary_signal")
        primary = N.transform(latest(signals, main), rule)
        label = F.lit(f"{main}:{rule}")
        if spec.get("bonus_field"):
            value = F.lower(F.coalesce(F.try_element_at(extra, F.lit(spec["bonus_field"])),
                                       F.lit("")))
            hit = value.isin(*[str(v).lower() for v in spec.get("bonus_values", [])])
            label = F.when(hit, F.lit(f"{main}:{rule}+{spec['bonus_field']}")).otherwise(label)
            bonus = primary + F.when(hit, float(spec.get("bonus", 0.0))).otherwise(0.0)
        else:
            bonus = primary
        fallback = N.transform(latest(signals, spec.get("fallback_signal")),
                               spec.get("fallback_transform", "identity"))
        score = score.when(kind == name, F.coalesce(bonus, fallback, F.lit(0.0)))
        method = method.when(kind == name, F.when(primary.isNotNull(), label).when(
            fallback.isNotNull(), F.lit(f"fallback:{spec.get('fallback_signal')}"))
            .otherwise("no_signal_available"))
    return score.otherwise(F.lit(0.0)), method.otherwise("kind_not_scored_by_profile")


def topical_relevance(profile: dict, kind: Column, haystack: Column) -> Column:
    """1.0 for always-relevant kinds, else by the number of distinct term hits."""
    rel = profile.get("relevance", {})
    always = kind.isin(*rel.get("kinds_always_relevant", [])) if rel.get(
        "kinds_always_relevant") else F.lit(False)
    terms = rel.get("terms", [])
    if not terms:
        return F.lit(1.0)
    weights = rel.get("weights", {})
    pattern = r"\b(?:" + "|".join(f"(?:{t})" for t in terms) + r")\b"
    hits = F.size(F.array_distinct(
        F.regexp_extract_all(F.lower(haystack), F.lit("(?U)" + pattern), F.lit(0))))
    by_hits = F.array(*[F.lit(float(weights.get(name, value))) for name, value in (
        ("no_hits", 0.25), ("one_hit", 0.75), ("two_or_more_hits", 1.0))])
    # the hits are named once, for what is named in several branches is searched in each
    return F.when(F.coalesce(always, F.lit(False)), 1.0).otherwise(
        F.get(by_hits, F.least(hits, F.lit(2))))


def signal_disagreement(salience, relevance, karma, citations) -> Column:
    """Spread of the scaled signals of a record; 0 with fewer than two of them."""
    return N.population_spread(F.array(
        salience.cast("double"), relevance.cast("double"),
        F.when(karma.isNotNull(), F.least(F.lit(1.0), karma / F.lit(600.0))),
        F.when(citations.isNotNull(),
               F.least(F.lit(1.0), F.log10(citations + F.lit(1.0)) / F.lit(4.0)))))


def review_status(n_reviews: Column, flagged: Column) -> Column:
    return (F.when(F.coalesce(n_reviews, F.lit(0)) > 0, "reviewed")
            .when(flagged, "needs_privacy_review").otherwise("unreviewed"))


def visible(clock: Column, at: Column) -> Column:
    """A gate: an unknown clock is ungated."""
    return clock.isNull() | (clock <= at)


def has_shortlist_term(title: Column) -> Column:
    """Does the padded title hold any term: one pattern, cheap enough to push down."""
    terms = "|".join(re.escape(t) for ts in K.SHORTLIST_TERMS.values() for t in ts)
    return F.concat(F.lit(" "), F.lower(F.coalesce(title, F.lit(""))), F.lit(" ")).rlike(terms)


def with_shortlist_score(df: DataFrame, title: str) -> DataFrame:
    """Add ``category`` (null when no term is found), ``n_terms`` and sorted ``terms``.

    The category with most terms wins, the first listed on a tie.  The padded
    title and the found terms are columns first, so each is computed once.
    """
    low = F.col("_padded")
    df = df.withColumn("_padded", F.concat(F.lit(" "), F.lower(F.coalesce(title, F.lit(""))),
                                           F.lit(" ")))
    found = {cat: f"_found_{i}" for i, cat in enumerate(K.SHORTLIST_TERMS)}
    df = df.withColumns({
        column: F.array_compact(F.array(*[
            F.when(F.contains(low, F.lit(t)), F.lit(t.strip())) for t in K.SHORTLIST_TERMS[cat]]))
        for cat, column in found.items()})
    sizes = {cat: F.size(column) for cat, column in found.items()}
    best = F
    for cat, n in sizes.items():
        best = best.when((n > 0) & (n == F.greatest(*sizes.values())), F.lit(cat))
    return df.withColumns({
        "category": best.otherwise(F.lit(None)),
        "n_terms": reduce(lambda a, b: a + b, sizes.values()),
        "terms": F.array_sort(F.array_distinct(F.flatten(F.array(*found.values())))),
    }).drop("_padded", *found.values())
