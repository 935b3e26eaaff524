"""A log-odds domain tagger trained and applied with joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.text import tag_words
from tidemark.operators.joins import is_small, lookup_join
from tidemark.workspace import durable


def labelled(df: DataFrame, label: str, parts: list[str]) -> DataFrame:
    """Rows with a label and non-blank concatenated text: (id columns kept, label, text)."""
    text = F.concat_ws(" ", *[F.nullif(F.col(p), F.lit("")) for p in parts])
    return (df.withColumn("text", text)
            .filter((F.col(label).cast("string") != "") & (F.trim("text") != "")))


def token_counts(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, token, n)."""
    return _occurrences(df, key, text).groupBy(*key, "token").agg(F.count("*").alias("n"))


def _occurrences(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, token), a row per occurrence; short words and stop words are dropped as rows."""
    token = F.col("token")
    return (df.select(*key, F.explode_outer(tag_words(F.col(text))).alias("token"))
            .filter((F.length(token) >= K.TAG_MIN_TOKEN_LENGTH) & ~token.isin(*K.TAG_STOPWORDS)))


def train(counts: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    """Smoothed log-odds per (domain, vocabulary token).

    ``counts`` is (label, token, n).  Returns one row per token with an array
    of weights, one per domain in the returned order, so the vocabulary is
    never multiplied by the domains in a join.
    """
    counts = durable(counts.groupBy(label, "token").agg(F.sum("n").alias("n")), "counts")
    totals = {r[label]: r["n"] for r in
              counts.groupBy(label).agg(F.sum("n").alias("n")).collect()}  # one row per domain
    domains = sorted(totals)
    size = counts.select("token").distinct().count() or 1
    grand, s = sum(totals.values()), K.TAG_SMOOTHING
    wide = counts.groupBy("token").agg(*[
        F.sum(F.when(F.col(label) == d, F.col("n")).otherwise(0)).alias(f"_{i}")
        for i, d in enumerate(domains)])
    both = sum((F.col(f"_{i}") for i in range(1, len(domains))), F.col("_0"))
    weights = []
    for i, d in enumerate(domains):
        p_in = (F.col(f"_{i}") + s) / F.lit(totals[d] + s * size)
        p_out = (both - F.col(f"_{i}") + s) / F.lit(grand - totals[d] + s * size)
        weights.append(F.log(p_in / p_out))
    return wide.select("token", F.array(*weights).alias("weights")), domains


def long_weights(weights: DataFrame, domains: list[str]) -> DataFrame:
    """(domain, token, weight) rows."""
    names = F.array(*[F.lit(d) for d in domains])
    return weights.select("token", F.posexplode("weights").alias("_i", "weight")).select(
        names[F.col("_i")].alias("domain"), "token", "weight")


def classify(df: DataFrame, key: str, text: str, weights: DataFrame, domains: list[str],
             model_rows: int | None = None) -> DataFrame:
    """(key, domain, margin, tokens, reason) with abstention.

    Fewer than four tokens, or a margin under 0.15 of the top score, abstains.
    Ties go to the lower domain name.
    """
    width = len(domains)
    small = is_small(weights) if model_rows is None else is_small(weights, model_rows)
    # a broadcast model meets every occurrence where it stands, and what is shuffled is a row per record
    counts = (_occurrences(df, [key], text).withColumn("n", F.lit(1).cast("bigint")) if small
              else token_counts(df, [key], text))
    scored = lookup_join(counts, weights, ["token"], "left", known_small=small)
    sums = scored.groupBy(key).agg(
        F.sum("n").alias("tokens"),
        *[F.sum(F.coalesce(F.get("weights", F.lit(i)), F.lit(0.0)) * F.col("n")).alias(f"_{i}")
          for i in range(width)])
    out = df.select(key).join(sums, key, "left").withColumn(
        "tokens", F.coalesce("tokens", F.lit(0)))
    # scores are compared at 12 decimals, so the order of summation cannot matter
    ranked = F.array_sort(F.array(*[
        F.struct((-F.round(F.col(f"_{i}") / F.col("tokens"), 12)).alias("neg"),
                 F.lit(d).alias("domain")) for i, d in enumerate(domains)]))
    out = out.withColumn("_ranked", F.when(F.col("tokens") > 0, ranked))
    top = -F.col("_ranked")[0]["neg"]
    second = -F.col("_ranked")[1]["neg"] if width > 1 else F.lit(0.0)
    margin = (top - second) / F.when(top == 0, F.lit(1e-9)).otherwise(F.abs(top))
    out = out.withColumn("_margin", F.when(F.col("tokens") >= K.TAG_MIN_TOKENS, margin)
                         .otherwise(0.0))
    reason = (F.when(F.col("tokens") < K.TAG_MIN_TOKENS, "too_few_tokens")
              .when(F.col("_margin") < K.TAG_MIN_MARGIN, "margin_below_threshold")
              .otherwise("ok"))
    return out.select(
        key, F.when(reason == "ok", F.col("_ranked")[0]["domain"]).alias("domain"),
        F.col("_margin").alias("margin"), "tokens", reason.alias("reason"))


def tag_confidence(tokens: Column, margin: Column) -> Column:
    return (F.when((tokens >= 25) & (margin >= 0.35), "medium")
            .when((tokens >= 12) & (margin >= 0.25), "low").otherwise("very_low"))


def holdout(df: DataFrame, key: str, fraction: float = 0.2, seed: str = "20260725") -> Column:
    """True for the held-out rows: a seeded hash of the key, the same on every run."""
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), 1, 8),
                    16, 10).cast("bigint")
    return number % 10_000 < int(fraction * 10_000)


def evaluate(df: DataFrame, key: str, label: str, text: str) -> DataFrame:
    """One row: sizes, coverage, accuracy when attempted, abstentions, baseline."""
    split = df.withColumn("_held", holdout(df, key))
    seen, held = split.filter(~F.col("_held")), split.filter("_held")
    weights, domains = train(token_counts(seen, [label], text), label)
    said = held.select(key, label).join(
        classify(held, key, text, durable(weights, "weights"), domains), key)
    result = said.agg(
        F.count("*").alias("test_size"), F.count("domain").alias("attempted"),
        F.count_if(F.col("domain").isNull()).alias("abstained"),
        F.count_if(F.col("domain") == F.col(label).cast("string")).alias("correct"))
    base = (seen.groupBy(label).agg(F.count("*").alias("n"))
            .agg(F.sum("n").alias("train_size"), F.max("n").alias("largest")))
    rate = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 4)).otherwise(0.0)
    # both sides are one row
    return result.join(F.broadcast(base)).select(
        "train_size", "test_size", "attempted", "abstained",
        rate("attempted", "test_size").alias("coverage"),
        rate("correct", "attempted").alias("accuracy_when_attempted"),
        rate("largest", "train_size").alias("majority_class_baseline"))
