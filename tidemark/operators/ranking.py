"""Ranks, percentiles and quantile tiers that do not gather a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import MAX_BROADCAST_ROWS, lookup_join
from tidemark.workspace import durable, fan_out

# Up to this many counted rows, one task may sort a group.
WINDOW_ROWS = 1_000_000
_SMALL_SCORE_TABLE = 20_000


def global_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """1-based position of every row in a total order.

    Rows are range-partitioned and sorted, numbered inside their partition and
    written once; the partition sizes (one row per partition) give the offsets.
    ``order`` must end in a unique column for the result to be determined.
    """
    n = fan_out(df.sparkSession)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_at", F.monotonically_increasing_id()))
    ranged = durable(ranged, "ranged")
    part = F.shiftright("_at", 33)
    numbered = ranged.withColumn("_part", part).withColumn(
        "_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy("_part").agg(F.count("*").alias("_size"))
               .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")))
    # one row per range partition: bounded by spark.sql.shuffle.partitions
    return (numbered.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_row") + F.col("_before") + 1)
            .drop("_at", "_part", "_row", "_before"))


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                name: str = "rank") -> DataFrame:
    """Row number inside each group by way of the global order."""
    placed = durable(global_position(df, [*[F.col(g) for g in group], *order], "_place"), "placed")
    starts = placed.groupBy(*group).agg(F.min("_place").alias("_start"))
    return (lookup_join(placed, starts, group)
            .withColumn(name, F.col("_place") - F.col("_start") + 1).drop("_place", "_start"))


def distinct_percentile(df: DataFrame, group: Sequence[str], value: str,
                        window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Add ``percentile``, ``group_size``: place among the *distinct* values of the group.

    ``index / (distinct - 1)``, ties share, 0.5 when the group has one value.
    Rows are first reduced to distinct (group, value) pairs with counts.  A
    pair table counted small is ranked by a window; a larger one by the global
    order, so no group is sorted in one task.
    """
    pairs = durable(df.groupBy(*group, value).agg(F.count("*").alias("_n")), "pairs")
    if pairs.count() <= window_rows:
        whole = Window.partitionBy(*group)
        place = F.dense_rank().over(whole.orderBy(value)) - 1
        lookup = pairs.select(*group, value, F.sum("_n").over(whole).alias("group_size"),
                              place.alias("_place"), F.count("*").over(whole).alias("_distinct"))
    else:
        placed = durable(global_position(
            pairs, [*[F.col(g) for g in group], F.col(value)], "_pos"), "percentile")
        groups = placed.groupBy(*group).agg(F.min("_pos").alias("_start"),
                                            F.count("*").alias("_distinct"),
                                            F.sum("_n").alias("group_size"))
        lookup = durable(lookup_join(placed, groups, group).withColumn(
            "_place", F.col("_pos") - F.col("_start")), "lookup")
    lookup = lookup.select(*group, value, "group_size", F.when(
        F.col("_distinct") <= 1, F.lit(0.5)).otherwise(
        F.col("_place").cast("double") / (F.col("_distinct") - 1).cast("double"))
        .alias("percentile"))
    return lookup_join(df, lookup, [*group, value], known_small=pairs.count() <= MAX_BROADCAST_ROWS)


def shrink(percentile: Column, group_size: Column, k: float) -> Column:
    """Pull a percentile toward 0.5 by the size of its group; k = 0 disables."""
    weight = group_size / (group_size + F.lit(float(k))) if k else F.lit(1.0)
    return F.lit(0.5) + (percentile - F.lit(0.5)) * weight


def tier_ends(total: int, quantiles: Sequence[tuple[str, float]]) -> list[tuple[str, int, int]]:
    """(tier, first, last+1) row ranges; each named tier takes at least one row."""
    out, start = [], 0
    for name, fraction in quantiles:
        end = min(total, start + max(1, int(round(fraction * total))))
        out.append((name, start, end))
        start = end
    return out


def quantile_tiers(df: DataFrame, score: str, tie: Sequence[Column],
                   quantiles: Sequence[tuple[str, float]], name: str = "tier",
                   rest: str = "D", window_rows: int = WINDOW_ROWS,
                   score_rows: int = _SMALL_SCORE_TABLE) -> DataFrame:
    """Cut the ranked population into tiers: score descending, then ``tie``.

    Rows without a score are kept in ``rest`` and do not count as population.
    Only the scores that a cut runs through need row positions; all other rows
    get their tier from their score alone.  ``df`` is read more than once:
    pass a written table.
    """
    scored = df.filter(F.col(score).isNotNull())
    counts = scored.groupBy(score).agg(F.count("*").alias("n"))
    head = counts.orderBy(F.desc(score)).limit(score_rows + 1).collect()
    if len(head) > score_rows:
        ranges = tier_ends(scored.count(), quantiles)
        placed = global_position(scored, [F.desc(score), *tie], "_pos")
        tiered = placed.withColumn(name, _tier_at(F.col("_pos") - 1, ranges, rest)).drop("_pos")
        return tiered.unionByName(df.filter(F.col(score).isNull()).withColumn(name, F.lit(rest)))
    ranges, lowest, split, tied_rows = _cuts([(r[score], r["n"]) for r in head], quantiles, rest)
    by_score = _tier_by_score(F.col(score), ranges, lowest, rest)
    if not split:
        return df.withColumn(name, by_score)
    first = F
    for value, position in split:
        first = first.when(F.col(score) == F.lit(value), F.lit(position))
    # a null score is never tied: it lies below all others, in ``rest``
    is_tied = F.coalesce(F.col(score).isin([v for v, _ in split if v is not None]), F.lit(False))
    tied = df.filter(is_tied)
    if tied_rows <= window_rows:
        place = F.row_number().over(Window.partitionBy(score).orderBy(*tie))
        tied = tied.withColumn("_pos", place)
    else:
        tied = rank_within(tied, [score], tie, "_pos")
    tied = tied.withColumn(name, _tier_at(F.col("_pos") - 1 + first, ranges, rest)).drop("_pos")
    return df.filter(~is_tied).withColumn(name, by_score).unionByName(tied)


def quantile_tiers_by_group(df: DataFrame, group: str, score: str, tie: Sequence[Column],
                            quantiles: Mapping[object, Sequence[tuple[str, float]]],
                            name: str = "tier", rest: str = "D", window_rows: int = WINDOW_ROWS,
                            score_rows: int = _SMALL_SCORE_TABLE) -> DataFrame:
    """As :func:`quantile_tiers`, each group (few, with quantiles of its own) by itself.

    All groups are cut by one table of counts, or, with very many scores, ranked by one global order,
    so the number of shuffles does not depend on theirs.
    """
    scored = df.filter(F.col(score).isNotNull())
    most = score_rows * len(quantiles)
    head = scored.groupBy(group, score).agg(F.count("*").alias("n")).orderBy(
        group, F.desc(score)).limit(most + 1).collect()
    tier = F.lit(rest)
    if len(head) > most:
        totals = {r[group]: r["n"] for r in scored.groupBy(group).agg(F.count("*").alias("n")).collect()}
        placed = rank_within(scored, [group], [F.desc(score), *tie], "_pos")
        for value, total in totals.items():
            tier = F.when(F.col(group) == F.lit(value), _tier_at(
                F.col("_pos") - 1, tier_ends(total, quantiles[value]), rest)).otherwise(tier)
        return (placed.withColumn(name, tier).drop("_pos")
                .unionByName(df.filter(F.col(score).isNull()).withColumn(name, F.lit(rest))))
    at, is_tied, tied_rows = F.lit(rest), F.lit(False), 0
    for value in dict.fromkeys(r[group] for r in head):
        here = F.col(group) == F.lit(value)
        ranges, lowest, split, rows = _cuts([(r[score], r["n"]) for r in head if r[group] == value],
                                            quantiles[value], rest)
        tier = F.when(here, _tier_by_score(F.col(score), ranges, lowest, rest)).otherwise(tier)
        tied_rows += rows
        for v, position in split:
            cut = here & (F.col(score) == F.lit(v))
            is_tied = is_tied | cut
            at = F.when(cut, _tier_at(F.col("_pos") - 1 + F.lit(position), ranges, rest)).otherwise(at)
    if not tied_rows:
        return df.withColumn(name, tier)
    is_tied = F.coalesce(is_tied, F.lit(False))
    tied = df.filter(is_tied)
    if tied_rows <= window_rows:
        tied = tied.withColumn("_pos", F.row_number().over(Window.partitionBy(group, score).orderBy(*tie)))
    else:
        tied = rank_within(tied, [group, score], tie, "_pos")
    return df.filter(~is_tied).withColumn(name, tier).unionByName(
        tied.withColumn(name, at).drop("_pos"))


def _cuts(counts: Sequence[tuple[float, int]], quantiles: Sequence[tuple[str, float]], rest: str):
    """(ranges, lowest score of tiers, scores that a cut runs through with their places, rows of these).

    ``counts`` are scores and their rows, highest first.
    """
    ranges = tier_ends(sum(n for _, n in counts), quantiles)
    cuts = {end for _, _, end in ranges}
    start, lowest, split, tied_rows = 0, {}, [], 0
    for value, n in counts:
        end = start + n
        if any(start < c < end for c in cuts):
            split.append((value, start))
            tied_rows += n
        else:
            lowest[_tier_name(start, ranges, rest)] = value
        start = end
    return ranges, lowest, split, tied_rows


def _tier_by_score(score: Column, ranges, lowest: Mapping[str, float], rest: str) -> Column:
    out = F.lit(rest)
    for tier in reversed([t for t, _, _ in ranges if t in lowest]):
        out = F.when(score >= F.lit(lowest[tier]), F.lit(tier)).otherwise(out)
    return out


def _tier_name(position: int, ranges, rest: str) -> str:
    return next((t for t, s, e in ranges if s <= position < e), rest)


def _tier_at(position: Column, ranges, rest: str) -> Column:
    out = F
    for tier, start, end in ranges:
        out = out.when((position >= start) & (position < end), F.lit(tier))
    return out.otherwise(F.lit(rest))


def tier_cuts(df: DataFrame, tier: str, score: str) -> DataFrame:
    """Count, highest and lowest score of every tier."""
    return df.groupBy(tier).agg(F.count("*").alias("count"), F.max(score).alias("salience_max"),
                                F.min(score).alias("salience_min"))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per group; Spark limits each partition before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
