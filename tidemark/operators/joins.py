"""Joins with checked broadcasts, hot-key salting, and as-of reads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.workspace import fan_out

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
_HOT_KEYS = 1_000


def is_small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> bool:
    """At most ``limit`` rows and not many bytes as JSON, found without reading further."""
    seen = df.limit(limit + 1).agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"))
    row = seen.first()
    return row["n"] <= limit and row["bytes"] <= MAX_BROADCAST_BYTES


def hot_keys(df: DataFrame, on: Sequence[str], slices: int) -> DataFrame:
    """Keys holding more than 1/``slices`` of the rows: fewer than ``slices`` of them."""
    counts = df.groupBy(*on).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    # one row
    return (counts.join(F.broadcast(total), F.col("_n") * slices > F.col("_total"))
            .select(*on, F.lit(True).alias("_hot")))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on ``on`` with null equal to null; the keys come from the left side once."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c)
                             for c in right.columns])
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, match, how).drop(*[f"_r_{c}" for c in on])


def salt_of(df: DataFrame, unique: Sequence[str] | None, salts: int) -> Column:
    """A salt below ``salts``, from the unique key or else from all columns without maps."""
    kinds = dict(df.dtypes)
    columns = list(unique) if unique else [c for c in df.columns if "map<" not in kinds[c]]
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts)).cast("int")


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                limit: int = MAX_BROADCAST_ROWS, known_small: bool | None = None,
                unique: Sequence[str] | None = None) -> DataFrame:
    """Join to a right side with unique keys; null equals null.

    The right side is broadcast only when counted small in rows and bytes (here,
    or by the caller who passes ``known_small``).  Otherwise the rows of hot left keys are spread over salts
    by their ``unique`` columns and their right rows repeated per salt; a join on the unique columns
    themselves has no hot keys.
    """
    on = list(on)
    if is_small(right, limit) if known_small is None else known_small:
        return null_safe_join(left, F.broadcast(right), on, how)
    if unique and set(unique) <= set(on):
        return null_safe_join(left, right, on, how)
    slices = min(_HOT_KEYS, 4 * fan_out(left.sparkSession))
    # bounded: fewer than ``slices`` keys hold more than 1/slices of the rows each
    hot = F.broadcast(hot_keys(left, on, slices))
    salts = fan_out(left.sparkSession)
    spread = salt_of(left, unique, salts)
    salted_left = null_safe_join(left, hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0))).drop("_hot")
    salted_right = null_safe_join(right, hot, on, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                           .otherwise(F.array(F.lit(0))))).drop("_hot")
    return null_safe_join(salted_left, salted_right, [*on, "_salt"], how).drop("_salt")


def keep_known(df: DataFrame, ids: DataFrame, on: str, known: bool = True) -> DataFrame:
    """Rows whose key is (or is not) in ``ids``."""
    return df.join(ids.select(on).distinct(), on, "left_semi" if known else "left_anti")


def split_by(df: DataFrame, removed: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): dropped rows carry the columns of ``removed`` (unique on ``on``)."""
    return (df.join(removed.select(on), on, "left_anti"),
            df.select(on).join(removed, on, "inner"))


def unmatched(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Two-way completeness: keys present on one side only."""
    a = left.select(on).distinct().withColumn("_l", F.lit(1))
    b = right.select(on).distinct().withColumn("_r", F.lit(1))
    return (a.join(b, on, "full_outer").filter(F.col("_l").isNull() | F.col("_r").isNull())
            .select(on, F.when(F.col("_l").isNull(), "left").otherwise("right")
                    .alias("missing_on")))


def alias_totals(entities: DataFrame, stats: DataFrame, *, key: str, name: str, aliases: str,
                 stat_name: str, repeat_names: bool = True) -> DataFrame:
    """Sum, first and last of the statistics matched by a name or any alias.

    ``repeat_names`` keeps a name that is also listed as an alias twice, so it
    counts twice; pass False to count it once.
    """
    names = F.concat(F.array(F.col(name)),
                     F.coalesce(F.col(aliases), F.array().cast("array<string>")))
    names = names if repeat_names else F.array_distinct(names)
    matched = (entities.select(key, F.explode(names).alias(stat_name))
               .join(stats, stat_name))
    totals = matched.groupBy(key).agg(F.sum("n").alias("n"), F.min("first").alias("first"),
                                      F.max("last").alias("last"))
    return entities.join(totals, key, "left")


def carry_forward(fresh: DataFrame, prior: DataFrame, on: str,
                  owned: Sequence[str]) -> DataFrame:
    """Fresh rows with the human-owned fields of the prior snapshot."""
    return (fresh.drop(*[c for c in owned if c in fresh.columns])
            .join(prior.select(on, *owned), on, "left"))


def orphans(fresh: DataFrame, prior: DataFrame, on: str, owned: Sequence[str]) -> DataFrame:
    """Prior rows that carry a human value but are no longer derived."""
    kinds = dict(prior.dtypes)
    has = F.lit(False)
    for c in owned:
        filled = (F.size(c) > 0) if kinds[c].startswith("array") else (F.col(c).cast("string") != "")
        has = has | F.coalesce(filled, F.lit(False))
    return prior.filter(has).select(on).join(fresh.select(on), on, "left_anti")


# --- as-of ---------------------------------------------------------------------

def as_of(observations: DataFrame, key: Sequence[str], at: str, value: str,
          when: Column) -> DataFrame:
    """Last value per key at or before ``when``; partial aggregation, one shuffle."""
    return (observations.filter(F.col(at) <= when).groupBy(*key)
            .agg(F.max_by(value, at).alias(value), F.max(at).alias(at)))


def fill_down(df: DataFrame, key: Sequence[str], order: Sequence[str], block: Column,
              fills: dict[str, Column]) -> DataFrame:
    """Last non-null value so far, per key in ``order``.

    ``block`` must not decrease along ``order``.  Values are filled inside each
    (key, block); what enters a block from before comes from a running last
    over one summary row per block, so a long key is never sorted in one task.
    """
    seq = F.struct(*order)
    df = df.withColumn("_block", block)
    for name, col in fills.items():
        df = df.withColumn(f"_v_{name}", col)
    inside = Window.partitionBy(*key, "_block").orderBy(*order)
    summary = df.groupBy(*key, "_block").agg(*[
        F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), seq)).alias(f"_c_{n}")
        for n in fills])
    earlier = (Window.partitionBy(*key).orderBy("_block")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = summary.select(*key, "_block", *[
        F.last(f"_c_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in fills])
    out = df.select("*", *[F.last(f"_v_{n}", ignorenulls=True).over(inside).alias(f"_f_{n}")
                           for n in fills])
    out = null_safe_join(out, carried, [*key, "_block"])
    for n in fills:
        out = out.withColumn(n, F.coalesce(f"_f_{n}", f"_c_{n}"))
    return out.drop("_block", *[f"_{p}_{n}" for n in fills for p in "vfc"])


def as_of_join(left: DataFrame, right: DataFrame, key: str, at: str, value: str,
               block: Column) -> DataFrame:
    """For every left row, the right value observed at or before its own time."""
    rows = (left.withColumn("_side", F.lit(1)).withColumn("_seen", F.lit(None).cast(
        dict(right.dtypes)[value]))
        .unionByName(right.select(key, at, F.col(value).alias("_seen"))
                     .withColumn("_side", F.lit(0)), allowMissingColumns=True))
    filled = fill_down(rows, [key], [at, "_side"], block, {value: F.col("_seen")})
    return filled.filter("_side = 1").drop("_side", "_seen")
