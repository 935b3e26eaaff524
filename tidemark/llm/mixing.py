"""Mixing sources to target weights by repeating or thinning their documents.

Sizes are summed per source; a source's rate is its target divided by its size.  A document is
emitted ``floor(rate)`` times, and once more if its hashed number in [0, 1) is below the
fraction.  The number depends on the id and the seed alone, so a rerun emits the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.frames import small, unit_hash, unused
from tidemark.workspace import durable

SEED = "mix-1"
#: A source is taken this many times at most.
MOST = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"),
                      F.lit(0).cast("long"))


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of each source of ``sizes`` (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share the sum of all sizes.
    A target stops at ``most`` times its source's size and the excess is shared again by weight.
    In order of size by weight, the sources that stop are the first ones; the others share what is
    left.  There is one row per source, so the ranking is small next to the documents.
    """
    per = durable(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = W.orderBy(F.col("source").cast("binary").asc_nulls_last())
    weighed = per.withColumn("w", ((F.row_number().over(order) - 1) % 3 + 1).cast("long"))
    # size / weight as an integer: six is divisible by every weight
    order = W.orderBy("by_weight", F.col("source").cast("binary").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    zero = F.lit(0).cast("long")
    filled = (weighed.withColumn("by_weight", F.col("source_size") * F.expr("6 div w"))
              .withColumn("rest", F.sum("source_size").over(every) - most * F.coalesce(
                  F.sum("source_size").over(before), zero))
              .withColumn("rest_w", F.sum("w").over(every) - F.coalesce(
                  F.sum("w").over(before), zero))
              # it stops if its share of what the earlier ones leave is above its limit
              .withColumn("stops", F.col("rest") * F.col("w")
                          > most * F.col("source_size") * F.col("rest_w")))
    level = filled.filter(~F.col("stops")).orderBy(
        "by_weight", F.col("source").cast("binary").asc_nulls_last()).limit(1).select(
        F.col("rest").alias("level"), F.col("rest_w").alias("level_w"))
    return (filled.join(F.broadcast(level), how="left")
            .select("source", "source_size", F.when(
                F.col("stops"), (most * F.col("source_size")).cast("double")).otherwise(
                (F.col("level") * F.col("w")).cast("double") / F.col("level_w")).alias("target")))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", seed: str = SEED, most: int = MOST) -> DataFrame:
    """Every row of ``docs`` with a struct ``_mix``: size, source_size, target, copies.

    The size is the number of words; a null text has none.  A source of size 0 has target 0 and is
    not taken.  A null source is a source of its own.  Equal ids draw equal numbers.
    """
    size, source, mix = (unused(docs, x) for x in ("mix_size", "mix_source", "mix"))
    sized = docs.withColumn(size, n_words(F.col(text_col)))
    found = durable(targets(sized.select(F.col(source_col).alias("source"),
                                         F.col(size).alias("size")), most), "targets")
    of = unused(docs, "mix_rate")
    rates = small(found.select(F.col("source").alias(source),
                               F.struct("source_size", "target").alias(of)))
    total, target = F.col(f"{of}.source_size"), F.col(f"{of}.target")
    rate = F.when(total > 0, target / total).otherwise(F.lit(0.0))
    draw = unit_hash(F.col(id_col), F.lit(seed))
    copies = F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    return (sized.join(rates, F.col(source_col).eqNullSafe(F.col(source)))
            .select(*(sized[c] for c in docs.columns),
                    F.struct(F.col(size).alias("size"), total.alias("source_size"),
                             target.alias("target"), copies.cast("long").alias("copies"))
                    .alias(mix)))


def mix(docs: DataFrame, **columns) -> DataFrame:
    """The mixture: each row of ``docs`` as often as it is taken, with its own columns."""
    name = unused(docs, "mix")
    copies = F.col(f"{name}.copies")
    return (plan(docs, **columns).filter(copies > 0)
            .withColumn(f"{name}_n", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
            .select(*docs.columns))
