"""Three de-duplication rules that must not be confused, and merge by key.

Winners are found on keys alone (a partial aggregate), then the full rows are
kept by a semi join on the unique winner key, so a hot id never collects its
rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import empty
from tidemark.operators.joins import null_safe_join
from tidemark.operators.ranking import rank_within


def keep_first(df: DataFrame, scope: Sequence[str], key: str, order: str) -> DataFrame:
    """First row per key inside ``scope``; rows without a key are all kept.

    (scope, order) must identify a row; a null in ``scope`` is a value like any
    other.  Only repeated keys are looked at again: the rows that lose are taken
    out by an anti join on (scope, order), so the full rows meet the losers and
    not a list as long as themselves.
    """
    by = list(dict.fromkeys([*scope, key]))
    keyed = df.select(*by, order).filter(~empty(F.col(key).cast("string")))
    repeated = (keyed.groupBy(*by).agg(F.min(order).alias("_first"),
                                               F.count("*").alias("_n"))
                .filter("_n > 1").drop("_n"))
    losers = (null_safe_join(keyed, repeated, by)
              .filter(F.col(order) != F.col("_first")).select(*scope, order))
    return null_safe_join(df, losers, [*scope, order], "left_anti")


def keep_last_file(df: DataFrame, key: str, file: str) -> DataFrame:
    """The row of the last file, by name, that holds the key; a null key is a key."""
    winners = df.groupBy(key).agg(F.max(file).alias(file))
    return null_safe_join(df, winners, [key, file], "left_semi")


def keep_by_precedence(df: DataFrame, key: str, file: str, precedence: Sequence[str],
                       override: str) -> DataFrame:
    """The file latest in ``precedence`` wins; ``override`` beats every file.

    ``provenance`` stays with the file whose row was replaced by ``override``.
    (key, file) must identify a row.
    """
    rank = F
    for i, name in enumerate([*precedence, override]):
        rank = rank.when(F.col(file) == name, F.lit(i))
    ranked = df.withColumn("_rank", rank).filter(F.col("_rank").isNotNull())
    last = F.lit(len(precedence))
    winners = ranked.groupBy(key).agg(
        F.max("_rank").alias("_rank"),
        F.coalesce(F.max_by(file, F.when(F.col("_rank") < last, F.col("_rank"))),
                   F.lit(override)).alias("provenance"))
    return ranked.join(winners, [key, "_rank"]).drop("_rank")


def undeclared_files(df: DataFrame, file: str, declared: Sequence[str]) -> DataFrame:
    """File names without a declared precedence."""
    return df.select(file).distinct().filter(~F.col(file).isin(list(declared)))


def merge_first_seen(df: DataFrame, key: str, order: str, scalars: Sequence[str], *,
                     sorted_sets: Sequence[str] = (), ordered_sets: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first row's scalars, unions of the other columns.

    ``sorted_sets`` are scalar columns united into a sorted array;
    ``ordered_sets`` are array columns united in order of first appearance.
    Array elements are reduced to distinct (key, element, first place) before
    they are gathered.
    """
    firsts = df.groupBy(key).agg(F.min(order).alias(order))
    out = df.join(firsts, [key, order], "left_semi").select(key, order, *scalars)
    for c in sorted_sets:
        united = (df.select(key, c).distinct().groupBy(key)
                  .agg(F.array_sort(F.collect_list(c)).alias(c)))
        out = out.join(united, key, "left")
    for c in ordered_sets:
        place = F.struct(F.col(order).alias("o"), F.col("pos").alias("p"))
        united = (df.select(key, order, F.posexplode(c).alias("pos", "item"))
                  .groupBy(key, "item").agg(F.min(place).alias("at"))
                  .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "item"))).alias(c)))
        out = out.join(united.select(key, F.transform(c, lambda s: s["item"]).alias(c)),
                       key, "left")
        out = out.withColumn(c, F.coalesce(c, F.array().cast(f"array<string>")))
    return out.drop(order)


def merged_children(df: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """(key, item, place): the distinct items of an array column of each key, in order of first sight.

    The child table of :func:`merge_first_seen` without its arrays: an item is a row, its place comes from
    one global order, and so a key with a third of all items is in no single row and no single task.
    """
    seen = (df.select(key, F.col(order).alias("_o"), F.posexplode(column).alias("_p", "item"))
            .groupBy(key, "item").agg(F.min(F.struct("_o", "_p")).alias("_at")))
    return rank_within(seen, [key], [F.col("_at"), F.col("item")], "place").drop("_at")


def merged_parents(df: DataFrame, key: str, order: str, scalars: Sequence[str]) -> DataFrame:
    """One row per key: the scalars of its first row."""
    firsts = df.groupBy(key).agg(F.min(order).alias(order))
    return df.join(firsts, [key, order], "left_semi").select(key, *scalars)


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def row_fingerprint(df: DataFrame) -> Column:
    """A hash of the whole row over its canonical JSON."""
    return F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
