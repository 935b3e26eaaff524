"""Set operations between collections and rebuild checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import row_fingerprint


def union_sources(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def build_diff(fresh: DataFrame, committed: DataFrame, key: str) -> DataFrame:
    """(key, change): ids only in one build, and ids whose content changed."""
    a = fresh.select(key, row_fingerprint(fresh).alias("_a"))
    b = committed.select(key, row_fingerprint(committed).alias("_b"))
    change = (F.when(F.col("_a").isNull(), "removed").when(F.col("_b").isNull(), "added")
              .when(F.col("_a") != F.col("_b"), "changed"))
    return (a.join(b, key, "full_outer").select(key, change.alias("change"))
            .filter(F.col("change").isNotNull()))


def rebuild_differences(fresh: DataFrame, committed: DataFrame,
                        columns: Sequence[str]) -> DataFrame:
    """Rows present in one build only, compared on the derived columns."""
    a, b = fresh.select(*columns), committed.select(*columns)
    return (a.exceptAll(b).withColumn("side", F.lit("fresh"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("committed"))))


def claimed_on_both(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).intersect(b.select(column))
