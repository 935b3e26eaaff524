"""Dumps laid out as ``source_id=../dump_ts=..`` and their newest snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dump_columns(df: DataFrame, file: str = "_file") -> DataFrame:
    """``source_id`` and ``dump_ts`` from a path ``<source>/dumps/<stamp>/<name>``."""
    return (df.withColumn("source_id", F.regexp_extract(file, r"([^/]+)/dumps/[^/]+/[^/]+\z", 1))
            .withColumn("dump_ts", F.regexp_extract(file, r"/dumps/([^/]+)/[^/]+\z", 1)))


def newest(df: DataFrame, source: str = "source_id", stamp: str = "dump_ts") -> DataFrame:
    """Rows of the newest snapshot of each source.

    On partition columns the newest stamps come from the file listing, and the
    semi join prunes the other partitions at run time.
    """
    last = df.select(source, stamp).distinct().groupBy(source).agg(F.max(stamp).alias(stamp))
    return df.join(last, [source, stamp], "left_semi")


def last_complete(meta: DataFrame) -> str | None:
    """Extraction date of the newest complete dump: the high-water mark."""
    row = (meta.filter("extraction_status = 'complete'")
           .agg(F.max_by("extraction_date", "dump").alias("at")).first())
    return row["at"] if row else None
