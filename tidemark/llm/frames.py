"""Small helpers that several operators share: ordered blocks, size-checked joins, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workspace import fan_out

#: A table of ids is broadcast up to this many rows (about 100 MB in memory); beyond it is shuffled.
BROADCAST_IDS = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small(df: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """``df``, a written table of narrow rows, marked for broadcast if its count allows it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def buckets_for(scan: DataFrame) -> int:
    """A number of shuffle buckets that grows with the input: its splits, or the session's."""
    return max(fan_out(scan.sparkSession), scan.rdd.getNumPartitions())


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def key_edges(df: DataFrame, key: str, blocks: int) -> list[int]:
    """At most ``blocks - 1`` values that cut the rows into ranges of about equal size."""
    if blocks < 2:
        return []
    at = [i / blocks for i in range(1, blocks)]
    found = df.agg(F.percentile_approx(key, at, max(10_000, 20 * blocks)).alias("e")).first()["e"]
    return sorted(set(found or []))


def block_of(key: Column, edges: list[int]) -> Column:
    """How many of the sorted ``edges`` are at most ``key``, by bisection; 0 for null."""
    if not edges:
        return F.lit(0)
    table = F.array(*map(F.lit, edges))
    steps = F.array(*(F.lit(1 << p) for p in reversed(range(len(edges).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when(
        F.get(table, p + s - 1) <= key, p + s).otherwise(p))


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts, 52 bits: the same everywhere."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(
        float(1 << 52))


def crc_of_id(column: Column) -> Column:
    """CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def token() -> str:
    return uuid.uuid4().hex


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows in the jobs that run inside, to bound the memory of
    Python workers that hold whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
