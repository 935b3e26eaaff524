"""Deterministic feeds, split exports, catalogues, lineage and guarded dumps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.operators.filters import without_metadata
from tidemark.operators.joins import hot_keys, null_safe_join, salt_of
from tidemark.sources.documents import file_hashes
from tidemark.workspace import fan_out


#: Files of a dump are about this long at most.
FILE_BYTES = 256 << 20


class RefusedWrite(ValueError):
    """Some row broke a rule, so nothing was written."""


def first_broken(found: DataFrame, most: int = 5) -> list[tuple[str, str]]:
    """The first (id, rule) of a violations table, in order.

    Ordered, they are looked for in all partitions at once; a plain limit would read a table without
    violations in rounds, the first of them one task.
    """
    rows = found.select("id", "rule").orderBy("id", "rule").limit(most).collect()
    return [(r["id"], r["rule"]) for r in rows]


def feed(df: DataFrame, path: str, order: Sequence[Column], single_file: bool = False) -> None:
    """Sorted rows with sorted keys as JSONL.

    Parts are range-partitioned and named in order; one file only on request,
    for feeds known to be small.
    """
    ordered = df.select(*sorted(df.columns)).orderBy(*order)
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def split_export(df: DataFrame, path: str, by: str,
                 unique: Sequence[str] | None = None) -> None:
    """One directory per value of ``by``; ``unique`` columns identify a row.

    A value has one file unless it holds a large share of the rows; such values
    (at most a few per core) are spread over several tasks and files.
    """
    df = without_metadata(df)
    slices = 4 * fan_out(df.sparkSession)
    # fewer than ``slices`` values hold more than 1/slices of the rows each
    hot = F.broadcast(hot_keys(df, [by], slices))
    spread = salt_of(df, unique, fan_out(df.sparkSession))
    salted = null_safe_join(df, hot, [by], "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0)))
    (salted.repartition(by, "_salt").drop("_hot", "_salt").write.mode("overwrite")
     .option("ignoreNullFields", "false").partitionBy(by).json(path))


def light_index(df: DataFrame) -> DataFrame:
    return df.select("id", "title", "year", "category", "rarity")


def collection_manifest(df: DataFrame) -> DataFrame:
    """One row: total and the sorted distinct years and categories."""
    return df.agg(F.count("*").alias("total_events"),
                  F.array_sort(F.collect_set("year")).alias("years"),
                  F.array_sort(F.collect_set("category")).alias("categories"))


def catalogue(datasets: dict[str, DataFrame], year: str = "year") -> DataFrame:
    """(dataset, count, years) rows plus a ``(total)`` row."""
    parts = None
    for name, df in datasets.items():
        row = df.agg(F.count("*").alias("count"), F.array_sort(F.collect_set(year)).alias("years"))
        row = row.select(F.lit(name).alias("dataset"), "count", "years")
        parts = row if parts is None else parts.unionByName(row)
    total = parts.agg(F.lit("(total)").alias("dataset"), F.sum("count").alias("count"),
                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("years"))))
                      .alias("years"))
    return parts.unionByName(total)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The same rows, counting as they pass; read the counts after the action."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), seen


def metadata_row(spark: SparkSession, counts: dict, **facts) -> DataFrame:
    """A one-row run or lineage record from counters and facts."""
    return spark.createDataFrame([{**facts, **counts}])


def lineage_inputs(df: DataFrame, hashes: DataFrame, file: str = "_file") -> DataFrame:
    """(file, records, sha256) of the inputs of a build."""
    return (df.groupBy(F.col(file).alias("file")).agg(F.count("*").alias("records"))
            .join(hashes.select("file", "sha256"), "file", "left"))


def _bounded(df: DataFrame, file_bytes: int) -> DataFrameWriter:
    """A writer whose files hold as many rows as make up ``file_bytes`` on average."""
    mean = df.agg(F.avg(F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})) + 1)
                  .alias("mean")).first()["mean"]
    return df.write.option("maxRecordsPerFile", max(1, int(file_bytes / (mean or 1))))


def guarded_dump(df: DataFrame, found: DataFrame, path: str, key: str = "id",
                 raw: DataFrame | None = None, metadata: dict | None = None,
                 file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a new immutable dump unless a row is invalid or an id repeats.

    ``found`` is the violations table of ``df``.  Returns the manifest of the
    files written, none of which is much longer than ``file_bytes``.
    """
    bad = found.unionByName(Q.unique_ids(df, "dump", key))
    first = first_broken(bad)
    if first:
        raise RefusedWrite(f"refused {path}: {first}")
    for name, rows in (("data", df), ("raw", raw)):
        if rows is not None:
            _bounded(rows, file_bytes).option("ignoreNullFields", "false").mode(
                "errorifexists").json(f"{path}/{name}")
    if metadata is not None:
        metadata_row(df.sparkSession, {}, **metadata).write.json(f"{path}/metadata")
    return file_hashes(df.sparkSession, path)


def with_overlay(df: DataFrame, overlay: DataFrame, key: str,
                 name: str = "_custom_metadata") -> DataFrame:
    """Rows with their overlay merged in as one struct."""
    fields = [c for c in overlay.columns if c != key]
    return df.join(overlay.select(key, F.struct(*fields).alias(name)), key, "left")


def tier_listing(df: DataFrame, tier: str, key: str, path: str | None = None) -> DataFrame:
    """Tier counts; the ids of each tier are written as a table split by tier.

    Ids stay rows: one tier may hold most of the collection.
    """
    if path:
        df.select(tier, key).write.mode("overwrite").partitionBy(tier).parquet(path)
    return df.groupBy(tier).agg(F.count("*").alias("count"))


def tag_layer(tags: DataFrame, path: str, layer_id: str, facts: dict) -> None:
    """A tag layer: (id, tag) table and a one-row metadata table."""
    tags.write.mode("overwrite").parquet(f"{path}/layer_id={layer_id}")
    metadata_row(tags.sparkSession, {"tagged_count": tags.count()}, layer_id=layer_id,
                 **facts).write.mode("overwrite").json(f"{path}_metadata/{layer_id}")


def review_layer(decisions: DataFrame, reviewer: str) -> DataFrame:
    """Decisions that say something, as rows of a new review layer."""
    from tidemark.functions.text import empty
    return (decisions.filter(~empty(F.col("verdict")) | ~empty(F.col("tier_override"))
                             | ~empty(F.col("note")))
            .select("id", F.coalesce(F.nullif("reviewer", F.lit("")), F.lit(reviewer))
                    .alias("reviewer"),
                    F.nullif("verdict", F.lit("")).alias("verdict"),
                    F.nullif("tier_override", F.lit("")).alias("tier_override"),
                    F.nullif("note", F.lit("")).alias("note"), "at"))


def upsert(current: DataFrame, fresh: DataFrame, key: str, refreshed: Sequence[str]) -> DataFrame:
    """Keyed upsert: new rows are added; ``refreshed`` columns change on conflict."""
    a, b = current.alias("a"), fresh.withColumn("_new", F.lit(True)).alias("b")
    cols = []
    for c in current.columns:
        old, new = F.col(f"a.{c}"), F.col(f"b.{c}")
        if c == key:
            cols.append(F.coalesce(old, new).alias(c))
        elif c in refreshed:
            cols.append(F.when(F.col("b._new"), new).otherwise(old).alias(c))
        else:
            cols.append(F.when(F.col(f"a.{key}").isNull(), new).otherwise(old).alias(c))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(*cols)


# --- versions ------------------------------------------------------------------------

_CURRENT = "current-"


def _pointers(spark: SparkSession, root: str):
    """The file system of ``root`` and its pointer files by number; the highest one counts."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(folder) if files.exists(folder) else []
    paths = [s.getPath() for s in found]
    return files, {int(p.getName().removeprefix(_CURRENT)): p for p in paths
                   if p.getName().startswith(_CURRENT)}


def current_version(spark: SparkSession, root: str) -> str | None:
    """The name of the version that readers see, or None before the first one."""
    _, pointers = _pointers(spark, root)
    return spark.read.text(pointers[max(pointers)].toString()).first()["value"] if pointers else None


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The published version: one whole version, whatever is being written meanwhile."""
    name = current_version(spark, root)
    if name is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root}/{name}")


def publish_version(df: DataFrame, root: str, check: Callable[[DataFrame], DataFrame],
                    clean: Callable[[DataFrame], DataFrame]) -> str:
    """Stages ``df``, validates it, cleans it, validates again and only then shows it to readers.

    ``check`` gives the violations of a table.  Both phases work on written tables, so what is checked
    is what is published.  The last step writes the version's name to a file and renames that file to
    the next pointer; a failure before that leaves the old version readable and the staged one unseen.
    Old pointers stay, so at no time is there none; of two writers at once one is refused.
    """
    spark = df.sparkSession
    name = f"version-{uuid.uuid4().hex}"

    def checked(rows: DataFrame, folder: str) -> DataFrame:
        rows.write.parquet(folder)
        staged = spark.read.schema(rows.schema).parquet(folder)
        first = first_broken(check(staged))
        if first:
            raise RefusedWrite(f"refused {root}: {first}")
        return staged

    before = checked(df, f"{root}/_staged-{name}")
    checked(clean(before), f"{root}/{name}")
    fresh = f"{root}/_pointer-{name}"
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(fresh)
    files, pointers = _pointers(spark, root)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    part = next(s.getPath() for s in files.listStatus(hadoop_path(fresh))
                if s.getPath().getName().startswith("part-"))
    place = hadoop_path(f"{root}/{_CURRENT}{max(pointers, default=0) + 1}")
    if files.exists(place) or not files.rename(part, place):
        raise RefusedWrite(f"another version of {root} was published meanwhile")
    return name
