"""JSONL, JSON document, CSV and text scans with rejects and file metadata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import is_blank
from tidemark.sources import fragments

CORRUPT = "_corrupt_record"
_CHUNK = 8 << 20


def _lines(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    """Lines of text files with their file and place, split at LF only.

    The place is (start of the file split, row number of the reading task), so
    large files are still split and read in parallel.
    """
    return (spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower())
            .text(path).select(
                "*", F.col("_metadata.file_path").alias("_file"),
                F.struct(F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row")).alias("_ord")))


def jsonl(spark: SparkSession, path: str, schema: T.StructType,
          recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of newline-delimited JSON, with ``_file``.

    Lines end at LF only: other Unicode line ends stay inside values.  Blank
    lines are skipped; lines that do not parse go to ``rejects``.
    """
    return parse_lines(_lines(spark, path, recursive).drop("_ord"), "value", schema)


def ordered_jsonl(spark: SparkSession, path: str,
                  schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """As :func:`jsonl` with ``_ord``, which sorts like the line's place in its file."""
    return parse_lines(_lines(spark, path, False), "value", schema)


def parse_lines(lines: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) from a column of JSON lines; blank lines are skipped."""
    kept = lines.filter(~is_blank(F.col(column)))
    parsed = kept.withColumn("_r", F.from_json(column, T.StructType([
        *schema.fields, T.StructField(CORRUPT, T.StringType())]),
        {"columnNameOfCorruptRecord": CORRUPT}))
    good = F.col("_r").isNotNull() & F.col(f"_r.{CORRUPT}").isNull()
    rest = [c for c in lines.columns if c != column]
    return (parsed.filter(good).select(*rest, "_r.*").drop(CORRUPT),
            parsed.filter(~good).select(*rest, F.col(column).alias(CORRUPT)))


def explode_document(docs: DataFrame, column: str, record: T.DataType) -> DataFrame:
    """Rows of a JSON document: a list gives its items, an object its values.

    Adds ``key`` (null for list items) and ``record``; other documents have no rows.
    """
    as_list = F.from_json(column, T.ArrayType(record))
    as_map = F.from_json(column, T.MapType(T.StringType(), record))
    start = F.left(F.ltrim(column), F.lit(1))
    entries = (F.when(start == "[", F.transform(as_list, lambda r: F.struct(
        F.lit(None).cast("string").alias("key"), r.alias("value"))))
        .when(start == "{", F.map_entries(as_map)))
    rest = [c for c in docs.columns if c != column]
    return docs.select(*rest, F.explode(entries).alias("e")).select(
        *rest, "e.key", F.col("e.value").alias("record"))


def json_documents(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """All documents under ``path`` with their file name, exploded; files are split."""
    records, _ = fragments.json_elements(spark, path, record)
    return records.select(F.element_at(F.split("file", "/"), -1).alias("file"), "key", "record")


def csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV as string columns; quoted cells may hold line ends; files are split."""
    return fragments.csv_records(spark, path)


def data_files(df: DataFrame) -> DataFrame:
    """Drop rows of metadata and sample files."""
    name = F.element_at(F.split("_file", "/"), -1)
    return df.filter(~name.startswith("_") & ~F.contains(name, F.lit("sample")))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files, split on LF only; files are split."""
    return fragments.numbered_lines(spark, path)


def number_lines(df: DataFrame, column: str) -> DataFrame:
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.posexplode(F.split(column, "\n")).alias("line_no", "line")).select(
        *rest, (F.col("line_no") + 1).alias("line_no"), "line")


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that Spark has listed, and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    host, _, own = rest.removeprefix("//").partition("/")
    files, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return files, f"{base.rstrip('/')}/{own}"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path in batch.column("file").to_pylist():
            digest = hashlib.sha256()
            files, at = _place(path)
            with files.open_input_stream(at, compression=None) as stream:
                while chunk := stream.read(_CHUNK):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())],
                                         ["file", "bytes", "sha256"])


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of every file under ``path``.

    Spark lists the files and deals them out by size without reading them; each is read once, in
    chunks, so a file may have any length.  The folder is local, HDFS or an object store.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .select(F.col("path").alias("file"), F.col("length").alias("bytes")))
    return listed.mapInArrow(_hashed, "file string, bytes long, sha256 string")


def from_listed(df: DataFrame, column: Column | str, allowed: list[str]) -> DataFrame:
    """Explicit source allow-list; on a partition column it prunes files."""
    return df.filter((F.col(column) if isinstance(column, str) else column).isin(allowed))
