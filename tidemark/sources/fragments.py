"""Large single files read by many tasks: JSON documents, CSV with quoted line ends, numbered lines.

Spark splits a text file at any separator, so each task reads its own part of a file as fragments
between separators.  What a fragment means depends on what came before it (inside a string or not,
how deep, in which record), and that is a prefix sum over the file: ``running`` adds one split by
split, with one row per split carrying the sums across.  Fragments of one record are put together
at last; a record is the largest thing a task must hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import lookup_join
from tidemark.workspace import durable

_PLACE = ("file", "block", "row")
_CORRUPT = "_corrupt_record"


def fragments(spark: SparkSession, path: str, separator: str, recursive: bool = False) -> DataFrame:
    """(file, size, block, row, text): the text between separators; (block, row) order it in its file."""
    return (spark.read.option("lineSep", separator)
            .option("recursiveFileLookup", str(recursive).lower()).text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_size").alias("size"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"), F.col("value").alias("text")))


def running(rows: DataFrame, **values: Column) -> DataFrame:
    """Adds to every row what the rows before it in its file sum up to, per named value."""
    own = rows.withColumns({f"_v_{n}": v.cast("long") for n, v in values.items()})
    inside = (Window.partitionBy("file", "block").orderBy("row")
              .rowsBetween(Window.unboundedPreceding, -1))
    earlier = (Window.partitionBy("file").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = own.groupBy("file", "block").agg(
        *[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values]).select(
        "file", "block", *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}")
                           for n in values])
    summed = own.select("*", *[F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)).alias(f"_i_{n}")
                               for n in values])
    out = lookup_join(summed, carried, ["file", "block"], unique=["row"])
    return out.select(*rows.columns, *[(F.col(f"_i_{n}") + F.col(f"_c_{n}")).alias(n)
                                       for n in values])


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _joined(pieces: DataFrame, marked: DataFrame, record: str, separator: str) -> DataFrame:
    """(file, record number, text, at, whole) from fragments and their numbers.

    ``whole`` tells whether the record's last fragment ends it.
    """
    place = F.struct("block", "row", "text")
    return (pieces.drop("size").join(marked, list(_PLACE)).groupBy("file", record)
            .agg(F.array_sort(F.collect_list(place)).alias("parts"), F.min("at").alias("at"),
                 F.bool_or("ends").alias("whole"))
            .select("file", record, F.array_join(F.transform("parts", lambda p: p["text"]), separator)
                    .alias("text"), "at", "whole"))


# --- JSON documents ----------------------------------------------------------------

def _elements(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    """(file, item, text, at, whole, opening): the objects inside the outer list or object.

    Fragments end at a closing brace.  A string may run over fragments, so each is counted for both
    cases, beginning inside a string or outside; the running count of quotes decides.
    """
    pieces = durable(fragments(spark, path, "}", recursive), "fragments")
    plain = F.regexp_replace("text", r"(?s)\\.", "")
    parts = F.split("plain", '"')
    side = lambda odd: F.array_join(F.filter(parts, lambda x, i: i % 2 == odd), "")
    net = lambda t: _count(t, r"[\[{]") - _count(t, r"[\]}]")
    counted = (pieces.withColumn("plain", plain)
               .select(*_PLACE, "size", (F.octet_length("text") + 1).alias("bytes"),
                       F.when(F.trim("text") != "", F.left(F.ltrim(F.regexp_replace(
                           "text", r"^\s+", "")), F.lit(1))).alias("begins"),
                       _count(F.col("plain"), '"').alias("quotes"),
                       net(side(0)).alias("outside"), net(side(1)).alias("inside")))
    in_string = F.col("q") % 2 == 1
    closes = (F.col("q") + F.col("quotes")) % 2 == 0
    placed = durable(running(counted, q=F.col("quotes"), at=F.col("bytes")), "fragments-placed")
    step = F.when(in_string, F.col("inside")).otherwise(F.col("outside")) - closes.cast("int")
    deep = durable(running(placed.withColumn("step", step), depth=F.col("step")), "fragments-deep")
    # the file may end without the brace
    ends = closes & (F.col("depth") + F.col("step") == 1) & (F.col("at") + F.col("bytes") <= F.col("size"))
    marked = durable(running(deep.withColumn("ends", ends), item=F.col("ends").cast("int")),
                     "fragments-marked")
    opening = (marked.filter("begins is not null").groupBy("file")
               .agg(F.min_by("begins", F.struct("block", "row")).alias("opening")))
    found = _joined(pieces, marked.select(*_PLACE, "item", "at", "ends"), "item", "}")
    return lookup_join(found, opening, ["file"], unique=["item"])


def json_elements(spark: SparkSession, path: str, record: T.StructType,
                  recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSON documents that are lists of objects or objects of objects.

    ``records`` (file, item, key, record): the items in order, with their key where the document is
    an object.  ``rejects`` (file, at, text): elements that do not parse, and what follows the last
    one, with the byte where they begin; elements that are no objects are rejected with the object
    after them.  A document of any other kind is a reject.  Files of any length are read by as many
    tasks as they have splits.
    """
    found = _elements(spark, path, recursive)
    body = F.when(F.col("item") == 0, F.regexp_replace("text", r"^\s*[\[{]", "")).otherwise(
        F.regexp_replace("text", r"^\s*,", ""))
    body = F.concat(body, F.lit("}"))
    typed = T.StructType([*record.fields, T.StructField(_CORRUPT, T.StringType())])
    one = F.from_json(body, typed, {"columnNameOfCorruptRecord": _CORRUPT})
    pairs = F.map_entries(F.from_json(F.concat(F.lit("{"), body, F.lit("}")),
                                      T.MapType(T.StringType(), record)))
    whole = F.col("whole") & F.col("opening").isin("[", "{")
    parsed = (found.withColumn("one", F.when(whole & (F.col("opening") == "["), one))
              .withColumn("pair", F.when(whole & (F.col("opening") == "{"), pairs)))
    listed = F.col("one").isNotNull() & F.col(f"one.{_CORRUPT}").isNull()
    keyed = F.size("pair") == 1
    good = F.coalesce(listed, F.lit(False)) | F.coalesce(keyed, F.lit(False))
    fields = [F.col(f"one.{f.name}").alias(f.name) for f in record.fields]
    records = parsed.filter(good).select(
        "file", "item", F.get("pair", F.lit(0))["key"].alias("key"),
        F.when(F.col("opening") == "[", F.struct(*fields)).otherwise(
            F.get("pair", F.lit(0))["value"]).alias("record"))
    closing = ~F.col("whole") & (
        ((F.col("item") > 0) & F.col("text").rlike(r"^[\s\]}]*$"))
        | ((F.col("item") == 0) & F.col("text").rlike(r"^\s*(\[\s*\]|\{)?\s*$")))
    rejects = parsed.filter(~good & ~F.coalesce(closing, F.lit(False))).select("file", "at", "text")
    return records, rejects


# --- CSV ---------------------------------------------------------------------------

def csv_records(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """A headed CSV as string columns; quoted cells may hold line ends, quotes are doubled.

    A record ends at a line end behind an even number of quotes.  The first record of each file is
    its header; the columns are those of the first file by name.  Blank lines are skipped.
    """
    pieces = durable(fragments(spark, path, "\n", recursive), "lines")
    counted = pieces.select(*_PLACE, _count(F.col("text"), '"').alias("quotes"),
                            (F.octet_length("text") + 1).alias("bytes"))
    placed = durable(running(counted, q=F.col("quotes"), at=F.col("bytes")), "lines-placed")
    ends = (F.col("q") + F.col("quotes")) % 2 == 0
    marked = running(placed.withColumn("ends", ends), record=F.col("ends").cast("int"))
    records = durable(_joined(pieces, marked.select(*_PLACE, "record", "at", "ends"), "record", "\n")
                      .withColumn("text", F.regexp_replace("text", r"\r$", "")), "records")
    first = records.filter("record = 0").orderBy("file").select("text").first()
    if first is None:
        return spark.createDataFrame([], T.StructType([]))
    how = {"escape": '"', "quote": '"'}
    names = spark.createDataFrame([first], "text string").select(F.from_csv(
        "text", ", ".join(f"_{i} string" for i in range(first["text"].count(",") + 1)), how)).first()[0]
    names = [n for n in names if n is not None]
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    return (records.filter((F.col("record") > 0) & (F.trim("text") != ""))
            .select(F.from_csv("text", schema, how).alias("r")).select("r.*"))


# --- lines -------------------------------------------------------------------------

def numbered_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(file, line_no, line) of text files, split on LF only, numbered from 1 through all splits."""
    counted = running(fragments(spark, path, "\n", recursive), before=F.lit(1))
    return counted.select("file", (F.col("before") + 1).alias("line_no"), F.col("text").alias("line"))
