"""Every string of free JSON documents with its path, keys included, whatever the nesting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators.joins import lookup_join
from tidemark.workspace import durable

KEY = "/<key>"

#: Spark's JSON parser refuses member names of more than 50,000 UTF-16 units; longer ones than this,
#: in characters as written, are given to it as digests.
LONG_NAME = 20_000

_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _digest(name: Column) -> Column:
    return F.concat(F.lit("\ue000name "), F.sha2(name, 256))


def _parsed(docs: DataFrame, raw: str, keep: Sequence[str]) -> DataFrame:
    """(keep, node, names): the parsed documents, null where they do not parse.

    A document that is refused is parsed again with its long member names as digests, if it has any;
    ``names`` holds them whole.
    """
    strings = F.regexp_extract_all(raw, F.lit(_STRING), F.lit(0))
    whole = lambda s, rest: F.when(
        (F.length(s) > LONG_NAME) & rest.rlike(r"\A\s*:"),
        F.try_variant_get(F.try_parse_json(s), "$", "string"))
    pieces = F.zip_with(F.concat(F.array(F.lit("")), strings), F.split(raw, _STRING, -1),
                        lambda s, rest: F.struct(s.alias("string"), rest.alias("rest"),
                                                 whole(s, rest).alias("name")))
    names = F.array_compact(F.transform("_pieces", lambda p: p["name"]))
    short = F.array_join(F.transform("_pieces", lambda p: F.concat(F.coalesce(
        F.concat(F.lit('"'), _digest(p["name"]), F.lit('"')), p["string"]), p["rest"])), "")
    refused = F.col("node").isNull() & (F.length(raw) > LONG_NAME)
    return (docs.withColumn("node", F.try_parse_json(raw))
            .withColumn("_pieces", F.when(refused, pieces)).withColumn("names", names)
            .select(*keep, F.when(F.size("names") > 0, F.try_parse_json(short)).otherwise(F.col("node"))
                    .alias("node"), "names"))


def _opened(nodes: DataFrame, keep: Sequence[str], names: DataFrame | None) -> DataFrame:
    """(keep, path, key, node) of the members of objects and the items of arrays."""
    members = nodes.lateralJoin(nodes.sparkSession.tvf.variant_explode(F.col("node").outer()).select(
        F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_value")))
    if names is not None:
        members = lookup_join(members, names, ["_key"], "left").withColumn(
            "_key", F.coalesce("_name", "_key"))
    step = F.when(F.col("_key").isNull(), F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]"))
                  ).otherwise(F.concat(F.lit("/"), F.col("_key")))
    return members.select(*keep, F.concat("path", step).alias("path"),
                          F.concat("path", F.lit(KEY)).alias("key_path"), F.col("_key").alias("key"),
                          F.col("_value").alias("node"))


def string_leaves(docs: DataFrame, raw: str, keep: Sequence[str]) -> DataFrame:
    """(keep, path, leaf) of all strings and all keys in the JSON text ``raw``.

    Paths read ``/member`` and ``[place]``; a key is reported at its object's path and ``/<key>``.
    The documents are parsed once and opened level by level, each level a table of the objects and
    arrays that the one before held, so depth costs rounds and a wide document only rows.  A document
    that does not parse, or is null, has the one row with path ``null`` and leaf null.
    """
    null = F.lit(None).cast("string")
    parsed = durable(_parsed(docs, raw, keep), "parsed")
    out = parsed.filter("node is null").select(*keep, null.alias("path"), null.alias("leaf"))
    long = parsed.filter("node is not null").select(F.explode("names").alias("_name")).distinct()
    names = durable(long.select(_digest(F.col("_name")).alias("_key"), "_name"), "long-names")
    names = None if names.isEmpty() else names
    nodes = parsed.filter("node is not null").select(
        *keep, F.lit("").alias("path"), null.alias("key_path"), null.alias("key"), "node")
    while True:
        kind = F.schema_of_variant("node")
        nodes = durable(nodes.withColumn("kind", F.when(kind == "STRING", "string").when(
            kind.startswith("OBJECT") | kind.startswith("ARRAY"), "open")), "nodes")
        out = (out.unionByName(nodes.filter("kind = 'string'").select(
            *keep, "path", F.variant_get("node", "$", "string").alias("leaf")))
            .unionByName(nodes.filter("key is not null").select(
                *keep, F.col("key_path").alias("path"), F.col("key").alias("leaf"))))
        below = nodes.filter("kind = 'open'")
        if below.isEmpty():
            return out
        nodes = _opened(below.select(*keep, "path", "node"), keep, names)


def broken_leaves(docs: DataFrame, collection: str, key: str, raw: str, rule: str,
                  broken: Callable[[Column], Column], gating: bool | Column = True) -> DataFrame:
    """One violation per string or key that is ``broken``, with its path as the detail.

    Documents that do not parse are violations as well: a file must not pass by being broken.
    ``gating`` may be a column of ``docs``: immutable zones report, derived zones gate.
    """
    gate = F.lit(gating) if isinstance(gating, bool) else gating
    rows = docs.select(F.col(key).cast("string").alias("id"), gate.alias("gate"), F.col(raw).alias("raw"))
    leaves = string_leaves(rows, "raw", ["id", "gate"])
    unread = F.col("path").isNull()
    return leaves.filter(unread | F.coalesce(broken(F.col("leaf")), F.lit(False))).select(
        F.lit(collection).alias("collection"), "id",
        F.when(unread, "does not parse as JSON").otherwise(rule).alias("rule"),
        F.when(F.col("gate"), "error").otherwise("report").alias("severity"),
        F.when(~unread, F.col("path")).alias("detail"))


def is_mojibake(leaf: Column) -> Column:
    return X.detect_mojibake(leaf).isNotNull()
