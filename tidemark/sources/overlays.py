"""Review layers, tag layers, tombstones, registry, scan payloads, sheets."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import cells, empty
from tidemark.operators.joins import fill_down

REVIEW_ENTRY = ("struct<reviewer:string,verdict:string,tier_override:string,note:string,"
                "at:string,reviewed_at:string>")


def review_layers(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reviews, layers) from (file, value) review documents.

    Entries without verdict, tier or note are skipped; reviewer and time fall
    back to the layer's; ``layer`` is the file name.
    """
    meta = F.from_json(F.get_json_object("value", "$._metadata"), "struct<reviewer:string>")
    records = F.from_json(F.get_json_object("value", "$.records"),
                          f"map<string,{REVIEW_ENTRY}>")
    named = F.coalesce(F.nullif(meta["reviewer"], F.lit("")), F.lit("unknown"))
    kept = F.filter(F.map_entries(records), lambda e: ~empty(e["value"]["verdict"])
                    | ~empty(e["value"]["tier_override"]) | ~empty(e["value"]["note"]))
    base = docs.select(F.element_at(F.split("file", "/"), -1).alias("layer"),
                       named.alias("layer_reviewer"),
                       F.coalesce(kept, F.array().cast(
                           f"array<struct<key:string,value:{REVIEW_ENTRY}>>")).alias("entries"))
    reviews = base.select("layer", "layer_reviewer", F.explode("entries").alias("e")).select(
        F.col("e.key").alias("id"),
        F.coalesce(F.nullif("e.value.reviewer", F.lit("")), "layer_reviewer").alias("reviewer"),
        "e.value.verdict", "e.value.tier_override", "e.value.note",
        F.coalesce(F.nullif("e.value.at", F.lit("")), "e.value.reviewed_at").alias("at"), "layer")
    layers = base.select(F.col("layer").alias("file"), F.col("layer_reviewer").alias("reviewer"),
                         F.size("entries").alias("records"))
    return reviews, layers


def review_metadata(docs: DataFrame) -> DataFrame:
    meta = F.from_json(F.get_json_object("value", "$._metadata"),
                       "struct<reviewer:string,layer:string,nature:string,tool:string,"
                       "tool_version:string,record_count:bigint>")
    return docs.select("file", meta.alias("m")).select("file", "m.*")


def tag_layers(docs: DataFrame) -> DataFrame:
    """(layer_id, id, tag) from (file, value) tag documents."""
    layer = F.coalesce(F.nullif(F.get_json_object("value", "$._metadata.layer_id"), F.lit("")),
                       F.element_at(F.split("file", "/"), -1))
    tags = F.from_json(F.get_json_object("value", "$.tags"),
                       "map<string,struct<domain:string,margin:double,tokens_used:bigint,"
                       "confidence:string>>")
    return docs.select(layer.alias("layer_id"), F.explode(tags).alias("id", "tag"))


def last_tombstones(rows: DataFrame, file: str = "_file", line: str = "_ord") -> DataFrame:
    """One tombstone per id: the later file and line wins."""
    place = F.struct(file, line)
    rest = [c for c in rows.columns if c not in ("id", file, line)]
    return rows.groupBy("id").agg(F.max_by(F.struct(*rest), place).alias("t")).select("id", "t.*")


def registry(docs: DataFrame) -> DataFrame:
    """Source registry rows from one JSON object per document; private keys dropped."""
    entry = ("struct<name:string,url:string,source_available_at:string,confidence:string,"
             "evidence:array<map<string,string>>>")
    parsed = F.from_json("value", f"map<string,{entry}>")
    return (docs.select(F.explode(parsed).alias("source_id", "e"))
            .filter(~F.col("source_id").startswith("_")).select("source_id", "e.*"))


#: So many profiles at most may lie in a folder: they are configuration and go to the driver.
MOST_PROFILES = 100


def profiles(spark: SparkSession, path: str, pattern: str = "*.json") -> list[dict]:
    """Every salience profile in a folder, in order of file name: a file is a profile.

    A profile needs an id of its own, tier quantiles and a scoring of kinds.
    """
    rows = (spark.read.option("wholetext", "true").option("pathGlobFilter", pattern).text(path)
            .select(F.col("_metadata.file_name").alias("file"), "value")
            .orderBy("file").limit(MOST_PROFILES + 1).collect())
    if len(rows) > MOST_PROFILES:
        raise ValueError(f"more than {MOST_PROFILES} profiles in {path}")
    out = [json.loads(r["value"]) for r in rows]
    for row, profile in zip(rows, out):
        absent = [k for k in ("profile_id", "tier_quantiles", "kind_scoring") if not profile.get(k)]
        if absent:
            raise ValueError(f"{row['file']} has no {', '.join(absent)}")
    ids = [p["profile_id"] for p in out]
    if len(set(ids)) < len(ids):
        raise ValueError(f"profiles share an id: {sorted(ids)}")
    return out


def scan_records(payloads: DataFrame) -> DataFrame:
    """(file, scan_id, pos, raw, record columns) from scan payload documents."""
    raw = F.transform(F.from_json(F.get_json_object("value", "$.records"), "array<variant>"),
                      lambda v: F.to_json(v))
    record = ("struct<slug:string,title:string,date:string,date_kind:string,description:string,"
              "sources:array<string>,why_it_matters:string,confidence:string,"
              "flags:array<string>,primary_source_retrieved:boolean>")
    return (payloads.select("file", F.get_json_object("value", "$.scan_id").alias("scan_id"),
                            F.posexplode(raw).alias("pos", "raw"))
            .withColumn("r", F.from_json("raw", record)).select("file", "scan_id", "pos", "raw",
                                                                "r.*"))


# --- sheets: (sheet, row_no, cells) --------------------------------------------------

def _present(row: Column) -> Column:
    return F.array_compact(cells(row))


def sectioned_levels(sheet: DataFrame, heads: list[str], header: str = "Category") -> DataFrame:
    """(sheet, row_no, category, level, description), the category filled down."""
    rows = sheet.withColumn("p", _present(F.col("cells"))).filter(F.size("p") >= 2)
    starts = (F.size("p") >= 3) & F.get("p", F.lit(0)).isin(heads)
    rows = rows.withColumn("starts", starts)
    filled = fill_down(rows, ["sheet"], ["row_no"], F.floor(F.col("row_no") / 10_000),
                       {"category": F.when(F.col("starts"), F.get("p", F.lit(0)))})
    shift = F.when(F.col("starts"), 1).otherwise(0)
    return (filled.filter(F.col("category").isNotNull()
                          & (F.col("starts") | (F.get("p", F.lit(0)) != header)))
            .select("sheet", "row_no", "category", F.get("p", shift).alias("level"),
                    F.get("p", shift + 1).alias("description")))


def sectioned_domains(sheet: DataFrame) -> DataFrame:
    """Domain rows carry an id ending in .0; sub-domain rows inherit the domain."""
    rows = sheet.withColumn("p", _present(F.col("cells"))).filter(F.size("p") >= 2)
    head = F.get("p", F.lit(0))
    rows = rows.withColumn("starts", head.endswith(".0") & (F.size("p") >= 4))
    filled = fill_down(rows, ["sheet"], ["row_no"], F.floor(F.col("row_no") / 10_000),
                       {"domain": F.when(F.col("starts"), F.struct(
                           head.alias("id"), F.get("p", F.lit(1)).alias("name")))})
    shift = F.when(F.col("starts"), 2).otherwise(0)
    return (filled.filter(F.col("domain").isNotNull()
                          & (F.col("starts") | (F.contains(head, F.lit("."))
                                             & ~head.endswith(".0"))))
            .select("sheet", "row_no", F.col("domain.id").alias("domain_id"),
                    F.col("domain.name").alias("domain"), F.get("p", shift).alias("subdomain_id"),
                    F.get("p", shift + 1).alias("subdomain"),
                    F.get("p", shift + 2).alias("description")))


def headed_table(sheet: DataFrame, header_row: int | None = None,
                 header_word: str = "title") -> DataFrame:
    """(sheet, row_no, record map) below a header row, fixed or found by a word.

    All-empty rows are dropped; cells are cleaned.
    """
    cleaned = sheet.withColumn("c", cells(F.col("cells")))
    if header_row is not None:
        heads = cleaned.filter(F.col("row_no") == header_row)
    else:
        heads = cleaned.filter(F.exists("c", lambda v: F.lower(v) == header_word))
    # one row per sheet
    header = heads.groupBy("sheet").agg(F.min("row_no").alias("head_no"),
                                        F.min_by("c", "row_no").alias("names"))
    pairs = F.filter(F.arrays_zip("names", "c"), lambda p: ~empty(p["names"])
                     & p["c"].isNotNull())
    return (cleaned.join(header, "sheet").filter(F.col("row_no") > F.col("head_no"))
            .withColumn("record", F.map_from_entries(F.transform(
                pairs, lambda p: F.struct(p["names"], p["c"]))))
            .filter(F.size("record") > 0).select("sheet", "row_no", "record"))
