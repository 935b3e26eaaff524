"""Queries that land the tables as files, read them back, publish and stream."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality as Q
from tidemark.plans import queries_candidates as QC
from tidemark.plans import queries_collections as QL
from tidemark.plans.registry import query
from tidemark.plans.standins import cte, heavy, standin, table
from tidemark.sinks import publish
from tidemark.sources import documents as D
from tidemark.sources import fragments, overlays, snapshots
from tidemark.streaming import incremental as INC
from tidemark.workspace import new_path

_STRINGS = "array<string>"


def ddl(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


# --- scans ---------------------------------------------------------------------------

def landed_documents(spark, sf) -> str:
    """Documents as JSONL with blank lines, broken lines and U+2028 inside values."""
    path = new_path(spark, "jsonl")
    k = F.col("doc_id")
    good = F.to_json(F.struct("doc_id", "lang", F.concat("text", F.lit(" end"))
                              .alias("text")))
    lines = F.array_compact(F.array(good, F.when(k % 10 == 0, "   "),
                                    F.when(k % 15 == 0, '{"doc_id": 1, "lang": "tr')))
    table(spark, sf, "documents").select(F.explode(lines).alias("value")).write.text(path)
    return path


@query("jsonl_scan", "S1 S2", """
SELECT doc_id, md5(text || chr(8232) || 'end') AS text_md5 FROM documents""")
def _(spark, sf):
    rows, _ = D.jsonl(spark, landed_documents(spark, sf), ddl("doc_id long, lang string, text string"))
    return rows.select("doc_id", F.md5("text").alias("text_md5"))


@query("jsonl_rejects", "S1", """
SELECT '{"doc_id": 1, "lang": "tr' AS line, count(*) AS n FROM documents WHERE doc_id % 15 = 0""")
def _(spark, sf):
    _, rejects = D.ordered_jsonl(spark, landed_documents(spark, sf), ddl("doc_id long, lang string"))
    return rejects.groupBy(F.col(D.CORRUPT).alias("line")).agg(F.count("*").alias("n"))


@query("landed_clean_counts", "S1 W5 C1 A24", """
SELECT lang, CAST(count(DISTINCT CASE WHEN doc_id % 9 <> 0 THEN doc_id % 50 END)
  + sum(CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept FROM documents GROUP BY 1""")
def _(spark, sf):
    from tidemark.plans import research as PR
    path = new_path(spark, "dumps")
    k = F.col("doc_id")
    # every task writes a file of each language: a language is never gathered in one task
    (heavy(spark, sf, "documents").select("lang", F.to_json(F.struct(
        F.when(k % 9 != 0, (k % 50).cast("string")).alias("id"), "text")).alias("value"))
     .write.partitionBy("lang").text(path))
    rows, _ = D.ordered_jsonl(spark, path, ddl("id string, text string"))
    # a language is one dump here, however many files it was written to
    cleaned = PR.clean(rows.withColumns({
        "_ord": F.struct("_file", "_ord"), "_file": F.col("lang")}))
    return cleaned.groupBy("lang").agg(F.count("*").alias("kept"))


@query("json_documents", "S3 S4", """
SELECT 'list' AS shape, NULL AS key, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT 'map', 'k' || c_custkey, c_name, c_acctbal FROM customer""")
def _(spark, sf):
    record = F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    key = F.concat(F.lit("k"), F.col("c_custkey").cast("string"))
    docs = table(spark, sf, "customer").select(F.explode(F.array(
        F.struct(F.lit("list").alias("shape"), F.to_json(F.array(record)).alias("value")),
        F.struct(F.lit("map").alias("shape"), F.to_json(F.create_map(key, record)).alias("value")),
        F.struct(F.lit("other").alias("shape"), F.lit("3").alias("value")))).alias("d")).select(
        "d.shape", "d.value")
    out = D.explode_document(docs, "value", ddl("name string, balance double"))
    return out.select("shape", "key", "record.name", "record.balance")


def one_file(rows, order, spark, label) -> str:
    """Lines (``value``) as a single text file in the order given; the lines stream through one task."""
    path = new_path(spark, label)
    rows.orderBy(order).select("value").coalesce(1).write.text(path)
    return path


def landed_json(spark, sf, shape) -> str:
    """Customers as one JSON list or object; every 50th element has broken syntax."""
    rows = table(spark, sf, "customer")
    least, k = rows.agg(F.min("c_custkey")).first()[0], F.col("c_custkey")
    item = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                              F.lit('a } "quoted\" ] brace {').alias("note")))
    item = F.when(k % 50 == 0, F.regexp_replace(item, '"name":', '"name" ')).otherwise(item)
    if shape == "map":
        item = F.concat(F.lit('"k'), k.cast("string"), F.lit('": '), item)
    item = F.concat(F.when(k == least, F.lit("[" if shape == "list" else "{")).otherwise(F.lit(",")), item)
    end = rows.sparkSession.createDataFrame([("]" if shape == "list" else "}",)], "value string")
    lines = rows.select(k.alias("k"), item.alias("value")).unionByName(
        end.withColumn("k", F.lit(None).cast("long")))
    return one_file(lines, F.col("k").asc_nulls_last(), spark, f"json-{shape}")


@query("json_file_in_splits", "S3 S4", """
SELECT 'list' AS shape, NULL AS key, c_name AS name, c_acctbal AS balance FROM customer
  WHERE c_custkey % 50 <> 0
UNION ALL SELECT 'map', 'k' || c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 50 <> 0""")
def _(spark, sf):
    out = None
    for shape in ("list", "map"):
        found, _ = fragments.json_elements(spark, landed_json(spark, sf, shape),
                                           ddl("name string, balance double, note string"))
        part = found.select(F.lit(shape).alias("shape"), "key", "record.name", "record.balance")
        out = part if out is None else out.unionByName(part)
    return out


@query("json_file_rejects", "S3 S4", """
SELECT CAST(regexp_extract(c_name, '[0-9]+') AS BIGINT) AS custkey, true AS begins_there FROM customer
WHERE c_custkey % 50 = 0""")
def _(spark, sf):
    """Broken elements with the byte they begin at; the bytes before it must lead up to it."""
    path = landed_json(spark, sf, "list")
    _, bad = fragments.json_elements(spark, path, ddl("name string, balance double, note string"))
    # in these files a line is an element; it begins behind the brace of the line before
    lines = fragments.running(fragments.fragments(spark, path, "\n"), at=F.octet_length("text") + 1)
    starts = lines.select(F.regexp_extract("text", r"#(\d+)", 1).try_cast("long").alias("custkey"),
                          F.greatest(F.col("at") - 1, F.lit(0)).alias("start"))
    found = bad.select(F.regexp_extract("text", r"#(\d+)", 1).try_cast("long").alias("custkey"), "at")
    return found.join(starts, "custkey").select("custkey", (F.col("at") == F.col("start"))
                                                .alias("begins_there"))


@query("csv_scan", "S5", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || chr(10) || '"quoted", ' || p_brand AS label
FROM part""")
def _(spark, sf):
    path = new_path(spark, "csv")
    table(spark, sf, "part").select("p_partkey", F.concat(
        "p_name", F.lit('\n"quoted", '), "p_brand").alias("label")).coalesce(1).write.csv(
        path, header=True, escape='"', quoteAll=True)
    return D.csv(spark, path).select("p_partkey", "label")


@query("data_files_only", "S6", """
SELECT 'orders' AS kind, count(*) AS n FROM orders""")
def _(spark, sf):
    path = new_path(spark, "tree")
    for name in ("deep/orders", "sample_orders"):
        table(spark, sf, "orders").select(F.to_json(F.struct("o_orderkey")).alias("value")) \
            .write.text(f"{path}/{name}")
    rows, _ = D.jsonl(spark, path, ddl("o_orderkey long"), recursive=True)
    # names are judged by directory here, because Spark names the part files
    named = rows.withColumn("_file", F.element_at(F.split("_file", "/"), -2))
    return D.data_files(named).groupBy(F.col("_file").alias("kind")).agg(F.count("*").alias("n"))


@query("numbered_lines", "S16", """
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INT) AS lines, md5(string_split(text, chr(10))[1])
  AS first_md5 FROM documents""")
def _(spark, sf):
    lines = D.number_lines(table(spark, sf, "documents").select("doc_id", "text"), "text")
    return lines.groupBy("doc_id").agg(F.max("line_no").alias("lines"), F.md5(F.min_by(
        "line", "line_no")).alias("first_md5"))


@query("input_lineage", "S17 K6", """
SELECT count(*) AS records, true AS hashed FROM documents""")
def _(spark, sf):
    path = landed_documents(spark, sf)
    rows, _ = D.jsonl(spark, path, ddl("doc_id long"))
    strip = F.regexp_replace(F.col("file"), "^file:/+", "/")
    hashes = D.file_hashes(spark, path).withColumn("file", strip)
    inputs = publish.lineage_inputs(rows.withColumn("_file", F.regexp_replace(
        "_file", "^file:/+", "/")), hashes)
    return inputs.agg(F.sum("records").alias("records"),
                      F.bool_and(F.length("sha256") == 64).alias("hashed"))


@query("snapshot_paths", "S7", """
SELECT 'src_' || (s_suppkey % 4) AS source_id, max('2026-01-' || lpad(CAST(1 + s_suppkey % 28
  AS VARCHAR), 2, '0')) AS dump_ts FROM supplier GROUP BY 1""")
def _(spark, sf):
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(F.concat(
        F.lit("/raw/src_"), (k % 4).cast("string"), F.lit("/dumps/2026-01-"), F.lpad(
            (1 + k % 28).cast("string"), 2, "0"), F.lit("/data.jsonl")).alias("_file"))
    return snapshots.newest(snapshots.with_dump_columns(rows)).select(
        "source_id", "dump_ts").distinct()


def review_documents(spark, sf):
    """Review layers of at most 50 records each, as JSON documents."""
    rows = standin(spark, sf, "reviews")
    k = F.col("doc_id")
    entry = F.struct(F.when(k % 4 == 0, F.col("reviewer")).alias("reviewer"),
                     F.when(k % 6 != 0, F.col("verdict")).alias("verdict"),
                     F.when(k % 12 == 6, F.lit("see")).alias("note"),
                     F.col("said_at").alias("reviewed_at"))
    block = F.floor(k / 50)
    return rows.groupBy(block.alias("b")).agg(F.map_from_entries(F.collect_list(
        F.struct("id", entry))).alias("records")).select(
        F.concat(F.lit("layers/l"), F.col("b").cast("string"), F.lit(".json")).alias("file"),
        F.to_json(F.struct(F.struct(F.when(F.col("b") % 2 == 0, "lead").alias("reviewer"),
                                    F.lit("opinion").alias("nature"),
                                    F.size("records").alias("record_count")).alias("_metadata"),
                           "records")).alias("value"))


SQL_LAYERS = """l AS (SELECT id, verdict, said_at, doc_id, reviewer,
  CAST(floor(doc_id / 50) AS BIGINT) AS b FROM reviews)"""


@query("review_layers", "S9", cte("reviews") + f""", {SQL_LAYERS}
SELECT id, CASE WHEN doc_id % 4 = 0 THEN reviewer WHEN b % 2 = 0 THEN 'lead' ELSE 'unknown' END
  AS reviewer, CASE WHEN doc_id % 6 <> 0 THEN verdict END AS verdict, said_at AS reviewed_at,
  'l' || b || '.json' AS layer FROM l WHERE doc_id % 6 <> 0 OR doc_id % 12 = 6""")
def _(spark, sf):
    reviews, _ = overlays.review_layers(review_documents(spark, sf))
    return reviews.select("id", "reviewer", "verdict", F.col("at").alias("reviewed_at"), "layer")


@query("review_layer_counts", "S9 S19", cte("reviews") + f""", {SQL_LAYERS}
SELECT 'l' || b || '.json' AS file, CASE WHEN b % 2 = 0 THEN 'lead' ELSE 'unknown' END AS reviewer,
  CAST(sum(CASE WHEN doc_id % 6 <> 0 OR doc_id % 12 = 6 THEN 1 ELSE 0 END) AS INT) AS records,
  'opinion' AS nature, count(*) AS record_count FROM l GROUP BY b""")
def _(spark, sf):
    docs = review_documents(spark, sf)
    _, layers = overlays.review_layers(docs)
    meta = overlays.review_metadata(docs).select(
        F.element_at(F.split("file", "/"), -1).alias("file"), "nature", "record_count")
    return layers.join(meta, "file")


@query("tag_layers", "S10", """
SELECT CASE WHEN p_size % 2 = 0 THEN 'machine_v1' ELSE 't' || p_size || '.json' END AS layer_id,
  'p' || p_partkey AS id, p_brand AS domain FROM part""")
def _(spark, sf):
    size = F.col("p_size")
    docs = table(spark, sf, "part").select(
        F.concat(F.lit("tags/t"), size.cast("string"), F.lit(".json")).alias("file"),
        F.to_json(F.struct(F.struct(F.when(size % 2 == 0, "machine_v1").alias("layer_id"))
                           .alias("_metadata"), F.create_map(
            F.concat(F.lit("p"), F.col("p_partkey").cast("string")),
            F.struct(F.col("p_brand").alias("domain"))).alias("tags"))).alias("value"))
    return overlays.tag_layers(docs).select("layer_id", "id", "tag.domain")


@query("source_registry", "S12", """
SELECT 'n' || n_nationkey AS source_id, 'https://' || n_name AS url,
  CAST(n_regionkey AS INT) AS evidence FROM nation""")
def _(spark, sf):
    docs = table(spark, sf, "nation").select(F.to_json(F.create_map(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")),
        F.struct(F.concat(F.lit("https://"), "n_name").alias("url"), F.array_repeat(
            F.create_map(F.lit("claim"), F.lit("x")), F.col("n_regionkey")).alias("evidence")),
        F.lit("_README"), F.struct(F.lit("no").alias("url"), F.array().cast(
            "array<map<string,string>>").alias("evidence")))).alias("value"))
    return overlays.registry(docs).select("source_id", "url", F.size("evidence").alias("evidence"))


@query("scan_payload_explode", "S15", """
SELECT 'scan' || event_id AS scan_id, p AS pos, event_type || '_' || p AS slug,
  'https://e/' || user_id AS source FROM events, (VALUES (0), (1)) v(p)""")
def _(spark, sf):
    rec = lambda p: F.struct(
        F.concat("event_type", F.lit(f"_{p}")).alias("slug"), F.array(F.concat(
            F.lit("https://e/"), F.col("user_id").cast("string"))).alias("sources"))
    docs = table(spark, sf, "events").select(F.lit("x.json").alias("file"), F.to_json(F.struct(
        F.concat(F.lit("scan"), F.col("event_id").cast("string")).alias("scan_id"),
        F.array(rec(0), rec(1)).alias("records"))).alias("value"))
    return overlays.scan_records(docs).select("scan_id", "pos", "slug",
                                              F.get("sources", F.lit(0)).alias("source"))


# --- sinks -------------------------------------------------------------------------------

@query("feed_round_trip", "K1 T1", cte("candidates") + "SELECT id, title, published_at FROM candidates")
def _(spark, sf):
    path = new_path(spark, "feed")
    publish.feed(QC.candidates(spark, sf).select("id", "title", "published_at", "main_value"), path,
                 [F.desc("main_value"), F.col("id")])
    return spark.read.schema("id string, title string, published_at string").json(path)


@query("split_exports", "K2 K15", cte("events_v") + """
SELECT 'year' AS split, CAST(year AS VARCHAR) AS value, count(*) AS n FROM events_v GROUP BY year
UNION ALL SELECT 'category', category, count(*) FROM events_v GROUP BY category""")
def _(spark, sf):
    events, out = QL.timeline_events(spark, sf).drop("sources_text", "tags_text"), None
    for by in ("year", "category"):
        path = new_path(spark, f"by-{by}")
        publish.split_export(events, path, by)
        part = spark.read.schema(f"id string, {by} string").json(path).groupBy(
            F.col(by).alias("value")).agg(F.count("*").alias("n")).select(
            F.lit(by).alias("split"), "value", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("guarded_dump", "K7 S17 Q2 Q3", cte("candidates") + """
SELECT count(*) AS written, true AS manifest_matches, true AS flip_differs, true AS refused_bad,
  true AS bounded FROM candidates""")
def _(spark, sf):
    k = F.col("o_orderkey")
    rows = QC.candidates(spark, sf).select(
        "id", "title", "kind", F.lit("2026-01-01").alias("ingested_at"), F.struct(
            F.lit("CC-BY-4.0").alias("spdx"), F.lit("a").alias("attribution"), F.lit("t").alias(
                "source_terms_url"), F.lit("2026").alias("verified_at")).alias("license"),
        "occurred_at", "published_at", "source_available_at", k.alias("k"))
    rows = rows.withColumn("raw", F.to_json(F.struct(
        "occurred_at", "published_at", "source_available_at"), {"ignoreNullFields": "false"}))
    path, most = new_path(spark, "dump"), 1 << 20
    manifest = publish.guarded_dump(rows.drop("raw", "k"), Q.admission(rows), path, file_bytes=most)
    refused = False
    try:
        bad = rows.withColumn("title", F.when(F.col("k") % 100 != 0, F.col("title")))
        publish.guarded_dump(bad.drop("raw", "k"), Q.admission(bad), path + "-bad")
    except publish.RefusedWrite:
        refused = True
    # files are bounded, so Spark can hold each one to hash it by itself, as it is and with a byte changed
    content = F.hex("content")
    flipped = F.unhex(F.concat(F.when(F.left(content, F.lit(2)) == "00", F.lit("01"))
                               .otherwise(F.lit("00")), F.substr(content, F.lit(3))))
    own = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
           .filter("length > 0").select(F.col("path").alias("file"), F.sha2("content", 256).alias("own"),
                                        F.sha2(flipped, 256).alias("flipped")))
    same = manifest.filter("bytes > 0").join(own, "file", "full_outer").agg(
        F.bool_and(F.coalesce(F.col("sha256") == F.col("own"), F.lit(False))).alias("manifest_matches"),
        F.bool_and(F.col("sha256") != F.col("flipped")).alias("flip_differs"),
        (F.max("bytes") < 2 * most).alias("bounded"))
    # one row each
    return (spark.read.schema("id string").json(path + "/data").agg(F.count("*").alias("written"))
            .join(F.broadcast(same)).withColumn("refused_bad", F.lit(refused)))


@query("tag_layer_write", "K9", """
SELECT count(*) AS tags, count(*) AS tagged_count FROM part""")
def _(spark, sf):
    path = new_path(spark, "tags")
    tags = table(spark, sf, "part").select(F.col("p_partkey").alias("id"),
                                           F.struct(F.col("p_brand").alias("domain")).alias("tag"))
    publish.tag_layer(tags, path, "machine_v1", {"layer_version": "0.1.0"})
    meta = spark.read.schema("tagged_count long").json(path + "_metadata/machine_v1")
    # one row each
    return spark.read.parquet(path).agg(F.count("*").alias("tags")).join(F.broadcast(meta))


@query("review_layer_export", "K13", cte("reviews") + """
SELECT id, CASE WHEN doc_id % 3 = 0 THEN 'ada' ELSE 'me' END AS reviewer,
  CASE WHEN doc_id % 2 = 0 THEN verdict END AS verdict FROM reviews
WHERE doc_id % 2 = 0 OR doc_id % 5 = 0""")
def _(spark, sf):
    k = F.col("doc_id")
    said = standin(spark, sf, "reviews").select(
        "id", F.when(k % 3 == 0, "ada").otherwise("").alias("reviewer"),
        F.when(k % 2 == 0, F.col("verdict")).otherwise("").alias("verdict"),
        F.lit(None).cast("string").alias("tier_override"),
        F.when(k % 5 == 0, "look").alias("note"), F.col("said_at").alias("at"))
    return publish.review_layer(said, "me").select("id", "reviewer", "verdict")


# --- incremental and streaming -----------------------------------------------------------------

@query("ledger_promotion", "R2 S17", """
SELECT 'f' || c_custkey AS file, true AS promoted FROM customer
WHERE c_custkey % 4 <> 0 AND c_custkey % 7 <> 0""")
def _(spark, sf):
    k = F.col("c_custkey")
    name = F.concat(F.lit("f"), k.cast("string"))
    hashes = table(spark, sf, "customer").select(k, name.alias("file"), F.sha2("c_name", 256)
                                                 .alias("sha256"))
    ledger = hashes.filter((k % 4 == 0) | (k % 5 == 0)).select("file", F.when(
        k % 4 != 0, F.lit("old")).otherwise(F.col("sha256")).alias("sha256"))
    errors = hashes.filter(k % 7 == 0).select(F.col("file").alias("_file"))
    rows = table(spark, sf, "orders").select(F.concat(F.lit("f"), F.col("o_custkey")
                                                      .cast("string")).alias("_file"), "o_orderkey")
    promoted, entries = INC.promote(rows, hashes.drop("c_custkey"), ledger, errors)
    kept = promoted.select(F.col("_file").alias("file")).distinct()
    return entries.join(kept.withColumn("has", F.lit(True)), "file", "left").select(
        "file", F.lit(True).alias("promoted"))


def landed_events(spark, sf) -> str:
    path = new_path(spark, "landing")
    (table(spark, sf, "events").select("event_id", "user_id", "event_type", "value",
                                       F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
     .repartition(4, "event_id").write.json(path))
    return path


@query("stream_deduplicated", "R3", """
SELECT event_id, user_id FROM events""")
def _(spark, sf):
    """Everything is delivered twice, in different micro-batches, and a row that is too late comes last."""
    landing, target = new_path(spark, "deliveries"), new_path(spark, "stream-dedup")
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    late = events.agg(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"),
                      (F.min("ts") - F.expr("INTERVAL 400 DAYS")).alias("ts"))
    for n, rows in enumerate((events, events, late)):
        rows.coalesce(1).write.json(f"{landing}/delivery-{n}")
    once = (spark.readStream.schema("event_id long, user_id long, ts timestamp")
            .option("maxFilesPerTrigger", 1).json(f"{landing}/*"))
    kept = INC.stream_keep_first(once, "event_id", "ts", "60 days").select("event_id", "user_id")
    (kept.writeStream.format("parquet").option("path", target)
     .option("checkpointLocation", target + "-state").trigger(availableNow=True).start()
     .awaitTermination())
    return spark.read.schema("event_id long, user_id long").parquet(target)


@query("stream_ingest", "R1", """
SELECT doc_id AS id FROM documents WHERE doc_id % 14 >= 4 AND length(text) >= 100
  AND source IN ('src1', 'src2', 'src3')""")
def _(spark, sf):
    landing, target = new_path(spark, "landing"), new_path(spark, "ingested")
    table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text", "source", F.concat(
            (2012 + F.col("doc_id") % 14).cast("string"), F.lit("-06-01")).alias("date_published")
    ).write.json(landing)
    INC.ingest_available(spark, landing, ddl("id long, text string, source string, "
                                             "date_published string"), target, target + "-state",
                         min_date="2016-01-01", sources=("src1", "src2", "src3")
                         ).awaitTermination()
    return spark.read.schema("id long").parquet(target)


SQL_DECISIONS = """SELECT 'u' || user_id AS id, arg_max(event_type, (ts, event_id)) AS watch_status,
  count(*) AS decisions FROM events GROUP BY 1"""


def decision_log(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
        F.col("event_type").alias("watch_status"), F.lit("A").alias("rating"),
        F.lit("ada").alias("by"), F.concat(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-"),
            F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("at"))


@query("current_decisions", "R4", SQL_DECISIONS)
def _(spark, sf):
    return INC.current_decisions(decision_log(spark, sf)).select("id", "watch_status", "decisions")


@query("stream_decision_fold", "R4", SQL_DECISIONS)
def _(spark, sf):
    landing, target = new_path(spark, "decisions"), new_path(spark, "folded")
    decision_log(spark, sf).select("id", "watch_status", "rating", "at").write.json(landing)
    log = spark.readStream.schema("id string, watch_status string, rating string, at string") \
        .option("maxFilesPerTrigger", 1).json(landing)

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    (INC.stream_decisions(log).writeStream.outputMode("update").foreachBatch(write)
     .option("checkpointLocation", target + "-state").trigger(availableNow=True).start()
     .awaitTermination())
    states = spark.read.parquet(target)
    return states.groupBy("id").agg(F.max_by(F.struct("watch_status", "decisions"), "decisions")
                                    .alias("s")).select("id", "s.watch_status", "s.decisions")


@query("retained_rows", "R5", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 20 DAYS""")
def _(spark, sf):
    return INC.retained(table(spark, sf, "events"), "ts",
                        F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'"), 20).select("event_id")


@query("watch_transitions", "R4", """
SELECT 'u' || user_id AS id, CASE WHEN arg_max(event_type, (ts, event_id)) = 'view'
  THEN strftime(max(ts), '%Y-%m-%d') END AS watching_since,
  CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'ada' END AS decided_by
FROM events GROUP BY 1""")
def _(spark, sf):
    now = INC.current_decisions(decision_log(spark, sf))
    status = F.when(F.col("watch_status") == "view", "watching").when(
        F.col("watch_status") == "error", "rejected")
    dates = INC.watch_dates(status, F.lit(None).cast("string"), F.col("at"), F.col("by"))
    return now.withColumns(dates).select("id", "watching_since", "decided_by")
