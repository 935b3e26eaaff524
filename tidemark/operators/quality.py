"""Data-quality jobs. Each yields (collection, id, rule, severity, detail)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import dates as D
from tidemark.functions import evidence as E
from tidemark.functions import text as X
from tidemark.operators.filters import missing_list
from tidemark.operators import json_leaves
from tidemark.operators.rules import Rule, as_violations, violations


def has_key(raw: str, name: str) -> Column:
    """Is the key present in a raw JSON object, whatever its value?"""
    return F.array_contains(F.json_object_keys(raw), name)


def with_keys(df: DataFrame, raw: str, names: Sequence[str], name: str = "_complete") -> DataFrame:
    """The keys of a raw JSON object as a column, taken once per row, and whether all ``names`` are among them."""
    keyed = df.withColumn("_keys", F.json_object_keys(raw))
    every = F.lit(True)
    for c in names:
        every = every & F.array_contains("_keys", c)
    return keyed.withColumn(name, every)


def missing_keys(names: Sequence[str]) -> list[Rule]:
    """One rule per name that is not in the column of :func:`with_keys`."""
    return [Rule(f"missing {c}", ~F.array_contains("_keys", c)) for c in names]


# --- candidates -----------------------------------------------------------------

def admission_rules(raw: str = "raw") -> list[Rule]:
    rules = [Rule(f"missing {c}", X.empty(F.col(c)))
             for c in ("id", "title", "kind", "ingested_at")]
    rules.append(Rule("missing license", F.col("license").isNull()))
    rules.append(Rule("unknown kind", ~X.empty(F.col("kind"))
                      & ~F.col("kind").isin(*K.CANDIDATE_KINDS), F.col("kind")))
    rules += [Rule(f"license missing {c}", X.empty(F.col(f"license.{c}")))
              for c in ("spdx", "attribution", "source_terms_url", "verified_at")]
    rules.append(share_alike())
    return rules + clocks(raw)


def admission(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Ingest rules of a candidate; ``raw`` keeps absent apart from null."""
    return violations(df, "candidates", "id", admission_rules(raw))


def share_alike() -> Rule:
    return Rule("share-alike licence", F.contains(F.upper("license.spdx"), F.lit("-SA")),
                F.col("license.spdx"))


def clocks(raw: str) -> list[Rule]:
    return [Rule(f"clock {c} absent", ~has_key(raw, c)) for c in K.CLOCKS]


def licences(df: DataFrame) -> DataFrame:
    return violations(df, "candidates", "id",
                      [Rule("no licence", X.empty(F.col("license.spdx"))), share_alike()])


def opinion_rules(raw: str, fields: Sequence[str]) -> list[Rule]:
    return [Rule(f"bare {f}", has_key(raw, f)) for f in fields]


def bare_opinions(df: DataFrame, collection: str, key: str, raw: str,
                  fields: Sequence[str] = ("salience", "salience_tier", "game_facing")) -> DataFrame:
    return violations(df, collection, key, opinion_rules(raw, fields))


def attribution_rules() -> list[Rule]:
    return [Rule("unattributed review", F.exists("reviews", lambda r: X.empty(r["reviewer"])))]


def reviews_attributed(df: DataFrame) -> DataFrame:
    return violations(df, "candidates", "id", attribution_rules())


def clocks_present(df: DataFrame, raw: str) -> DataFrame:
    return violations(df, "candidates", "id", clocks(raw))


def unique_ids(df: DataFrame, collection: str, key: str) -> DataFrame:
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return as_violations(repeated, collection, key, "duplicate id",
                         detail=F.col("n").cast("string"))


def tombstones_honoured(feed: DataFrame, tombstones: DataFrame) -> DataFrame:
    leaked = feed.join(tombstones.select("id").distinct(), "id", "left_semi")
    return as_violations(leaked, "candidates", "id", "tombstoned record present")


# --- files and catalogues ---------------------------------------------------------

def reconcile_manifest(manifest: DataFrame, actual: DataFrame, tombstoned: DataFrame) -> DataFrame:
    """(file, outcome) from claimed, actual and post-redaction hashes."""
    joined = (manifest.select("file", F.col("sha256").alias("claimed"))
              .join(actual.select("file", F.col("sha256").alias("actual")), "file", "full_outer")
              .join(tombstoned.select("file", F.col("sha256").alias("after")), "file", "left"))
    outcome = (F.when(F.col("claimed").isNull(), "unlisted")
               .when(F.col("actual").isNull(), "missing")
               .when(F.col("claimed") == F.col("actual"), "ok")
               .when(F.col("after") == F.col("actual"), "redacted")
               .when(F.col("after").isNotNull(), "tombstone disagrees")
               .otherwise("mismatch"))
    return joined.select("file", outcome.alias("outcome"))


def catalogue_counts(claimed: DataFrame, actual: DataFrame, known: DataFrame) -> DataFrame:
    """Claimed counts that differ from the data; registered ones only warn."""
    off = (claimed.join(actual, "collection").filter(F.col("claimed") != F.col("actual"))
           .join(known.select("file", F.lit(True).alias("_known")), "file", "left"))
    return off.select(
        "collection", F.col("file").alias("id"), F.lit("count differs").alias("rule"),
        F.when(F.col("_known"), "warning").otherwise("error").alias("severity"),
        F.concat_ws(" vs ", F.col("claimed").cast("string"), F.col("actual").cast("string"))
        .alias("detail"))


def registry_evidence(registry: DataFrame) -> DataFrame:
    return violations(registry.filter(~F.col("source_id").startswith("_")), "registry",
                      "source_id", [Rule("date without evidence",
                                         ~X.empty(F.col("source_available_at"))
                                         & missing_list(F.col("evidence")))])


# --- research, grants, dumps ---------------------------------------------------------

def research_records(df: DataFrame, sources: Sequence[str],
                     required: Sequence[str] = ("id", "source", "title", "text", "url",
                                                "date_published"),
                     text_columns: Sequence[str] = ("title", "text"),
                     order: str = "_ord") -> DataFrame:
    """Record rules plus repeats: every row after the first of an id."""
    date, url = F.col("date_published"), F.col("url")
    rules = [Rule(f"missing {c}", X.empty(F.col(c))) for c in required]
    rules += [Rule(f"non-ascii {c}", X.has_non_ascii(F.col(c))) for c in text_columns]
    rules += [
        Rule("date shape", ~X.empty(date) & ~date.rlike(r"(?s)^.{4}-.{2}-.{2}")),
        Rule("url scheme", ~X.empty(url) & ~url.rlike("^https?://")),
        Rule("unknown source", ~X.empty(F.col("source"))
             & ~F.col("source").isin(list(sources)))]
    firsts = df.groupBy("id").agg(F.min(order).alias("_first"))
    repeats = (df.filter(~X.empty(F.col("id"))).select("id", order)
               .join(firsts, "id").filter(F.col(order) > F.col("_first")))
    return violations(df, "research", "id", rules).unionByName(
        as_violations(repeats, "research", "id", "duplicate id"))


def grants(df: DataFrame, required: Sequence[str] = ("grant_id", "amount", "date", "source"),
           raw: str | None = None) -> DataFrame:
    """Missing is an error, empty a warning; amount must parse; odd dates warn."""
    amount = F.replace(F.replace(F.col("amount"), F.lit(","), F.lit("")), F.lit("$"), F.lit(""))
    date = F.col("date")
    parsed = F.coalesce(*[
        F.try_to_timestamp(F.when(date.rlike(shape), date), F.lit(fmt))
        for shape, fmt in ((r"^\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
                           (r"^\d{4}/\d{1,2}/\d{1,2}\z", "yyyy/M/d"),
                           (r"^\d{1,2}/\d{1,2}/\d{4}\z", "M/d/yyyy"),
                           (r"^\d{1,2}/\d{1,2}/\d{4}\z", "d/M/yyyy"))])
    rules = []
    for c in required:
        present = has_key(raw, c) if raw else F.lit(True)
        rules.append(Rule(f"missing {c}", ~present))
        rules.append(Rule(f"empty {c}", present & X.empty(F.col(c)), severity="warning"))
    has_amount = has_key(raw, "amount") if raw else F.lit(True)
    rules.append(Rule("invalid amount",
                      has_amount & F.coalesce(X.strip(amount), F.lit("")).try_cast("double").isNull(),
                      F.col("amount")))
    rules.append(Rule("odd date", ~X.empty(date) & parsed.isNull(), date, "warning"))
    return violations(df, "grants", "grant_id", rules)


def csv_files(lines: DataFrame, required: Sequence[str]) -> DataFrame:
    """(file, line_no, value) of CSV text: header columns present, at least one row."""
    per_file = lines.groupBy("file").agg(
        F.min_by("value", "line_no").alias("header"), F.count("*").alias("n"))
    names = F.transform(F.split("header", ","), X.strip)
    rules = [Rule(f"missing column {c}", ~F.array_contains(names, c)) for c in required]
    rules.append(Rule("no data rows", F.col("n") < 2, severity="warning"))
    return violations(per_file, "csv", "file", rules)


def dump_metadata(meta: DataFrame, counts: DataFrame, raw: str = "raw") -> DataFrame:
    """Metadata rules of a dump (dump, source, raw + columns) and its row count."""
    rules = []
    for c in K.DUMP_REQUIRED:
        rules.append(Rule(f"missing {c}", ~has_key(raw, c)))
        rules.append(Rule(f"empty {c}", has_key(raw, c) & X.empty(F.col(c)), severity="warning"))
    rules += [
        Rule("source mismatch", F.col("source_name") != F.col("source"), F.col("source_name")),
        Rule("bad method", ~F.col("extraction_method").isin(*K.DUMP_METHODS),
             F.col("extraction_method")),
        Rule("bad status", ~F.col("extraction_status").isin(*K.DUMP_STATUSES),
             F.col("extraction_status")),
        Rule("zero records", F.col("record_count") == 0, severity="warning"),
        Rule("no data", F.col("rows").isNull(), severity="warning"),
        Rule("count mismatch", F.col("record_count") != F.col("rows"),
             F.concat_ws(" vs ", F.col("record_count").cast("string"),
                         F.col("rows").cast("string")), "warning")]
    return violations(meta.join(counts, "dump", "left"), "dumps", "dump", rules)


# --- evidence, labs ------------------------------------------------------------------

def lab_evidence(labs: DataFrame) -> DataFrame:
    """Dated rows need evidence whose quote carries the date to its precision."""
    ev, sev = F.col("founded_evidence"), F.col("status_evidence")
    founded, precision = F.col("founded"), F.col("founded_precision")
    missing = E.missing_date_part(founded, precision, ev["quote"])
    declared = F.coalesce(ev["date_in_quote"] == F.lit(False), F.lit(False))
    derived = E.grade(ev["publisher"], ev["url"], F.lit(True))
    dated = ~X.empty(founded)
    status = F.col("status_date")
    status_gap = E.missing_date_part(status, D.precision_of(status), sev["quote"])
    alts = F.coalesce(F.col("founded_alternatives"), F.array().cast(
        "array<struct<date:string,url:string,quote:string>>"))
    alt_gaps = F.exists(alts, lambda a: ~X.empty(a["date"]) & ~X.empty(a["quote"]) & F.coalesce(
        E.missing_date_part(a["date"], D.precision_of(a["date"]), a["quote"]).isNotNull(),
        F.lit(False)))
    cited = F.array_compact(F.concat(
        F.array(F.nullif(ev["url"], F.lit("")), F.nullif(sev["url"], F.lit(""))),
        F.transform(alts, lambda a: F.nullif(a["url"], F.lit("")))))
    uncited = F.array_except(cited, F.coalesce("sources", F.array().cast("array<string>")))
    return violations(labs, "labs", "id", [
        Rule("dated without evidence", dated & ev.isNull()),
        Rule("quote lacks date", dated & ev.isNotNull() & missing.isNotNull() & ~declared, missing),
        Rule("undated with precision", ~dated & precision.isNotNull(), precision),
        Rule("undated with grade", ~dated & ~F.col("evidence_strength").eqNullSafe("none"),
             F.col("evidence_strength")),
        Rule("grade differs", dated & ev.isNotNull()
             & ~F.col("evidence_strength").eqNullSafe(derived), derived),
        Rule("status quote lacks date", ~X.empty(status) & ~X.empty(sev["quote"])
             & status_gap.isNotNull()
             & ~F.coalesce(sev["date_in_quote"] == F.lit(False), F.lit(False)),
             status_gap, "warning"),
        Rule("alternative quote lacks date", alt_gaps, severity="warning"),
        Rule("cited url not in sources", F.size(uncited) > 0, F.array_join(uncited, " "))])


def lab_sanity(labs: DataFrame) -> DataFrame:
    founded = F.col("founded")
    year = F.left(founded, F.lit(4)).try_cast("int")
    first = F.col("epoch_first_frontier_model")
    return violations(labs, "labs", "id", [
        Rule("founded year out of range", ~year.between(1900, 2030), founded),
        Rule("model before founding", D.precedes(first, founded), first),
        Rule("status before founding", D.precedes(F.col("status_date"), founded),
             F.col("status_date")),
        Rule("undated with precision", founded.isNull()
             & F.col("founded_precision").isNotNull())])


def names_in_one_file(rows: DataFrame, name: str, file: str) -> DataFrame:
    """A name may come from one research file only."""
    spread = rows.select(name, file).distinct().groupBy(name).agg(F.count("*").alias("files"))
    return as_violations(spread.filter("files > 1"), "research rows", name,
                         "name in several files", detail=F.col("files").cast("string"))


def mechanical_basis(labs: DataFrame) -> DataFrame:
    return violations(labs, "labs", "id", [
        Rule("mechanical basis without match",
             (F.col("inclusion_basis") == "epoch_frontier_model")
             & F.col("epoch_frontier_models").isNull())])


# --- scan claims -----------------------------------------------------------------------

def scan_records(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Rules of one claimed record: (scan_id, slug, ...) with its raw JSON."""
    date, sources, flags = F.col("date"), F.col("sources"), F.col("flags")
    unsourced = missing_list(sources)
    no_flags = missing_list(flags)
    wanted = ("slug", "title", "date", "date_kind", "description", "sources", "why_it_matters",
              "confidence", "flags")
    flag_text = F.upper(F.array_join(F.coalesce(flags, F.array().cast("array<string>")), " "))
    rules = [
        ("slug shape", ~F.coalesce("slug", F.lit("")).rlike(r"^[a-z0-9_]+\z"), F.col("slug")),
        ("empty title", X.is_blank(F.col("title")), None),
        ("short description", F.length(F.coalesce("description", F.lit(""))) < 40, None),
        ("bad confidence", ~F.coalesce(F.col("confidence").isin(*K.SCAN_CONFIDENCE),
                                       F.lit(False)), F.col("confidence")),
        ("bad date kind", ~F.coalesce(F.col("date_kind").isin(*K.SCAN_DATE_KINDS),
                                      F.lit(False)), F.col("date_kind")),
        ("sources not a list", sources.isNull(), None),
        ("source not a url", F.exists(sources, lambda s: ~s.startswith("http")), None),
        ("flags not a list", flags.isNull(), None),
        ("date shape", ~date.rlike(r"^\d{4}-\d{2}-\d{2}\z"), date),
        ("date without source", date.isNotNull() & unsourced, date),
        ("date kind needs null date", date.isNotNull()
         & F.col("date_kind").isin("contested", "unverified"), F.col("date_kind")),
        ("unsourced without flag", unsourced & ~F.contains(flag_text, F.lit("UNVERIFIED")), None),
        ("low confidence without flag", (F.col("confidence") == "low") & no_flags, None),
        ("retrieved without source", F.col("primary_source_retrieved") & unsourced, None)]
    checked = [Rule(n, F.col("_complete") & b, d) for n, b, d in rules]
    return violations(with_keys(df, raw, wanted), "scan records", F.concat_ws("/", "scan_id", "slug"),
                      [*missing_keys(wanted), *checked])


def repeated_slugs(df: DataFrame) -> DataFrame:
    return unique_ids(df.withColumn("id", F.concat_ws("/", "scan_id", "slug")),
                      "scan records", "id")


def scan_payloads(payloads: DataFrame, records: DataFrame, raw: str = "raw") -> DataFrame:
    """Payload rules, with retrieval accounting when a record is unsourced."""
    sums = records.groupBy("scan_id").agg(
        F.count("*").alias("_n"), F.count_if(missing_list(F.col("sources"))).alias("_unsourced"))
    wanted = ("scan_id", "scan_scope", "scanned_at", "scanner", "operator", "instruction_summary",
              "records")
    rules = missing_keys(wanted) + [
        Rule("non-ascii", X.has_non_ascii(F.col(raw))),
        Rule("scanned_at shape", ~X.empty(F.col("scanned_at")) & ~F.col("scanned_at").rlike(
            r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"), F.col("scanned_at")),
        Rule("no records", F.coalesce("_n", F.lit(0)) == 0),
        Rule("unsourced without accounting", (F.col("_unsourced") > 0)
             & F.get_json_object(raw, "$.retrieval_accounting").isNull(),
             F.col("_unsourced").cast("string"))]
    judged = with_keys(payloads.join(sums, "scan_id", "left"), raw, wanted)
    return violations(judged, "scan payloads", "scan_id", rules)


# --- mojibake, taxonomy, events, ascii ---------------------------------------------------

def mojibake(df: DataFrame, collection: str, key: str, columns: Sequence[str],
             gating: bool = True) -> DataFrame:
    """Corrupted strings by column; raw zones report, derived zones gate."""
    return violations(df, collection, key, [
        Rule(f"mojibake in {c}", X.detect_mojibake(F.col(c)).isNotNull(),
             severity="error" if gating else "report") for c in columns])


def mojibake_leaves(df: DataFrame, collection: str, key: str, raw: str,
                    gating: bool | Column = True) -> DataFrame:
    """Corrupted strings and keys anywhere in free JSON, each with its path as the detail.

    Raw zones report, derived zones gate; a document that does not parse is a violation.
    """
    return json_leaves.broken_leaves(df, collection, key, raw, "mojibake", json_leaves.is_mojibake,
                                     gating)


def taxonomy(here: DataFrame, elsewhere: DataFrame) -> DataFrame:
    status = F.coalesce(F.col("status").isin(*K.TERM_STATUSES), F.lit(False))
    minted = violations(here, "minted here", "term", [
        Rule("no definition", X.is_blank(F.col("definition"))),
        Rule("bad status", ~status, F.col("status")),
        Rule("ruled without authority", (F.col("status") == "ruled")
             & X.is_blank(F.col("authority")))])
    others = violations(elsewhere, "minted elsewhere", "term", [
        Rule("no owner", X.is_blank(F.col("minted_by"))),
        Rule("no note", X.is_blank(F.col("note"))),
        Rule("bad status", ~status, F.col("status"))])
    both = here.select("term").intersect(elsewhere.select("term"))
    return (minted.unionByName(others)
            .unionByName(as_violations(both, "taxonomy", "term", "claimed on both sides"))
            .unionByName(unique_ids(here, "minted here", "term"))
            .unionByName(unique_ids(elsewhere, "minted elsewhere", "term")))


def event_health(df: DataFrame, raw: str,
                 required: Sequence[str] = ("id", "title", "year", "category", "description",
                                            "impacts", "sources", "tags")) -> DataFrame:
    rules = missing_keys(required)
    rules += [Rule("empty sources", missing_list(F.col("sources"))),
              Rule("empty tags", missing_list(F.col("tags"))),
              Rule("non-ascii", X.has_non_ascii(F.col(raw)),
                   F.regexp_count(raw, F.lit(K.NON_ASCII)).cast("string"))]
    return violations(with_keys(df, raw, required), "events", "id", rules)


def legacy_events(df: DataFrame) -> DataFrame:
    return violations(df, "events", "key", [
        Rule("key differs from id", ~F.col("key").eqNullSafe(F.col("id"))),
        Rule("missing title or description", X.empty(F.col("title"))
             | X.empty(F.col("description"))),
        Rule("no sources", missing_list(F.col("sources"))),
        Rule("no impacts", missing_list(F.col("impacts")))])


def ascii_rows(df: DataFrame, collection: str, key: str, highest: int = 127) -> DataFrame:
    """Rows whose JSON holds a character above ``highest``."""
    return violations(df, collection, key, [
        Rule("non-ascii", F.to_json(F.struct("*")).rlike(rf"[^\x00-\x{highest:02X}]"))])
