"""Watch list, accepted atoms, labs, timeline, taxonomy, grants, quality, checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import dates as D
from tidemark.functions import evidence as E
from tidemark.functions import grants as G
from tidemark.functions import numbers as N
from tidemark.functions import text as X
from tidemark.operators import aggregates as A
from tidemark.operators import dedup, joins, similarity
from tidemark.operators.filters import missing_list
from tidemark.operators.rules import schema_violations, verdicts
from tidemark.sinks.publish import RefusedWrite, collection_manifest, first_broken, light_index
from tidemark.workspace import durable

_STRINGS = "array<string>"


# --- watch list ------------------------------------------------------------------------

def watch_atoms(records: DataFrame) -> DataFrame:
    """One atom per slug from scan records (file, pos, scan_id, ...), first record wins."""
    ordered = records.withColumn("_at", F.struct("file", "pos")).withColumn(
        "scans", F.col("scan_id"))
    merged = dedup.merge_first_seen(
        ordered, "slug", "_at",
        ["title", "date", "date_kind", "description", "why_it_matters", "confidence",
         "primary_source_retrieved"],
        sorted_sets=["scans"], ordered_sets=["sources", "flags"])
    return merged.withColumnsRenamed({"confidence": "scan_confidence", "flags": "scan_flags"}) \
        .withColumn("id", F.col("slug"))


@dataclass(frozen=True)
class WatchRelations:
    """What atoms have to do with each other, factored so that no table grows with copies squared.

    ``members`` (id, set_id, day): atoms of equal title, or title and date, are one set.  ``edges`` (left_set,
    right_set, overlap, dated): sets that look like one event, if dated those of their members with close dates.  ``cited`` (id, other): atoms that name each other.
    """

    atoms: DataFrame
    members: DataFrame
    edges: DataFrame
    cited: DataFrame


def watch_relations(atoms: DataFrame) -> WatchRelations:
    cites = similarity.citations(atoms, "id", F.array_join("scan_flags", " "))
    cited = durable(similarity.citation_edges(cites, atoms, "id"), "cited")
    members, edges = similarity.near_duplicate_titles(
        atoms, "id", "title", F.try_to_date("date", "yyyy-MM-dd"))
    return WatchRelations(atoms, members, durable(edges, "edges"), cited)


def attention(found: WatchRelations) -> DataFrame:
    """The atoms with ``duplicates``, ``cross_references`` and ``needs_attention``.

    A citation between atoms that look alike anyway counts once, as a duplicate.  An atom without title
    words is in no set and has only citations.
    """
    near = similarity.duplicate_counts(found.members, found.edges, "id").select("id", "duplicates")
    others = (similarity.cited_apart(found.members, found.edges, found.cited, "id").groupBy("id")
              .agg(F.count("*").alias("cross_references")))
    counted = found.atoms.join(near, "id", "left").join(others, "id", "left").fillna(
        0, ["duplicates", "cross_references"])
    return counted.withColumn("needs_attention",
                              F.col("duplicates") + F.col("cross_references") > 0)


def watch_list(records: DataFrame, prior: DataFrame, expand: bool = False) -> DataFrame:
    """Atoms with duplicate flags and the human fields of the prior list.

    Each atom carries the numbers of its near duplicates and cross references, which are linear; with
    ``expand`` also the ids it may repeat, a list that is quadratic in the copies of a title.

    Refuses when an id with a human decision is no longer derived.
    """
    atoms = watch_atoms(records)
    lost = joins.orphans(atoms, prior, "id", K.WATCH_HUMAN_FIELDS)
    first = lost.limit(5).collect()
    if first:
        raise RefusedWrite(f"decided atoms no longer derived: {[r['id'] for r in first]}")
    found = watch_relations(atoms)
    out = attention(found)
    if expand:
        pairs = similarity.possible_duplicates(found.members, found.edges, found.cited, "id")
        out = out.join(pairs.groupBy("id").agg(
            F.array_sort(F.collect_list("other")).alias("possible_duplicate_of")), "id", "left")
    return joins.carry_forward(out, prior, "id", K.WATCH_HUMAN_FIELDS)


def block_reasons() -> Column:
    return F.array_compact(F.array(
        F.when(X.empty(F.col("date")), F.lit("no date")),
        F.when(missing_list(F.col("sources")), F.lit("no source")),
        F.when(X.empty(F.col("decided_by")), F.lit("no named decider"))))


def promote(df: DataFrame) -> DataFrame:
    strings = lambda c: F.coalesce(c, F.array().cast(_STRINGS)).alias(c)
    return df.select(
        "id", "title", F.col("date").alias("occurred_at"), "date_kind", "description",
        "why_it_matters", strings("sources"), "primary_source_retrieved", "scan_confidence",
        strings("scan_flags"), strings("scans"), F.col("decided_by").alias("accepted_by"),
        F.col("decided_on").alias("accepted_on"), "decision_note", "watching_since")


def accepted(atoms: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(served, blocked with reasons, counts by watch status)."""
    chosen = atoms.filter("watch_status = 'accepted'").withColumn("reasons", block_reasons())
    served = promote(chosen.filter(F.size("reasons") == 0))
    counts = atoms.groupBy(F.coalesce(F.nullif("watch_status", F.lit("")), F.lit("undecided"))
                           .alias("watch_status")).agg(F.count("*").alias("n"))
    return served, chosen.filter(F.size("reasons") > 0).select("id", "reasons"), counts


# --- labs -----------------------------------------------------------------------------------

def lab_sources() -> Column:
    """Distinct URLs in order: evidence, alternatives, status, extras."""
    alternatives = F.transform(F.coalesce("founded_alternatives", F.array().cast(
        "array<struct<date:string,url:string,quote:string>>")), lambda a: a["url"])
    urls = F.concat(F.array("founded_evidence.url"), alternatives, F.array("status_evidence.url"),
                    F.coalesce("sources_extra", F.array().cast(_STRINGS)))
    return F.array_distinct(F.filter(urls, lambda u: ~X.empty(u)))


def labs(research: DataFrame, curation: DataFrame, stats: DataFrame) -> DataFrame:
    """Labs from research rows, a curation table by name and organisation statistics.

    Refuses on names present on one side only and on rows that cite nothing.
    """
    gaps = joins.unmatched(research, curation, "name").limit(5).collect()
    if gaps:
        raise RefusedWrite(f"names on one side only: {[(r[0], r[1]) for r in gaps]}")
    taken = [c for c in curation.columns if c != "name" and c in research.columns]
    rows = research.drop(*taken).join(curation, "name").withColumn("sources", lab_sources())
    empty = rows.filter(F.size("sources") == 0).select("name").limit(5).collect()
    if empty:
        raise RefusedWrite(f"no source cited: {[r[0] for r in empty]}")
    evidence = F.col("founded_evidence")
    rows = rows.withColumns({
        "id": F.coalesce(F.nullif("id", F.lit("")), X.lab_slug(F.col("name"))) if
        "id" in rows.columns else X.lab_slug(F.col("name")),
        "aliases": F.coalesce("aliases", F.array().cast(_STRINGS)),
        "evidence_strength": E.grade(evidence["publisher"], evidence["url"],
                                     F.col("founded").isNotNull())})
    return joins.alias_totals(rows, stats, key="id", name="name", aliases="aliases",
                              stat_name="org").withColumnsRenamed(
        {"n": "epoch_frontier_models", "first": "epoch_first_frontier_model",
         "last": "epoch_last_frontier_model"})


def lab_counts(df: DataFrame) -> DataFrame:
    """(field, value, n) by basis, kind, evidence and status, undated and contested too."""
    return A.tally(df.withColumns({
        "undated": F.col("founded").isNull(), "contested": F.coalesce(
            "founded_contested", F.lit(False))}), "inclusion_basis", "lab_kind",
        "evidence_strength", "status", "undated", "contested")


# --- timeline --------------------------------------------------------------------------------

def publish_text(df: DataFrame) -> DataFrame:
    """Sorted lists, repaired and ASCII-substituted strings and list items."""
    fix = lambda c: X.ascii_publish(X.repair_mojibake(c))
    changes: dict[str, Column] = {}
    for name, kind in df.dtypes:
        if name.startswith("_") or name in ("id", "file"):
            continue
        if kind == "string":
            changes[name] = fix(F.col(name))
        elif kind == _STRINGS:
            items = F.array_sort(name) if name in ("tags", "sources") else F.col(name)
            changes[name] = F.transform(items, fix)
    return df.withColumns(changes)


def timeline(raw: DataFrame, enriched: DataFrame, precedence: Sequence[str],
             override: str = "enriched") -> DataFrame:
    """Hand-authored and research events; the enriched copy wins, provenance stays raw."""
    both = raw.unionByName(enriched.withColumn("file", F.lit(override)),
                           allowMissingColumns=True)
    return publish_text(dedup.keep_by_precedence(both, "id", "file", precedence, override))


def event_errors(df: DataFrame, schema: dict) -> DataFrame:
    """Schema violations of typed rows; columns that begin with an underscore are no fields."""
    raw = df.select("id", F.to_json(F.struct(*[
        c for c in df.columns if not c.startswith("_")])).alias("raw"))
    return schema_violations(raw, "events", "id", "raw", schema)


def revalidated(events: DataFrame, schema: dict, clean) -> DataFrame:
    """Validate, clean and validate again; nothing comes out if anything fails."""
    def check(df: DataFrame) -> None:
        bad = first_broken(event_errors(df, schema))
        if bad:
            raise RefusedWrite(f"schema: {bad}")

    check(events)
    cleaned = clean(events)
    check(cleaned)
    return cleaned


def timeline_sidecars(events: DataFrame, score_column: str) -> dict[str, DataFrame]:
    return {"manifest": collection_manifest(events), "index": light_index(events),
            "tallies": A.tally(events, "year", "category", "rarity"),
            "impact_variables": A.impact_variables(events),
            "score_distribution": A.value_distribution(events, score_column)}


# --- taxonomy, grants, quality, checks -----------------------------------------------------------

def taxonomy(here: DataFrame, elsewhere: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(terms in order, counts by status)."""
    terms = here.select("term", "status", F.lit("minted_here").alias("side")).unionByName(
        elsewhere.select("term", "status", F.lit("minted_elsewhere").alias("side")))
    return (terms.orderBy("side", "term"),
            here.groupBy("status").agg(F.count("*").alias("n")))


def grants(df: DataFrame, prefix: str, source: str, extracted_at: Column) -> DataFrame:
    """Normalised grants from (page, position, recipient, amount, date, ...) strings."""
    date = D.grant_date(F.col("date_text"))
    ident = F.concat(F.lit(prefix + "-"), F.coalesce(F.left(date, F.lit(4)), F.lit("UNKN")),
                     F.lit("-"), F.lpad(F.col("position").cast("string"),
                                        F.greatest(F.lit(3), F.length(F.col("position")
                                                                      .cast("string"))),
                                        F.lit("0")))
    return df.select(
        ident.alias("grant_id"), F.lit(source).alias("source"),
        F.col("recipient").alias("recipient_name"),
        G.recipient_type(F.col("recipient")).alias("recipient_type"),
        N.parse_amount(F.col("amount_text")).alias("amount"), F.lit("USD").alias("currency"),
        date.alias("grant_date"),
        G.grant_type(F.col("description"), F.col("focus_area")).alias("grant_type"),
        "focus_area", "description", "source_url", extracted_at.alias("extracted_at"))


def quality_report(df: DataFrame, key: str = "id",
                   text: str = "description") -> tuple[DataFrame, DataFrame]:
    return A.description_quality(df, text), A.import_families(df, key)


def run_checks(*found: DataFrame, reporting: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(violations, verdicts); rules of ``reporting`` collections never gate."""
    every = reduce(lambda a, b: a.unionByName(b), found)
    gate = ~F.col("collection").isin(list(reporting)) & (F.col("severity") == "error")
    return every, verdicts(every).withColumn("gating", gate)

