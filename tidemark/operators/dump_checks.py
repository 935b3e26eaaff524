"""Validation of dumps of raw JSON records: schema, record rules, repeats, and the dump's own counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import text as X
from tidemark.operators.joins import lookup_join, null_safe_join
from tidemark.operators.json_leaves import KEY, string_leaves
from tidemark.operators.rules import Rule, broken_rules, with_schema_errors
from tidemark.workspace import durable


def _record_rules(sources: Sequence[str], required: Sequence[str]) -> list[Rule]:
    date, url, source = F.col("date_published"), F.col("url"), F.col("source")
    return [
        *(Rule(f"missing {c}", X.empty(F.col(c))) for c in required),
        Rule("date shape", ~X.empty(date) & ~date.rlike(r"(?s)^.{4}-.{2}-.{2}"), date),
        Rule("url scheme", ~X.empty(url) & ~url.rlike("^https?://"), url),
        Rule("unknown source", ~X.empty(source) & ~source.isin(list(sources)), source)]


def _repeats(rows: DataFrame) -> DataFrame:
    """Every line after the first of its id.  Ids that occur once leave before the join."""
    named = rows.filter(~X.empty(F.col("id"))).select("dump", "id", "line_no")
    firsts = (named.groupBy("dump", "id").agg(F.min("line_no").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select("dump", "id", "first"))
    return (lookup_join(named, durable(firsts, "repeated-ids"), ["dump", "id"], unique=["line_no"])
            .filter("line_no > first"))


def research_lines(lines: DataFrame, schema: dict, sources: Sequence[str],
                   required: Sequence[str] = K.RESEARCH_REQUIRED) -> DataFrame:
    """(dump, line_no, id, rule, severity, detail) of ``lines`` (dump, line_no, raw).

    A line that does not parse has that one violation.  The schema step names each failed keyword by
    its path; characters outside ASCII are found in strings of any depth, one violation a string.
    """
    fields = [*dict.fromkeys([*required, "id", "source", "url", "date_published"])]
    checked = with_schema_errors(lines, "raw", schema, "schema_errors")
    failed = F.array_contains("schema_errors", "$: does not parse")
    rows = durable(checked.withColumns({
        **{c: F.when(~failed, F.get_json_object("raw", f"$.{c}")) for c in fields},
        "unread": F.coalesce(failed, F.lit(True))}), "research-lines")
    broken = F.when(F.col("unread"), F.array(F.struct(
        F.lit("does not parse as JSON").alias("rule"), F.lit("error").alias("severity"),
        F.lit(None).cast("string").alias("detail")))).otherwise(F.concat(
            F.transform("schema_errors", lambda e: F.struct(
                F.lit("schema").alias("rule"), F.lit("error").alias("severity"), e.alias("detail"))),
            broken_rules(_record_rules(sources, required))))
    place = ["dump", "line_no", "id"]
    own = (rows.select(*place, F.explode_outer(broken).alias("v")).filter(F.col("v").isNotNull())
           .select(*place, "v.rule", "v.severity", "v.detail"))
    error = F.lit("error").alias("severity")
    repeats = _repeats(rows).select(*place, F.lit("duplicate id").alias("rule"), error,
                                    F.lit(None).cast("string").alias("detail"))
    leaves = string_leaves(rows.filter("not unread"), "raw", place)
    foreign = (leaves.filter(~F.col("path").endswith(KEY) & X.has_non_ascii(F.col("leaf")))
               .select(*place, F.lit("non-ascii").alias("rule"), error, F.col("path").alias("detail")))
    return own.unionByName(repeats).unionByName(foreign)


def reconciled(lines: DataFrame, found: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row per dump: what was observed, what its metadata says, and the rules that breaks.

    ``found`` is the table of :func:`research_lines`; ``metadata`` (dump, raw) one JSON text a dump.
    Counts come from one aggregate over the lines and one over their violations.
    """
    def lines_with(*rules: str):
        return F.count_distinct(F.when(F.col("rule").isin(*rules), F.col("line_no")))

    missing = F.col("rule").startswith("missing ")
    totals = lines.groupBy("dump").agg(F.count("*").alias("total"))
    faults = found.groupBy("dump").agg(
        F.count_distinct("line_no").alias("invalid"), lines_with("schema").alias("schema_errors"),
        F.count_if(missing).alias("missing_fields"), lines_with("duplicate id").alias("duplicate_ids"),
        lines_with("non-ascii").alias("ascii_errors"))
    counts = ["invalid", "schema_errors", "missing_fields", "duplicate_ids", "ascii_errors"]
    seen = null_safe_join(totals, faults, ["dump"], "left").fillna(0, counts)
    read = F.try_parse_json("raw")
    absent = F.array_compact(F.array(*[F.when(
        F.try_variant_get(read, f"$.{f}", "variant").isNull(), F.lit(f"missing metadata field {f}"))
        for f in K.RESEARCH_METADATA]))
    said = metadata.select("dump", F.try_variant_get(read, "$.record_count", "long").alias("expected"),
                           F.coalesce(absent, F.array(F.lit("no metadata"))).alias("absent"))
    both = (null_safe_join(seen, said.withColumn("known", F.lit(True)), ["dump"], "left")
            .unionByName(said.join(seen.select("dump"), "dump", "left_anti")
                         .select("dump", *[F.lit(0).cast("long").alias(c) for c in ["total", *counts]],
                                 "expected", "absent", F.lit(True).alias("known"))))
    rules = F.concat(
        F.when(F.col("known").isNull(), F.array(F.lit("no metadata"))).otherwise(F.col("absent")),
        F.when(F.coalesce(F.col("expected") != F.col("total"), F.lit(False)),
               F.array(F.lit("record count mismatch"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("total") == 0, F.array(F.lit("no data"))).otherwise(
            F.array().cast("array<string>")))
    return both.select("dump", "total", (F.col("total") - F.col("invalid")).alias("valid"), *counts,
                       "expected", F.array_join(rules, "; ").alias("problems"))


def all_valid(stats: DataFrame) -> bool:
    """No record of any dump breaks a rule and no metadata is missing; a wrong count only warns."""
    bad = reduce(lambda a, b: a | b, [F.col("invalid") > 0, F.col("problems").contains("no "),
                                      F.col("problems").contains("missing metadata")])
    return stats.filter(bad).isEmpty()
