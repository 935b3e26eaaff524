"""The maturity ladder: predicates as data, measured over the records of all collections at once."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import text as X
from tidemark.operators.rules import with_schema_errors


@dataclass(frozen=True)
class Predicate:
    """One step of the ladder: ``kind`` names how it is measured, ``fields`` what it looks at."""

    rung: str
    name: str
    kind: str
    fields: tuple[str, ...] = ()


LADDER = (
    Predicate("wood", "exists", "parses"),
    Predicate("bronze", "has schema", "schema"),
    Predicate("bronze", "validates", "validates"),
    Predicate("bronze", "every record sourced", "any of", ("sources", "source_urls")),
    Predicate("silver", "lineage names inputs", "lineage", ("inputs", "projected_from")),
    Predicate("gold", "schema versioned", "schema version"),
    Predicate("gold", "dates carry evidence", "evidence", K.DATED_FIELDS),
    Predicate("gold", "no bare opinion", "none of", K.BARE_OPINIONS),
    Predicate("iridium", "declared cadence", "lineage", ("cadence",)),
    Predicate("iridium", "self reports", "lineage", ("maturity",)),
)


def _filled(raw: Column, field: str) -> Column:
    """The field is there and not null, false, zero or empty."""
    value = F.get_json_object(raw, f"$.{field}")
    return value.isNotNull() & ~value.isin("", "[]", "{}", "null", "false", "0")


def _any_of(raw: Column, fields: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_filled(raw, f) for f in fields])


def _measures(p: Predicate, i: int) -> dict[str, Column]:
    """The aggregates over a collection's records that a predicate needs."""
    raw, keys = F.col("raw"), F.col("_names")
    name = f"m{i}"
    if p.kind == "parses":
        return {name: F.count_if(keys.isNull())}
    if p.kind == "validates":
        return {name: F.count_if(F.size("_errors") > 0)}
    if p.kind == "any of":
        return {name: F.count_if(~F.coalesce(_any_of(raw, p.fields), F.lit(False)))}
    if p.kind == "none of":
        names = F.array(*map(F.lit, p.fields))
        return {name: F.array_sort(F.array_distinct(F.flatten(F.collect_set(
            F.array_intersect(F.coalesce(keys, F.array().cast("array<string>")), names)))))}
    if p.kind == "evidence":
        dated = F.array_intersect(keys, F.array(*map(F.lit, p.fields)))
        proven = F.coalesce(F.json_object_keys(F.get_json_object(raw, "$._provenance")),
                            F.array().cast("array<string>"))
        founded = _filled(raw, "founded")
        quote = F.when(_filled(raw, "founded_evidence"), _filled(raw, "founded_evidence.quote")).otherwise(
            _filled(raw, "evidence.quote"))
        return {f"{name}_founded": F.count_if(founded), f"{name}_dated": F.count_if(F.size(dated) > 0),
                f"{name}_unquoted": F.count_if(founded & ~quote),
                f"{name}_unproven": F.count_if(F.size(F.array_except(dated, proven)) > 0)}
    return {}


def _verdict(p: Predicate, i: int) -> tuple[Column, Column]:
    """(passed, detail) from a collection's row of aggregates, its configuration and its lineage."""
    own, n = F.col(f"m{i}") if p.kind in ("parses", "validates", "any of", "none of") else None, F.col("n")
    of = lambda count, text: F.concat(count.cast("string"), F.lit(f" of "), n.cast("string"),
                                      F.lit(f" {text}"))
    if p.kind == "parses":
        return (n > 0) & (own == 0), F.when(n == 0, "no records").otherwise(of(own, "do not parse"))
    if p.kind == "schema":
        return F.col("has_schema"), F.lit("no schema declared")
    if p.kind == "schema version":
        return F.col("version").isNotNull(), F.lit("the schema declares no version")
    if p.kind == "validates":
        return F.col("has_schema") & (own == 0), of(own, "fail the schema")
    if p.kind == "any of":
        return own == 0, of(own, "have none of " + ", ".join(p.fields))
    if p.kind == "none of":
        return F.size(own) == 0, F.array_join(own, ", ")
    if p.kind == "lineage":
        return _any_of(F.col("lineage"), p.fields), F.lit("lineage without " + " or ".join(p.fields))
    founded, dated, unquoted, unproven = (F.col(f"m{i}_{x}") for x in (
        "founded", "dated", "unquoted", "unproven"))
    return (F.when(founded > 0, unquoted == 0).otherwise((dated > 0) & (unproven == 0)),
            F.when(founded > 0, of(unquoted, "founded without a quote")).when(
                dated == 0, "no dates to check").otherwise(of(unproven, "dated without provenance")))


def measured(records: DataFrame, schemas: Mapping[str, dict | None], lineage: DataFrame,
             ladder: Sequence[Predicate] = LADDER) -> DataFrame:
    """(collection, predicate, ok, detail) of every collection of ``schemas`` and every predicate.

    ``records`` (collection, raw) are one JSON document each, ``lineage`` (collection, raw) one document
    a collection, ``schemas`` the collections with their JSON Schemas, or None.  The records of all
    collections are read once, by one conditional aggregate; what cannot be measured has not passed.
    """
    rows = records.withColumn("_names", F.json_object_keys("raw"))
    none = F.array().cast("array<string>")
    errors = none
    alike: dict[str, list[str]] = {}
    for name, schema in schemas.items():
        if schema is not None:
            alike.setdefault(json.dumps(schema), []).append(name)
    for i, (text, names) in enumerate(alike.items()):
        mine = F.col("collection").isin(names)
        rows = with_schema_errors(rows.withColumn("_own", F.when(mine, F.col("raw"))), "_own",
                                  json.loads(text), f"_e{i}").drop("_own")
        errors = F.when(mine, F.col(f"_e{i}")).otherwise(errors)
    wanted = {k: v for i, p in enumerate(ladder) for k, v in _measures(p, i).items()}
    counted = rows.withColumn("_errors", errors).groupBy("collection").agg(
        F.count("*").alias("n"), *[c.alias(k) for k, c in wanted.items()])
    # one row a collection from here on
    config = records.sparkSession.createDataFrame(
        [(n, s is not None, str(s["version"]) if s and s.get("version") else None)
         for n, s in schemas.items()], "collection string, has_schema boolean, version string")
    facts = (config.join(counted, "collection", "left").fillna(0, ["n"])
             .join(lineage.select("collection", F.col("raw").alias("lineage")), "collection", "left"))
    verdicts = []
    for i, p in enumerate(ladder):
        ok, detail = _verdict(p, i)
        ok = F.coalesce(ok, F.lit(False))
        verdicts.append(F.struct(F.lit(p.name).alias("predicate"), ok.alias("ok"),
                                 F.when(~ok, detail).alias("detail")))
    return (facts.select("collection", F.explode(F.array(*verdicts)).alias("v"))
            .select("collection", "v.predicate", "v.ok", "v.detail"))


def assess(passed: DataFrame, ladder: Sequence[Predicate] = LADDER) -> DataFrame:
    """(collection, rung, next_rung, next_task) from (collection, predicate, ok).

    The rung is the last one fully passed; the first failure in ladder order
    is the next task.  A predicate without a row has not passed.
    """
    place, rungs = F, [*dict.fromkeys(p.rung for p in ladder)]
    for i, p in enumerate(ladder):
        place = place.when(F.col("predicate") == p.name, F.lit(i))
    per = (passed.withColumn("_i", place).filter("_i is not null").groupBy("collection")
           .agg(F.array_sort(F.collect_set(F.when(F.col("ok"), F.col("_i")))).alias("_ok")))
    order = F.array(*[F.lit(i) for i in range(len(ladder))])
    failing = F.array_min(F.array_except(order, F.col("_ok")))
    below = [rungs[rungs.index(p.rung) - 1] if rungs.index(p.rung) else "below wood" for p in ladder]
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("_f"))
    return per.withColumn("_f", failing).select(
        "collection", F.coalesce(pick(below), F.lit(rungs[-1])).alias("rung"),
        pick([p.rung for p in ladder]).alias("next_rung"), pick([p.name for p in ladder]).alias("next_task"))
