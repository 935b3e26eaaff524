"""Rules as data: violations tables, and JSON Schema compiled to expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``broken`` true is a violation; null counts as not broken."""

    name: str
    broken: Column
    detail: Column | None = None
    severity: str = "error"


def broken_rules(rules: Iterable[Rule]) -> Column:
    entries = [
        F.when(F.coalesce(r.broken, F.lit(False)), F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
            (F.lit(None) if r.detail is None else r.detail).cast("string").alias("detail")))
        for r in rules]
    return F.array_compact(F.array(*entries))


def violations(df: DataFrame, collection: str, key: Column | str,
               rules: Iterable[Rule]) -> DataFrame:
    """(collection, id, rule, severity, detail), one row per broken rule."""
    key = F.col(key) if isinstance(key, str) else key
    # explode_outer: plain explode would copy the rules into a filter in front of itself
    return (df.select(key.cast("string").alias("id"),
                      F.explode_outer(broken_rules(rules)).alias("v"))
            .filter(F.col("v").isNotNull())
            .select(F.lit(collection).alias("collection"), "id", "v.rule", "v.severity",
                    "v.detail"))


def as_violations(df: DataFrame, collection: str, key: str, rule: str,
                  severity: str = "error", detail: Column | None = None) -> DataFrame:
    """Every row of ``df`` is one violation."""
    return df.select(
        F.lit(collection).alias("collection"), F.col(key).cast("string").alias("id"),
        F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def verdicts(found: DataFrame) -> DataFrame:
    """(collection, rule, severity, n): gating rules fail on n > 0."""
    return found.groupBy("collection", "rule", "severity").agg(F.count("*").alias("n"))


# --- JSON Schema ----------------------------------------------------------------

_TYPES = {
    "string": lambda t: t == "STRING",
    "integer": lambda t: t == "BIGINT",
    "number": lambda t: (t == "BIGINT") | (t == "DOUBLE") | (t == "FLOAT")
    | t.startswith("DECIMAL"),
    "boolean": lambda t: t == "BOOLEAN",
    "array": lambda t: t.startswith("ARRAY"),
    "object": lambda t: t.startswith("OBJECT"),
    "null": lambda t: t == "VOID",
}


@dataclass(frozen=True)
class _Node:
    """A variant and what most checks ask of it, each taken once.

    ``keys`` is null of what is no object and left out where it is taken on demand; ``tops`` are the
    properties that are nodes already.
    """

    value: Column
    kind: Column
    keys: Column | None = None
    tops: dict[str, _Node] = field(default_factory=dict)


def with_schema_errors(df: DataFrame, raw: str, schema: dict, name: str = "errors") -> DataFrame:
    """Add an array of ``path: keyword`` for a column of raw JSON documents.

    Keys keep the difference between absent and null, because the checks run
    on the parsed variant and not on a typed row.  The document is parsed once; it and its top-level
    properties, their types and their keys are columns of their own, one layer after the other.
    """
    parts = {f"_top_{i}": p for i, p in enumerate(schema.get("properties", {}))}
    parsed = df.withColumn("_doc", F.try_parse_json(raw))
    parsed = parsed.withColumn("_doc_kind", F.schema_of_variant("_doc"))
    is_object = F.col("_doc_kind").startswith("OBJECT")
    first = {c: _child(F.when(is_object, F.col("_doc")), p) for c, p in parts.items()}
    if _asks_keys(schema, schema):
        first["_doc_keys"] = _keys(F.col("_doc"), F.col("_doc_kind"))
    parsed = parsed.withColumns(first) if first else parsed
    if parts:
        parsed = parsed.withColumns({f"{c}_kind": F.schema_of_variant(c) for c in parts})
    keyed = [c for c, p in parts.items() if _asks_keys(schema["properties"][p], schema)]
    if keyed:
        parsed = parsed.withColumns({f"{c}_keys": _keys(F.col(c), F.col(f"{c}_kind")) for c in keyed})
    tops = {p: _Node(F.col(c), F.col(f"{c}_kind"), F.col(f"{c}_keys") if c in keyed else None)
            for c, p in parts.items()}
    doc = _Node(F.col("_doc"), F.col("_doc_kind"), F.col("_doc_keys") if "_doc_keys" in first else None, tops)
    errors = F.when(F.col("_doc").isNull(), F.array(F.lit("$: does not parse"))).otherwise(
        _errors(schema, doc, "$", schema))
    return parsed.withColumn(name, errors).drop(
        "_doc", "_doc_kind", *first, *[f"{c}_kind" for c in parts], *[f"{c}_keys" for c in keyed])


def _resolved(schema: dict, root: dict) -> dict:
    while "$ref" in schema:
        target = root
        for step in schema["$ref"].lstrip("#/").split("/"):
            target = target[step]
        schema = target
    return schema


def _same_node(schema: dict) -> list[dict]:
    """The parts of a schema that judge the node itself."""
    return [part for keyword in ("oneOf", "anyOf", "allOf") for part in schema.get(keyword, [])] + [
        schema[keyword] for keyword in ("not", "if", "then", "else") if keyword in schema]


def _asks_keys(schema: dict, root: dict) -> bool:
    schema = _resolved(schema, root)
    return (bool(schema.get("required")) or "minProperties" in schema
            or (schema.get("additionalProperties") is False and not schema.get("patternProperties"))
            or any(_asks_keys(part, root) for part in _same_node(schema)))


def _keys(value: Column, kind: Column) -> Column:
    return F.map_keys(F.when(kind.startswith("OBJECT"), F.try_variant_get(value, "$", "map<string,variant>")))


def _errors_of_all(values: Column, schema: dict, path: str, root: dict) -> Column:
    """The errors of every variant of an array; the type and the keys of each are taken once."""
    asks = _asks_keys(schema, root)
    kinds = F.transform(values, lambda v: F.struct(v.alias("v"), F.schema_of_variant(v).alias("k")))
    if asks:
        kinds = F.transform(kinds, lambda n: F.struct(
            n["v"].alias("v"), n["k"].alias("k"), _keys(n["v"], n["k"]).alias("keys")))
    return F.flatten(F.transform(kinds, lambda n: _errors(
        schema, _Node(n["v"], n["k"], n["keys"] if asks else None), path, root)))


def _child(node: Column, name: str) -> Column:
    return F.try_variant_get(node, f"$['{name}']", "variant")


def _none() -> Column:
    return F.array().cast("array<string>")


def _flag(broken: Column, message: str) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.array(F.lit(message))).otherwise(_none())


def _java(pattern: str) -> str:
    return re.sub(r"\$$", r"\\n?\\z", pattern)


def _errors(schema: dict, node: _Node, path: str, root: dict) -> Column:
    """Errors of a present variant."""
    schema = _resolved(schema, root)
    value, kind = node.value, node.kind
    keys = _keys(value, kind) if node.keys is None else node.keys
    is_text, is_list = kind == "STRING", kind.startswith("ARRAY")
    is_number = _TYPES["number"](kind)
    text = F.when(is_text, F.try_variant_get(value, "$", "string"))
    number = F.when(is_number, F.try_variant_get(value, "$", "double"))
    items = F.when(is_list, F.try_variant_get(value, "$", "array<variant>"))
    found: list[Column] = []

    def flag(broken: Column, keyword: str) -> None:
        found.append(_flag(broken, f"{path}: {keyword}"))

    if "type" in schema:
        wanted = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        ok = F.lit(False)
        for name in wanted:
            ok = ok | _TYPES[name](kind)
        flag(~ok, "type")
    if "enum" in schema:
        flag(~_is_one_of(value, is_text, text, schema["enum"]), "enum")
    if "const" in schema:
        flag(~_is_one_of(value, is_text, text, [schema["const"]]), "const")
    if "pattern" in schema:
        flag(~text.rlike(_java(schema["pattern"])), "pattern")
    for keyword, broken in (("minLength", lambda n: F.length(text) < n),
                            ("maxLength", lambda n: F.length(text) > n),
                            ("minimum", lambda n: number < n),
                            ("maximum", lambda n: number > n),
                            ("minItems", lambda n: F.size(items) < n),
                            ("maxItems", lambda n: F.size(items) > n),
                            ("minProperties", lambda n: F.size(keys) < n)):
        if keyword in schema:
            flag(broken(F.lit(schema[keyword])), keyword)
    if schema.get("uniqueItems"):
        texts = F.transform(items, lambda v: F.to_json(v))
        flag(F.size(F.array_distinct(texts)) < F.size(texts), "uniqueItems")
    if isinstance(schema.get("items"), dict):
        found.append(F.coalesce(F.array_distinct(
            _errors_of_all(items, schema["items"], path + "[]", root)), _none()))
    found += _object_errors(schema, node, keys, path, root)
    for keyword in ("oneOf", "anyOf"):
        if keyword in schema:
            hits = [F.when(F.size(_errors(s, node, path, root)) == 0, 1).otherwise(0)
                    for s in schema[keyword]]
            n = hits[0]
            for h in hits[1:]:
                n = n + h
            flag((n != 1) if keyword == "oneOf" else (n == 0), keyword)
    for part in schema.get("allOf", []):
        found.append(_errors(part, node, path, root))
    if "not" in schema:
        flag(F.size(_errors(schema["not"], node, path, root)) == 0, "not")
    if "if" in schema:
        holds = F.size(_errors(schema["if"], node, path, root)) == 0
        found.append(F.when(holds, _errors(schema.get("then", {}), node, path, root))
                     .otherwise(_errors(schema.get("else", {}), node, path, root)))
    return F.concat(*found) if found else _none()


def _object_errors(schema: dict, node: _Node, keys: Column, path: str, root: dict) -> list[Column]:
    found = [_flag(~F.array_contains(keys, name), f"{path}.{name}: required")
             for name in schema.get("required", [])]
    members = F.when(node.kind.startswith("OBJECT"), node.value)
    known = schema.get("properties", {})
    patterns = schema.get("patternProperties", {})
    for name, part in known.items():
        if not part:
            continue
        if name in node.tops:
            child = node.tops[name]
            found.append(F.when(child.value.isNotNull(), _errors(part, child, f"{path}.{name}", root))
                         .otherwise(_none()))
        else:
            found.append(_errors_of_all(F.array_compact(F.array(_child(members, name))), part,
                                        f"{path}.{name}", root))
    extra = schema.get("additionalProperties", True)
    if extra is False and not patterns:
        others = F.array_except(keys, F.array(*[F.lit(k) for k in known]))
        found.append(_flag(F.size(others) > 0, f"{path}: additionalProperties"))
    elif (extra is not True) or patterns:
        entries = F.map_entries(members.cast("map<string,variant>"))
        rest = F.filter(entries, lambda e: ~e["key"].isin(list(known)) if known else F.lit(True))
        for pattern, part in patterns.items():
            if part:
                found.append(_entry_errors(_with_keys(rest, pattern, True), part, path, root))
            rest = _with_keys(rest, pattern, False)
        if extra is False:
            found.append(_flag(F.size(rest) > 0, f"{path}: additionalProperties"))
        elif isinstance(extra, dict):
            found.append(_entry_errors(rest, extra, path, root))
    return found


def _with_keys(entries: Column, pattern: str, wanted: bool) -> Column:
    return F.filter(entries, lambda e: e["key"].rlike(_java(pattern)) == F.lit(wanted))


def _entry_errors(entries: Column, schema: dict, path: str, root: dict) -> Column:
    return F.coalesce(F.array_distinct(_errors_of_all(
        F.transform(entries, lambda e: e["value"]), schema, path + ".*", root)), _none())


def _is_one_of(value: Column, is_text: Column, text: Column, allowed: Iterable) -> Column:
    """Is the variant one of ``allowed``?  Texts are compared as they are, only the rest as JSON."""
    texts = [v for v in allowed if isinstance(v, str)]
    rest = [_json(v) for v in allowed if not isinstance(v, str)]
    found = is_text & text.isin(texts) if texts else F.lit(False)
    return found | (~is_text & F.to_json(value).isin(rest)) if rest else found


def _json(value) -> str:
    import json
    return json.dumps(value, ensure_ascii=False)


def schema_violations(df: DataFrame, collection: str, key: str, raw: str,
                      schema: dict) -> DataFrame:
    """One violation per failed keyword and path."""
    checked = with_schema_errors(df, raw, schema)
    return (checked.select(F.col(key).cast("string").alias("id"),
                           F.explode_outer("errors").alias("rule"))
            .filter(F.col("rule").isNotNull())
            .select(F.lit(collection).alias("collection"), "id", "rule",
                    F.lit("error").alias("severity"), F.lit(None).cast("string").alias("detail")))
