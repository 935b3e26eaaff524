"""Rules must be able to fire and to stay quiet; schema defects one at a time."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators import dump_checks, json_leaves, maturity, similarity
from tidemark.operators import quality as Q
from tidemark.sources import fragments as FR
from tidemark.operators.rules import Rule, schema_violations
from tidemark.plans import checks
from tidemark.plans import collections as PL
from tidemark.sinks import publish
from tidemark.sinks.publish import RefusedWrite

SCHEMA = {
    "type": "object", "additionalProperties": False,
    "required": ["id", "kind", "published_at", "license"],
    "definitions": {"day": {"oneOf": [{"type": "null"}, {
        "type": "string", "pattern": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}]}},
    "properties": {
        "id": {"type": "string", "pattern": "^[a-z]+:[a-z0-9]+$"},
        "kind": {"enum": ["post", "model"]}, "published_at": {"$ref": "#/definitions/day"},
        "score": {"type": "number", "minimum": 0, "maximum": 1},
        "urls": {"type": "array", "uniqueItems": True, "maxItems": 2,
                 "items": {"type": "string", "minLength": 8}},
        "license": {"type": "object", "required": ["spdx"], "additionalProperties": False,
                    "properties": {"spdx": {"type": "string", "not": {"pattern": "-SA"}}}},
        "by": {"type": "object", "minProperties": 1, "additionalProperties": False,
               "patternProperties": {"^[a-z]+_v[0-9]+$": {"type": "number"}}},
        "signals": {"type": "object", "additionalProperties": {"type": "array", "items": {
            "type": "object", "required": ["observed_at"]}}},
        "flag": {"type": "boolean"}},
    "if": {"properties": {"kind": {"const": "model"}}}, "then": {"required": ["score"]},
}
GOOD = {"id": "a:b1", "kind": "post", "published_at": None, "urls": ["https://a", "https://b"],
        "license": {"spdx": "MIT"}, "by": {"default_v1": 0.5}, "score": 1, "flag": True,
        "signals": {"karma": [{"observed_at": "2026", "value": 3}]}}
DEFECTS = [
    ({"id": "A:b"}, "$.id: pattern"), ({"id": 5}, "$.id: type"), ({"kind": "other"}, "$.kind: enum"),
    ({"published_at": "2026"}, "$.published_at: oneOf"), ({"score": 1.5}, "$.score: maximum"),
    ({"score": -0.1}, "$.score: minimum"), ({"score": "1"}, "$.score: type"),
    ({"urls": ["https://a", "https://a"]}, "$.urls: uniqueItems"),
    ({"urls": ["https://a", "https://b", "https://c"]}, "$.urls: maxItems"),
    ({"urls": ["x"]}, "$.urls[]: minLength"), ({"license": {}}, "$.license.spdx: required"),
    ({"license": {"spdx": "CC-BY-SA"}}, "$.license.spdx: not"),
    ({"license": {"spdx": "MIT", "x": 1}}, "$.license: additionalProperties"),
    ({"by": {}}, "$.by: minProperties"), ({"by": {"Bad": 1}}, "$.by: additionalProperties"),
    ({"by": {"a_v1": "x"}}, "$.by.*: type"), ({"extra": 1}, "$: additionalProperties"),
    ({"signals": {"k": [{}]}}, "$.signals.*[].observed_at: required"), ({"flag": "yes"}, "$.flag: type"),
    ({"flag": None}, "$.flag: type")]


def test_schema_rejects_each_defect_and_nothing_else(spark):
    cases = [("good", json.dumps(GOOD), None), ("broken", "{", "$: does not parse")]
    for i, (change, rule) in enumerate(DEFECTS):
        cases.append((f"d{i}", json.dumps({**copy.deepcopy(GOOD), **change}), rule))
    for key in SCHEMA["required"]:
        cases.append((f"no {key}", json.dumps({k: v for k, v in GOOD.items() if k != key}),
                      f"$.{key}: required"))
    bare = {k: v for k, v in GOOD.items() if k != "score"}
    cases.append(("model", json.dumps({**bare, "kind": "model"}), "$.score: required"))
    cases.append(("post", json.dumps(bare), None))
    df = spark.createDataFrame([c[:2] for c in cases], "id string, raw string")
    got = {}
    for r in schema_violations(df, "x", "id", "raw", SCHEMA).collect():
        got.setdefault(r["id"], set()).add(r["rule"])
    assert got == {name: {rule} for name, _, rule in cases if rule}


def test_schema_checks_write_no_json_and_take_each_type_once(spark):
    schema = {"required": ["kind"], "properties": {
        "kind": {"enum": ["a", "\u00e9\n", 3, None]}, "who": {},
        "parts": {"type": "array", "items": {
            "type": "object", "required": ["n"], "properties": {"n": {"type": "number", "minimum": 1}}}}},
        "if": {"properties": {"kind": {"const": "a"}}},
        "then": {"properties": {"who": {"required": ["name"], "minProperties": 2}}}}
    cases = {'{"kind": "a"}': set(), '{"kind": "b"}': {"$.kind: enum"}, '{"kind": "\u00e9\\n"}': set(),
             '{"kind": 3, "who": {}}': set(), '{"kind": null}': set(), '{"kind": "3"}': {"$.kind: enum"},
             '{"kind": 4}': {"$.kind: enum"}, '{"kind": "null"}': {"$.kind: enum"}, "{}": {"$.kind: required"},
             '{"kind": "a", "who": {}}': {"$.who.name: required", "$.who: minProperties"},
             '{"kind": "a", "who": {"name": null, "x": 1}}': set(), '{"kind": "a", "who": 5}': set(),
             '{"kind": "a", "parts": [{"n": 0}, {"n": "x"}, {}, 7]}': {
                 "$.parts[].n: minimum", "$.parts[].n: type", "$.parts[].n: required", "$.parts[]: type"}}
    df = spark.createDataFrame([(k, k) for k in cases], "id string, raw string")
    got = {k: set() for k in cases}
    for r in schema_violations(df, "x", "id", "raw", schema).collect():
        got[r["id"]].add(r["rule"])
    assert got == cases
    texts = {**schema, "properties": {**schema["properties"], "kind": {"enum": ["a", "b"]}}}
    plan = schema_violations(df, "x", "id", "raw", texts)._jdf.queryExecution().optimizedPlan().toString()
    assert "StructsToJson" not in plan and "to_json" not in plan
    assert plan.count("schemaOfVariant") + plan.count("schema_of_variant") <= 7


def test_a_refusal_names_the_first_broken_rows_in_order(spark, tmp_path):
    rows = spark.range(9, -1, -1, 5).selectExpr("concat('e', id) AS id", "'bad' AS title")
    schema = {"properties": {"title": {"minLength": 5}}}
    with pytest.raises(RefusedWrite) as refused:
        publish.publish_version(rows, str(tmp_path / "p"), lambda d: PL.event_errors(d, schema), lambda d: d)
    assert str([(f"e{i}", "$.title: minLength") for i in range(5)]) in str(refused.value)


def test_pairs_of_alike_titles_are_not_shuffled(spark):
    members = spark.createDataFrame([(f"m{i}", "AABBC"[i]) for i in range(5)], "id string, set_id string")
    edges = spark.createDataFrame([("A", "B", 0.6)], "left_set string, right_set string, overlap double")
    named = [("m0", "m1"), ("m0", "m3"), ("m0", "m4"), ("m4", "m9")]
    cited = spark.createDataFrame(named + [(b, a) for a, b in named], "id string, other string")
    pairs = similarity.possible_duplicates(members, edges, cited, "id")
    near = {(f"m{a}", f"m{b}") for a in range(4) for b in range(4) if a != b}
    apart = {("m0", "m4"), ("m4", "m0"), ("m4", "m9"), ("m9", "m4")}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == near | apart
    top = pairs._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert top.startswith("Union")


def test_keys_of_a_scan_record_are_taken_once(spark):
    record = {"slug": "a_b", "title": "T", "date": None, "date_kind": "action", "description": "d" * 40,
              "sources": ["https://x"], "why_it_matters": "w", "confidence": "high", "flags": []}
    kind = ("scan_id string, slug string, title string, date string, date_kind string, description string, "
            "sources array<string>, why_it_matters string, confidence string, flags array<string>, "
            "primary_source_retrieved boolean, raw string")
    row = lambda raw: ("s", *[record[c] for c in (
        "slug", "title", "date", "date_kind", "description", "sources", "why_it_matters", "confidence",
        "flags")], False, raw)
    bare = {k: v for k, v in record.items() if k != "date"}
    df = spark.createDataFrame([row(json.dumps(record)), row(json.dumps(bare)), row("{"), row(None)], kind)
    found = Q.scan_records(df)
    assert [r["rule"] for r in found.collect()] == ["missing date"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("jsonObjectKeys") == 1


def lab(**change):
    base = dict(id="l", founded="2019-11", founded_precision="month",
                founded_evidence=("Companies House", "https://e", "since November 2019", None),
                founded_alternatives=[], status_date=None, status_evidence=None,
                evidence_strength="registry", sources=["https://e"],
                epoch_first_frontier_model=None)
    return {**base, **change}


LAB = ("id string, founded string, founded_precision string, founded_evidence struct<"
       "publisher:string,url:string,quote:string,date_in_quote:boolean>, founded_alternatives "
       "array<struct<date:string,url:string,quote:string>>, status_date string, status_evidence "
       "struct<publisher:string,url:string,quote:string,date_in_quote:boolean>, "
       "evidence_strength string, sources array<string>, epoch_first_frontier_model string")
EV = ("Companies House", "https://e", "in 2018", None)


@pytest.mark.parametrize("change,rule", [
    ({}, None), ({"founded_evidence": None}, "dated without evidence"),
    ({"founded_evidence": EV}, "quote lacks date"),
    ({"founded_evidence": (*EV[:3], False)}, None),
    ({"evidence_strength": "press"}, "grade differs"), ({"sources": []}, "cited url not in sources"),
    ({"founded": None, "founded_precision": "year", "evidence_strength": "none"},
     "undated with precision"),
    ({"founded": None, "founded_precision": None}, "undated with grade"),
    ({"status_date": "2020-05", "status_evidence": ("p", "https://e", "in 2020", None)},
     "status quote lacks date"),
    ({"founded_alternatives": [("2018", "https://e", "in 2017")]}, "alternative quote lacks date")])
def test_lab_evidence(spark, change, rule):
    row = lab(**change)
    df = spark.createDataFrame([tuple(row.values())], LAB)
    assert [r["rule"] for r in Q.lab_evidence(df).collect()] == ([rule] if rule else [])


@pytest.mark.parametrize("change,rule", [
    ({}, None), ({"founded": "1850"}, "founded year out of range"),
    ({"epoch_first_frontier_model": "2019-10-30"}, "model before founding"),
    ({"founded": "2019", "epoch_first_frontier_model": "2019-01-30"}, None),
    ({"status_date": "2018"}, "status before founding")])
def test_lab_sanity(spark, change, rule):
    df = spark.createDataFrame([tuple(lab(**change).values())], LAB)
    assert [r["rule"] for r in Q.lab_sanity(df).collect()] == ([rule] if rule else [])


def test_maturity_stops_at_the_first_failure(spark):
    names = [p.name for p in maturity.LADDER]
    rows = [("all", n, True) for n in names]
    rows += [("gap", n, n != "validates") for n in names]
    rows += [("unknown", "exists", True), ("none", "exists", False)]
    got = {r["collection"]: (r["rung"], r["next_task"]) for r in
           maturity.assess(spark.createDataFrame(rows, "collection string, predicate string, ok boolean"))
           .collect()}
    assert got == {"all": ("iridium", None), "gap": ("wood", "validates"),
                   "unknown": ("wood", "has schema"), "none": ("below wood", "exists")}


def test_mojibake_in_free_json(spark):
    df = spark.createDataFrame([("a", '{"x": [{"y": "Ã©"}]}'), ("b", '{"Ã©": 1}'),
                                ("c", '{"x": "é"}')], "id string, raw string")
    assert sorted(r["id"] for r in Q.mojibake_leaves(df, "c", "id", "raw").collect()) == ["a", "b"]


def test_watch_list(spark):
    schema = ("file string, pos int, scan_id string, slug string, title string, date string, "
              "date_kind string, description string, sources array<string>, why_it_matters string, "
              "confidence string, flags array<string>, primary_source_retrieved boolean")
    row = lambda f, p, slug, title, src, flags=(): (
        f, p, "scan_" + f, slug, title, "2026-01-01", "action", "d", src, "w", "high",
        list(flags), True)
    records = spark.createDataFrame([
        row("a", 0, "one_two_three", "Lab opens large centre", ["u1", "u2"]),
        row("b", 0, "one_two_three", "Other title", ["u3", "u1"], ["see four_five_six"]),
        row("b", 1, "four_five_six", "Completely different words", ["u4"]),
        row("b", 2, "seven_eight_nine", "Lab opens large office", [])], schema)
    prior_schema = ("id string, watch_status string, watching_since string, decided_on string, "
                    "decided_by string, decision_note string, rating string, "
                    "cleared_for array<string>, note string")
    prior = spark.createDataFrame([("one_two_three", "watching", "2026-01-02", None, None, None,
                                    "A", None, None)], prior_schema)
    got = {r["id"]: r for r in PL.watch_list(records, prior, expand=True).collect()}
    first = got["one_two_three"]
    assert first["title"] == "Lab opens large centre" and first["sources"] == ["u1", "u2", "u3"]
    assert first["scans"] == ["scan_a", "scan_b"] and first["watch_status"] == "watching"
    assert first["possible_duplicate_of"] == ["four_five_six", "seven_eight_nine"]
    assert got["four_five_six"]["possible_duplicate_of"] == ["one_two_three"]
    lost = prior.withColumn("id", F.lit("gone"))
    with pytest.raises(RefusedWrite):
        PL.watch_list(records, lost, expand=True)


def test_revalidation_is_all_or_nothing(spark):
    from tidemark.plans.research import clean_event_fields
    schema = {"properties": {"title": {"minLength": 3}}}
    df = spark.createDataFrame([("a", " abc ", ["u"], ["T"])],
                               "id string, title string, sources array<string>, tags array<string>")
    assert PL.revalidated(df, schema, clean_event_fields).first()["tags"] == ["t"]
    with pytest.raises(RefusedWrite):
        PL.revalidated(df.withColumn("title", F.lit("  a ")), schema, clean_event_fields)


# --- leaves of free JSON -------------------------------------------------------------------

def walk(node, path=""):
    """Strings and keys of a parsed document with their paths."""
    if isinstance(node, str):
        yield path, node
    elif isinstance(node, dict):
        for key, value in node.items():
            yield path + "/<key>", key
            yield from walk(value, f"{path}/{key}")
    elif isinstance(node, list):
        for i, value in enumerate(node):
            yield from walk(value, f"{path}[{i}]")


def test_string_leaves_equal_a_walk(spark):
    import json
    import random
    rng = random.Random(6)

    def grow(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind == 0:
            return rng.choice(["", "caf\u00c3\u00a9", "x", "\u2028", "a\"b"])
        if kind in (1, 2):
            return rng.choice([None, 3, True, 1.5])
        if kind == 3:
            return [grow(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["k", "caf\u00c3\u00a9", "", "a/b", "$", "'"]) + str(i): grow(depth - 1)
                for i in range(rng.randrange(4))}

    docs = [grow(6) for _ in range(60)]
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)]
                               + [(900, "{bad"), (901, None)], "id int, raw string")
    got = sorted(map(tuple, json_leaves.string_leaves(df, "raw", ["id"]).collect()), key=str)
    want = [(i, *leaf) for i, d in enumerate(docs) for leaf in walk(d)]
    assert got == sorted([*want, (900, None, None), (901, None, None)], key=str)


def test_member_names_longer_than_the_parser_takes(spark):
    """Names of over 50,000 characters, nested and escaped, twice, and beside a value that reads like one."""
    import json
    name = 'n\u00e9 "\\' * 20_000
    other = "caf\u00c3\u00a9\n" + "y" * 60_000
    docs = [{name: {other: ["a", {name: "b"}]}, "k": name, "l": [f'"{other}":']}, [{other: 1}, other], {"k": other}]
    raw = [json.dumps(d, ensure_ascii=i == 1, indent=i) for i, d in enumerate(docs)]
    raw += [raw[0][:-1], '{"' + "z" * 60_000 + '" "x"}', '{"' + "z" * 60_000 + r'\q": 1}']
    df = spark.createDataFrame(list(enumerate(raw)), "id int, raw string")
    got = sorted(map(tuple, json_leaves.string_leaves(df, "raw", ["id"]).collect()), key=str)
    want = [(i, *leaf) for i, d in enumerate(docs) for leaf in walk(d)]
    assert got == sorted([*want, *((i, None, None) for i in (3, 4, 5))], key=str)


def test_json_lines_are_split_on_line_feed_only(spark, tmp_path):
    """U+2028 and its like inside values must not make the check invent findings."""
    import json
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps({"t": f"a{c}b"}, ensure_ascii=False) for c in (
        "\u2028", "\u2029", "\x85", "caf\u00c3\u00a9")) + "\n")
    lines = FR.numbered_lines(spark, str(tmp_path)).withColumn("raw_zone", F.lit(False))
    found = Q.mojibake_leaves(lines, "a", "line_no", "line", F.col("raw_zone"))
    assert [tuple(r)[1:] for r in found.collect()] == [("4", "mojibake", "report", "/t")]


# --- research dumps --------------------------------------------------------------------------

def test_a_wrong_count_and_a_nested_leaf_are_one_violation_each(spark):
    import json
    good = {"id": "a", "source": "s", "title": "t", "text": "x", "url": "https://x",
            "date_published": "2024-01-02", "notes": []}
    deep = {**good, "id": "b", "notes": [{"who": ["n\u00e9"]}]}
    lines = spark.createDataFrame([("d", 1, json.dumps(good)), ("d", 2, json.dumps(deep)),
                                   ("e", 1, json.dumps(good))], "dump string, line_no long, raw string")
    said = {f: "x" for f in K.RESEARCH_METADATA}
    metadata = spark.createDataFrame([("d", json.dumps({**said, "record_count": 2})),
                                      ("e", json.dumps({**said, "record_count": 9}))],
                                     "dump string, raw string")
    found = dump_checks.research_lines(lines, {"type": "object"}, ["s"])
    assert [(r.dump, r.rule, r.detail) for r in found.collect()] == [("d", "non-ascii", "/notes[0]/who[0]")]
    stats = dump_checks.reconciled(lines, found, metadata)
    assert {r.dump: (r.total, r.valid, r.problems) for r in stats.collect()} == {
        "d": (2, 1, ""), "e": (1, 1, "record count mismatch")}
    assert not dump_checks.all_valid(stats) and dump_checks.all_valid(stats.filter("dump = 'e'"))


def test_a_hot_id_is_one_group_of_repeats(spark):
    rows = spark.range(3000).selectExpr("'d' AS dump", "id AS line_no", """
        to_json(named_struct('id', if(id % 3 = 0, 'hot', concat('r', id)), 'source', 's', 'title', 't',
        'text', 'x', 'url', 'https://x', 'date_published', '2024-01-02')) AS raw""")
    found = dump_checks.research_lines(rows, {"type": "object"}, ["s"])
    assert [tuple(r) for r in found.groupBy("id", "rule").count().collect()] == [
        ("hot", "duplicate id", 999)]


# --- measured maturity -------------------------------------------------------------------------

RECORD = {"id": "a", "sources": ["s"], "published_at": "2026-01-01", "_provenance": {"published_at": "p"}}
LINEAGE = {"inputs": ["x"], "cadence": "weekly", "maturity": "gold"}
PINNED = {"type": "object", "required": ["id"], "version": "1"}


def rung_of(spark, records, schema=PINNED, lineage=LINEAGE):
    rows = spark.createDataFrame([("c", json.dumps(r) if isinstance(r, dict) else r) for r in records],
                                 "collection string, raw string")
    said = spark.createDataFrame([("c", json.dumps(lineage))] if lineage else [],
                                 "collection string, raw string")
    row = maturity.assess(maturity.measured(rows, {"c": schema}, said)).first()
    return row.rung, row.next_task


def test_one_broken_record_lowers_one_rung(spark):
    good = [RECORD] * 3
    without = lambda *names: {k: v for k, v in RECORD.items() if k not in names}
    assert rung_of(spark, good) == ("iridium", None)
    for broken, want in ((without("id"), ("wood", "validates")),
                         ("{bad", ("below wood", "exists")),
                         (RECORD | {"sources": []}, ("wood", "every record sourced")),
                         (without("_provenance"), ("silver", "dates carry evidence")),
                         (RECORD | {"founded": 1999}, ("silver", "dates carry evidence")),
                         (RECORD | {"tier": None}, ("silver", "no bare opinion"))):
        assert rung_of(spark, [*good, broken]) == want
    quoted = {"id": "b", "sources": ["s"], "founded": 1999, "founded_evidence": {"quote": "q"}}
    assert rung_of(spark, [quoted]) == ("iridium", None)
    assert rung_of(spark, [{"id": "b", "sources": ["s"]}]) == ("silver", "dates carry evidence")


def test_configuration_and_lineage_hold_rungs_back(spark):
    assert rung_of(spark, []) == ("below wood", "exists")
    assert rung_of(spark, [RECORD], None) == ("wood", "has schema")
    assert rung_of(spark, [RECORD], {"type": "object"}) == ("silver", "schema versioned")
    assert rung_of(spark, [RECORD], PINNED, None) == ("bronze", "lineage names inputs")
    assert rung_of(spark, [RECORD], PINNED, {"projected_from": "x"}) == ("gold", "declared cadence")


# --- rule jobs and versions --------------------------------------------------------------------

def test_row_jobs_of_a_table_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200).selectExpr("concat('i', id % 190) AS id", "id", "if(id % 50 = 0, '{\"y\": 1}', '{\"y\": \"z\"}') "
                                "AS raw").toDF("id", "n", "raw").write.parquet(path)
    t = spark.read.parquet(path)
    n = F.col("n")
    jobs = [checks.RowJob("a", "t", "id", (Rule("low", n < 10),), unique=True),
            checks.RowJob("b", "t", "n", (Rule("high", n >= 195, n, "warning"),)),
            checks.RowJob("c", "t", "id", schema={"properties": {"y": {"type": "string"}}}, gates=False),
            checks.TableJob(("t",), lambda d: Q.unique_ids(d, "d", "raw"), gates=False)]
    fused = checks.scanned(t, jobs[:3])
    plan = fused._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    report = checks.run_jobs(jobs, {"t": t})
    got = {(r.collection, r.rule, r.severity, r.gates): r.n for r in report.verdicts.collect()}
    assert got == {("a", "low", "error", True): 10, ("a", "duplicate id", "error", True): 10,
                   ("b", "high", "warning", False): 5, ("c", "$.y: type", "error", False): 4,
                   ("d", "duplicate id", "error", False): 2}
    assert (report.gating, report.reporting, report.passed) == (20, 11, False)
    assert checks.run_jobs(jobs[1:], {"t": t}).passed


def test_readers_see_the_old_version_or_the_new_one(spark, tmp_path):
    from tidemark.sinks import publish
    root = str(tmp_path / "p")
    errors = lambda d: PL.event_errors(d, {"properties": {"n": {"maximum": 5}}})
    rows = lambda *ns: spark.createDataFrame([(f"e{n}", n) for n in ns], "id string, n int")
    seen = lambda: sorted(r.n for r in publish.read_version(spark, root).collect())
    with pytest.raises(FileNotFoundError):
        publish.read_version(spark, root)
    with pytest.raises(RefusedWrite):
        publish.publish_version(rows(1, 9), root, errors, lambda d: d)
    assert publish.current_version(spark, root) is None
    publish.publish_version(rows(1, 2), root, errors, lambda d: d)
    old = publish.read_version(spark, root)
    for broken, clean in ((rows(1, 9), lambda d: d), (rows(1, 3), lambda d: d.withColumn("n", F.col("n") * 3))):
        with pytest.raises(RefusedWrite):
            publish.publish_version(broken, root, errors, clean)
        assert seen() == [1, 2]
    publish.publish_version(rows(3), root, errors, lambda d: d.withColumn("n", F.col("n") + 1))
    assert seen() == [4] and sorted(r.n for r in old.collect()) == [1, 2]
