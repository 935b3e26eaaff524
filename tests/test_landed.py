"""Sources, sinks and streams over files in a temporary folder."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks import publish
from tidemark.sources import documents as D
from tidemark.sources import fragments as FR
from tidemark.sources import overlays, snapshots
from tidemark.streaming import incremental as INC


def ddl(text):
    return T._parse_datatype_string(text)


def test_jsonl_splits_on_line_feed_only(spark, tmp_path):
    path = tmp_path / "data.jsonl"
    path.write_bytes('{"id": "a", "t": "x y\x85z"}\n\n   \n{"id": "b"}\n{bad\n'.encode())
    good, bad = D.ordered_jsonl(spark, str(path), ddl("id string, t string"))
    rows = good.orderBy("_ord").collect()
    assert [r["id"] for r in rows] == ["a", "b"] and rows[0]["t"] == "x y\x85z"
    assert [r[D.CORRUPT] for r in bad.collect()] == ["{bad"]


def test_json_document_shapes(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"n": 1}, {"n": 2}]')
    (tmp_path / "map.json").write_text('{"k": {"n": 3}}')
    got = D.json_documents(spark, str(tmp_path), ddl("n int"))
    assert sorted((r["file"], r["key"], r["record"]["n"]) for r in got.collect()
                  if r["key"]) == [("map.json", "k", 3)]
    assert got.count() == 3


def test_newest_snapshot(spark):
    df = spark.createDataFrame([("/r/a/dumps/2026-01-01_1/data.jsonl",),
                                ("/r/a/dumps/2026-01-02_1/data.jsonl",),
                                ("/r/b/dumps/2025-01-01_1/data.jsonl",)], "_file string")
    got = snapshots.newest(snapshots.with_dump_columns(df)).select("source_id", "dump_ts")
    assert sorted(map(tuple, got.collect())) == [("a", "2026-01-02_1"), ("b", "2025-01-01_1")]
    meta = spark.createDataFrame([("1", "2026-01-01", "complete"), ("2", "2026-02-01", "failed")],
                                 "dump string, extraction_date string, extraction_status string")
    assert snapshots.last_complete(meta) == "2026-01-01"


def test_tombstones_later_line_wins(spark):
    df = spark.createDataFrame([("x", "f1", 9, "old"), ("x", "f2", 1, "new"), ("y", "f1", 1, "a"),
                                ("y", "f1", 2, "b")], "id string, _file string, _ord int, category string")
    assert sorted(map(tuple, overlays.last_tombstones(df).collect())) == [("x", "new"), ("y", "b")]


def test_sheets(spark):
    rows = [(1, ["Category", "Level", "Description"]), (2, ["Entity", "Human", "a  person"]),
            (3, [None, "AI", "é system"]), (4, ["only"]), (5, ["Intent", "On purpose", "x"]),
            (6, ["", "Accident", "y"])]
    sheet = spark.createDataFrame([("s", *r) for r in rows],
                                  "sheet string, row_no int, cells array<string>")
    got = overlays.sectioned_levels(sheet, ["Entity", "Intent", "Timing"]).orderBy("row_no")
    assert [tuple(r)[2:] for r in got.collect()] == [
        ("Entity", "Human", "a person"), ("Entity", "AI", "e system"),
        ("Intent", "On purpose", "x"), ("Intent", "Accident", "y")]
    rows = [(1, ["note here", "x"]), (2, ["1.0", "Bias", "1.1", "Unfair", "text"]),
            (3, [None, None, "1.2", "Toxic", None]), (4, ["2.0", "Privacy", "2.1", "Leak"])]
    sheet = spark.createDataFrame([("s", *r) for r in rows],
                                  "sheet string, row_no int, cells array<string>")
    got = overlays.sectioned_domains(sheet).orderBy("row_no")
    assert [tuple(r)[2:] for r in got.collect()] == [
        ("1.0", "Bias", "1.1", "Unfair", "text"), ("1.0", "Bias", "1.2", "Toxic", None),
        ("2.0", "Privacy", "2.1", "Leak", None)]
    rows = [(1, ["about"]), (2, ["Title", "Year"]), (3, ["A", "2020"]), (4, ["", " "])]
    sheet = spark.createDataFrame([("s", *r) for r in rows],
                                  "sheet string, row_no int, cells array<string>")
    assert [r["record"] for r in overlays.headed_table(sheet).collect()] == [
        {"Title": "A", "Year": "2020"}]


def test_feed_is_ordered_and_complete(spark, tmp_path):
    df = spark.createDataFrame([(f"id{i}", i % 5, None) for i in range(50)],
                               "id string, s int, n string")
    path = str(tmp_path / "feed")
    publish.feed(df, path, [F.desc("s"), F.col("id")], single_file=True)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    want = df.orderBy(F.desc("s"), "id").select(F.to_json(F.struct("id", "n", "s"),
                                                          {"ignoreNullFields": "false"})).collect()
    assert lines == [r[0] for r in want]


def test_dump_is_immutable_and_refuses_repeats(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "id string")
    none = spark.createDataFrame([], "collection string, id string, rule string, severity string, "
                                     "detail string")
    path = str(tmp_path / "dump")
    manifest = publish.guarded_dump(df, none, path, raw=df, metadata={"source": "s"})
    assert manifest.filter("sha256 is not null").count() >= 3
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        publish.guarded_dump(df, none, path)
    with pytest.raises(publish.RefusedWrite):
        publish.guarded_dump(df.union(df), none, str(tmp_path / "other"))


def test_promotion_is_idempotent(spark, tmp_path):
    target, ledger = str(tmp_path / "t"), str(tmp_path / "l")
    rules = lambda b: b.filter("v < 0").select("_file", F.lit("error").alias("severity"))
    run = INC.promotion_batch(target, ledger, rules)
    batch = spark.createDataFrame([("f1", 1), ("f1", 2), ("f2", -1), ("f2", 5)], "_file string, v int")
    for _ in range(2):
        run(batch, 0)
    assert spark.read.parquet(target).count() == 2
    assert [(r["file"], r["rows"]) for r in spark.read.parquet(ledger).collect()] == [("f1", 2)]
    # delivered again in another order: skipped; with other content: promoted again
    run(spark.createDataFrame([("f1", 2), ("f1", 1)], "_file string, v int"), 1)
    assert spark.read.parquet(target).count() == 2
    run(spark.createDataFrame([("f1", 2), ("f1", 7), ("f3", 1)], "_file string, v int"), 2)
    assert spark.read.parquet(target).count() == 5
    assert spark.read.parquet(ledger).filter("file = 'f1'").count() == 2


def test_changed_checksum_is_pending_again(spark):
    hashes = spark.createDataFrame([("f1", "x"), ("f2", "y")], "file string, sha256 string")
    ledger = spark.createDataFrame([("f1", "x"), ("f2", "old")], "file string, sha256 string")
    assert [r["file"] for r in INC.pending_files(hashes, ledger).collect()] == ["f2"]


def test_ingest_reads_each_file_once(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = ddl("id string, source string, title string, text string, date_published string")
    row = lambda i, date, n=200: (i, "s", "t", "x" * n, date)

    def land(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(landing)
        INC.ingest_available(spark, landing, schema, target, state,
                             min_date="2020-01-01").awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    assert land(row("a", "2021-01-01"), row("b", "2019-01-01"), row("c", "2021-01-01", 9)) == ["a"]
    assert land(row("d", "2022-01-01")) == ["a", "d"]


def test_watch_dates(spark):
    df = spark.createDataFrame([("watching", None), ("watching", "2025-01-01"), ("rejected", "x"),
                                (None, "x")], "s string, since string")
    cols = INC.watch_dates(F.col("s"), F.col("since"), F.lit("2026-03-04T00:00:00"), F.lit("ada"))
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in cols.items()]).collect()]
    assert got == [("2026-03-04", None, None), ("2025-01-01", None, None),
                   ("x", "2026-03-04", "ada"), (None, None, None)]


def test_upsert(spark):
    a = spark.createDataFrame([("1", "t", "c"), ("2", "t", "c")], "id string, title string, c string")
    b = spark.createDataFrame([("2", None, "z"), ("3", "n", "z")], a.schema)
    assert sorted(map(tuple, publish.upsert(a, b, "id", ["title"]).collect())) == [
        ("1", "t", "c"), ("2", None, "c"), ("3", "n", "z")]


# --- files in many splits ------------------------------------------------------------

@pytest.fixture(params=["300", "1g"])
def split_size(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


WILD = ['plain', 'a } b ] c', 'quote " and \\ back', '{"n": 1}, {', '\\', '\\"}', '', 'é €   x',
        'line\nend', '}}}}', '[[[', 'x' * 60]


def wild(i):
    return {"n": i, "t": WILD[i % len(WILD)], "deep": {"list": [1, {"t": WILD[(i * 5) % len(WILD)]}]}}


@pytest.mark.parametrize("indent", [None, 2])
def test_json_documents_in_many_splits(spark, tmp_path, split_size, indent):
    import json
    items = [wild(i) for i in range(24)]
    (tmp_path / "list.json").write_text(json.dumps(items, indent=indent, ensure_ascii=False))
    (tmp_path / "map.json").write_text(" \n" + json.dumps(
        {f'k"}}{i}': x for i, x in enumerate(items)}, indent=indent) + "\n")
    (tmp_path / "none.json").write_text("[ ]\n")
    (tmp_path / "empty.json").write_text("{}")
    (tmp_path / "blank.json").write_text("")
    schema = ddl("n int, t string, deep struct<list: array<string>>")
    records, rejects = FR.json_elements(spark, str(tmp_path), schema)
    got = records.orderBy("file", "item").collect()
    want = [(k, x["n"], x["t"]) for k, x in
            [*((None, x) for x in items), *((f'k"}}{i}', x) for i, x in enumerate(items))]]
    assert [(r.key, r.record.n, r.record.t) for r in got] == want
    assert all(json.loads(r.record.deep.list[1]) == items[r.record.n]["deep"]["list"][1] for r in got)
    assert rejects.count() == 0
    if split_size == "300":
        assert FR.fragments(spark, str(tmp_path / "list.json"), "}").rdd.getNumPartitions() > 5


def test_bad_elements_and_their_offsets(spark, tmp_path, split_size):
    bad = '{"n" 3, "t": "é"}'
    text = '[{"n": 1}, ' + bad + ', {"n": 2}, 7, {"n": 8}, {"n": 4}, 5]'
    (tmp_path / "list.json").write_text(text)
    (tmp_path / "cut.json").write_text('{"a": {"n": 5}, "b": {"n": 6')
    (tmp_path / "other.json").write_text("3")
    records, rejects = FR.json_elements(spark, str(tmp_path), ddl("n int, t string"))
    assert sorted((r.key or "", r.record.n) for r in records.collect()) == [
        ("", 1), ("", 2), ("", 4), ("a", 5)]
    found = {(r.file.split("/")[-1], r.at): r.text for r in rejects.collect()}
    raw = text.encode()
    assert found == {("list.json", raw.index(b", {\"n\" 3")): ", " + bad[:-1],
                     ("list.json", raw.index(b", 7")): ', 7, {"n": 8',
                     ("list.json", raw.index(b", 5]")): ", 5]",
                     ("cut.json", 14): ', "b": {"n": 6', ("other.json", 0): "3"}


def test_csv_in_many_splits(spark, tmp_path, split_size):
    import csv
    cells = ["plain", 'a "quoted" word', "line\nend", "comma, and\n\"\n\"", "", "é ", "x" * 50, '"']
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n" if name == "a" else "\r\n")
            out.writerow(["id", "the label", "last"])
            for i in range(20):
                out.writerow([f"{name}{i}", cells[i % 8], cells[(i * 3 + 1) % 8]])
        with open(tmp_path / f"{name}.csv", "a") as f:
            f.write("\n")
    got = FR.csv_records(spark, str(tmp_path))
    want = spark.read.csv(str(tmp_path), header=True, multiLine=True, escape='"')
    assert got.columns == want.columns == ["id", "the label", "last"]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert got.count() == 40 and rows(got) == rows(want)
    (tmp_path / "none").mkdir()
    assert FR.csv_records(spark, str(tmp_path / "none")).count() == 0


def test_lines_are_numbered_through_splits(spark, tmp_path, split_size):
    lines = [f"line {i} é " * (i % 4) for i in range(60)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.txt").write_text("one\r\ntwo")
    got = FR.numbered_lines(spark, str(tmp_path)).orderBy("file", "line_no").collect()
    assert [(r.line_no, r.line) for r in got] == [
        *enumerate(lines, 1), (1, "one\r"), (2, "two")]


def test_long_files_hash_in_chunks_and_dumps_are_bounded(spark, tmp_path, monkeypatch):
    import hashlib
    import os
    sparse = tmp_path / "in" / "long.bin"
    sparse.parent.mkdir()
    with open(sparse, "wb") as f:
        f.write(b"begin")
        f.truncate((2 << 30) + 10)  # longer than one value of Spark may be
    (tmp_path / "in" / "two words.txt").write_bytes(b"ab")
    got = {os.path.basename(r.file): (r.bytes, r.sha256)
           for r in D.file_hashes(spark, str(tmp_path / "in")).collect()}
    digest = hashlib.sha256()
    with open(sparse, "rb") as f:
        while chunk := f.read(1 << 24):
            digest.update(chunk)
    os.remove(sparse)
    assert got["long.bin"] == ((2 << 30) + 10, digest.hexdigest())
    assert {v for k, v in got.items() if k.startswith("two")} == {
        (2, hashlib.sha256(b"ab").hexdigest())}
    rows = spark.range(500).selectExpr("cast(id AS string) AS id", "repeat('x', 100) AS t").coalesce(1)
    found = spark.createDataFrame([], "collection string, id string, rule string, severity string, "
                                      "detail string")
    files = publish.guarded_dump(rows, found, str(tmp_path / "out"), file_bytes=10_000).filter(
        "bytes > 1000").collect()
    assert len(files) >= 5 and max(r.bytes for r in files) < 20_000


def test_a_language_is_landed_by_many_tasks(spark, tmp_path, monkeypatch):
    """One language holds everything: it is written to as many files as there are tasks."""
    from tidemark.plans import queries_landed as QD
    from tidemark.plans.catalog import QUERIES
    spark.range(400).selectExpr("id AS doc_id", "'de' AS lang", "concat('t', id) AS text").repartition(4).write.parquet(
        str(tmp_path / "documents.parquet"))
    root = str(tmp_path / "landed")
    monkeypatch.setattr(QD, "new_path", lambda spark, label: root)
    got = QUERIES["landed_clean_counts"].run(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("de", 50 + 45)]
    assert len(list((tmp_path / "landed" / "lang=de").glob("*.txt"))) >= 4
