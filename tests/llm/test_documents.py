"""Operators on documents against plain Python, and on odd and empty tables."""

import hashlib
import random
import re
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests_llm_tools import TEXT, sets_of, words_of
from tidemark.llm import (components, decontaminate, fingerprints, jaccard, licenses, mixing, token_files,
                          warc, words)
from tidemark.workspace import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_shingle_hashes_stand_for_shingles():
    rnd = random.Random(1)
    texts = ["", None, "a", "é b c d e f", "A  b\tc\nd e"] + [
        " ".join(rnd.choice("abc") for _ in range(rnd.randrange(14))) for _ in range(150)]
    got = list(words.shingle_sets(pa.array(texts)))
    want = [sets_of(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i + 1):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = "x" * 50 + " " + "ab cd " * 400
    whole = words.words(pa.array([text]), words.NOT_SPACE).hashes()
    monkeypatch.setattr(words, "_PIECE", 32)
    assert (words.words(pa.array([text]), words.NOT_SPACE).hashes() == whole).all()


def test_sketch_merges_and_estimates():
    rnd = np.random.default_rng(3)
    a, b = (np.unique(rnd.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
            for _ in range(2))
    both = np.union1d(a, b)
    assert (fingerprints.merge(fingerprints.sketch(a), fingerprints.sketch(b))
            == fingerprints.sketch(both)).all()
    _, inside, _ = fingerprints.compare(fingerprints.sketch(a), fingerprints.sketch(both))
    assert inside == 1
    _, _, back = fingerprints.compare(fingerprints.sketch(a), fingerprints.sketch(both))
    assert abs(back - 0.5) < 0.08
    assert fingerprints.compare(a[:0], a[:0])[0] == 1 and fingerprints.compare(a[:0], a)[0] == 0
    assert (fingerprints.from_text(fingerprints.as_text(a[:9])) == a[:9]).all()


def test_edited_texts(spark, odd, none):
    got = fingerprints.edited_against_next(odd)
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (key, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    found = got.collect()
    order = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r[0], r[1], r[2]) for r in found), key=order) == sorted(want, key=order)
    by = {r.doc_id: r for r in found}
    assert by[1].fingerprint == by[2].fingerprint == dict(
        rows_of(fingerprints.fingerprint(odd)))[1]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert fingerprints.edited_against_next(none).count() == 0


def test_jaccard_equals_brute_force(spark, odd, none):
    rnd = random.Random(5)
    base = [[f"w{rnd.randrange(40)}" for _ in range(rnd.choice([4, 6, 9, 15, 40, 120]))]
            for _ in range(25)]
    texts = []
    for b in base:
        for _ in range(8):
            copy = list(b)
            for _ in range(rnd.randrange(0, 1 + len(b) // 12)):
                copy[rnd.randrange(len(copy))] = f"v{rnd.randrange(9)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert_components(jaccard.link(docs), list(enumerate(texts)))
    rows = jaccard.link(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].component_id == 1 and by[3].component_id == 3
    assert (by[8].component_id, by[8].n_shingles) == (7, 1)
    assert all(by[i].component_id == i and by[i].n_shingles == 0 for i in (4, 5, 6))
    assert jaccard.link(none).count() == 0


@pytest.mark.parametrize("whole", [0, 4])
def test_jaccard_without_small_clusters(spark, monkeypatch, whole):
    """The rounds, the pairs and the blocks give what whole clusters give."""
    monkeypatch.setattr(jaccard, "_WHOLE", whole)
    monkeypatch.setattr(jaccard, "_NEAR", 2)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(rnd.randrange(1, 4)):
            copy[rnd.randrange(len(copy))] = f"v{rnd.randrange(99)}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert_components(jaccard.link(docs), list(enumerate(texts)))


@pytest.mark.parametrize("whole", [0, 4096])
def test_jaccard_in_many_blocks(spark, monkeypatch, whole):
    """Groups of bitmaps, stars and groups of whole sets that are dealt into several blocks."""
    monkeypatch.setattr(jaccard, "_BLOCK", 8)
    monkeypatch.setattr(jaccard, "_WHOLE", whole)
    rnd = random.Random(9)
    texts = []
    for b in range(3):
        for _ in range(25):
            copy = [f"w{b}-{i}" for i in range(70)]
            for _ in range(rnd.randrange(1, 4)):
                copy[rnd.randrange(len(copy))] = f"v{rnd.randrange(99)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert_components(jaccard.link(docs), list(enumerate(texts)))


def test_components_leave_ever_fewer_rows(spark, monkeypatch):
    """All rounds together write a few times the nodes, on long paths too."""
    rnd, rows, durable = random.Random(2), [], components.durable
    ids = rnd.sample(range(10**6), 3000)
    links = [*zip(ids, ids[1:2500]), *((ids[2500], x) for x in ids[2501:]), (7, 7), (None, 3)]

    def counted(df, label):
        out = durable(df, label)
        rows.append(out.count())
        return out

    monkeypatch.setattr(components, "durable", counted)
    got = dict(rows_of(components.connected(spark.createDataFrame(links, "a long, b long"))))
    want = {x: min(ids[:2500]) for x in ids[:2500]} | {x: min(ids[2500:]) for x in ids[2500:]}
    assert got == want and sum(rows) < 8 * len(ids)
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_only_sets_that_bitmaps_leave_alike_are_dealt_whole(spark, monkeypatch):
    rnd, seen, durable = random.Random(4), [], jaccard.durable
    shared = " ".join(f"s{rnd.randrange(9**9)}" for _ in range(60))
    texts = [shared + " " + " ".join(f"w{rnd.randrange(9**9)}" for _ in range(60)) for _ in range(40)]
    texts += [texts[0] + " one", texts[1] + " two"]

    def watched(df, label):
        out = durable(df, label)
        if "items" in out.columns:
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "durable", watched)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert_components(jaccard.link(docs), list(enumerate(texts)))
    assert seen == [4]


def test_bitmaps_of_a_tile_against_pairs():
    """Forests of tiles, with groups that are cut by batches and bitmaps of different lengths."""
    rnd = np.random.default_rng(6)
    rows, want = [], {}
    for g in range(12):
        base = np.unique(rnd.integers(0, 1 << 63, rnd.choice([9, 60, 130, 1100]), dtype=np.uint64))
        ti, tj = (0, 0) if g % 2 else (0, 1)
        for i in range(rnd.integers(1, 12)):
            own = np.unique(np.append(base[rnd.random(len(base)) < rnd.choice([0.6, 0.85, 0.95])],
                                      rnd.integers(0, 1 << 63, len(base) // 20 + 1, dtype=np.uint64)))
            rows.append((g, ti, tj, 1000 * g + i, i % 2 * tj, len(own), jaccard._bits(own)))
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[3] < y[3] and not (x[1] != x[2] and x[4] == y[4]):
                a, b = sorted((np.unpackbits(np.frombuffer(z[6], np.uint8)) for z in (x, y)), key=len)
                while len(b) > len(a):
                    b = b[:len(b) // 2] ^ b[len(b) // 2:]
                if 4 * min(x[5], y[5]) >= 3 * max(x[5], y[5]) and (a != b).sum() <= (x[5] + y[5]) // 7:
                    want[x[3], y[3]] = 1
    names = ["g", "ti", "tj", "sid", "block", "n", "bits"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    parts = [batch.slice(a, 5) for a in range(0, len(rows), 5)]
    got = [tuple(r.values()) for b in jaccard._close_tiles(3, 4)(iter(parts)) for r in b.to_pylist()]

    def classes(pairs):
        root = {r[3]: r[3] for r in rows}
        top = lambda x: x if root[x] == x else top(root[x])
        for a, b in pairs:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return {x: top(x) for x in root}
    assert len(got) < len(rows) and classes(got) == classes(want) != classes([])


def assert_components(df, rows):
    sets = {i: sets_of(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    assert sorted(rows_of(df)) == sorted((i, len(s), top(i)) for i, s in sets.items())


def test_decontamination(spark, odd, none, monkeypatch):
    bench = [(1, " ".join(words_of_alnum(TEXT)[3:20])), (2, "One, TWO"), (3, None), (4, "--"),
             (None, "zzz yyy")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    first = sorted(map(str, rows_of(decontaminate.report(odd, items))))
    by = {r.doc_id: r for r in decontaminate.report(odd, items).collect() if r.doc_id}
    assert (by[1].n_hit, by[1].n_items, by[1].contaminated) == (17, 1, True)
    assert by[3].n_hit == 0
    assert (by[7].n_hit, by[7].items_sha256) == (2, hashlib.sha256(b"2").hexdigest())
    assert (by[4].n_words, by[4].n_hit, by[4].contaminated) == (0, 0, False)
    kept = decontaminate.clean(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - sum(r.contaminated for r in decontaminate.report(
        odd, items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK", 2)
    assert sorted(map(str, rows_of(decontaminate.report(odd, items)))) == first
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(odd, empty).filter("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.report(none, items).count() == 0


def words_of_alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def test_mixing(spark, odd, none):
    plan = mixing.plan(odd)
    rows = plan.collect()
    assert len(rows) == odd.count() and plan.columns[:7] == odd.columns
    total = sum(len(words_of(r.text)) for r in rows)
    targets = {r.source: r["_mix"].target for r in rows}
    sizes = {r.source: r["_mix"].source_size for r in rows}
    assert abs(sum(targets.values()) - total) < 1e-6
    assert all(targets[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    assert all(r["_mix"].copies <= 3 for r in rows)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r["_mix"].copies for r in rows)
    assert sorted(map(str, rows_of(mixing.mix(odd)))) == sorted(map(str, rows_of(mixed)))
    assert mixing.plan(none).count() == 0


def test_mixing_rates_come_near_targets(spark):
    docs = spark.range(4000).selectExpr(
        "id AS doc_id", "repeat('w ', 10) AS text",
        "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 30 = 1 THEN 'b' ELSE 'c' END AS source")
    got = mixing.plan(docs).selectExpr("source", "_mix.*").groupBy("source").agg(
        {"target": "max", "source_size": "max"})
    taken = dict(rows_of(mixing.plan(docs).selectExpr("source", "_mix.size * _mix.copies AS t")
                         .groupBy("source").sum("t")))
    for r in got.collect():
        assert abs(taken[r.source] / r["max(target)"] - 1) < 0.1


def test_licences(spark, odd, none):
    mit = " ".join(licenses.SENTENCES[i] for i in ("mit-grant", "mit-keep", "as-is",
                                                   "mit-liability"))
    texts = [(1, mit), (2, "x.\nReleased  under the MIT license.\nAll rights reserved.\n"),
             (3, licenses.SENTENCES["apache-notice"] + " " + licenses.SENTENCES["cc0"]), (4, None)]
    got = {r.doc_id: r for r in licenses.scan(
        spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert (got[1].licenses, got[1].undecided) == ("MIT", 0)
    assert (got[2].sentence_ids, got[2].licenses, got[2].undecided) == (
        "mit-notice,all-rights", "MIT", 1)
    assert got[3].licenses == "Apache-2.0,CC0-1.0"
    assert (got[4].n_sentences, got[4].licenses) == (0, "")
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(none).count() == 0


def test_wrapped_licences(spark, odd, none):
    """Licences as they stand in files: wrapped, in comments and lists, with names of their own."""
    table = licenses.SENTENCES | licenses.MORE_SENTENCES

    def wrapped(*parts, mark="", width=72):
        lines = [x for p in parts for x in [*textwrap.wrap(p, width), ""]]
        return "\n".join((mark + x).rstrip() for x in lines)
    apache = wrapped("Copyright 2020 Someone", table["apache-grant"],
                     "You may obtain a copy of the License at",
                     "    https://www.apache.org/licenses/LICENSE-2.0",
                     table["apache-basis"] + " " + table["apache-see"], mark=" * ")
    names = table["bsd-names"].replace("the copyright holder", "Example Works, Inc.")
    bsd = ("Copyright (c) 2020, Example Works, Inc.\nAll rights reserved.\n\n"
           + wrapped(table["bsd-grant"], "1. " + table["bsd-source"], "(2) " + table["bsd-binary"],
                     "* " + names, mark="# ", width=60))
    mpl = wrapped(table["mpl2-terms"] + " " + table["mpl2-copy"], mark="dnl ")
    mit = wrapped(table["mit-grant"], table["mit-keep"], table["as-is"] + " "
                  + table["mit-liability"]).replace("\n", "\r\n")
    gnu = [(name, wrapped(table[run[0]].replace("This program", "Frob"), table["gpl-warranty"] + "  "
                          + table[run[2]], mark="// "))
           for name, run in licenses.MORE_RULES if len(run) == 3 and run[1] == "gpl-warranty"]
    zlib_text = wrapped(table["zlib-as-is"] + " " + table["zlib-liability"], table["zlib-grant"])
    one = [(name, wrapped(table[run[0]], mark="; ", width=50))
           for name, run in licenses.RULES + licenses.MORE_RULES if len(run) == 1]
    cases = [("Apache-2.0", f"/*\n{apache}\n */\nint x;"), ("BSD-3-Clause", bsd), ("MPL-2.0", mpl),
             ("MIT", mit), ("Zlib", zlib_text), *gnu, *one, ("", "x\n\nlicensed\n\nunder\n"),
             ("MIT", "A tool\nReleased under the MIT License\nsince 2020")]
    rows = [(i, text) for i, (_, text) in enumerate(cases)]
    got = {r.doc_id: r for r in licenses.scan_whole(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].licenses for i in range(len(cases))] == [name for name, _ in cases]
    assert [got[i].undecided for i in range(len(cases))] == [int(i == 1) for i in range(len(cases))]
    assert got[1].sentence_ids == "all-rights,bsd-grant,bsd-source,bsd-binary,bsd-names"
    assert got[4].n_sentences == 3
    # every sentence of the table, on one line, is found as itself
    lines = list(table.items())
    got = {r.doc_id: r.sentence_ids for r in licenses.scan_whole(spark.createDataFrame(
        [(i, s) for i, (_, s) in enumerate(lines)], "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(lines))] == [i for i, _ in lines]
    assert licenses.scan_whole(odd).count() == odd.count()
    assert licenses.scan_whole(none).count() == 0


def test_huffman_round_trip():
    rnd = np.random.default_rng(2)
    for n, most in ((0, 16), (1, 16), (700, 9), (5000, 16)):
        ids = rnd.zipf(1.4, n) % 400
        lengths = token_files.code_lengths(np.bincount(ids, minlength=1), most)
        assert lengths.max(initial=0) <= most
        assert (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1
        bits, points = token_files.pack(ids, lengths, token_files.canonical(lengths))
        assert (token_files.unpack(bits, lengths, points, n) == ids).all()


def test_tokens_equal_the_tokenizers_own(odd):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(PATH)
    texts = [r.text for r in odd.collect()] + [
        "it's 'quoted' don't", "abc123def 4.5", "x\x1cy\x85z", "naïve—dash", "_a_b #$ab#",
        "İstanbul ΣΑΣ", "ﬁ Å"]
    ids, each = token_files.Encoder(PATH).encode(pa.array(texts), 1)
    got = [x.tolist() for x in np.split(ids, np.cumsum(each)[:-1])]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_tokens_of_more_words_than_are_remembered(monkeypatch):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(PATH)
    monkeypatch.setattr(token_files, "REMEMBERED", 8)
    encoder = token_files.Encoder(PATH)
    long = " ".join(f"{chr(97 + i)}x {i}" for i in range(26))
    for texts in (["ax bx 3"], [long, "ax zz"], ["ax new"], [long + " qq", None], ["one"]):
        ids, each = encoder.encode(pa.array(texts, pa.string()), 1)
        got = [x.tolist() for x in np.split(ids, np.cumsum(each)[:-1])]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert len(encoder.known) <= 8


def test_token_files(spark, odd, none):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(PATH)
    root = new_path(spark, "tokens-test")
    manifest = token_files.write(odd, root, PATH, 1)
    got = token_files.read(manifest, root).collect()
    ids = sorted(((r.doc_id is not None, r.doc_id or 0, r.start) for r in got))
    assert [x[2] for x in ids] == sorted(x[2] for x in ids) and ids[0][2] == 0
    want = sorted((str(r.doc_id), plain.encode(r.text or "", add_special_tokens=False).ids + [1])
                  for r in odd.collect())
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    root = new_path(spark, "tokens-test")
    assert token_files.read(token_files.write(none, root, PATH, 1), root).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<p>x</p>", 1), (2, None, "<p>x</p>", 1), (3, "http://b/ c\r\n", "", 1),
         (4, "u", None, 1), (4, "u", None, 1), (None, "n", "<p>x</p>", 1), (5, "v", "é" * 5000, 1)],
        "page_id long, url string, html string, name int")
    root = new_path(spark, "warc-test")
    manifest = warc.write(pages, root, roll=600)
    got = sorted(map(str, [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                            r.refers_to, r.payload.decode()) for r in warc.read(
                                manifest, root, with_payload=True).collect()]))
    x, e, long = (warc.digest(t.encode()) for t in ("<p>x</p>", "", "é" * 5000))
    assert got == sorted(map(str, [
        (1, 8, x, "revisit", 2, ""), (2, 8, x, "response", None, "<p>x</p>"),
        (3, 0, e, "revisit", 4, ""), (4, 0, e, "response", None, ""),
        (4, 0, e, "response", None, ""), (None, 8, x, "response", None, "<p>x</p>"),
        (5, 10000, long, "response", None, "é" * 5000)]))
    again = new_path(spark, "warc-test")
    warc.write(pages.repartition(5), again, roll=600)
    for r in manifest.collect():
        assert (warc.shards.read_bytes(root, r.name).readall()
                == warc.shards.read_bytes(again, r.name).readall())
    root = new_path(spark, "warc-test")
    assert warc.read(warc.write(pages.limit(0), root), root).count() == 0


def test_warc_payloads_of_one_id(spark):
    """Only the payload that has a copy under a larger id becomes a revisit."""
    pages = spark.createDataFrame(
        [(1, "a", "twice"), (1, "b", "alone"), (1, "c", "third"), (2, "d", "twice"), (3, "e", "third")],
        "page_id long, url string, html string")
    root = new_path(spark, "warc-test")
    got = warc.read(warc.write(pages, root), root, with_payload=True).collect()
    assert sorted((r.url, r.record_type, r.refers_to, r.payload.decode()) for r in got) == [
        ("a", "revisit", 2, ""), ("b", "response", None, "alone"), ("c", "revisit", 3, ""),
        ("d", "response", None, "twice"), ("e", "response", None, "third")]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_gives_its_own_ids(spark, odd, name):
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    root = new_path(spark, "tokens")
    manifest = token_files.write(odd, root, path, 1)
    got = sorted((r.doc_id is not None, r.doc_id, r.ids) for r in token_files.read(
        manifest, root).collect() if r.doc_id is not None)
    want = sorted((True, r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1])
                  for r in odd.collect() if r.doc_id is not None)
    assert [(a, b, list(c)) for a, b, c in got] == want


def test_large_vocabularies_have_longer_codes():
    ids = np.r_[np.arange(100_000), np.zeros(50_000, int), np.arange(0, 100_000, 7)].astype(np.uint32)
    counts = np.bincount(ids)
    lengths = token_files.code_lengths(counts, 18)
    bits, points = token_files.pack(ids, lengths, token_files.canonical(lengths))
    assert lengths.max() <= 18 and (token_files.unpack(bits, lengths, points, len(ids)) == ids).all()


def test_licence_scans_take_long_runs_and_blank_lines(spark):
    import time
    bodies = ["你" * 350_000, "\n" * 100_000, "─ " * 200_000, " \n\t\n" * 50_000, "=" * 500_000 + "\n",
              "* " * 100_000, "1. " * 100_000, "Ж " * 2_000 + "\n" + "ж" * 100_000]
    rows = [(i, b + "\n" + t, "en", "a") for i, (b, t) in enumerate(
        (b, t) for b in bodies for t in ("", "Licensed under CC BY-NC 4.0.\n"))]
    df = spark.createDataFrame([(*r, len(r[1])) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    for scan in (licenses.scan, licenses.scan_whole):
        begun = time.time()
        got = {r.doc_id: r.licenses for r in scan(df.repartition(8)).collect()}
        assert time.time() - begun < 60
        assert all((got[i] == "CC-BY-NC-4.0") == (i % 2 == 1) for i in got), got
