"""Classifiers by held-out accuracy, the pipeline against plain Python, odd and empty tables."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_documents import assert_components

import corpus_pipeline as P
from tidemark.llm import decontaminate, jaccard, language, mixing, quality_zstd, queries, toxicity
from tidemark.workspace import durable

SF = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


def held_out(spark, name, column, mod, rest):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (crc(r.doc_id) % mod == rest) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    return [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def test_quality(spark):
    pairs = held_out(spark, "op2_quality", "quality", 5, 0)
    assert sum(a == b for a, b in pairs) >= 0.9 * len(pairs)


def test_toxicity(spark):
    pairs = held_out(spark, "op7_toxicity", "toxic", 4, 2)
    assert sum(a == b for a, b in pairs) >= 0.85 * len(pairs)


def test_toxicity_learns_words_and_spares_others():
    clean = [f"calm words number w{i} are here w{i + 1}" for i in range(300)]
    toxic = [f"calm words vile{'abcdef'[i % 6]} number w{i} here" for i in range(300)]
    texts = [t for both in zip(clean, toxic) for t in both]
    places, weights, bias = toxicity.train(texts, np.array([0.0, 1.0] * 300), 0.5)
    assert len(places) < 3000
    table = dict(zip(places.tolist(), weights))
    unseen = pa.array(["calm words number w901 are here w902", "calm words vilez number w901 here"])
    score = [sum(table.get(i, 0) for i in f) + bias for f in toxicity.features(unseen)]
    assert score[0] < 0 < score[1]


def test_language(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in queries.QUERIES["op5_language"](spark, SF).collect()
            if crc(r.doc_id) % 3 == 1]
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) >= 0.98 * len(rows)


def test_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 1, 1), (10, 0, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for docs in (odd, none):
        for known in (labels, labels.limit(0)):
            for module in (quality_zstd, toxicity):
                got = module.score(docs, module.fit(docs, known)).collect()
                assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    model = language.fit(odd)
    got = language.predict(odd, model, "_p").collect()
    assert len(got) == odd.count()
    unknown = {r.doc_id for r in got if r["_p"].lang == "und"}
    assert unknown == {4, 5, 6, 9, None} and all(r["_p"].rejected for r in got
                                                 if r["_p"].lang == "und")
    assert language.predict(none, language.fit(none), "_p").count() == 0
    assert {r["_p"].lang for r in language.predict(odd, language.fit(none), "_p").collect()} == {
        "und"}


@pytest.mark.parametrize("table", ["odd", "none", "small"])
def test_pipeline_stages(spark, request, table):
    """Each stage on what its predecessor kept, against the operator's own tests' brute force."""
    sf = "/root/testdata/sf0.001"
    docs = (spark.read.parquet(f"{sf}/documents.parquet") if table == "small"
            else request.getfixturevalue(table))
    before = durable(docs, "documents")
    for name, stage in P.STAGES[:-1]:
        after = durable(stage(spark, before, sf), name)
        assert after.columns == list(P.COLUMNS)
        was, now = [sorted(map(str, x.select("doc_id", "text").collect())) for x in (before, after)]
        if name == "language":
            assert all(r.text for r in after.collect()) and len(now) >= 0.5 * len(was)
        elif name == "near_duplicates":
            rows = {r.doc_id: r.text for r in before.collect() if r.doc_id is not None}
            if table == "small":
                assert_components(jaccard.link(before), list(rows.items()))
            first = {r.doc_id for r in jaccard.link(before).collect()
                     if r.doc_id is not None and r.doc_id == r.component_id}
            kept = [r.doc_id for r in after.collect() if r.doc_id is not None]
            assert sorted(kept) == sorted(first)
        elif name == "decontamination":
            bad = decontaminate.report(before, spark.read.parquet(f"{sf}/benchmark.parquet"))
            assert len(now) == bad.filter("not contaminated").count()
        else:
            copies = mixing.plan(before).selectExpr("sum(_mix.copies)").first()[0] or 0
            assert len(now) == copies and set(now) <= set(was)
        before = after
    last = P.STAGES[-1][1](spark, before, sf).collect()
    assert len(last) == before.count()
    assert sum(r.n_tokens for r in last) == max((r.start + r.n_tokens for r in last), default=0)


def test_letters_are_of_category_l():
    assert all(language.has_letter(t) for t in ("a", "é", "你", "1 ª", "ʰ"))
    assert not any(language.has_letter(t) for t in (None, "", "½", "²²", "①", "Ⅷ", "12 _ !", "😀"))


def test_a_language_left_out_is_rejected_and_the_others_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    for out in ("en", "de"):
        model = language.fit(docs.filter(f"lang <> '{out}'"))
        rows = language.predict(docs, model, "p").select("lang", "p.rejected").collect()
        own = [r.rejected for r in rows if r.lang == out]
        others = [r.rejected for r in rows if r.lang != out]
        assert sum(own) >= 0.95 * len(own) and sum(others) <= 0.01 * len(others)


def test_odd_texts_do_not_move_the_bound(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").filter(
        "lang = 'fr'")
    short = spark.createDataFrame([(10_000_000 + i, t, "fr") for i, t in enumerate(
        ["x", "a 1", "qz"] * 3)], "doc_id long, text string, lang string")
    bound = [language.fit(d)[3].min() for d in (docs, docs.unionByName(short))]
    assert bound[1] > 0.75 * bound[0]


def test_one_id_with_two_texts_keeps_both(spark):
    a, b = ("first text of some length that nothing else repeats today",
            "quite another text under the same id which nobody copied ever")
    c = "a third one of its own with words enough for several shingles"
    rows = [(1, a, "en", "s"), (5, a, "en", "s"), (5, b, "en", "s"), (5, b, "en", "s"),
            (None, c, "en", "s"), (None, c, "en", "s"), (9, None, "en", "s"), (9, "", "en", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = durable(docs.repartition(3), "docs")
    got = sorted(((r.doc_id, r.text) for r in P.one_of_each_group(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, a), (5, b), (None, c), (9, None), (9, "")], key=str)
