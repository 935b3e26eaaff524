"""Joins, ranks, de-duplication, similarity and tagging on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators import dedup, joins, similarity
from tidemark.operators import ranking as RK
from tidemark.operators import tagging as TG
from tidemark.plans import candidates as PC


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tier_sizes_of_the_published_feed():
    ends = RK.tier_ends(3434, K.DEFAULT_PROFILE["tier_quantiles"])
    sizes = [e - s for _, s, e in ends]
    assert [*sizes, 3434 - ends[-1][2]] == [172, 687, 1717, 858]


def python_tiers(scores, quantiles):
    order = sorted(range(len(scores)), key=lambda i: -scores[i])
    out = ["D"] * len(scores)
    for name, s, e in RK.tier_ends(len(scores), quantiles):
        for i in order[s:e]:
            out[i] = name
    return out


@pytest.mark.parametrize("n,window,distinct", [(2, 1_000, 3), (500, 1_000, 4), (500, 0, 4),
                                               (300, 0, 300), (1, 1_000, 1)])
def test_quantile_tiers(spark, monkeypatch, n, window, distinct):
    if distinct == 300:
        monkeypatch.setattr(RK, "_SMALL_SCORE_TABLE", 50)
    rng = random.Random(n)
    scores = [rng.randrange(distinct) / 10 for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(scores)), "o int, s double")
    quantiles = [("A", 0.05), ("B", 0.2), ("C", 0.5)]
    got = dict(RK.quantile_tiers(df, "s", [F.col("o")], quantiles, window_rows=window)
               .select("o", "tier").collect())
    assert [got[i] for i in range(n)] == python_tiers(scores, quantiles)


@pytest.mark.parametrize("window", [1_000_000, 0])
def test_distinct_percentile_with_one_hot_group(spark, window):
    rng = random.Random(7)
    data = [("hot" if i % 3 else f"g{i % 20}", rng.randrange(40)) for i in range(900)]
    data.append(("alone", 5))
    df = spark.createDataFrame(data, "g string, v int")
    want = {}
    for g in {g for g, _ in data}:
        values = sorted({v for h, v in data if h == g})
        for i, v in enumerate(values):
            want[(g, v)] = 0.5 if len(values) == 1 else i / (len(values) - 1)
    got = RK.distinct_percentile(df, ["g"], "v", window_rows=window).collect()
    assert len(got) == len(data)
    assert all(abs(r["percentile"] - want[(r["g"], r["v"])]) < 1e-12 for r in got)
    assert all(r["group_size"] == sum(g == r["g"] for g, _ in data) for r in got)


def test_shrink(spark):
    df = spark.range(1).select(RK.shrink(F.lit(1.0), F.lit(12), 12), RK.shrink(F.lit(1.0), F.lit(1), 0))
    assert tuple(df.first()) == (0.75, 1.0)


def test_rank_within_follows_order(spark):
    data = [(g, v) for g in ("a", "b") for v in random.Random(3).sample(range(1000), 200)]
    got = RK.rank_within(spark.createDataFrame(data, "g string, v int"), ["g"], [F.desc("v")])
    for g in ("a", "b"):
        ranked = [r["v"] for r in sorted((r for r in got.collect() if r["g"] == g),
                                         key=lambda r: r["rank"])]
        assert ranked == sorted((v for h, v in data if h == g), reverse=True)


def test_lookup_join_salts_hot_keys(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(600)],
                                 "i int, k string")
    right = left.select("k").distinct().withColumn("x", F.length("k"))
    want = rows(left.join(right, "k").select("i", "x"))
    assert rows(joins.lookup_join(left, right, ["k"], limit=10).select("i", "x")) == want
    half = right.filter("k <> 'hot'")
    assert joins.lookup_join(left, half, ["k"], "left", limit=10).filter("x is null").count() == 400


def test_fill_down_crosses_blocks(spark):
    data = [("s", i, "v%d" % i if i in (2, 9) else None) for i in range(20)]
    df = spark.createDataFrame(data, "s string, n int, v string")
    got = joins.fill_down(df, ["s"], ["n"], F.floor(F.col("n") / 4), {"f": F.col("v")})
    filled = [r["f"] for r in got.orderBy("n").collect()]
    assert filled == [None] * 2 + ["v2"] * 7 + ["v9"] * 11


def test_dedup_rules(spark):
    df = spark.createDataFrame([("f1", 1, "a", "x"), ("f1", 2, "a", "y"), ("f1", 3, None, "z"),
                                ("f1", 4, "", "w"), ("f2", 1, "a", "v")],
                               "f string, n int, id string, t string")
    assert sorted(r["t"] for r in dedup.keep_first(df, ["f"], "id", "n").collect()) == [
        "v", "w", "x", "z"]
    last = df.filter("n = 1")
    assert [r["t"] for r in dedup.keep_last_file(last, "id", "f").collect()] == ["v"]


def test_precedence_keeps_raw_provenance(spark):
    df = spark.createDataFrame([("a", "one", 1), ("a", "two", 2), ("a", "enriched", 3),
                                ("b", "enriched", 4), ("c", "two", 5), ("d", "other", 6)],
                               "id string, file string, v int")
    out = dedup.keep_by_precedence(df, "id", "file", ["one", "two"], "enriched")
    assert rows(out.select("id", "v", "provenance")) == [
        ("a", 3, "two"), ("b", 4, "enriched"), ("c", 5, "two")]
    assert rows(dedup.undeclared_files(df, "file", ["one", "two", "enriched"])) == [("other",)]


def test_alias_counts_twice_unless_told_not_to(spark):
    labs = spark.createDataFrame([("l", "Org", ["Org", "Old"])],
                                 "id string, name string, aliases array<string>")
    stats = spark.createDataFrame([("Org", 2, "2001", "2002"), ("Old", 1, "1999", "2000")],
                                  "org string, n int, first string, last string")
    kw = dict(key="id", name="name", aliases="aliases", stat_name="org")
    assert joins.alias_totals(labs, stats, **kw).first()["n"] == 5
    assert joins.alias_totals(labs, stats, repeat_names=False, **kw).first()["n"] == 3


# --- similarity --------------------------------------------------------------------------

def python_pairs(items):
    def toks(t):
        import re
        return {w for w in re.findall("[a-z0-9]+", t.lower()) if len(w) > 2} - set(K.TITLE_STOPWORDS)
    out = set()
    for (i, t, d), (j, u, e) in itertools.combinations(items, 2):
        a, b = toks(t), toks(u)
        if not a or not b:
            continue
        jac = len(a & b) / len(a | b)
        near = d and e and abs((d - e).days) <= 3
        if jac >= 0.5 or (jac >= 0.3 and near):
            out |= {(i, j), (j, i)}
    return out


@pytest.mark.parametrize("most", [2000, 1, 12])
def test_near_duplicates_equal_brute_force(spark, most):
    import datetime as dt
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta", "iota", "zeta"]
    base = dt.date(2026, 1, 1)
    items = []
    for i in range(160):
        n = rng.randrange(1, 8)
        title = "hot " * (i % 3 > 0) + " ".join(rng.choice(words) for _ in range(n))
        day = None if i % 9 == 0 else base + dt.timedelta(days=rng.randrange(30))
        items.append((f"r{i}", title, day))
    items += [(f"c{i}", "copy of one title here", base) for i in range(40)]
    df = spark.createDataFrame(items, "id string, title string, day date")
    members, edges = similarity.near_duplicate_titles(df, "id", "title", F.col("day"), most)
    none = spark.createDataFrame([], "id string, other string")
    got = similarity.possible_duplicates(members, edges, none, "id")
    want = python_pairs(items)
    # equal titles with far dates are separate sets but still strong overlap
    assert {tuple(r) for r in got.collect()} == want
    counts = dict(similarity.duplicate_counts(members, edges, "id").select("id", "duplicates")
                  .collect())
    for i, _, _ in items:
        assert counts.get(i, 0) == sum(a == i for a, _ in want)


def test_a_common_pair_is_split_until_groups_are_small(spark, monkeypatch):
    """Titles so short that two words which all of them hold are in every prefix."""
    rng = random.Random(3)
    items = [(f"r{i}", " ".join(["aaa", "bbb", *(f"w{rng.randrange(40)}" for _ in range(1 + i % 3 % 2 * 2))]),
              None) for i in range(160)] + [("q", "aaa bbb", None)]
    df = spark.createDataFrame(items, "id string, title string, day date")
    groups = []
    met = similarity._met
    monkeypatch.setattr(similarity, "_met", lambda left, right, on, t, d, exactly: (
        groups.append((exactly, right.groupBy(*on).count())), met(left, right, on, t, d, exactly))[1])
    members, edges = similarity.near_duplicate_titles(df, "id", "title", most=15)
    none = spark.createDataFrame([], "id string, other string")
    got = {tuple(r) for r in similarity.possible_duplicates(members, edges, none, "id").collect()}
    assert got == python_pairs(items)
    assert len(groups) > 2 and max((g.agg(F.max("count")).first()[0] or 0)
                                   for exactly, g in groups if not exactly) <= 15


def test_few_titles_on_many_dates(spark):
    """Titles are compared once, not once for each date, with the same pairs, counts and citations."""
    import datetime as dt
    rng = random.Random(13)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa"]
    named = [" ".join(rng.sample(words, rng.randrange(1, 5))) for _ in range(12)]
    items = [(f"r{i}", rng.choice(named), None if i % 11 == 0 else
              dt.date(2026, 1, 1) + dt.timedelta(days=rng.randrange(50))) for i in range(220)]
    df = spark.createDataFrame(items, "id string, title string, day date")
    members, edges = similarity.near_duplicate_titles(df, "id", "title", F.col("day"))
    sets = members.select("set_id").distinct().count()
    assert sets <= 12 and edges.count() <= sets * (sets - 1) // 2
    cited = [(f"r{i}", f"r{i * 7 % 220}") for i in range(1, 220)]
    got = [tuple(r) for r in similarity.possible_duplicates(
        members, edges, spark.createDataFrame([], "id string, other string"), "id").collect()]
    want = python_pairs(items)
    assert len(got) == len(want) and set(got) == want
    counts = {r["id"]: r["duplicates"] for r in similarity.duplicate_counts(members, edges, "id").collect()}
    assert counts == {i: sum(a == i for a, _ in want) for i, _, _ in items}
    apart = similarity.cited_apart(members, edges, spark.createDataFrame(cited, "id string, other string"), "id")
    assert set(rows(apart)) == set(cited) - want - {(a, a) for a, _ in cited}


def _rows_of_joins(plan):
    """Rows that each join of a finished plan made."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return _rows_of_joins(plan.executedPlan())
    inner = [plan.plan()] if "QueryStage" in name else [
        plan.children().apply(i) for i in range(plan.children().size())]
    own = [plan.metrics().apply("numOutputRows").value()] if "Join" in name else []
    return own + [n for p in inner for n in _rows_of_joins(p)]


def test_pairs_are_written_out_from_blocks(spark, monkeypatch):
    """Copies meet by blocks: no join makes a row for each pair, or holds the pairs of a record at once."""
    import datetime as dt
    for name, n in (("BLOCK_ROWS", 40), ("SLICE_ROWS", 3), ("SLICES_A_COPY", 5), ("PAIRS_A_TASK", 2_000)):
        monkeypatch.setattr(similarity, name, n, raising=False)
    rng = random.Random(17)
    named = ["alpha", "alpha beta", "alpha gamma", "beta gamma delta", "kappa"]
    items = [(f"r{i}", named[rng.randrange(5) if i % 3 else 1], None if i % 7 == 0 else
              dt.date(2026, 1, 1) + dt.timedelta(days=rng.randrange(8))) for i in range(330)]
    items.append(("single", "unlike anything", None))
    df = spark.createDataFrame(items, "id string, title string, day date")
    members, edges = similarity.near_duplicate_titles(df, "id", "title", F.col("day"))
    assert sorted({r["dated"] for r in edges.collect()}) == [False, True]
    pairs = similarity.possible_duplicates(
        members, edges, spark.createDataFrame([], "id string, other string"), "id")
    got, want = [tuple(r) for r in pairs.collect()], python_pairs(items)
    assert len(got) == len(want) and set(got) == want
    made = _rows_of_joins(pairs._jdf.queryExecution().executedPlan())
    assert made and max(made) * 10 < len(want)


def test_thresholds_at_their_edges(spark):
    import datetime as dt
    d = dt.date(2026, 1, 10)
    items = [("a", "one1 two2", d), ("b", "one1 two2 thr3 fou4", dt.date(2025, 1, 1)),
             ("c", "aaa bbb ccc ddd eee fff ggg", d),
             ("d", "aaa bbb ccc hhh iii jjj", dt.date(2026, 1, 13)),
             ("e", "aaa bbb ccc kkk lll mmm", dt.date(2026, 1, 14))]
    df = spark.createDataFrame(items, "id string, title string, day date")
    members, edges = similarity.near_duplicate_titles(df, "id", "title", F.col("day"))
    none = spark.createDataFrame([], "id string, other string")
    got = {tuple(r) for r in similarity.possible_duplicates(members, edges, none, "id").collect()}
    assert got == python_pairs(items)
    assert ("a", "b") in got and ("c", "d") in got and ("c", "e") not in got


def test_citations(spark):
    df = spark.createDataFrame([("one_two_three", "see four_five_six and one_two_three"),
                                ("four_five_six", "no_such_slug ok"), ("x_y_z", "a_b")],
                               "id string, f string")
    cites = similarity.citations(df, "id", F.col("f"))
    assert rows(similarity.citation_edges(cites, df, "id")) == [
        ("four_five_six", "one_two_three"), ("one_two_three", "four_five_six")]
    served = spark.createDataFrame([("no_such_slug",)], "id string")
    bad, external = similarity.unresolved_citations(cites, df, served, "id")
    assert bad.count() == 0 and external.count() == 1


# --- tagger ----------------------------------------------------------------------------------

def test_tagger_abstains(spark):
    train = spark.createDataFrame(
        [("bio", "virus cell protein genome"), ("bio", "cell virus vaccine"),
         ("war", "missile drone soldier army"), ("war", "army weapon drone")],
        "d string, text string")
    weights, domains = TG.train(TG.token_counts(train, ["d"], "text"), "d")
    assert domains == ["bio", "war"]
    df = spark.createDataFrame(
        [("1", "virus cell protein vaccine"), ("2", "army"), ("3", "qqq www zzz yyy"),
         ("4", "virus cell army drone"), ("5", "")], "id string, text string")
    got = {r["id"]: (r["domain"], r["reason"]) for r in
           TG.classify(df, "id", "text", weights, domains).collect()}
    assert got["1"] == ("bio", "ok")
    assert got["2"] == (None, "too_few_tokens") and got["5"] == (None, "too_few_tokens")
    assert got["3"] == (None, "margin_below_threshold")


def test_tagger_salted_model_gives_the_same_result(spark):
    rng = random.Random(5)
    words = [f"w{i}x" for i in range(50)]
    train = spark.createDataFrame(
        [("ab"[i % 2], " ".join(rng.choices(words[:30] if i % 2 else words[20:], k=12)))
         for i in range(60)], "d string, text string")
    weights, domains = TG.train(TG.token_counts(train, ["d"], "text"), "d")
    df = spark.createDataFrame([(i, "w1x " + " ".join(rng.choices(words, k=9))) for i in range(80)],
                               "id int, text string")
    a = rows(TG.classify(df, "id", "text", weights, domains).select("id", "domain", "reason"))
    b = rows(TG.classify(df, "id", "text", weights, domains, model_rows=3)
             .select("id", "domain", "reason"))
    assert a == b


# --- candidates ---------------------------------------------------------------------------------

def candidate(spark, data):
    return spark.createDataFrame(
        data, "id string, _ord int, kind string, title string, published_at string, "
        "signals map<string,array<struct<observed_at:string,value:double>>>, "
        "extra map<string,string>, forum_tags array<string>")


def test_score_profile_edge_cases(spark):
    sig = lambda n, v: {n: [("2026", v)]}
    data = [("s:1", 1, "forum_post", "AI safety", "2024-01-01", sig("karma", 10.0), {}, []),
            ("s:2", 2, "forum_post", "cats", "2024-01-02", sig("karma", 10.0), {}, []),
            ("s:3", 3, "forum_post", "AI", "2024-01-03", sig("karma", 90.0), {}, ["safety"]),
            ("s:4", 4, "model_release", "M", None, {}, {"frontier_model": "TRUE"}, []),
            ("s:5", 5, "rumour", "x", "2024-01-01", sig("karma", 5.0), {}, []),
            ("s:6", 6, "model_release", "N", "2024-01-01", sig("training_compute_flop", 0.0), {}, [])]
    got = {r["id"]: r for r in PC.score_profile(candidate(spark, data), K.DEFAULT_PROFILE).collect()}
    assert got["s:4"]["basis"]["percentile_within"] == "kind=model_release,year=____"
    assert got["s:4"]["salience"] == 0.5 and got["s:4"]["basis"]["method"] == "no_signal_available"
    assert got["s:5"]["basis"]["method"] == "kind_not_scored_by_profile"
    assert got["s:6"]["basis"]["method"] == "no_signal_available"
    # three in the group: shrink 3 / 15; ties share a percentile
    assert got["s:3"]["salience"] == 0.6 and got["s:1"]["salience"] == 0.4
    assert got["s:2"]["salience"] == 0.1
    assert got["s:3"]["tier"] == "A"


def test_two_profiles_side_by_side(spark):
    other = {**K.DEFAULT_PROFILE, "profile_id": "flat_v1", "shrinkage_k": 0}
    data = [("s:%d" % i, i, "forum_post", "AI safety", "2024-01-01", {"karma": [("2026", float(i))]},
             {}, []) for i in range(5)]
    out = PC.score_all(candidate(spark, data), [K.DEFAULT_PROFILE, other])
    top = out.filter("id = 's:4'").first()
    assert top["salience_by_profile"]["flat_v1"] == 1.0
    assert top["salience_by_profile"]["default_v1"] < 1.0
    for mode in ("spread", "salience", "privacy", "date"):
        view = out.withColumn("privacy_review_required", F.col("id") == "s:2")
        first = view.orderBy(*PC.queue_order(mode, "default_v1")).first()["id"]
        assert first == ("s:2" if mode == "privacy" else "s:0" if mode == "date" else first)


def test_children_of_a_hot_key_have_places(spark):
    rows = [("hot" if i % 3 else f"k{i}", i, [f"s{i % 7}", f"s{i}", f"s{(i * 5) % 11}"]) for i in range(60)]
    rows += [(None, 60, ["x", "y", "x"]), ("empty", 61, []), ("none", 62, None)]
    df = spark.createDataFrame(rows, "slug string, n int, items array<string>")
    want = set()
    for slug in {r[0] for r in rows}:
        seen = list(dict.fromkeys(x for r in rows if r[0] == slug for x in r[2] or []))
        want |= {(slug, x, i) for i, x in enumerate(seen, 1)}
    assert {tuple(r) for r in dedup.merged_children(df, "slug", "n", "items").collect()} == want
    parents = dedup.merged_parents(df.filter("slug is not null"), "slug", "n", ["n"])
    assert {r.slug: r.n for r in parents.collect()}["hot"] == 1


def test_profiles_from_files_share_every_shuffle(spark, tmp_path, monkeypatch):
    import json
    from tidemark.sources import overlays
    kinds = {**K.DEFAULT_PROFILE, "profile_id": "third", "version": "3", "shrinkage_k": 1,
             "tier_quantiles": [["A", 0.4], ["B", 0.4], ["C", 0.1]]}
    for p in (kinds, K.DEFAULT_PROFILE, {**K.DEFAULT_PROFILE, "profile_id": "flat", "shrinkage_k": 0}):
        (tmp_path / f"{p['profile_id']}.json").write_text(json.dumps(p))
    (tmp_path / "note.txt").write_text("no profile")
    found = overlays.profiles(spark, str(tmp_path))
    assert [p["profile_id"] for p in found] == ["default_v1", "flat", "third"]
    data = [(None if i % 7 == 0 else f"s:{i}", i, ["forum_post", "publication"][i % 2], "AI safety",
             f"202{i % 3}-01-01", {"karma": [("2026", float(i % 5))], "citations": [("2026", float(i % 4))]},
             {}, []) for i in range(40)]
    df = candidate(spark, data)
    writes = []
    durable = PC.durable
    monkeypatch.setattr(PC, "durable", lambda d, label: (writes.append(label), durable(d, label))[1])
    one = PC.score_all(df, found[:1])
    first, writes[:] = list(writes), []
    out = {r["_ord"]: r for r in PC.score_all(df, found).collect()}
    assert writes == first and len(out) == 40 and one.count() == 40
    for p in found:
        alone = PC.score_profile(df, p).collect()
        assert len(alone) == 40
        for r in alone:
            own, name = out[r["_ord"]], p["profile_id"]
            assert own["salience_by_profile"][name] == r["salience"]
            assert own["salience_tier_by_profile"][name] == r["tier"]
            assert own["salience_basis_by_profile"][name] == r["basis"]
    (tmp_path / "bad.json").write_text('{"profile_id": "x"}')
    with pytest.raises(ValueError, match="bad.json"):
        overlays.profiles(spark, str(tmp_path))


@pytest.mark.parametrize("limits", [{}, {"window_rows": 3}, {"score_rows": 2}])
def test_tiers_of_groups_are_cut_by_counts(spark, limits, monkeypatch):
    """Few scores need no ranking of all rows; ties on a cut, null scores and each way of working agree."""
    import random
    rng = random.Random(5)
    data = [(i, i % 2, rng.choice([None, 0.1, 0.2, 0.25, 0.5])) for i in range(400)]
    quantiles = {0: [("A", 0.05), ("B", 0.2)], 1: [("A", 0.5)]}
    want = {}
    for g, cuts in quantiles.items():
        rows = sorted((r for r in data if r[1] == g and r[2] is not None), key=lambda r: (-r[2], r[0]))
        ends = RK.tier_ends(len(rows), cuts)
        want |= {r[0]: next((t for t, a, b in ends if a <= n < b), "D") for n, r in enumerate(rows)}
    want |= {r[0]: "D" for r in data if r[2] is None}
    df = spark.createDataFrame(data, "id int, g int, s double").localCheckpoint()
    if not limits:
        monkeypatch.setattr(RK, "global_position", None)
    got = RK.quantile_tiers_by_group(df, "g", "s", [F.col("id")], quantiles, **limits).collect()
    assert {r.id: r.tier for r in got} == want and len(got) == len(data)


def test_a_join_on_its_unique_columns_looks_for_no_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "hot_keys", None)
    left = spark.createDataFrame([(1, None, "a"), (2, "x", "b")], "o int, id string, v string")
    right = left.select("o", "id", F.upper("v").alias("w"))
    got = joins.lookup_join(left, right, ["id", "o"], known_small=False, unique=["o", "id"]).collect()
    assert sorted((r.o, r.w) for r in got) == [(1, "A"), (2, "B")]


def test_queues_are_ordered_without_their_records(spark, monkeypatch):
    from tidemark.plans import queries_candidates as QC
    from tidemark.plans.catalog import QUERIES
    seen = []

    def position(df, order, name="position"):
        seen.append(df.columns)
        return RK.global_position(df, order, name)

    monkeypatch.setattr(QC, "global_position", position)
    QUERIES["review_queue_orders"].run(spark, "/root/testdata/sf0.001")
    assert [len(c) for c in seen] == [2, 3, 2]


def test_a_small_model_needs_no_counts_per_record(spark, monkeypatch):
    """Both ways of classifying agree; the broadcast one does not shuffle a row per token."""
    rng = random.Random(8)
    words = ["alpha", "beta-two", "gamma", "delta", "the", "ab", "omega"]
    data = [(i, "xy"[i % 2], " ".join(rng.choice(words) for _ in range(rng.randrange(12)))) for i in range(80)]
    df = spark.createDataFrame([*data, (99, "x", None)], "i int, d string, t string")
    weights, domains = TG.train(TG.token_counts(df, ["d"], "t"), "d")
    weights = weights.localCheckpoint()
    key = lambda d: sorted((r.i, r.domain or "", round(r.margin, 9), r.tokens, r.reason) for r in d.collect())
    want = key(TG.classify(df, "i", "t", weights, domains, model_rows=1))
    monkeypatch.setattr(TG, "token_counts", None)
    assert key(TG.classify(df, "i", "t", weights, domains)) == want


def test_unique_ids_are_counted_in_tasks_of_bounded_size(spark):
    from tidemark.plans import checks
    found = spark.range(5_000).selectExpr(
        "IF(id >= 0, 'c', 'd') AS collection", "CASE WHEN id < 4990 THEN CAST(id AS STRING) WHEN id < 4997 THEN 'twice' END AS id",
        "CAST(NULL AS STRING) AS rule", "id >= 0 AS gates")
    out = checks._repeated(found, 100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and ", 50), REPARTITION_BY_NUM" in plan
    assert sorted((r.id or "", r.detail) for r in out.collect()) == [("", "3"), ("twice", "7")]
