"""Null keys and values, map columns, and both size paths give one answer."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, joins, ranking
from tidemark.sinks import publish
from tidemark.workspace import durable, new_path, scope


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, None if i % 5 == 0 else i % 7, None if i % 6 == 0 else f"g{i % 3}")
            for i in range(60)]
    return durable(spark.createDataFrame(rows, "id int, score int, g string"), "scored")


def test_tiers_keep_rows_without_a_score(scored):
    cuts = [("A", 0.1), ("B", 0.3)]
    small, large = (ranking.quantile_tiers(scored, "score", [F.col("id")], cuts, score_rows=n)
                    for n in (1000, 0))
    a, b = (sorted(map(tuple, x.select("id", "tier").collect())) for x in (small, large))
    assert a == b and len(a) == 60
    assert all(t == "D" for i, t in a if i % 5 == 0)


def test_ranks_and_percentiles_keep_null_groups(scored):
    ranked = ranking.rank_within(scored, ["g"], [F.desc("score"), F.col("id")]).collect()
    assert len(ranked) == 60
    none = sorted(r["rank"] for r in ranked if r.g is None)
    assert none == list(range(1, len(none) + 1))
    for limit in (1000, 0):
        rows = ranking.distinct_percentile(scored, ["g"], "score", window_rows=limit).collect()
        assert len(rows) == 60 and all(r.percentile is not None for r in rows)


def test_lookup_join_both_ways_with_maps_and_nulls(spark):
    left = spark.range(300).select(
        "id", F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("k"),
        F.create_map(F.lit("a"), F.col("id")).alias("m"))
    right = spark.createDataFrame([("hot", 1), (None, 2)], "k string, v int")
    got = [sorted((r.id, r.v) for r in joins.lookup_join(
        left, right, ["k"], "left", known_small=s, unique=u).collect())
        for s, u in ((True, None), (False, ["id"]), (False, None))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 300
    assert sum(v == 2 for _, v in got[0]) == 50 and sum(v is None for _, v in got[0]) == 50


def test_fill_down_and_as_of_keep_null_keys(spark):
    rows = [(None, 1, "x"), (None, 2, None), ("a", 1, None), ("a", 2, "y"), ("a", 30, None)]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    got = joins.fill_down(df, ["k"], ["at"], F.floor(F.col("at") / 10), {"w": F.col("v")})
    assert sorted((r.k or "", r["at"], r.w or "") for r in got.collect()) == [
        ("", 1, "x"), ("", 2, "x"), ("a", 1, ""), ("a", 2, "y"), ("a", 30, "y")]
    left = spark.createDataFrame([(None, 5), ("a", 5)], "k string, at int")
    out = joins.as_of_join(left, df, "k", "at", "v", F.floor(F.col("at") / 10)).collect()
    assert sorted((r.k or "", r.v) for r in out) == [("", "x"), ("a", "y")]


def test_first_and_last_keep_null_scopes_and_ids(spark):
    rows = [(None, "i", 1), (None, "i", 2), ("f", "i", 1), ("f", None, 2), ("f", None, 3)]
    df = spark.createDataFrame(rows, "file string, id string, n int")
    kept = dedup.keep_first(df, ["file"], "id", "n").collect()
    assert sorted((r.file or "", r.id or "", r.n) for r in kept) == [
        ("", "i", 1), ("f", "", 2), ("f", "", 3), ("f", "i", 1)]
    last = dedup.keep_last_file(df.filter("file is not null or n = 1"), "id", "file").collect()
    assert {r.id for r in last} == {None, "i"}


def test_split_export_of_map_columns(spark):
    df = spark.range(40).select("id", F.when(F.col("id") % 4 > 0, "x").alias("by"),
                                F.create_map(F.lit("a"), F.col("id")).alias("m"))
    path = new_path(spark, "export")
    publish.split_export(df, path, "by", unique=["id"])
    assert spark.read.json(path).count() == 40


def test_scope_drops_its_tables(spark):
    with scope(spark):
        path = durable(spark.range(3), "scoped").inputFiles()[0]
    from urllib.parse import urlparse
    import os
    assert not os.path.exists(urlparse(path).path)


def test_a_folder_of_the_driver_is_no_shared_folder_on_a_cluster():
    from tidemark.workspace import _warehouse
    assert _warehouse("file:/tmp/w", "local[4]") == "file:/tmp/w"
    assert _warehouse("hdfs://n/w", "yarn") == "hdfs://n/w"
    for folder in ("file:/tmp/w", "/tmp/w", "spark-warehouse"):
        with pytest.raises(ValueError):
            _warehouse(folder, "spark://host:7077")
