"""Every registered query equals its SQL on the smallest tables."""

import hashlib

import pytest
from compare import compare, duck

from tidemark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, name, QUERIES[name], SF)
    assert problem is None or problem.startswith("no rows expected"), problem


def test_entry_points(spark):
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["near_duplicate_part_names", "part_watch_list"])
def test_titles_are_whole(spark, tmp_path, name):
    """Titles that share twelve words and differ after them, and the other way round."""
    head, tail = " ".join(f"same{i}" for i in range(12)), " ".join(f"tail{i}" for i in range(40))
    rows = [(1, head + " " + tail), (2, head + " " + tail.replace("tail", "other")),
            (3, "unlike " * 12 + head + " " + tail)]
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(
        str(tmp_path / "part.parquet"))
    got = {r.id: r.duplicates for r in QUERIES[name].run(spark, str(tmp_path)).collect()}
    assert got == {"p1": 1, "p2": 0, "p3": 1}


def test_texts_addresses_and_filters_are_whole(spark, tmp_path):
    text = "Write to someone.here@mail.org or another_one@mail.org; " + "long " * 20
    rows = [(1, f" {text}a\n", "src1"), (2, f" {text}b\n", "src1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    sf = str(tmp_path)
    heads = {r.head for r in QUERIES["stripped_texts"].run(spark, sf).collect()}
    assert heads == {hashlib.md5(f"{text}{x}".encode()).hexdigest()[:8] for x in "ab"}
    found = QUERIES["all_severed_addresses"].run(spark, sf).collect()
    assert sorted((r.doc_id, r.found) for r in found) == [(i, True) for i in (1, 1, 2, 2)]
    assert "LIMIT" not in QUERIES["event_filter_whole"].sql
    spark.range(300, 1900).selectExpr(
        "id * 5 AS o_orderkey", "3L AS o_custkey", "DATE '1997-03-04' AS o_orderdate",
        "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus").write.parquet(
        str(tmp_path / "orders.parquet"))
    assert QUERIES["event_filter_whole"].run(spark, sf).count() == 1600
