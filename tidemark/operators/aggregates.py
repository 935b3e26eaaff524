"""Counts, distributions, profiles and summaries of collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import research as R
from tidemark.functions.text import is_blank, strip
from tidemark.operators.joins import lookup_join
from tidemark.operators.ranking import rank_within


def tally(df: DataFrame, *columns: str, as_text: bool = False) -> DataFrame:
    """(field, value, n) counts of several columns in one pass."""
    kind = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None")) if as_text \
        else F.col(c).cast("string")
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), kind(c).alias("value"))
                      for c in columns])
    return (df.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value")
            .agg(F.count("*").alias("n")))


def impact_variables(df: DataFrame, impacts: str = "impacts") -> DataFrame:
    return (df.select(F.explode(impacts).alias("i"))
            .filter(F.coalesce(F.col("i.variable"), F.lit("")) != "")
            .groupBy(F.col("i.variable").alias("variable")).agg(F.count("*").alias("n")))


def sign_buckets(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(F.count_if(c.isNull()).alias("null"), F.count_if(c < 0).alias("negative"),
                  F.count_if(c == 0).alias("zero"), F.count_if(c > 0).alias("positive"))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Exact values as text; null is the text ``None``."""
    return (df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("value"))
            .agg(F.count("*").alias("n")))


def year_range(df: DataFrame, year: str = "year") -> DataFrame:
    """Smallest and largest year; 0 and null do not count."""
    y = F.nullif(F.col(year), F.lit(0))
    return df.agg(F.min(y).alias("year_min"), F.max(y).alias("year_max"))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.bround(F.lit(100.0) * part / whole, 1))


def description_quality(df: DataFrame, text: str, short: int = 60) -> DataFrame:
    """One row of measured facts about a description column."""
    body = F.coalesce(F.col(text), F.lit(""))
    n, low = F.length(body), F.lower(body)
    whole = F.count("*")
    counts = {
        "under_60_chars": F.count_if(n < short),
        "starts_with_introduction": F.count_if(strip(low).startswith("introduction")),
        "contains_introduction_anywhere": F.count_if(F.contains(low, F.lit("introduction"))),
        "empty": F.count_if(is_blank(body)),
    }
    return df.agg(
        whole.alias("total"), *[c.alias(k) for k, c in counts.items()],
        *[percent(counts[k], whole).alias(f"{k}_pct") for k in list(counts)[:3]],
        F.min(n).alias("length_min"), F.floor(F.percentile(n, F.lit(0.5))).alias("length_median"),
        F.floor(F.sum(n) / whole).alias("length_mean"), F.max(n).alias("length_max"))


def import_families(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(R.import_family(F.col(key)).alias("family")).agg(F.count("*").alias("n"))


_VARIANT_TYPES = {"BIGINT": "int", "DOUBLE": "float", "STRING": "str", "BOOLEAN": "bool",
                  "VOID": "NoneType"}


def field_profile(df: DataFrame, raw: str) -> DataFrame:
    """(field, types, present, present_pct) of a column of JSON objects.

    Types are reduced to distinct (field, type) before they are gathered.
    """
    doc = F.try_parse_json(raw)
    fields = F.json_object_keys(raw)
    total = df.agg(F.count("*").alias("total"))
    kind = F.schema_of_variant(F.col("value"))
    name = F
    for spark_type, label in _VARIANT_TYPES.items():
        name = name.when(kind == spark_type, F.lit(label))
    name = (name.when(kind.startswith("DECIMAL"), F.lit("float"))
            .when(kind.startswith("ARRAY"), F.lit("list")).otherwise(F.lit("dict")))
    pairs = F.map_entries(doc.cast("map<string,variant>"))
    rows = (df.filter(fields.isNotNull()).select(F.explode(pairs).alias("e"))
            .select(F.col("e.key").alias("field"), F.col("e.value").alias("value"))
            .groupBy("field", name.alias("type")).agg(F.count("*").alias("n")))
    # total is one row
    return (rows.groupBy("field").agg(F.array_join(F.array_sort(F.collect_list("type")), ", ")
                                      .alias("types"), F.sum("n").alias("present"))
            .join(F.broadcast(total)).select(
                "field", "types", "present",
                percent(F.col("present"), F.col("total")).alias("present_pct")))


def organisation_stats(df: DataFrame, *, flag: str, date: str, organisations: str,
                       since: str = "2000") -> DataFrame:
    """(org, n, first, last) over flagged rows dated from ``since`` on."""
    day = strip(F.coalesce(F.col(date), F.lit("")))
    return (df.filter(strip(F.col(flag)) == "True")
            .filter((day != "") & (F.left(day, F.lit(4)) >= since))
            .select(day.alias("day"), F.explode(F.split(organisations, ",")).alias("org"))
            .withColumn("org", strip(F.col("org"))).filter("org <> ''")
            .groupBy("org").agg(F.count("*").alias("n"), F.min("day").alias("first"),
                                F.max("day").alias("last")))


def overlay_coverage(df: DataFrame, overlay: DataFrame, key: str) -> DataFrame:
    """Rows with an overlay, all rows and the percentage."""
    flags = df.select(key).join(overlay.select(key).distinct().withColumn("_o", F.lit(1)), key,
                                "left")
    return flags.agg(F.count("_o").alias("with_overlay"), F.count("*").alias("total"),
                     percent(F.count("_o"), F.count("*")).alias("coverage_pct"))


def review_outcomes(reviews: DataFrame) -> DataFrame:
    """(reviewer, verdict, n)."""
    named = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown"))
    return reviews.groupBy(named("reviewer").alias("reviewer"),
                           named("verdict").alias("verdict")).agg(F.count("*").alias("n"))


def ordered_groups(df: DataFrame, group: str, order: Sequence[Column], place: str,
                   size: str) -> DataFrame:
    """All rows with their place in their group and its size; no group is sorted in one task."""
    sizes = df.groupBy(group).agg(F.count("*").alias(size))
    return lookup_join(rank_within(df, [group], order, place), sizes, [group])
