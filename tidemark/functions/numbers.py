"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip


def parse_number(col: Column) -> Column:
    """A number with thousands commas; null on blank or bad input."""
    return strip(F.replace(col, F.lit(","), F.lit(""))).try_cast("double")


def parse_amount(col: Column) -> Column:
    """``$1,200``, ``12K`` and ``3M`` to a whole amount; null otherwise."""
    text = strip(F.replace(F.replace(col, F.lit("$"), F.lit("")), F.lit(","), F.lit("")))
    factor = (F.when(text.rlike("[Kk]$"), 1000.0).when(text.rlike("[Mm]$"), 1000000.0)
              .otherwise(1.0))
    value = strip(F.regexp_replace(text, "[KkMm]$", "")).try_cast("double") * factor
    return F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("bigint")


def transform(col: Column, name: str) -> Column:
    """log10 (null at or below 0), log10_plus1 (null below 0) or identity."""
    if name == "log10":
        return F.when(col > 0, F.log10(col))
    if name == "log10_plus1":
        return F.when(col >= 0, F.log10(col + F.lit(1.0)))
    return col.cast("double")


def population_spread(parts: Column) -> Column:
    """Population standard deviation of an array; 0 with fewer than two parts."""
    kept = F.array_compact(parts)
    n = F.size(kept)
    mean = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / n
    var = F.aggregate(kept, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n
    return F.when(n < 2, F.lit(0.0)).otherwise(F.sqrt(var))
