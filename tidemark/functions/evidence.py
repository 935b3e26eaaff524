"""Evidence expressions: source grades and dates found in quotes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import text as X


def grade(publisher: Column, url: Column, dated: Column) -> Column:
    """Evidence grade from the class of source alone."""
    pub = F.lower(F.coalesce(publisher, F.lit("")))
    link = F.lower(F.coalesce(url, F.lit("")))
    return (F.when(~dated, "none")
            .when(X.any_present(pub, K.REGISTRY_MARKS) | X.any_present(link, K.REGISTRY_MARKS),
                  "registry")
            .when(X.any_present(pub, ("first-party", "official")), "first_party")
            .when(F.contains(pub, F.lit("wikipedia"))
                  | X.any_present(link, ("wikipedia", "baike")), "secondary")
            .when(X.any_present(link, ("forbes.com/companies", "investing.com")), "secondary")
            .otherwise("press"))


def missing_date_part(iso: Column, precision: Column, quote: Column) -> Column:
    """The first part of a partial date its quote does not carry, or null."""
    words = X.evidence_text(F.coalesce(quote, F.lit("")))
    parts = F.split(iso, "-")
    n = F.size(parts)
    year = parts[0]
    month = F.get(parts, F.lit(1)).try_cast("int")
    day = F.get(parts, F.lit(2)).try_cast("int")
    names = F.array(*[F.lit("|".join(rf"\b{w}" for w in group)) for group in K.MONTH_WORDS])
    month_hit = (F.regexp_like(words, F.concat(F.lit("(?U)"), F.get(names, month - 1)))
                 | F.contains(words, F.concat(year, F.lit("-"),
                                              F.lpad(month.cast("string"), 2, "0"))))
    day_hit = F.regexp_like(words, F.concat(
        F.lit(r"(?U)\b0?"), day.cast("string"), F.lit(r"(?:st|nd|rd|th)?\b")))
    return (F.when(X.empty(iso) | X.empty(quote), "quote")
            .when(~F.regexp_like(words, F.concat(F.lit(r"(?U)\b"), year, F.lit(r"\b"))), "year")
            .when(precision == "year", F.lit(None))
            .when((n < 2) | ~F.coalesce(month_hit, F.lit(False)), "month")
            .when(precision == "month", F.lit(None))
            .when((n < 3) | ~F.coalesce(day_hit, F.lit(False)), "day"))
