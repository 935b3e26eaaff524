"""Date expressions. Unknown stays null; bad input never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import empty, strip

_ISO = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})?)?\n?\z"

# (shape, pattern) in order of preference; month first beats day first.
_COMMON = (
    (r"^\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}\z", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}\z", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}\z", "d/M/yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\z", "yyyy-M-d'T'H:m:s"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z\z", "yyyy-M-d'T'H:m:s'Z'"),
)
_GRANT = (
    (r"^\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}\z", "yyyy/M/d"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}\z", "MMMM d, yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}\z", "MMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}\z", "d MMMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}\z", "d MMM yyyy"),
)


def _first_parse(col: Column, formats) -> Column:
    tries = [F.try_to_timestamp(F.when(col.rlike(shape), col), F.lit(pattern))
             for shape, pattern in formats]
    return F.date_format(F.coalesce(*tries), "yyyy-MM-dd")


def normalise(col: Column) -> Column:
    """ISO passes; otherwise the first of six formats; otherwise unchanged."""
    return F.when(empty(col) | col.rlike(_ISO), col).otherwise(
        F.coalesce(_first_parse(col, _COMMON), col))


def grant_date(col: Column) -> Column:
    """Six formats with month names; null when none fits."""
    return _first_parse(strip(F.initcap(F.lower(col))), _GRANT)


def pad_partial(col: Column) -> Column:
    """YYYY and YYYY-MM to their first day; anything else null."""
    value = strip(col)
    return (F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}\z"), value)
            .when(value.rlike(r"^\d{4}-\d{2}\z"), F.concat(value, F.lit("-01")))
            .when(value.rlike(r"^\d{4}\z"), F.concat(value, F.lit("-01-01"))))


def calendar_date(col: Column) -> Column:
    """The date of an ISO date or timestamp string, or null."""
    shaped = F.when(col.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), col).when(
        col.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{3}|\.\d{6})?)?(Z|[+-]\d{2}:\d{2})?\z"),
        F.left(col, F.lit(10)))
    return F.try_to_timestamp(shaped, F.lit("yyyy-M-d")).cast("date")


def temporal_fields(col: Column) -> dict[str, Column]:
    """Year, quarter, month and decade; all null when the date does not parse."""
    day = calendar_date(col)
    year = F.year(day)
    return {
        "year": year,
        "quarter": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month": F.month(day),
        "decade": F.concat((year - year % 10).cast("string"), F.lit("s")),
    }


def year_or(col: Column, default: int = 2020) -> Column:
    """The first four characters as a year, else ``default``."""
    digits = strip(F.left(col, F.lit(4)))
    return F.coalesce(F.when(digits.rlike(r"^\d{1,4}\z"), digits.try_cast("int")), F.lit(default))


def precision_of(col: Column) -> Column:
    parts = F.size(F.split(col, "-"))
    return F.when(parts == 1, "year").when(parts == 2, "month").otherwise("day")


def precedes(a: Column, b: Column) -> Column:
    """Partial dates compared on their common prefix: is ``a`` before ``b``?"""
    n = F.least(F.length(a), F.length(b))
    return F.left(a, n) < F.left(b, n)
