"""Grant expressions: who received it and what kind it is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import text as X


def recipient_type(name: Column) -> Column:
    marks = reduce(lambda a, b: a | b,
                   [F.contains(name, F.lit(m)) for m in K.ORGANISATION_MARKS])
    parts = F.size(F.split(X.collapse_space(name), " "))
    return (F.when(X.empty(name), "unknown").when(marks, "organization")
            .when((parts >= 2) & ~name.rlike(r"(?U)\d"), "individual")
            .otherwise("organization"))


def grant_type(description: Column, focus_area: Column) -> Column:
    text = F.lower(F.concat(F.coalesce(description, F.lit("")), F.lit(" "),
                            F.coalesce(focus_area, F.lit(""))))
    has = lambda *w: X.any_present(text, w)
    return (F.when(has("fellow"), "Individual Fellowship")
            .when(has("research"), "Research Grant")
            .when(has("general", "operational", "support"), "General Support")
            .when(has("project"), "Project Grant").otherwise("General Grant"))
