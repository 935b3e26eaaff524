"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.text import strip


def drop_tracking(url: Column) -> Column:
    """Remove the tracking parameters, keep the others in order, trim."""
    base = F.split(url, r"\?", 2)
    tracked = F.array(*[F.lit(p) for p in K.TRACKING_PARAMETERS])
    kept = F.filter(F.split(base[1], "&"),
                    lambda p: ~F.array_contains(tracked, F.split(p, "=", 2)[0]))
    joined = F.when(F.size(kept) > 0,
                    F.concat(base[0], F.lit("?"), F.array_join(kept, "&"))).otherwise(base[0])
    return strip(F.when(F.contains(url, F.lit("?")), joined).otherwise(url))


def split_cell(cell: Column) -> Column:
    """The distinct URLs of a free-text cell, in order; prose is dropped."""
    tokens = F.transform(F.split(strip(F.coalesce(cell, F.lit(""))), K.PY_SPACE_CLASS + "+"),
                         lambda t: F.rtrim(t, F.lit(",;")))
    located = F.transform(
        tokens,
        lambda t: F.when(t.startswith("http://") | t.startswith("https://"), t)
        .when(F.lower(t).rlike(r"^[a-z0-9][a-z0-9.\-]*\.[a-z]{2,24}/"),
              F.concat(F.lit("https://"), t)))
    return F.array_distinct(F.array_compact(located))


def split_cells(cells: Column) -> Column:
    """Rewrite an array of cells; each cell is split on its own."""
    return F.flatten(F.transform(F.coalesce(cells, F.array().cast("array<string>")), split_cell))
