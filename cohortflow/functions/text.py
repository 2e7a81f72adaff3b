"""String helpers as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_list(values: str, sep: str = ", ") -> Column:
    """Aggregate over SQL expression ``values``: sorted distinct non-NULL values
    joined by ``sep``; NULL when there are none.

    ``collect_set`` is combined map-side, so a hot group only ships its distinct
    values to the reducer.
    """
    arr = f"array_sort(collect_set({values}))"
    return F.expr(f"CASE WHEN size({arr}) > 0 THEN array_join({arr}, '{sep}') END")


def replace_all(c: Column, pairs) -> Column:
    """Apply literal (search, replacement) pairs in order."""
    for search, repl in pairs:
        c = F.replace(c, F.lit(search), F.lit(repl))
    return c
