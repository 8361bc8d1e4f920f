"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(table: DataFrame, keep: list[str], array: Column, value: str, position: str = "_at") -> DataFrame:
    """One row per array item, with its position.

    The inner ``explode`` makes Catalyst filter on the size of the array first, which
    evaluates a computed array again; the outer form evaluates it once.
    """
    return table.select(*keep, F.posexplode_outer(array).alias(position, value)).filter(F.col(position).isNotNull())
