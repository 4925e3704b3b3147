"""Change detection against a snapshot of (key, status)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changes(current: DataFrame, previous: DataFrame | None, first_run: Column | None = None) -> DataFrame:
    """Rows of ``current`` (key, status, ...) that are new or have another status. Without a previous snapshot,
    those for which ``first_run`` holds (all if it is None). Keys that are gone are not rows of the result."""
    if previous is None:
        return current if first_run is None else current.filter(first_run)
    old = previous.select("key", F.col("status").alias("__old"), F.lit(True).alias("__seen"))
    met = current.join(old, "key", "left")
    return met.filter(F.col("__seen").isNull() | ~F.col("status").eqNullSafe(F.col("__old"))).drop("__old", "__seen")


def next_snapshot(current: DataFrame) -> DataFrame:
    """What replaces the snapshot, once the changes are validated and written: keys that are gone leave it."""
    return current.select("key", "status").distinct()
