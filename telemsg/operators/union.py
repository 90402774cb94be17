"""Set operations over decoded tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by column name; with ``allow_missing`` a column absent from a
    frame is null there. Frames whose columns clash in type raise, never mix silently."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def drop_duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """U4: drop duplicates on ``keys`` (all columns when None)."""
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()
