"""Join helpers: broadcast only behind a size check, salt hot keys otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when the planner knows it to be at most this large.
MAX_BROADCAST_BYTES = 64 << 20


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of ``df`` in bytes: exact for written tables and local rows, an upper estimate otherwise.
    No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its planned size is at most ``max_bytes``; otherwise ``df`` unchanged, so the
    join is planned as a shuffle join that AQE can re-plan and split when skewed."""
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    salts: int = 32,
    salt_of: Column | None = None,
) -> DataFrame:
    """Equi-join for a small side too large to broadcast while the big side has
    hot keys: the big side gets a deterministic salt in [0, salts) from its own
    columns (stable under task retries), the small side is replicated per salt, so
    ``salts`` times its size is shuffled."""
    salt = salt_of if salt_of is not None else F.xxhash64(*[F.col(c) for c in big.columns])
    b = big.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, on + ["_salt"], how).drop("_salt")
