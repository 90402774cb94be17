"""Time-series operators per vehicle.

``forward_fill`` (W1) gives ``{c}_reference`` = last non-null value of ``c`` for
the same key, from the first row up to the current row, ordered by the order
columns. A plain ``Window.partitionBy(key)`` puts every row of a key in one task,
and one vehicle may hold a large share of all rows. So a hot key is cut along its order:

1. one narrow pass counts the rows of every key by a map-side aggregation and gathers, for keys of more than
   ``slice_rows`` rows, evenly spaced order values from a hash sample: the cuts. At most one key in ``slice_rows`` rows
   has any, so this table is far smaller than the input and is broadcast;
2. a second narrow pass, over hot keys only, takes the last non-null values of every slice; a window over these few
   rows carries them to the later slices of the key;
3. the rows are scanned once and shuffled once, by (key, slice), and filled inside the slice by a window; the carry
   comes by a broadcast.

The result equals the single-window fill for orders of any type, null keys and null orders (which come first) included.
A table bucketed by the key is filled without any exchange of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key beyond which it is cut into slices of about this size.
SLICE_ROWS = 2_000_000
_PER_SLICE = 8


def hot_cuts(df: DataFrame, key: str, order: list[str], slice_rows: int) -> DataFrame:
    """(_hot_key, _cuts): keys of more than ``slice_rows`` rows with the order values at which they are cut."""
    at = F.struct(*order)
    sampled = F.when(F.pmod(F.xxhash64(*order), F.lit(max(1, slice_rows // _PER_SLICE))) == 0, at)
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_set(sampled)).alias("_sample"))
    cuts = F.filter("_sample", lambda x, i: i % _PER_SLICE == _PER_SLICE - 1)
    return keys.where(F.col("_n") > slice_rows).select(F.col(key).alias("_hot_key"), cuts.alias("_cuts"))


def forward_fill(
    df: DataFrame,
    columns: list[str],
    key: str = "vin",
    order: list[str] | str = "app_timestamp",
    suffix: str = "_reference",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``{c}{suffix}`` for each column. ``order`` may hold a tie-breaker after the timestamp."""
    order = [order] if isinstance(order, str) else list(order)
    if not columns:
        return df
    at = F.struct(*order)
    cuts = F.broadcast(hot_cuts(df.select(*dict.fromkeys([key, *order])), key, order, slice_rows))
    nth = F.size(F.filter("_cuts", lambda c: c <= at))
    narrow = df.select(*dict.fromkeys([key, *order, *columns]))
    hot = narrow.join(cuts, narrow[key].eqNullSafe(F.col("_hot_key"))).withColumn("_slice", nth)
    last = hot.groupBy(key, "_slice").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in columns]
    )
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(
        F.col(key).alias("_carry_key"), F.col("_slice").alias("_carry_slice"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns],
    )
    rows = df.join(cuts, df[key].eqNullSafe(F.col("_hot_key")), "left")
    rows = rows.withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(nth)).drop("_hot_key", "_cuts")
    within = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumns({f"{c}{suffix}": F.last(c, ignorenulls=True).over(within) for c in columns})
    same = filled[key].eqNullSafe(F.col("_carry_key")) & (filled["_slice"] == F.col("_carry_slice"))
    out = filled.join(F.broadcast(carry), same, "left").withColumns(
        {f"{c}{suffix}": F.coalesce(f"{c}{suffix}", f"_carry_{c}") for c in columns}
    )
    return out.drop("_slice", "_carry_key", "_carry_slice", *[f"_carry_{c}" for c in columns])


def forward_fill_window(df: DataFrame, columns: list[str], key: str = "vin", order: list[str] | str = "app_timestamp",
                        suffix: str = "_reference") -> DataFrame:
    """W1 as a single window per key (the reference's plan); for keys known to be small."""
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({f"{c}{suffix}": F.last(c, ignorenulls=True).over(w) for c in columns})


def first_n_per_group(df: DataFrame, n: int, group: str | list[str] = "MODEL_CODE",
                      order: list[str] | str = "app_timestamp") -> DataFrame:
    """The first ``n`` rows of each group by order (a sampling operator).
    Implemented as a window top-n, which Spark plans with a partial per-task
    limit before the shuffle, so a hot group sends at most n rows per task."""
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
