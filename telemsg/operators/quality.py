"""Counts and data-quality figures.

Every figure is an aggregation that Spark computes with a map-side partial
aggregate, so the shuffle carries one row per group and task, whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(df: DataFrame, keys: list[str] | str = ("MODEL_CODE", "MODEL_YEAR")) -> DataFrame:
    """A1/A2: row count per key, ordered by key (O2)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def distinct_values(df: DataFrame, col: str = "MODEL_CODE") -> DataFrame:
    """Distinct values of a column."""
    return df.select(col).distinct()


def has_error(c: Column) -> Column:
    """the decoded text contains ``error`` (lower case, as the reference tests it)."""
    return F.coalesce(c.contains("error"), F.lit(False))


def decoding_summary(df: DataFrame, decoded_cols: list[str], flattened_cols: list[str]) -> DataFrame:
    """A4/A5: one row: total rows, column counts, rows with errors and non-null
    values per decoded column, and the success rate. One pass over the data."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for c in decoded_cols:
        aggs.append(F.count(F.col(c)).alias(f"{c}_decoded_rows"))
        aggs.append(F.sum(has_error(F.col(c).cast("string")).cast("int")).alias(f"{c}_error_rows"))
    out = df.agg(*aggs).withColumns(
        {
            "total_columns": F.lit(len(df.columns)),
            "decoded_columns": F.lit(len(decoded_cols)),
            "flattened_columns": F.lit(len(flattened_cols)),
        }
    )
    if decoded_cols:
        errs = sum((F.col(f"{c}_error_rows") for c in decoded_cols), F.lit(0))
        dec = sum((F.col(f"{c}_decoded_rows") for c in decoded_cols), F.lit(0))
        out = out.withColumns(
            {
                "columns_with_errors": sum(
                    ((F.col(f"{c}_error_rows") > 0).cast("int") for c in decoded_cols), F.lit(0)
                ),
                "success_rate_pct": F.when(dec > 0, (dec - errs) * 100.0 / dec),
            }
        )
    return out


def observe_counts(df: DataFrame, name: str, condition: Column):
    """Total rows and rows meeting ``condition``, collected by an
    ``Observation`` while the real job runs (no extra job).
    Returns (observed DataFrame, observation); read ``observation.get`` after an action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(condition, 1).otherwise(0)).alias("kept_rows"),
    )
    return observed, obs


def observe_groups(df: DataFrame, groups: list[tuple[str, int]], family: str = "MODEL_CODE", year: str = "MODEL_YEAR"):
    """A6 per (family, year): the rows of each of ``groups`` (a short configured list) as ``g0``, ``g1``, ... beside
    ``total_rows``, collected while the real job runs. Returns (observed DataFrame, observation)."""
    from pyspark.sql import Observation

    obs = Observation()
    each = [
        F.count_if((F.col(family) == f) & (F.col(year) == y)).alias(f"g{i}") for i, (f, y) in enumerate(groups)
    ]
    return df.observe(obs, F.count(F.lit(1)).alias("total_rows"), *each), obs


def filter_counts(df: DataFrame, condition: Column, keys: list[str] | None = None) -> DataFrame:
    """A6 as a DataFrame: before / after / removed row counts (per key if given)."""
    aggs = [
        F.count(F.lit(1)).alias("rows_before"),
        F.sum(F.when(condition, 1).otherwise(0)).alias("rows_after"),
    ]
    out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return out.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def in_families(df: DataFrame, families: list[str], col: str = "MODEL_CODE") -> DataFrame:
    """rows of the named families."""
    return df.filter(F.col(col).isin(list(families)))


def with_value(df: DataFrame, *cols: str) -> DataFrame:
    """rows where all the columns are present."""
    return df.dropna(subset=list(cols))


def by_time(df: DataFrame, order: list[str] | str = "app_timestamp", limit: int | None = None) -> DataFrame:
    """O1 / O3: rows in time order (a range-partitioned sort); with ``limit`` the first ones only, by a top-n."""
    out = df.orderBy(*([order] if isinstance(order, str) else order))
    return out if limit is None else out.limit(limit)
