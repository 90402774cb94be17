"""Message validity by expected length.

The expected length of each message per (family, year) comes from the
catalogue. It is joined to the telemetry as a small dimension (one row per
(family, year), one length column per message), so every message of a row is
checked with one broadcast join instead of a per-row lookup.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemsg.plans.joins import checked_broadcast

SENTINEL = "E#1"  # fixed value: the capture's "no answer" marker named by the reference


def reference_lengths(lengths: DataFrame, messages: list[str]) -> DataFrame:
    """(family, year, {msg}_reference_len ...) from (family, year, msg, length)."""
    aggs = [F.max(F.when(F.col("msg") == m, F.col("length"))).alias(f"{m}_reference_len") for m in messages]
    return lengths.groupBy("family", "year").agg(*aggs)


def add_reference_lengths(
    df: DataFrame, lengths: DataFrame, messages: list[str], family_col: str = "MODEL_CODE", year_col: str = "MODEL_YEAR"
) -> DataFrame:
    """Left join of {msg}_reference_len on (family, year); unknown -> null."""
    dim = reference_lengths(lengths, messages).withColumnRenamed("family", "_fam").withColumnRenamed("year", "_yr")
    dim = checked_broadcast(dim)
    cond = (F.col(family_col) == F.col("_fam")) & (F.col(year_col).try_cast("int") == F.col("_yr"))
    return df.join(dim, cond, "left").drop("_fam", "_yr")


def validity_expr(msg: Column, reference_len: Column) -> Column:
    """not null, not the sentinel, length equal to a known reference length."""
    return (
        msg.isNotNull()
        & (msg != SENTINEL)
        & F.coalesce(F.length(msg) == reference_len, F.lit(False))
        & reference_len.isNotNull()
    )


def add_validity(df: DataFrame, message_columns: dict[str, str]) -> DataFrame:
    """adds {m}_actual_len, {m}_is_valid for each message m -> column
    (expects {m}_reference_len, e.g. from ``add_reference_lengths``)."""
    cols = {}
    for m, c in message_columns.items():
        cols[f"{m}_actual_len"] = F.length(F.col(c))
        cols[f"{m}_is_valid"] = validity_expr(F.col(c), F.col(f"{m}_reference_len"))
    return df.withColumns(cols)


def valid_condition(messages: list[str], how: str = "all") -> Column:
    """all (default, as the reference's code does) or any message valid."""
    conds = [F.col(f"{m}_is_valid") for m in messages]
    if how == "all":
        return reduce(lambda a, b: a & b, conds)
    if how == "any":
        return reduce(lambda a, b: a | b, conds)
    raise ValueError(f"how must be 'all' or 'any', not {how!r}")


def filter_valid(df: DataFrame, messages: list[str], how: str = "all") -> DataFrame:
    return df.filter(valid_condition(messages, how))


def any_usable(message_columns: list[str]) -> Column:
    """at least one message column is present and not the sentinel."""
    conds = [F.col(c).isNotNull() & (F.col(c) != SENTINEL) for c in message_columns]
    return reduce(lambda a, b: a | b, conds)


def length_flags(
    df: DataFrame,
    lengths: DataFrame,
    alerts: list[str],
    message_columns: dict[str, str],
    family_col: str = "MODEL_CODE",
    year_col: str = "MODEL_YEAR",
) -> DataFrame:
    """valid_length_{a}, has_valid_length_{a}, all_ddt_lengths_valid.
    Alerts whose message column is missing from ``df`` are skipped."""
    present = [a for a in alerts if message_columns.get(a) in df.columns]
    dim = reference_lengths(lengths, present)
    dim = dim.select(
        F.col("family").alias("_fam"), F.col("year").alias("_yr"),
        *[F.col(f"{a}_reference_len").alias(f"valid_length_{a}") for a in present],
    )
    cond = (F.col(family_col) == F.col("_fam")) & (F.col(year_col).try_cast("int") == F.col("_yr"))
    out = df.join(checked_broadcast(dim), cond, "left").drop("_fam", "_yr")
    flags = {
        f"has_valid_length_{a}": F.coalesce(F.length(message_columns[a]) == F.col(f"valid_length_{a}"), F.lit(False))
        for a in present
    }
    out = out.withColumns(flags)
    all_ok = reduce(lambda x, y: x & y, [F.col(f"has_valid_length_{a}") for a in present], F.lit(True))
    return out.withColumn("all_ddt_lengths_valid", all_ok)


def length_filter(
    df: DataFrame,
    lengths: DataFrame,
    alerts: list[str],
    message_columns: dict[str, str],
    filter_invalid: bool = True,
    family_col: str = "MODEL_CODE",
    year_col: str = "MODEL_YEAR",
) -> DataFrame:
    """Keep rows whose messages all have their expected length and drop
    the helper columns, or keep every row with the flags."""
    flagged = length_flags(df, lengths, alerts, message_columns, family_col, year_col)
    if not filter_invalid:
        return flagged
    helper = [c for c in flagged.columns if c not in df.columns]
    return flagged.filter("all_ddt_lengths_valid").drop(*helper)


def good_input_marker(df: DataFrame, alerts: list[str]) -> DataFrame:
    """goodDiagInput_{a} = "x" when the length check passed, else ""; "unknown" where there is no check (the
    alert's flag column is missing or null)."""
    return df.withColumns(
        {
            f"goodDiagInput_{a}": F.when(F.col(f"has_valid_length_{a}"), "x")
            .when(~F.col(f"has_valid_length_{a}"), "")
            .otherwise("unknown")
            if f"has_valid_length_{a}" in df.columns
            else F.lit("unknown")
            for a in alerts
        }
    )


def length_summary(flagged: DataFrame, alerts: list[str], family_col: str = "MODEL_CODE", year_col: str = "MODEL_YEAR") -> DataFrame:
    """A3: per (family, year): total rows, valid_{a}_count, all_valid_count."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.sum(F.col(f"has_valid_length_{a}").cast("int")).alias(f"valid_{a}_count") for a in alerts]
    aggs.append(F.sum(F.col("all_ddt_lengths_valid").cast("int")).alias("all_valid_count"))
    return flagged.groupBy(family_col, year_col).agg(*aggs)


def length_semi_filter(
    df: DataFrame, lengths: DataFrame, msg: str, message_column: str,
    family_col: str = "MODEL_CODE", year_col: str = "MODEL_YEAR",
) -> DataFrame:
    """J4 (F5 re-aimed): rows whose message has a configured (family, year, length)."""
    dim = lengths.filter(F.col("msg") == msg).select(
        F.col("family").alias("_fam"), F.col("year").alias("_yr"), F.col("length").alias("_len")
    )
    cond = (
        (F.col(family_col) == F.col("_fam"))
        & (F.col(year_col).try_cast("int") == F.col("_yr"))
        & (F.length(F.col(message_column)) == F.col("_len"))
    )
    return df.join(checked_broadcast(dim), cond, "left_semi")


def codec_coverage(keys: DataFrame, codec: DataFrame, linear_keys: DataFrame, table_keys: DataFrame) -> DataFrame:
    """Distinct (family, year, msg) of the data with a flag per part: has_layout, has_linear, has_table.
    ``linear_keys`` and ``table_keys`` are the (family, year) that have a conversion file, layout or not."""
    out = keys.select("family", "year", "msg").distinct()
    for flag, part, on in (
        ("has_layout", codec.select("family", "year", "msg"), ["family", "year", "msg"]),
        ("has_linear", linear_keys.select("family", "year"), ["family", "year"]),
        ("has_table", table_keys.select("family", "year"), ["family", "year"]),
    ):
        have = checked_broadcast(part.distinct().withColumn(flag, F.lit(True)))
        out = out.join(have, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return out.select("family", "year", "msg", "has_layout", "has_linear", "has_table")


def prepare_family(
    df: DataFrame,
    family: str,
    year: int,
    lengths: DataFrame,
    alerts: list[str],
    message_columns: dict[str, str],
    family_col: str = "MODEL_CODE",
    year_col: str = "MODEL_YEAR",
) -> DataFrame:
    """rows of one family that pass F8. A family or year without configured lengths is returned unfiltered by
    length, with a warning. (The configuration is looked up, not the data.)"""
    one = df.filter(F.col(family_col) == family) if family_col in df.columns else df
    known = lengths.filter((F.col("family") == family) & (F.col("year") == year)).limit(1).count() > 0
    if not known:
        warnings.warn(f"no lengths configured for family {family!r}, year {year!r}: rows are not filtered by length")
        return one
    return length_filter(one, lengths, alerts, message_columns, True, family_col, year_col)
