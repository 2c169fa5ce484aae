"""Validity flags, outlier limits and the cleaned transactions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.quantiles import exact_quantiles
from shelfcast.functions.scalars import holds

CHECKED = ("price", "amount")


def std_limits(df: DataFrame, columns: Sequence[str] = CHECKED, width: float = 3.0) -> DataFrame:
    """One row with ``lower_c`` and ``upper_c``: mean -/+ ``width`` sample deviations."""
    ends = []
    for c in columns:
        mean, spread = F.avg(c), F.stddev_samp(c) * width
        ends += [(mean - spread).alias(f"lower_{c}"), (mean + spread).alias(f"upper_{c}")]
    return df.agg(*ends)


def iqr_limits(
    df: DataFrame, columns: Sequence[str] = CHECKED, low: float = 0.25, high: float = 0.75, reach: float = 1.5
) -> DataFrame:
    """One row with ``lower_c`` and ``upper_c``: the quartiles -/+ ``reach`` times their distance."""
    quantiles = exact_quantiles(df, list(columns), [low, high])
    ends = []
    for c in columns:
        q1, q3 = (F.max(F.when((F.col("column") == c) & (F.col("level") == q), F.col("quantile"))) for q in (low, high))
        reached = (q3 - q1) * reach
        ends += [(q1 - reached).alias(f"lower_{c}"), (q3 + reached).alias(f"upper_{c}")]
    return quantiles.agg(*ends)


def outlier_limits(df: DataFrame, columns: Sequence[str] = CHECKED, method: str = "std", **levels: float) -> DataFrame:
    """``levels`` go to the method: ``width`` for std; ``low``, ``high``, ``reach`` for iqr."""
    if method == "std":
        return std_limits(df, columns, **levels)
    if method == "iqr":
        return iqr_limits(df, columns, **levels)
    raise ValueError(f"method must be std or iqr, not {method!r}")


def negative_flags(columns: Sequence[str] = CHECKED) -> dict[str, Column]:
    return {c: holds(F.col(c) < 0) for c in columns}


def outlier_flags(df: DataFrame, columns: Sequence[str] = CHECKED, method: str = "std", **levels: float) -> dict[str, Column]:
    """Per column: is the value outside the limits of the whole of ``df``?

    The limits are one aggregate over all rows, read as a scalar subquery.
    """
    limits = outlier_limits(df, columns, method, **levels).select(F.struct("*").alias("limits")).scalar()
    return {
        c: holds((F.col(c) < limits[f"lower_{c}"]) | (F.col(c) > limits[f"upper_{c}"])) for c in columns
    }


def _mark(df: DataFrame, flags: dict[str, Column], valid: str) -> DataFrame:
    bad = reduce(or_, flags.values())
    before = F.col(valid) if valid in df.columns else F.lit(True)
    return df.withColumn(valid, before & ~bad)


def flag_negatives(df: DataFrame, columns: Sequence[str] = CHECKED, valid: str = "valid") -> DataFrame:
    return _mark(df, negative_flags(columns), valid)


def flag_outliers(
    df: DataFrame, columns: Sequence[str] = CHECKED, method: str = "std", valid: str = "valid", **levels: float
) -> DataFrame:
    return _mark(df, outlier_flags(df, columns, method, **levels), valid)


def clean_transactions(
    df: DataFrame,
    remove_negatives: bool = True,
    remove_outliers: bool = True,
    method: str = "std",
    columns: Sequence[str] = CHECKED,
    **levels: float,
) -> DataFrame:
    """Rows without negatives and outliers; a missing price or amount is no reason to go.

    The limits come from all rows, also from those with negative values.
    """
    flags = []
    if remove_negatives:
        flags += negative_flags(columns).values()
    if remove_outliers:
        flags += outlier_flags(df, columns, method, **levels).values()
    return df.where(~reduce(or_, flags)) if flags else df


def cleaning_report(df: DataFrame, method: str = "std", columns: Sequence[str] = CHECKED, **levels: float) -> DataFrame:
    """One row: flagged rows per rule and column, removed rows, share lost."""
    negative, outlier = negative_flags(columns), outlier_flags(df, columns, method, **levels)
    rules = {f"negative_{c}": f for c, f in negative.items()} | {f"outlier_{c}": f for c, f in outlier.items()}
    flagged = df.select(*[f.cast("int").alias(name) for name, f in rules.items()])
    removed = F.sum(F.greatest(*[F.col(name) for name in rules]))
    return flagged.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(name).alias(name) for name in rules],
        removed.alias("removed"),
        (removed / F.count(F.lit(1))).alias("loss_rate"),
    )
