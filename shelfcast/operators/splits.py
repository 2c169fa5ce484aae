"""Train and validation rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scalars import in_sample
from shelfcast.operators.cleaning import clean_transactions
from shelfcast.spec import PanelSpec

STRATEGIES = ("random", "months", "last_months_val")
CLEANING = ("olrem_for_all", "no_olrem_for_val")


def val_month_count(spec: PanelSpec = PanelSpec(), lag_periods: int | None = None) -> Column:
    """Aggregate: months to validate on, the given share of those with complete lags, half-even.

    ``lag_periods`` is what to take off the months in the frame; give 0 for a
    frame whose first months are already gone.
    """
    lag_periods = spec.lags if lag_periods is None else lag_periods
    usable = F.count_distinct(F.col(spec.period)) - lag_periods
    return F.bround(usable * F.lit(spec.val_ratio), 0).cast("int")


def random_periods(df: DataFrame, spec: PanelSpec = PanelSpec(), lag_periods: int | None = None) -> DataFrame:
    """One row with ``periods``: the validation months, drawn by seeded hash without replacement."""
    drawn = F.struct(F.md5(F.concat_ws("|", F.col(spec.period).cast("string"), F.lit(str(spec.seed)))).alias("draw"), spec.period)
    months = df.select(spec.period).where(F.col(spec.period).isNotNull()).distinct()
    return months.agg(
        F.sort_array(F.collect_list(drawn)).alias("drawn"), F.greatest(val_month_count(spec, lag_periods), F.lit(0)).alias("k")
    ).select(F.slice("drawn", 1, F.col("k"))[spec.period].alias("periods"))


def last_periods_start(df: DataFrame, spec: PanelSpec = PanelSpec(), lag_periods: int | None = None) -> Column:
    """First of the last k months, as a scalar subquery."""
    facts = df.agg(F.max(spec.period).alias("last"), val_month_count(spec, lag_periods).alias("k"))
    return facts.select(F.add_months("last", 1 - F.col("k")).alias("start")).scalar()


def _assign(df: DataFrame, validation: Column) -> DataFrame:
    return df.withColumn("split", F.when(validation, "val").otherwise("train"))


def split_random(df: DataFrame, keys: Sequence[str], spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Rows to ``split`` train or val by a hash of their key; the ratio holds in expectation."""
    return _assign(df, in_sample(list(keys), spec.seed, spec.val_ratio))


def split_random_periods(df: DataFrame, spec: PanelSpec = PanelSpec(), lag_periods: int | None = None) -> DataFrame:
    chosen = random_periods(df, spec, lag_periods).scalar()
    return _assign(df, F.array_contains(chosen, F.col(spec.period)))


def split_last_periods(df: DataFrame, spec: PanelSpec = PanelSpec(), lag_periods: int | None = None) -> DataFrame:
    return _assign(df, F.col(spec.period) >= last_periods_start(df, spec, lag_periods))


def split_panel(df: DataFrame, strategy: str, spec: PanelSpec = PanelSpec(), lag_periods: int | None = None) -> DataFrame:
    if strategy == "random":
        return split_random(df, spec.key, spec)
    if strategy == "months":
        return split_random_periods(df, spec, lag_periods)
    if strategy == "last_months_val":
        return split_last_periods(df, spec, lag_periods)
    raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and validation frames of a frame with a ``split`` column."""
    return tuple(df.where(F.col("split") == name).drop("split") for name in ("train", "val"))


def split_daily_last_periods(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> tuple[DataFrame, DataFrame]:
    """Train ends before the last k months; validation starts ``lags`` months earlier, to have its lags."""
    start = last_periods_start(daily, spec)
    day = F.col(spec.date)
    return daily.where(day < start), daily.where(day >= F.add_months(start, -spec.lags))


def split_daily(
    daily: DataFrame, strategy: str, spec: PanelSpec = PanelSpec(), keys: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and validation transactions; ``keys`` tell rows apart for the random strategy."""
    if strategy == "last_months_val":
        return split_daily_last_periods(daily, spec)
    if strategy == "random":
        return parts(split_random(daily, keys or [c for c in daily.columns], spec))
    return parts(split_panel(daily, strategy, spec))


def clean_by_strategy(
    daily: DataFrame,
    cleaning: str = "olrem_for_all",
    strategy: str = "random",
    spec: PanelSpec = PanelSpec(),
    keys: Sequence[str] | None = None,
    method: str = "std",
    **levels: float,
) -> dict[str, DataFrame]:
    """Cleaned transactions by part.

    ``olrem_for_all`` cleans all rows and leaves the split to the panel.
    ``no_olrem_for_val`` splits first and keeps the outliers of the validation
    rows; the limits for the others come from the training rows alone. ``method``
    and ``levels`` say how outliers are told, as in ``clean_transactions``.
    """
    if cleaning == "olrem_for_all":
        return {"all": clean_transactions(daily, method=method, **levels)}
    if cleaning == "no_olrem_for_val":
        train, val = split_daily(daily, strategy, spec, keys)
        return {"train": clean_transactions(train, method=method, **levels), "val": clean_transactions(val, remove_outliers=False)}
    raise ValueError(f"cleaning must be one of {CLEANING}, not {cleaning!r}")
