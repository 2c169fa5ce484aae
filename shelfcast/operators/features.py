"""Calendar, lag and moving-average columns of a panel, and the month after it.

The window forms take any panel, such as one read back from storage. They need
one shuffle by shop x item; ``plans.panel.feature_panel`` builds the same columns
without it while the panel is being made.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.functions.scalars import next_month
from shelfcast.spec import PanelSpec


def calendar_features(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return df.withColumns({"year": F.year(spec.period), "month": F.month(spec.period)})


def drop_label_columns(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return df.drop(*spec.measures)


def _history(spec: PanelSpec) -> WindowSpec:
    return Window.partitionBy(*spec.entity).orderBy(spec.period)


def feature_lags(df: DataFrame, columns: Sequence[str], spec: PanelSpec = PanelSpec(), lags: int | None = None) -> DataFrame:
    """Values of 1..n periods earlier in the same shop and item, all in one window."""
    steps = range(1, (lags or spec.lags) + 1)
    return df.withColumns({spec.lag(c, i): F.lag(c, i).over(_history(spec)) for c in columns for i in steps})


def moving_averages(
    df: DataFrame, columns: Sequence[str], spec: PanelSpec = PanelSpec(), windows: Sequence[int] | None = None
) -> DataFrame:
    """Trailing means over w periods; null until w known values are in the frame."""
    new = {}
    for w in windows or [spec.window]:
        frame = _history(spec).rowsBetween(1 - w, 0)
        for c in columns:
            new[spec.average(c, w)] = F.when(F.count(c).over(frame) == w, F.avg(c).over(frame))
    return df.withColumns(new)


def lag_features(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return feature_lags(df, spec.measures, spec)


def lag_averages(spec: PanelSpec) -> list[Column]:
    """Mean of the ``window`` latest lags of each measure; null when one of them is."""
    return [
        (reduce(add, [F.col(spec.lag(c, i)) for i in range(1, spec.window + 1)]) / F.lit(float(spec.window))).alias(
            spec.average(spec.lag(c, 1))
        )
        for c in spec.measures
    ]


def moving_average_features(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Means of the latest lags: the frame of ``_l1`` values is the row's own lag columns."""
    return df.select("*", *lag_averages(spec))


def drop_warmup_periods(
    df: DataFrame, spec: PanelSpec = PanelSpec(), periods: int | None = None, known: Column | None = None
) -> DataFrame:
    """Without the first periods, for which lags do not exist.

    ``known`` is the sorted array of the frame's months, such as ``period_list`` of its facts; without it they are looked up in the
    frame, which is read twice then.
    """
    if known is None:
        known = df.agg(F.sort_array(F.collect_set(spec.period)).alias("periods")).scalar()
    return df.where(F.col(spec.period) > F.try_element_at(known, F.lit(periods or spec.lags)))


def ts_features(base: DataFrame, spec: PanelSpec = PanelSpec(), known: Column | None = None) -> DataFrame:
    lagged = moving_average_features(lag_features(base, spec), spec)
    return drop_warmup_periods(lagged, spec, known=known).select(*spec.panel_columns)


def last_period_rows(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Rows of the latest period; on a stage split by period, only that part is read."""
    return df.where(F.col(spec.period) == df.agg(F.max(spec.period).alias("period")).scalar())


def shift_lag_columns(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Each measure becomes its first lag, each lag the next one."""
    shifted = []
    for c in spec.measures:
        sources = [c, *[spec.lag(c, i) for i in range(1, spec.lags)]]
        shifted += [F.col(old).alias(spec.lag(c, i)) for i, old in enumerate(sources, 1)]
    return df.select(*spec.key, spec.category, *shifted)


def advance_period(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return calendar_features(df.withColumn(spec.period, next_month(spec.period)), spec)


def next_period_base(features: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The month to forecast, with its lags."""
    return advance_period(shift_lag_columns(last_period_rows(features, spec), spec), spec)


def next_period_features(features: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The month to forecast, with lags and moving averages."""
    return moving_average_features(next_period_base(features, spec), spec)


def forecast_design_matrix(features: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Feature columns of the month to forecast."""
    return next_period_features(features, spec).select(spec.period, *spec.roles().features)


def features_and_label(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Feature columns and ``label``, the amount of the item; the key month stays for splits and scores."""
    return df.select(spec.period, *spec.roles(df.columns).features, F.col(spec.amount_item).alias("label"))
