"""Lags, averages, filters by month, the month to forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators.features import (
    advance_period,
    drop_warmup_periods,
    feature_lags,
    forecast_design_matrix,
    lag_features,
    last_period_rows,
    moving_average_features,
    moving_averages,
    next_period_base,
    next_period_features,
    shift_lag_columns,
    ts_features,
)
from shelfcast.operators.grid import period_list
from shelfcast.operators.splits import random_periods
from shelfcast.plans.panel import feature_panel
from workloads.digest import digest, digest_sql
from workloads.queries.sources import BASE_DOUBLES, PERIOD_SHOP
from workloads.registry import query, step
from workloads.retail import SPEC, builder

HISTORY = "OVER (PARTITION BY shop_id, item_id ORDER BY monthly_period)"
MEASURES = ["price", "amount_item", "amount_cat"]
LAGS = ", ".join(f"lag({c}, {i}) {HISTORY} AS {c}_l{i}" for c in MEASURES for i in (1, 2, 3))
AVERAGES = ", ".join(f"({c}_l1 + {c}_l2) / 2 AS {c}_l1_ma2" for c in MEASURES)
LAG_COLUMNS = SPEC.lag_columns
PANEL_DOUBLES = BASE_DOUBLES + LAG_COLUMNS + SPEC.average_columns

step("numbered_periods", "SELECT monthly_period, row_number() OVER (ORDER BY monthly_period) AS position FROM periods")
step("lagged", f"SELECT *, {LAGS} FROM base")
step("averaged", f"SELECT *, {AVERAGES} FROM lagged")
step(
    "features",
    "SELECT a.* FROM averaged a JOIN numbered_periods n ON n.monthly_period = a.monthly_period WHERE n.position > 3",
)
step("last_features", "SELECT * FROM features WHERE monthly_period = (SELECT max(monthly_period) FROM periods)")
SHIFTED = ", ".join(
    f"{new} AS {old}"
    for c in MEASURES
    for old, new in ((f"{c}_l1", c), (f"{c}_l2", f"{c}_l1"), (f"{c}_l3", f"{c}_l2"))
)
step(
    "next_base",
    "SELECT CAST(monthly_period + INTERVAL 1 MONTH AS DATE) AS monthly_period, shop_id, item_id, item_category_id, "
    f"{SHIFTED}, CAST(year(monthly_period + INTERVAL 1 MONTH) AS INT) AS year, "
    "CAST(month(monthly_period + INTERVAL 1 MONTH) AS INT) AS month FROM last_features",
)
NEXT_COLUMNS = ["monthly_period", "shop_id", "item_id", "item_category_id", *LAG_COLUMNS]
LIST = ", ".join


@query("feature_lags", digest_sql("lagged", PERIOD_SHOP, ["item_id", "amount_item", "amount_item_l1", "amount_item_l2", "amount_item_l3"], PANEL_DOUBLES))
def _(spark, sf_dir):
    lagged = feature_lags(builder(spark, sf_dir).base(), ["amount_item"], SPEC)
    return digest(lagged, PERIOD_SHOP, ["item_id", "amount_item", "amount_item_l1", "amount_item_l2", "amount_item_l3"])


@query("lag_features", digest_sql("lagged", PERIOD_SHOP, SPEC.base_columns + LAG_COLUMNS, PANEL_DOUBLES))
def _(spark, sf_dir):
    return digest(lag_features(builder(spark, sf_dir).base(), SPEC), PERIOD_SHOP, SPEC.base_columns + LAG_COLUMNS)


step(
    "two_months",
    "SELECT *, CASE WHEN count(amount_item) OVER w = 2 THEN avg(amount_item) OVER w END AS amount_item_ma2 FROM base "
    "WINDOW w AS (PARTITION BY shop_id, item_id ORDER BY monthly_period ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)",
)


@query("feature_moving_average", digest_sql("two_months", PERIOD_SHOP, ["item_id", "amount_item", "amount_item_ma2"], ["amount_item", "amount_item_ma2"]))
def _(spark, sf_dir):
    trailing = moving_averages(builder(spark, sf_dir).base(), ["amount_item"], SPEC)
    return digest(trailing, PERIOD_SHOP, ["item_id", "amount_item", "amount_item_ma2"])


@query("moving_average_features", digest_sql("averaged", PERIOD_SHOP, SPEC.panel_columns, PANEL_DOUBLES))
def _(spark, sf_dir):
    averaged = moving_average_features(lag_features(builder(spark, sf_dir).base(), SPEC), SPEC)
    return digest(averaged, PERIOD_SHOP, SPEC.panel_columns)


@query("ts_features", digest_sql("features", PERIOD_SHOP, SPEC.panel_columns, PANEL_DOUBLES))
def _(spark, sf_dir):
    b = builder(spark, sf_dir)
    return digest(ts_features(b.base(), SPEC, known=period_list(b.facts(), SPEC)), PERIOD_SHOP, SPEC.panel_columns)


@query("feature_panel", digest_sql("features", PERIOD_SHOP, SPEC.panel_columns, PANEL_DOUBLES))
def _(spark, sf_dir):
    b = builder(spark, sf_dir)
    return digest(feature_panel(b.facts(), b.tables["item_list"], b.tables["shop_list"], SPEC), PERIOD_SHOP, SPEC.panel_columns)


@query(
    "drop_warmup_periods",
    "SELECT b.monthly_period, count(*) AS rows FROM base b JOIN numbered_periods n ON n.monthly_period = b.monthly_period "
    "WHERE n.position > 3 GROUP BY b.monthly_period",
)
def _(spark, sf_dir):
    kept = drop_warmup_periods(builder(spark, sf_dir).base(), SPEC)
    return kept.groupBy("monthly_period").agg(F.count(F.lit(1)).alias("rows"))


@query("last_period_rows", f"SELECT {LIST(SPEC.base_columns)} FROM last_features")
def _(spark, sf_dir):
    return last_period_rows(builder(spark, sf_dir).base(), SPEC)


@query(
    "date_range_filter",
    "SELECT monthly_period, CAST(sum(amount_item) AS DOUBLE) AS amount FROM base "
    "WHERE monthly_period >= DATE '1998-01-01' AND monthly_period < DATE '2000-01-01' GROUP BY monthly_period",
)
def _(spark, sf_dir):
    period = F.col("monthly_period")
    base = builder(spark, sf_dir).base()
    inside = base.where((period >= F.lit("1998-01-01").cast("date")) & (period < F.lit("2000-01-01").cast("date")))
    return inside.groupBy("monthly_period").agg(F.sum("amount_item").alias("amount"))


step("chosen_periods", "SELECT monthly_period, row_number() OVER (ORDER BY md5(CAST(monthly_period AS VARCHAR) || '|42')) AS draw FROM periods")
step("validation_count", "SELECT CAST(round_even((count(*) - 3) * 0.2::DOUBLE, 0) AS INT) AS k FROM periods")
step("drawn_periods", "SELECT monthly_period FROM chosen_periods, validation_count WHERE draw <= k")


@query("period_in", "SELECT monthly_period, count(*) AS rows FROM base WHERE monthly_period IN (SELECT monthly_period FROM drawn_periods) GROUP BY 1")
def _(spark, sf_dir):
    base = builder(spark, sf_dir).base()
    drawn = random_periods(base, SPEC).scalar()
    return base.where(F.array_contains(drawn, F.col("monthly_period"))).groupBy("monthly_period").agg(F.count(F.lit(1)).alias("rows"))


@query("period_not_in", "SELECT monthly_period, count(*) AS rows FROM base WHERE monthly_period NOT IN (SELECT monthly_period FROM drawn_periods) GROUP BY 1")
def _(spark, sf_dir):
    base = builder(spark, sf_dir).base()
    drawn = random_periods(base, SPEC).scalar()
    return base.where(~F.array_contains(drawn, F.col("monthly_period"))).groupBy("monthly_period").agg(F.count(F.lit(1)).alias("rows"))


@query("period_difference", "SELECT monthly_period FROM periods EXCEPT SELECT monthly_period FROM drawn_periods")
def _(spark, sf_dir):
    base = builder(spark, sf_dir).base()
    drawn = random_periods(base, SPEC).select(F.explode("periods").alias("monthly_period"))
    return base.select("monthly_period").distinct().join(drawn, "monthly_period", "left_anti")


@query("advance_period", "SELECT monthly_period, year, month, count(*) AS rows FROM next_base GROUP BY ALL")
def _(spark, sf_dir):
    moved = advance_period(last_period_rows(builder(spark, sf_dir).features(), SPEC), SPEC)
    return moved.groupBy("monthly_period", "year", "month").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "shift_lag_columns",
    f"SELECT monthly_period, shop_id, item_id, item_category_id, {SHIFTED} FROM last_features",
)
def _(spark, sf_dir):
    return shift_lag_columns(last_period_rows(builder(spark, sf_dir).features(), SPEC), SPEC)


@query("next_period_base", f"SELECT {LIST(NEXT_COLUMNS)}, year, month FROM next_base")
def _(spark, sf_dir):
    return next_period_base(builder(spark, sf_dir).features(), SPEC)


@query("next_period_moving_average", f"SELECT {LIST(NEXT_COLUMNS)}, year, month, {AVERAGES} FROM next_base")
def _(spark, sf_dir):
    return next_period_features(builder(spark, sf_dir).features(), SPEC)


@query(
    "forecast_design_matrix",
    f"SELECT monthly_period, shop_id, item_id, item_category_id, {LIST(LAG_COLUMNS)}, year, month, {AVERAGES} FROM next_base",
)
def _(spark, sf_dir):
    return forecast_design_matrix(builder(spark, sf_dir).features(), SPEC)


@query("head", f"SELECT {LIST(SPEC.panel_columns)} FROM features ORDER BY monthly_period, shop_id, item_id LIMIT 5")
def _(spark, sf_dir):
    return builder(spark, sf_dir).features().orderBy("monthly_period", "shop_id", "item_id").limit(5)
