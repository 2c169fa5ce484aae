from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfcast import PanelSpec
from shelfcast.operators.cleaning import clean_transactions
from shelfcast.operators.features import features_and_label
from shelfcast.operators.splits import (
    clean_by_strategy,
    parts,
    random_periods,
    split_daily,
    split_daily_last_periods,
    split_panel,
    val_month_count,
)

SPEC = PanelSpec()


@pytest.fixture(scope="module")
def panel(spark):
    """23 months up to a December, 4 shops, 5 items."""
    months = spark.range(23).select(F.add_months(F.lit("2019-02-01").cast("date"), F.col("id").cast("int")).alias("monthly_period"))
    cells = spark.range(20).select((F.col("id") % 4).cast("int").alias("shop_id"), F.floor(F.col("id") / 4).cast("int").alias("item_id"))
    rows = months.withColumn("k", F.lit(1)).join(cells.withColumn("k", F.lit(1)), "k").drop("k")
    return rows.withColumn("amount_item", F.lit(1.0)).withColumn("date", F.date_add("monthly_period", 9))


@pytest.mark.parametrize("strategy", ["random", "months", "last_months_val"])
def test_parts_are_whole_and_disjoint(panel, strategy):
    labeled = split_panel(panel, strategy, SPEC)
    train, val = parts(labeled)
    assert train.count() + val.count() == panel.count()
    assert train.join(val, SPEC.key, "left_semi").count() == 0
    again = split_panel(panel.repartition(7), strategy, SPEC)
    assert labeled.exceptAll(again).count() == 0
    other = split_panel(panel, strategy, replace(SPEC, seed=7))
    assert (labeled.exceptAll(other).count() == 0) == (strategy == "last_months_val")


def test_month_count_is_half_even(panel):
    assert panel.agg(val_month_count(SPEC)).first()[0] == 4
    assert panel.agg(val_month_count(replace(SPEC, val_ratio=0.125))).first()[0] == 2  # 2.5
    assert panel.agg(val_month_count(replace(SPEC, val_ratio=0.175))).first()[0] == 4  # 3.5
    assert panel.agg(val_month_count(SPEC, lag_periods=0)).first()[0] == 5  # 4.6


def test_months_are_drawn_without_replacement(panel):
    drawn = random_periods(panel, SPEC).first()["periods"]
    assert len(drawn) == len(set(drawn)) == 4
    train, val = parts(split_panel(panel, "months", SPEC))
    assert {r[0] for r in val.select("monthly_period").distinct().collect()} == set(drawn)
    assert val.count() == 4 * 20


def test_last_months_may_end_in_december(panel):
    _train, val = parts(split_panel(panel, "last_months_val", SPEC))
    first, last = val.agg(F.min("monthly_period"), F.max("monthly_period")).first()
    assert (first, last) == (dt.date(2020, 9, 1), dt.date(2020, 12, 1))


def test_daily_parts_overlap_by_the_lags(panel):
    train, val = split_daily_last_periods(panel, SPEC)
    both = train.join(val, [*SPEC.key, "date"], "left_semi").select("monthly_period").distinct()
    assert sorted(r[0] for r in both.collect()) == [dt.date(2020, m, 1) for m in (6, 7, 8)]
    assert val.agg(F.max("date")).first()[0] == dt.date(2020, 12, 10)


@pytest.mark.parametrize("strategy", ["random", "months"])
def test_other_daily_parts_are_disjoint(panel, strategy):
    train, val = split_daily(panel, strategy, SPEC, SPEC.key)
    assert train.count() + val.count() == panel.count() and val.count() > 0


def test_unknown_strategies_are_refused(panel):
    with pytest.raises(ValueError):
        split_panel(panel, "weeks", SPEC)
    with pytest.raises(ValueError):
        clean_by_strategy(panel, "none", "random", SPEC)


def test_outliers_stay_in_the_validation_part_only(spark):
    rows = [(dt.date(2019 + i // 12, i % 12 + 1, 5), 1, k, 10.0, 1.0) for i in range(23) for k in range(10)]
    rows += [(dt.date(2019, 3, 5), 1, 1, 9000.0, 1.0), (dt.date(2020, 11, 5), 1, 1, 9000.0, 1.0), (dt.date(2020, 11, 6), 1, 1, -1.0, 1.0)]
    daily = spark.createDataFrame(rows, "date date, shop_id int, item_id int, price double, amount double")
    daily = daily.withColumn("monthly_period", F.trunc("date", "MM"))
    cleaned = clean_by_strategy(daily, "no_olrem_for_val", "last_months_val", SPEC)
    assert cleaned["train"].agg(F.max("price")).first()[0] == 10.0
    assert cleaned["val"].agg(F.min("price"), F.max("price")).first()[:] == (10.0, 9000.0)
    wide = clean_by_strategy(daily, "no_olrem_for_val", "last_months_val", SPEC, method="std", width=1e6)
    assert wide["train"].agg(F.max("price")).first()[0] == 9000.0
    ranged = clean_by_strategy(daily, "no_olrem_for_val", "last_months_val", SPEC, method="iqr", low=0.0, high=1.0, reach=0.0)
    assert ranged["train"].agg(F.max("price")).first()[0] == 9000.0
    assert clean_by_strategy(daily, spec=SPEC)["all"].count() == clean_transactions(daily).count() == 230


def test_label_and_features_do_not_mix(spark):
    columns = PanelSpec().panel_columns
    df = spark.createDataFrame([(dt.date(2020, 1, 1), *range(1, 4), *[float(i) for i in range(len(columns) - 4)])], columns)
    got = features_and_label(df, SPEC)
    assert got.columns == ["monthly_period", *SPEC.roles().features, "label"]
    assert df.columns == columns and got.first()["label"] == df.first()["amount_item"]
