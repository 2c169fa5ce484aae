"""Reports that share a pass are the same, row by row, as those that make their own."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfcast import PanelSpec
from shelfcast.operators.profile import (
    amounts_by,
    boxplot_stats,
    completeness_profile,
    cube_reports,
    daily_counts,
    date_range,
    describe_columns,
    month_of_year_amounts,
    overview,
    price_amount_correlation,
    quartiles_of,
    sales_cube,
    shop_period_amounts,
    top_categories,
    weekday_amounts,
)

SPEC = PanelSpec()
SCHEMA = "date date, shop_id int, item_category_name string, price double, amount double"


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = [
        (
            rng.choice([None, *[dt.date(2023, 1, 30) + dt.timedelta(d) for d in range(40)]]),
            rng.choice([None, 1, 1, 1, 2, 3]),
            rng.choice([None, "a", "b", "c"]),
            rng.choice([None, 1.5, 2.0, 9.0]),
            rng.choice([None, 1.0, 2.0, -1.0]),
        )
        for _ in range(600)
    ]
    path = f"{tmp_path_factory.mktemp('profile')}/daily"
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted((tuple(r.asDict().items()) for r in df.collect()), key=repr)


def test_cube_gives_all_counts_and_amounts(daily):
    direct = {
        "daily_counts": daily_counts(daily, SPEC),
        "daily_amounts": amounts_by(daily, ["date"], SPEC),
        "month_amounts": month_of_year_amounts(daily, SPEC),
        "weekday_amounts": weekday_amounts(daily, SPEC),
        "shop_amounts": amounts_by(daily, ["shop_id"], SPEC),
        "shop_period_amounts": shop_period_amounts(daily, SPEC),
        "top_categories": top_categories(daily, 5, SPEC),
    }
    from_cube = cube_reports(sales_cube(daily, SPEC), SPEC, above=5)
    assert from_cube.keys() == direct.keys()
    for name, df in from_cube.items():
        assert rows(df) == rows(direct[name]) != [], name
        assert not set(df.inputFiles()) & set(daily.inputFiles())


def test_overview_gives_its_reports(daily):
    got = overview(daily, SPEC)
    assert rows(got["completeness"]) == rows(completeness_profile(daily))
    assert rows(got["date_range"]) == rows(date_range(daily))
    mine, direct = got["correlation"].first(), price_amount_correlation(daily, SPEC).first()
    assert mine["pairs"] == direct["pairs"] and mine["correlation"] == pytest.approx(direct["correlation"])
    for df in got.values():
        assert not set(df.inputFiles()) & set(daily.inputFiles())


def test_given_quartiles_change_nothing(daily):
    measures = ["price", "amount"]
    known = quartiles_of(daily, measures)
    assert rows(describe_columns(daily, measures, known)) == rows(describe_columns(daily, measures))
    assert rows(boxplot_stats(daily, measures, quartiles=known)) == rows(boxplot_stats(daily, measures))


def test_reports_of_no_sales(daily):
    none = daily.where(F.lit(False))
    assert all(df.count() == 0 for df in cube_reports(sales_cube(none, SPEC), SPEC).values())
    got = overview(none, SPEC)
    assert {r["known"] for r in got["completeness"].collect()} == {0}
    assert tuple(got["date_range"].first()) == (None, None) and tuple(got["correlation"].first()) == (0, None)
