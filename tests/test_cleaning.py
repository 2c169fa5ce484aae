from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.functions import quantiles
from shelfcast.functions.quantiles import exact_quantiles
from shelfcast.functions.scalars import cyclic, hash_value, next_month, parse_date, rounded_count, weekday_name
from shelfcast.operators.cleaning import (
    clean_transactions,
    cleaning_report,
    flag_negatives,
    flag_outliers,
    iqr_limits,
    outlier_limits,
    std_limits,
)
from shelfcast.operators.enrich import enrich_transactions, unrepresented, unseen_pairs
from shelfcast.operators.profile import boxplot_stats, describe_columns

ROWS = [(1, 5.0, 1.0), (2, -1.0, 2.0), (3, None, 3.0), (4, 6.0, -4.0), (5, 7.0, None), (6, None, None)]


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(ROWS, "id int, price double, amount double")


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_dates(spark):
    assert one(spark, parse_date(F.lit("2.1.2013"))) == dt.date(2013, 1, 2)
    assert one(spark, parse_date(F.lit("02.01.2013"))) == dt.date(2013, 1, 2)
    assert one(spark, parse_date(F.lit("2013-01-02"), lenient=True)) is None
    with pytest.raises(Exception, match="(?i)pars|date"):
        one(spark, parse_date(F.lit("2013-01-02")))
    monday = F.lit("2024-01-01").cast("date")
    assert one(spark, F.weekday(monday)) == 0 and one(spark, weekday_name(monday)) == "Monday"
    assert one(spark, next_month(F.lit("2020-12-01").cast("date"))) == dt.date(2021, 1, 1)


def test_rounding_is_half_even_and_keeps_null(spark):
    values = [(0.5,), (1.5,), (2.5,), (-0.5,), (None,)]
    got = [r[0] for r in spark.createDataFrame(values, "v double").select(rounded_count("v")).collect()]
    assert got == [0, 2, 2, 0, None]


def test_cyclic(spark):
    for m in range(1, 13):
        assert one(spark, cyclic(F.lit(m), 12, "sin")) == pytest.approx(math.sin(m / 12 * 2 * math.pi))
    with pytest.raises(ValueError):
        cyclic("month", 12, "tan")


def test_hash_does_not_depend_on_partitioning(spark):
    df = spark.range(200).select("id", (F.col("id") * 7).alias("k"))
    few, many = (df.repartition(n).select("id", hash_value(["id", "k"], 1).alias("h")).collect() for n in (1, 7))
    assert sorted(map(tuple, few)) == sorted(map(tuple, many))


def test_null_is_no_reason_to_go(sales):
    flagged = {r["id"]: r["valid"] for r in flag_negatives(sales).collect()}
    assert flagged == {1: True, 2: False, 3: True, 4: False, 5: True, 6: True}
    assert {r["id"] for r in clean_transactions(sales, remove_outliers=False).collect()} == {1, 3, 5, 6}
    assert clean_transactions(sales, False, False).count() == len(ROWS)


def test_limits_come_from_all_rows(sales):
    limits = std_limits(sales).first()
    prices = [r[1] for r in ROWS if r[1] is not None]
    spread = 3 * statistics.stdev(prices)
    assert limits["lower_price"] == pytest.approx(statistics.mean(prices) - spread)
    assert limits["upper_price"] == pytest.approx(statistics.mean(prices) + spread)


def test_flags_combine_and_unknown_method_is_refused(spark):
    rows = [(float(v), 1.0) for v in [1] * 30 + [1000]] + [(-1.0, 1.0)]
    df = spark.createDataFrame(rows, "price double, amount double")
    both = flag_outliers(flag_negatives(df))
    assert both.where("NOT valid").count() == 2
    report = cleaning_report(df).first()
    assert (report["rows"], report["negative_price"], report["outlier_price"], report["removed"]) == (32, 1, 1, 2)
    assert report["loss_rate"] == pytest.approx(2 / 32)
    with pytest.raises(ValueError):
        outlier_limits(df, method="mad")


def test_single_row_has_no_spread(spark):
    df = spark.createDataFrame([(5.0, 1.0)], "price double, amount double")
    assert clean_transactions(df).count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, values):
    known = [v for v in values if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["level"]: r["quantile"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    assert len(got) == (5 if known else 0)
    for level, value in got.items():
        assert value == pytest.approx(np.quantile(known, level), rel=1e-9, abs=1e-6)


@pytest.mark.parametrize("poor", [False, True])
def test_long_ranges_are_cut_further(spark, monkeypatch, poor):
    """No task orders more than MOST_VALUES values; estimates that miss the rank cost a reading, not the result."""
    monkeypatch.setattr(quantiles, "MOST_VALUES", 5)
    draw = np.random.default_rng(4)
    data = np.concatenate([draw.normal(0, 1, 3000), np.exp2(-draw.integers(1, 900, 500).astype(float)), np.full(1500, 0.25), draw.integers(0, 9, 500) * 1e300])
    if poor:
        monkeypatch.setattr(quantiles, "_cuts", lambda df, columns, near: {c: F.array(*[F.lit(5.0 + i) for i in range(len(near))]) for c in columns})
    df = spark.createDataFrame([(float(x), 1.0) for x in data], "x double, y double").repartition(6)
    levels = [0.0, 0.1, 0.4567, 0.5, 0.98, 1.0]
    got = {(r["column"], r["level"]): r["quantile"] for r in exact_quantiles(df, ["x", "y"], levels).collect()}
    for q in levels:
        assert got["x", q] == pytest.approx(np.quantile(data, q), rel=1e-9, abs=1e-300) and got["y", q] == 1.0


def test_quantiles_with_a_third_in_one_value(spark):
    random.seed(5)
    x = [3.0] * 20000 + [random.lognormvariate(1, 2) for _ in range(40000)]
    y = [float(random.randint(0, 9)) for _ in x]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double").repartition(5)
    got = {(r["column"], r["level"]): r["quantile"] for r in exact_quantiles(df, ["x", "y"], [0.01, 0.25, 0.5, 0.75]).collect()}
    for name, data in (("x", x), ("y", y)):
        for q in (0.01, 0.25, 0.5, 0.75):
            assert got[name, q] == pytest.approx(np.quantile(data, q), abs=1e-9)


def test_describe_and_boxplot(spark):
    data = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in [*data, None]], "x double")
    row = describe_columns(df, ["x"]).first()
    assert (row["count"], row["q25"], row["q50"], row["q75"], row["max"]) == (5, 2.0, 3.0, 4.0, 100.0)
    assert row["std"] == pytest.approx(statistics.stdev(data))
    box = boxplot_stats(df, ["x"]).first()
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 4.0, 1)
    ends = iqr_limits(df, ["x"]).first()
    assert (ends["lower_x"], ends["upper_x"]) == (-1.0, 7.0)


def test_enrichment_keeps_every_sale(spark):
    sales = spark.createDataFrame([(1, 1), (2, 8), (7, 1)], "shop_id int, item_id int")
    items = spark.createDataFrame([(1, "cup", 5)], "item_id int, item_name string, item_category_id int")
    kinds = spark.createDataFrame([(5, "ware")], "item_category_id int, item_category_name string")
    shops = spark.createDataFrame([(1, "N"), (2, "S"), (3, "W")], "shop_id int, shop_name string")
    got = {(r["shop_id"], r["item_id"]): (r["item_category_name"], r["shop_name"]) for r in enrich_transactions(sales, items, kinds, shops).collect()}
    assert got == {(1, 1): ("ware", "N"), (2, 8): (None, "S"), (7, 1): ("ware", None)}
    assert [r["shop_id"] for r in unrepresented(shops, sales, "shop_id").collect()] == [3]
    assert [tuple(r) for r in unseen_pairs(spark.createDataFrame([(1, 1), (1, 8)], "shop_id int, item_id int"), sales).collect()] == [(1, 8)]
