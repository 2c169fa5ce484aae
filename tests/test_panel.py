from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import small
from shelfcast import PanelSpec
from shelfcast.operators.features import (
    drop_warmup_periods,
    feature_lags,
    forecast_design_matrix,
    last_period_rows,
    moving_averages,
    next_period_features,
    ts_features,
)
from shelfcast.operators import grid
from shelfcast.operators.grid import dense_grid, densify_zero_sales, period_list
from shelfcast.operators.monthly import mean_prices, monthly_category_sales, monthly_facts, monthly_item_sales
from shelfcast.operators.prices import attach_category_amount, backfill_category, price_cascade, priced_items
from shelfcast.operators.profile import missing_report
from shelfcast.plans.panel import PanelBuilder, backfilled_sales, feature_panel, monthly_panel, priced_grid, sales_with_totals
from shelfcast.session import co_located
from shelfcast.sources.stages import StageStore

SPEC = PanelSpec()


@pytest.fixture(scope="module")
def chain(spark):
    return small.frames(spark)


@pytest.fixture(scope="module")
def facts(chain):
    daily, items, _shops = chain
    return monthly_facts(daily, items, SPEC)


def test_lags_below_two_are_refused():
    with pytest.raises(ValueError):
        PanelSpec(lags=1)


def test_roles_follow_the_schema():
    roles = SPEC.roles()
    assert roles.categorical == ["shop_id", "item_id", "item_category_id"] and roles.seasonal == ["month"]
    assert roles.numeric[0] == "year" and len(roles.features) == 17
    assert roles.numeric[-1] == "amount_cat_l1_ma2"


@pytest.mark.parametrize("decimals", [None, 2])
@pytest.mark.parametrize("partitions", [1, 7])
def test_panel_by_hand(chain, decimals, partitions):
    daily, items, shops = chain
    spec = PanelSpec(price_decimals=decimals, partitions=partitions)
    got = monthly_panel(monthly_facts(daily, items, spec), items, shops, spec, with_level=True)
    expected = small.panel()
    assert {c["price_level"] for c in expected.values()} == {0, 1, 2, 3, 4}
    small.assert_same(small.by_key(got), expected)


@pytest.mark.parametrize("lags", [2, 3])
def test_features_by_hand(chain, facts, lags):
    _daily, items, shops = chain
    spec = PanelSpec(lags=lags)
    got = feature_panel(facts, items, shops, spec)
    assert got.columns == spec.panel_columns
    small.assert_same(small.by_key(got), small.features(lags))


def test_windows_give_the_same_features(chain, facts):
    _daily, items, shops = chain
    base = monthly_panel(facts, items, shops, SPEC)
    small.assert_same(small.by_key(ts_features(base, SPEC)), small.features())


def test_steps_give_the_same_panel(chain, facts):
    daily, items, shops = chain
    named = daily.join(items, "item_id", "left")
    dense = backfill_category(densify_zero_sales(monthly_item_sales(named, SPEC), shops, items, SPEC), items, SPEC)
    priced = price_cascade(dense, facts, SPEC)
    totals = densify_zero_sales(monthly_category_sales(named, SPEC), shops, items, SPEC, other="item_category_id")
    got = attach_category_amount(priced, totals, SPEC)
    expected = {k: {c: v for c, v in cell.items() if c not in ("year", "month")} for k, cell in small.panel().items()}
    small.assert_same(small.by_key(got), expected)


def test_grid_has_each_combination_once(chain, facts):
    _daily, items, shops = chain
    every = dense_grid(shops, items, facts, SPEC)
    periods = facts.select("monthly_period").distinct().count()
    assert every.count() == every.distinct().count() == len(small.SHOPS) * len(small.ITEMS) * periods


@pytest.mark.parametrize("most", [100_000, 2000])
def test_many_shops_come_in_several_chunks(spark, facts, monkeypatch, most):
    monkeypatch.setattr(grid, "MOST_SHOPS", most)
    shops = spark.range(3000).select(F.col("id").cast("int").alias("shop_id"))
    items = spark.createDataFrame([(11, 1), (12, 1)], "item_id int, item_category_id int")
    pairs = dense_grid(shops, items, facts, SPEC).select("shop_id", "item_id").distinct()
    assert pairs.count() == 6000


def test_calendar_periods_add_the_empty_months(chain, facts):
    _daily, items, shops = chain
    spec = PanelSpec(calendar_periods=True)
    months = [dt.date(2020, m, 1) for m in range(1, 13)]
    small.assert_same(small.by_key(monthly_panel(facts, items, shops, spec)), {k: {c: v for c, v in cell.items() if c != "price_level"} for k, cell in small.panel(months).items()})
    july = feature_panel(facts, items, shops, spec).where("monthly_period = '2020-07-01' AND shop_id = 2 AND item_id = 11").first()
    assert (july["amount_item_l3"], july["amount_item_l1"]) == (1.0, 0.0)


def test_prices_of_training_months_only(chain):
    daily, items, shops = chain
    facts = monthly_facts(daily, items, SPEC)
    early = facts.where("monthly_period < '2020-06-01'")
    got = small.by_key(monthly_panel(facts, items, shops, SPEC, price_facts=early))
    assert got[dt.date(2020, 6, 1), 2, 11]["price"] == 20.0
    assert got[dt.date(2020, 12, 1), 2, 11]["price"] == 22.0


def test_null_keys_form_no_group(spark):
    rows = [(1, None, "1.1.2020", 4.0, 1.0, None), (1, 5, "1.1.2020", 6.0, None, None), (None, 5, "1.1.2020", 9.0, 2.0, 3)]
    daily = spark.createDataFrame(rows, "shop_id int, item_id int, monthly_period string, price double, amount double, item_category_id int")
    daily = daily.withColumn("monthly_period", F.lit("2020-01-01").cast("date"))
    assert [tuple(r)[1:] for r in monthly_item_sales(daily).collect()] == [(1, 5, None, 6.0, 0.0)]
    assert mean_prices(daily, ["item_id"]).count() == 1
    assert mean_prices(daily, []).first()["price"] == pytest.approx(19 / 3)
    assert monthly_category_sales(daily).count() == 0


def test_moving_average_waits_for_a_full_window(spark):
    rows = [(1, 1, m, v) for m, v in enumerate([4.0, None, 6.0, 8.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "shop_id int, item_id int, m int, x double")
    df = df.withColumn("monthly_period", F.make_date(F.lit(2020), "m", F.lit(1)))
    got = [r["x_ma2"] for r in moving_averages(df, ["x"], SPEC, [2]).orderBy("m").collect()]
    assert got == [None, None, None, 7.0, 4.5]
    lagged = [r["x_l2"] for r in feature_lags(df, ["x"], SPEC, 2).orderBy("m").collect()]
    assert lagged == [None, None, 4.0, None, 6.0]
    assert drop_warmup_periods(df, SPEC).count() == 2


@pytest.mark.parametrize("lags", [2, 3, 4])
def test_next_month_equals_features_of_an_appended_month(chain, facts, lags):
    """Lags and averages of the month to come are those of an extra month at the end."""
    _daily, items, shops = chain
    spec = PanelSpec(lags=lags)
    base = monthly_panel(facts, items, shops, spec)
    after = last_period_rows(base, spec).withColumn("monthly_period", F.lit("2021-01-01").cast("date"))
    extended = last_period_rows(ts_features(base.unionByName(after), spec), spec)
    got = next_period_features(ts_features(base, spec), spec)
    columns = ["monthly_period", "shop_id", "item_id", "item_category_id", *spec.lag_columns, *spec.average_columns]
    small.assert_same(small.by_key(got.select(columns)), small.by_key(extended.select(columns)))
    january = got.select("year", "month").distinct().collect()
    assert [tuple(r) for r in january] == [(2021, 1)]
    assert set(spec.roles().features) <= set(forecast_design_matrix(ts_features(base, spec), spec).columns)


def test_missing_report_falls_step_by_step(chain, facts):
    _daily, items, shops = chain
    report = missing_report(monthly_panel(facts, items, shops, SPEC, with_level=True)).first()
    levels = [c["price_level"] for c in small.panel().values()]
    steps = ["own_month", "shop_item", "item", "category", "global"]
    assert [report[f"missing_after_{s}"] for s in steps] == [sum(v > i for v in levels) for i in range(5)]


def test_stages_are_reused_and_rebuilt(spark, chain, tmp_path):
    daily, items, shops = chain
    raw = daily.withColumn("date", F.date_format("date", "d.M.yyyy")).drop("monthly_period")
    tables = {"transaction": raw, "item_list": items, "shop_list": shops}
    store = StageStore(spark, str(tmp_path))
    first = PanelBuilder(tables, store, "small").features()
    files = sorted(first.inputFiles())
    assert sorted(PanelBuilder(tables, store, "small").features().inputFiles()) == files
    longer = PanelBuilder(tables, store, "small", replace(SPEC, lags=2)).features()
    assert "price_l3" not in longer.columns and longer.count() > first.count()
    rebuilt = PanelBuilder(tables, store, "small").features(refresh=True)
    assert sorted(rebuilt.inputFiles()) != files
    assert rebuilt.count() == len(small.features())


def test_last_month_reads_one_part_of_a_stage(spark, chain, tmp_path):
    daily, items, shops = chain
    raw = daily.withColumn("date", F.date_format("date", "d.M.yyyy")).drop("monthly_period")
    b = PanelBuilder({"transaction": raw, "item_list": items, "shop_list": shops}, StageStore(spark, str(tmp_path)), "small")
    plan = last_period_rows(b.features(), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(monthly_period" in plan


def test_no_cross_join_and_no_shuffle_of_the_grid(chain, facts):
    _daily, items, shops = chain
    plan = feature_panel(facts, items, shops, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Window" not in plan
    above = plan[: plan.index("Generate posexplode")]
    assert "Exchange" not in above and "Sort" not in above


def nodes(plan: str) -> list[str]:
    return [line.strip(" :+-*()0123456789") for line in plan.splitlines()]


def test_shops_meet_their_months_without_a_shuffle(spark, chain, facts):
    """Without broadcasts, what is above the explosion of shops is shuffled for category totals only."""
    _daily, items, shops = chain
    spec = replace(SPEC, partitions=7)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        with co_located(spark):
            dense = densify_zero_sales(facts.select("monthly_period", "shop_id", "item_id", "amount"), shops, items, spec)
            plans = [df._jdf.queryExecution().executedPlan().toString() for df in (dense, feature_panel(facts, items, shops, spec))]
            small.assert_same(small.by_key(feature_panel(facts, items, shops, spec)), small.features())
    finally:
        spark.conf.set(name, before)
    for plan, shuffles in zip(plans, (0, 2)):
        above = plan[: plan.index("Generate explode(")]
        assert above.count("Exchange hashpartitioning(shop_id") <= shuffles
        assert "chunk" not in plan and "CartesianProduct" not in plan
        by_pair = [n for n in nodes(plan) if n.startswith("Exchange hashpartitioning(shop_id") and "item_id" in n]
        assert not by_pair
        assert sum("Exchange hashpartitioning(item_id" in n and ", 7)" in n for n in nodes(plan)) >= 2
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_known_months_spare_a_second_reading(chain, facts):
    _daily, items, shops = chain
    base = monthly_panel(facts, items, shops, SPEC)
    got = ts_features(base, SPEC, known=period_list(facts, SPEC))
    small.assert_same(small.by_key(got), small.features())
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("posexplode")
    assert count(got) == 1 and count(ts_features(base, SPEC)) >= 1


def test_parts_of_the_panel_are_made_before_the_months(chain, facts):
    """Categories, prices and totals alone: the same values as by joins of the panel, and no join, sort or shuffle above its months."""
    daily, items, shops = chain
    dense = backfill_category(densify_zero_sales(monthly_item_sales(daily.join(items, "item_id", "left"), SPEC), shops, items, SPEC), items, SPEC)
    priced = price_cascade(dense, facts, SPEC).drop("amount")
    category_months = monthly_category_sales(daily.join(items, "item_id", "left"), SPEC)
    totals = attach_category_amount(dense, category_months, SPEC).drop("price")
    assert totals.where("amount_cat is null").count() == 0
    for plan, joined in ((backfilled_sales, dense), (priced_grid, priced), (sales_with_totals, totals)):
        got = plan(facts, items, shops, SPEC)
        small.assert_same(small.by_key(got), small.by_key(joined))
        text = got._jdf.queryExecution().executedPlan().toString()
        above = text[: text.index("Generate posexplode")]
        assert not any(word in above for word in ("Join", "Exchange", "Sort"))


def test_a_category_without_sales_has_a_total_of_zero(spark, facts):
    items = spark.createDataFrame([(11, 77), (12, None)], "item_id int, item_category_id int")
    shops = spark.createDataFrame([(1,)], "shop_id int")
    assert {r["amount_cat"] for r in sales_with_totals(facts, items, shops, SPEC).collect()} == {0.0}
    panel = backfilled_sales(facts, items, shops, SPEC)
    none = facts.select("shop_id", "item_category_id", "monthly_period", "amount").limit(0)
    assert {r["amount_cat"] for r in attach_category_amount(panel, none, SPEC).collect()} == {0.0}


def test_coarse_prices_come_from_one_aggregate(spark, chain, tmp_path):
    """Means of items, of categories and of all sales read the facts once."""
    daily, items, _shops = chain
    monthly_facts(daily, items, SPEC).write.parquet(f"{tmp_path}/facts")
    got = priced_items(items, spark.read.parquet(f"{tmp_path}/facts"), SPEC)
    assert got.count() == len(small.ITEMS)
    assert f"{tmp_path}/facts" not in " ".join(got.inputFiles())


def test_a_saved_panel_is_smaller_than_its_rows(spark, chain, tmp_path):
    """One row per shop x item is saved, none per month, and neither windows nor look-ups by item shuffle the rows laid out from it."""
    daily, items, shops = chain
    raw = daily.withColumn("date", F.date_format("date", "d.M.yyyy")).drop("monthly_period")
    store = StageStore(spark, str(tmp_path))
    b = PanelBuilder({"transaction": raw, "item_list": items, "shop_list": shops}, store, "small")
    small.assert_same(small.by_key(b.features()), small.features())
    paths = store.part_paths("features", b.base_settings | b.settings("lags"), list(b.stage_parts))
    assert spark.read.parquet(paths["entities"]).count() == len(small.ITEMS) * len(small.SHOPS)
    assert spark.read.parquet(paths["months"]).count() == b.facts().dropna(subset=b.spec.key).select("monthly_period").distinct().count()
    lagged = feature_lags(b.base(), ["amount_item"], SPEC)
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan[: plan.index("NestedLoopJoin")]
    small.assert_same(small.by_key(ts_features(b.base(), SPEC)), small.features())


def test_a_null_item_and_a_null_category_keep_their_rows(spark, tmp_path):
    """What is saved and laid out again is what the plan makes at once, with nulls in all lists and sales."""
    sales = spark.createDataFrame(
        [(1, 11, "1.1.2020", 2.0, 1.0), (1, None, "3.2.2020", 3.0, 1.0), (None, 11, "1.3.2020", 4.0, None), (2, 12, "1.4.2020", None, 5.0), (2, 12, "1.5.2020", 6.0, 5.0), (2, 11, "1.6.2020", 6.5, 2.0), (1, 12, "1.7.2020", 1.0, 3.0)],
        "shop_id int, item_id int, date string, price double, amount double",
    )
    items = spark.createDataFrame([(11, 1), (12, None), (None, 2), (13, 2)], "item_id int, item_category_id int")
    shops = spark.createDataFrame([(1,), (2,), (None,)], "shop_id int")
    b = PanelBuilder({"transaction": sales, "item_list": items, "shop_list": shops}, StageStore(spark, str(tmp_path)), "nulls", SPEC)
    for saved, plan in ((b.base(), monthly_panel), (b.features(), feature_panel)):
        made = plan(b.facts(), items, shops, SPEC).select(saved.columns)
        assert saved.count() == made.count() > 0 and saved.exceptAll(made).count() == 0


def test_a_saved_panel_tells_its_price_levels(spark, chain, tmp_path):
    """The profile needs no panel written as rows: the saved one has the level of each price, null where there is none."""
    daily, items, shops = chain
    raw = daily.withColumn("date", F.date_format("date", "d.M.yyyy")).drop("monthly_period")
    b = PanelBuilder({"transaction": raw, "item_list": items, "shop_list": shops}, StageStore(spark, str(tmp_path)), "small")
    saved = b.base(with_level=True)
    small.assert_same(small.by_key(saved), small.panel())
    assert "price_level" not in b.base().columns
    items = spark.createDataFrame([(11, 77)], "item_id int, item_category_id int")
    unpriced = b.facts().withColumn("price_count", F.lit(0).cast("bigint")).withColumn("price_units", F.lit(None).cast("double"))
    made = monthly_panel(unpriced, items, shops, SPEC, with_level=True)
    assert {r["price_level"] for r in made.collect()} == {None}


def test_tasks_grow_with_the_cells(spark, chain, facts, monkeypatch):
    """A panel that is not saved gets tasks by its cells, dealt out by shop and item once for the grid and once for the facts; the totals
    of categories, whose size is known, do not move its rows."""
    _daily, items, shops = chain
    monkeypatch.setattr(grid, "CELLS_PER_TASK", 10)
    periods = facts.dropna(subset=SPEC.key).select("monthly_period").distinct().count()
    tasks = -(-len(small.SHOPS) * len(small.ITEMS) * periods // 10)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "16k")
    try:
        monthly = facts.select("monthly_period", "shop_id", "item_id", "amount")
        frames = [densify_zero_sales(monthly, shops, items, SPEC), priced_grid(facts, items, shops, SPEC), feature_panel(facts, items, shops, SPEC)]
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in frames]
    finally:
        spark.conf.set(name, before)
    for plan in plans:
        by_pair = [n for n in nodes(plan) if "Exchange hashpartitioning(shop_id" in n and "item_id" in n]
        assert by_pair and all(f", {tasks}), REPARTITION_BY_NUM" in n for n in by_pair)
        assert not [n for n in nodes(plan[: plan.index("Generate explode(")]) if "Exchange hashpartitioning(shop_id" in n and "category" in n]
    small.assert_same(small.by_key(frames[-1]), small.features())
