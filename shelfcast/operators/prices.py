"""Categories, prices and category totals.

``priced_items`` and ``with_category_totals`` work on the item list and on one row per shop x item, before the months are laid out;
``plans.panel`` is made of them. The others give the same values to a panel frame that lacks them, by joins of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.grid import dense, pack_history, period_list
from shelfcast.operators.monthly import item_categories, keyed, rolled_mean_prices
from shelfcast.session import written_down
from shelfcast.spec import PanelSpec

# From the closest substitute to the farthest.
FALLBACKS = ("price_shop_item", "price_item", "price_category", "price_global")


def priced_items(items: DataFrame, facts: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The item list, one row per item: its category and the mean prices of the item, of its category and of all sales.

    The facts are summed up by item once and the sums, a row per item, written down; all three means are rolled up from those.
    """
    sums = written_down(facts.groupBy(spec.item, spec.category).agg(*[F.sum(c).alias(c) for c in ("price_units", "price_count")]))
    means = [
        (rolled_mean_prices(sums, [key], name, spec), key) for key, name in ((spec.item, "price_item"), (spec.category, "price_category"))
    ]
    listed = item_categories(items, spec)
    for mean, key in means:
        listed = listed.join(mean, key, "left")
    return listed.withColumn("price_global", rolled_mean_prices(sums, [], "price_global", spec).scalar())


def category_totals(facts: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row per shop x category with ``totals``: its amounts as an array by the months on record, 0 without sales."""
    keys = [spec.shop, spec.category]
    months = keyed(facts, [spec.period, *keys]).groupBy(*keys, spec.period).agg(F.sum(spec.amount).alias(spec.amount))
    return (
        pack_history(months, keys, {"amount": F.col(spec.amount)}, spec)
        .withColumn("periods", period_list(facts, spec))
        .select(*keys, F.transform(dense("history"), lambda cell: F.coalesce(cell["amount"], F.lit(0.0))).alias("totals"))
    )


def with_category_totals(entities: DataFrame, facts: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Shop x item rows with ``totals``: the amounts of shop and category as an array by the months of ``periods``.

    A month without sales of the category is 0 there; a category without any sale in the shop, and an item without category, has
    no array, which counts as 0 as well once the months are laid out. The totals, a row per shop and category, are written down: by
    their size Spark leaves the shop x item rows where they lie as long as it can.
    """
    return entities.join(written_down(category_totals(facts, spec)), [spec.shop, spec.category], "left")


def backfill_category(panel: DataFrame, items: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Rows without a category take it from the item list."""
    listed = item_categories(items, spec).withColumnRenamed(spec.category, "listed_category")
    return (
        panel.join(listed, spec.item, "left")
        .withColumn(spec.category, F.coalesce(spec.category, "listed_category"))
        .select(*panel.columns)
    )


def with_fallback_prices(df: DataFrame, facts: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Add the four substitute prices; means are over single sales, not over months."""
    by = {"price_shop_item": spec.entity, "price_item": [spec.item], "price_category": [spec.category]}
    for name, keys in by.items():
        df = df.join(rolled_mean_prices(facts, keys, name, spec), keys, "left")
    return df.withColumn("price_global", rolled_mean_prices(facts, [], "price_global", spec).scalar())


def price_level(price: Column) -> Column:
    """Which source the price comes from: 0 is the month itself, 4 the global mean."""
    return F.when(price.isNotNull(), 0).otherwise(substitute_level())


def substitute_level() -> Column:
    """Which of the substitute prices is the closest; null without any."""
    return F.coalesce(*[F.when(F.col(name).isNotNull(), i) for i, name in enumerate(FALLBACKS, 1)])


def price_cascade(panel: DataFrame, facts: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Fill missing prices from the closest substitute, and tell which one it was."""
    own = F.col(spec.price)
    priced = with_fallback_prices(panel, facts, spec).withColumn("price_level", price_level(own))
    return priced.withColumn(spec.price, F.coalesce(own, *FALLBACKS)).select(*panel.columns, "price_level")


def attach_category_amount(
    panel: DataFrame, category_panel: DataFrame, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Join the category totals; the two amounts get the suffixes ``_item`` and ``_cat``. An absent total is 0, as in ``plans.panel``."""
    keys = [spec.shop, spec.category, spec.period]
    totals = category_panel.select(*keys, F.col(spec.amount).alias(spec.amount_cat))
    joined = panel.withColumnRenamed(spec.amount, spec.amount_item).join(totals, keys, "left")
    return joined.fillna(0.0, subset=[spec.amount_cat])
