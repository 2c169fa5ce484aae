"""Daily rows to months, and the mean prices missing months fall back to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scalars import amount_sum, mean_price, price_average, price_sum
from shelfcast.spec import PanelSpec


def monthly_facts(daily: DataFrame, items: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Everything later steps need of the cleaned transactions, one row per shop, item and month.

    Price sums and counts are kept apart, so that any coarser mean can be rolled
    up from here. The item's category is joined after the aggregation, to months
    instead of single sales. Rows with a null key stay: they count in the coarser
    means.
    """
    months = daily.groupBy(*spec.key).agg(
        price_sum(spec).alias("price_units"),
        F.count(spec.price).alias("price_count"),
        amount_sum(spec).alias(spec.amount),
    )
    return months.join(item_categories(items, spec), spec.item, "left")


def item_categories(items: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row per item; an item belongs to one category."""
    return items.groupBy(spec.item).agg(F.max(spec.category).alias(spec.category))


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all known: a group without a name is no group."""
    return df.dropna(subset=keys)


def monthly_item_sales(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Category, mean price and total amount by shop, item and month."""
    return keyed(daily, spec.key).groupBy(*spec.key).agg(
        F.max(spec.category).alias(spec.category),
        price_average(spec).alias(spec.price),
        amount_sum(spec).alias(spec.amount),
    )


def monthly_category_sales(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Total amount by shop, category and month."""
    keys = [spec.period, spec.shop, spec.category]
    return keyed(daily, keys).groupBy(*keys).agg(amount_sum(spec).alias(spec.amount))


def mean_prices(daily: DataFrame, keys: list[str], spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Mean price of the single sales by ``keys``; without keys, of all sales."""
    price = price_average(spec).alias(spec.price)
    return keyed(daily, keys).groupBy(*keys).agg(price) if keys else daily.agg(price)


def rolled_price(spec: PanelSpec) -> Column:
    """Aggregate over monthly facts: the mean price of the single sales behind them."""
    return mean_price(F.sum("price_units"), F.sum("price_count"), spec)


def rolled_mean_prices(facts: DataFrame, keys: list[str], name: str, spec: PanelSpec = PanelSpec()) -> DataFrame:
    price = rolled_price(spec).alias(name)
    return keyed(facts, keys).groupBy(*keys).agg(price) if keys else facts.agg(price)
