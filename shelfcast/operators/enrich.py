"""Names and categories for transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scalars import month_period, parse_date
from shelfcast.spec import PanelSpec


def enrich_transactions(
    transactions: DataFrame, items: DataFrame, categories: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Left-join item, category and shop names to each transaction.

    The item list brings its category name along, so the fact is joined twice
    only. No side is forced to be broadcast: Spark does so below its size limit,
    and splits a hot item over several tasks above it.
    """
    named_items = items.select(spec.item, "item_name", spec.category).join(
        categories.select(spec.category, "item_category_name"), spec.category, "left"
    )
    return transactions.join(named_items, spec.item, "left").join(
        shops.select(spec.shop, "shop_name"), spec.shop, "left"
    )


def handle_dates(df: DataFrame, spec: PanelSpec = PanelSpec(), lenient: bool = False) -> DataFrame:
    """Text dates to dates, and the month they fall in."""
    parsed = df.withColumn(spec.date, parse_date(spec.date, lenient))
    return parsed.withColumn(spec.period, month_period(spec.date))


def unseen_pairs(request: DataFrame, transactions: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Requested pairs without any transaction (each pair of the fact is shuffled once per task)."""
    return request.join(transactions.select(*spec.entity).distinct(), spec.entity, "left_anti")


def unrepresented(dimension: DataFrame, transactions: DataFrame, key: str) -> DataFrame:
    """Rows of a dimension whose key no transaction uses."""
    return dimension.join(transactions.select(key).distinct(), key, "left_anti")


def entity_pair(df: DataFrame, spec: PanelSpec = PanelSpec(), name: str = "shop_item") -> DataFrame:
    return df.withColumn(name, F.struct(*spec.entity))
