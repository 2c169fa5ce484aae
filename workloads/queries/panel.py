"""Months, the dense grid, prices, category totals, the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.scalars import mean_price
from shelfcast.operators.grid import dense_grid, densify_zero_sales
from shelfcast.operators.monthly import mean_prices, monthly_category_sales, monthly_item_sales
from shelfcast.plans.panel import PanelBuilder, backfilled_sales, monthly_panel, priced_grid, sales_with_totals
from workloads.digest import digest, digest_sql
from workloads.queries.cleaning import cleaned
from workloads.queries.sources import BASE_DOUBLES, PERIOD_SHOP
from workloads.registry import query, step
from workloads.retail import SPEC, builder

MEAN = "CAST(sum(cents) AS DOUBLE) / (count(cents) * 100.0::DOUBLE)"

step(
    "facts",
    f"SELECT monthly_period, shop_id, item_id, max(item_category_id) AS item_category_id, "
    f"CASE WHEN count(cents) > 0 THEN {MEAN} END AS price, CAST(sum(amount) AS DOUBLE) AS amount FROM cleaned GROUP BY 1, 2, 3",
)
step("periods", "SELECT DISTINCT monthly_period FROM facts")
step(
    "grid",
    "SELECT monthly_period, shop_id, item_id, item_category_id FROM shop_list, item_list, periods",
)
for name, keys in {"si": "shop_id, item_id", "i": "item_id", "c": "item_category_id"}.items():
    step(
        f"price_{name}",
        f"SELECT {keys}, CASE WHEN count(cents) > 0 THEN {MEAN} END AS price FROM cleaned GROUP BY {keys}",
    )
step("price_g", f"SELECT {MEAN} AS price FROM cleaned")
step(
    "leveled",
    "SELECT g.monthly_period, g.shop_id, g.item_id, g.item_category_id, "
    "coalesce(f.price, a.price, b.price, c.price, d.price) AS price, "
    "CASE WHEN f.price IS NOT NULL THEN 0 WHEN a.price IS NOT NULL THEN 1 WHEN b.price IS NOT NULL THEN 2 "
    "WHEN c.price IS NOT NULL THEN 3 ELSE 4 END AS price_level, coalesce(f.amount, 0) AS amount_item "
    "FROM grid g LEFT JOIN facts f ON f.monthly_period = g.monthly_period AND f.shop_id = g.shop_id AND f.item_id = g.item_id "
    "LEFT JOIN price_si a ON a.shop_id = g.shop_id AND a.item_id = g.item_id LEFT JOIN price_i b ON b.item_id = g.item_id "
    "LEFT JOIN price_c c ON c.item_category_id = g.item_category_id CROSS JOIN price_g d",
)
step(
    "category_totals",
    "SELECT monthly_period, shop_id, item_category_id, CAST(sum(amount) AS DOUBLE) AS amount FROM cleaned "
    "WHERE item_category_id IS NOT NULL GROUP BY 1, 2, 3",
)
step(
    "base",
    "SELECT l.monthly_period, l.shop_id, l.item_id, l.item_category_id, l.price, l.amount_item, "
    "coalesce(t.amount, 0) AS amount_cat, CAST(year(l.monthly_period) AS INT) AS year, "
    "CAST(month(l.monthly_period) AS INT) AS month FROM leveled l LEFT JOIN category_totals t "
    "ON t.monthly_period = l.monthly_period AND t.shop_id = l.shop_id AND t.item_category_id = l.item_category_id",
)
step(
    "category_panel",
    "SELECT p.monthly_period, s.shop_id, k.item_category_id, coalesce(t.amount, 0) AS amount FROM shop_list s "
    "CROSS JOIN (SELECT DISTINCT item_category_id FROM item_list) k CROSS JOIN periods p LEFT JOIN category_totals t "
    "ON t.monthly_period = p.monthly_period AND t.shop_id = s.shop_id AND t.item_category_id = k.item_category_id",
)


@query("monthly_item_sales", "SELECT monthly_period, shop_id, item_id, item_category_id, price, amount FROM facts")
def _(spark, sf_dir):
    return monthly_item_sales(cleaned(spark, sf_dir), SPEC)


@query("monthly_category_sales", "SELECT monthly_period, shop_id, item_category_id, amount FROM category_totals")
def _(spark, sf_dir):
    return monthly_category_sales(cleaned(spark, sf_dir), SPEC)


@query("mean_price_shop_item", "SELECT shop_id, item_id, price FROM price_si")
def _(spark, sf_dir):
    return mean_prices(cleaned(spark, sf_dir), ["shop_id", "item_id"], SPEC)


@query("mean_price_item", "SELECT item_id, price FROM price_i")
def _(spark, sf_dir):
    return mean_prices(cleaned(spark, sf_dir), ["item_id"], SPEC)


@query("mean_price_category", "SELECT item_category_id, price FROM price_c WHERE item_category_id IS NOT NULL")
def _(spark, sf_dir):
    return mean_prices(cleaned(spark, sf_dir), ["item_category_id"], SPEC)


@query("mean_price_global", "SELECT price FROM price_g")
def _(spark, sf_dir):
    return mean_prices(cleaned(spark, sf_dir), [], SPEC)


GRID = ["monthly_period", "shop_id", "item_id"]


@query("dense_grid", digest_sql("grid", PERIOD_SHOP, GRID, []))
def _(spark, sf_dir):
    b = builder(spark, sf_dir)
    return digest(dense_grid(b.tables["shop_list"], b.tables["item_list"], b.facts(), SPEC), PERIOD_SHOP, GRID)


def lists(b: PanelBuilder) -> tuple[DataFrame, DataFrame, DataFrame]:
    return b.facts(), b.tables["item_list"], b.tables["shop_list"]


def item_months(b: PanelBuilder) -> DataFrame:
    """The saved facts as monthly sales with their mean price."""
    price = mean_price(F.col("price_units"), F.col("price_count"), SPEC)
    return b.facts().select(*SPEC.key, SPEC.category, price.alias("price"), "amount")


def dense_items(b: PanelBuilder) -> DataFrame:
    return densify_zero_sales(item_months(b), b.tables["shop_list"], b.tables["item_list"], SPEC)


def dense_categories(b: PanelBuilder) -> DataFrame:
    months = monthly_category_sales(b.facts(), SPEC)
    return densify_zero_sales(months, b.tables["shop_list"], b.tables["item_list"], SPEC, other=SPEC.category)


DENSE = [*GRID, "item_category_id", "price", "amount"]

step(
    "dense_items",
    "SELECT g.monthly_period, g.shop_id, g.item_id, f.item_category_id, f.price, coalesce(f.amount, 0) AS amount FROM grid g "
    "LEFT JOIN facts f ON f.monthly_period = g.monthly_period AND f.shop_id = g.shop_id AND f.item_id = g.item_id",
)
step(
    "with_category",
    "SELECT d.* REPLACE (coalesce(d.item_category_id, i.item_category_id) AS item_category_id) FROM dense_items d "
    "LEFT JOIN item_list i ON i.item_id = d.item_id",
)


@query("densify_zero_sales", digest_sql("dense_items", PERIOD_SHOP, DENSE, ["price", "amount"]))
def _(spark, sf_dir):
    return digest(dense_items(builder(spark, sf_dir)), PERIOD_SHOP, DENSE)


@query("backfill_category", digest_sql("with_category", PERIOD_SHOP, DENSE, ["price", "amount"]))
def _(spark, sf_dir):
    return digest(backfilled_sales(*lists(builder(spark, sf_dir)), SPEC), PERIOD_SHOP, DENSE)


PRICED = [*GRID, "item_category_id", "price", "price_level"]


@query("price_cascade", digest_sql("leveled", PERIOD_SHOP, PRICED, ["price"]))
def _(spark, sf_dir):
    return digest(priced_grid(*lists(builder(spark, sf_dir)), SPEC), PERIOD_SHOP, PRICED)


@query("densify_category_sales", "SELECT monthly_period, shop_id, item_category_id, amount FROM category_panel")
def _(spark, sf_dir):
    return dense_categories(builder(spark, sf_dir))


ATTACHED = [*GRID, "item_category_id", "amount_item", "amount_cat"]


@query("attach_category_amount", digest_sql("base", PERIOD_SHOP, ATTACHED, ["amount_item", "amount_cat"]))
def _(spark, sf_dir):
    return digest(sales_with_totals(*lists(builder(spark, sf_dir)), SPEC), PERIOD_SHOP, ATTACHED)


@query("monthly_panel", digest_sql("base", PERIOD_SHOP, SPEC.base_columns, BASE_DOUBLES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = builder(spark, sf_dir)
    return digest(monthly_panel(b.facts(), b.tables["item_list"], b.tables["shop_list"], SPEC), PERIOD_SHOP, SPEC.base_columns)


def panel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month: cells, amounts, and where the prices come from."""
    b = builder(spark, sf_dir)
    panel = monthly_panel(b.facts(), b.tables["item_list"], b.tables["shop_list"], SPEC, with_level=True)
    levels = [F.count_if(F.col("price_level") == i).alias(f"price_level_{i}") for i in range(5)]
    return panel.groupBy("monthly_period").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount_item").alias("amount_item"), F.sum("amount_cat").alias("amount_cat"), *levels
    )


query(
    "panel_summary",
    "SELECT b.monthly_period, count(*) AS rows, sum(b.amount_item) AS amount_item, sum(b.amount_cat) AS amount_cat, "
    + ", ".join(f"count(*) FILTER (price_level = {i}) AS price_level_{i}" for i in range(5))
    + " FROM base b JOIN leveled l ON l.monthly_period = b.monthly_period AND l.shop_id = b.shop_id AND l.item_id = b.item_id "
    "GROUP BY b.monthly_period",
)(panel_summary)


@query("sort_panel", "SELECT monthly_period, shop_id, item_category_id, amount FROM category_panel ORDER BY 1, 2, 3")
def _(spark, sf_dir):
    return dense_categories(builder(spark, sf_dir)).orderBy("monthly_period", "shop_id", "item_category_id")
