"""The given tables as a retail chain: regions are shops, parts are items, brands are categories.

Every row of every table is used. The awkward cases a panel has to survive come
from the values of a row, never from leaving rows out:

* returned first lines are sold in negative amounts, bulk tax codes in outlying ones;
* untaxed, undiscounted lines carry the price -1, some have no price at all,
  and no line of a size-1 part or of brand 13 has one;
* suppliers in debt sell under a shop number the shop list does not know, and
  some lines name an item the item list does not know;
* the last region sells through the shop before it, so one shop has no sale, nor have
  the announced items, one for each brand;
* shipments of July 1997 move on by 31 days, so that a month is missing everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.plans.panel import PanelBuilder
from shelfcast.session import shared_dir
from shelfcast.sources.stages import StageStore
from shelfcast.sources.tables import fix_schema, request_schema
from shelfcast.spec import PanelSpec

SPEC = PanelSpec(price_decimals=2)
SALE_KEYS = ["order_id", "line_no", "item_id"]

RETAIL_TEMPLATES = {
    "shop_list": "SELECT r_regionkey AS shop_id, r_name AS shop_name FROM {region}",
    "category_list": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS item_category_id, p_brand AS item_category_name FROM {part}""",
    "item_list": """
        SELECT CAST(p_partkey AS INT) AS item_id, p_name AS item_name, CAST(substr(p_brand, 7) AS INT) AS item_category_id
        FROM {part}
        UNION ALL
        SELECT DISTINCT 100000000 + CAST(substr(p_brand, 7) AS INT), 'announced ' || p_brand, CAST(substr(p_brand, 7) AS INT)
        FROM {part}""",
    "sales": """
        SELECT
          l_orderkey AS order_id, l_linenumber AS line_no,
          CASE WHEN l_shipdate >= DATE '1997-07-01' AND l_shipdate < DATE '1997-08-01'
               THEN CAST(l_shipdate + INTERVAL 31 DAY AS DATE) ELSE CAST(l_shipdate AS DATE) END AS date,
          CASE WHEN s_acctbal < 0 THEN -1 WHEN n_regionkey = 4 THEN 3 ELSE n_regionkey END AS shop_id,
          CAST(CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' AND l_discount > 0.095
               THEN -1 - l_partkey ELSE l_partkey END AS INT) AS item_id,
          CASE WHEN l_tax < 0.005 AND l_discount < 0.005 THEN CAST(-1 AS DOUBLE)
               WHEN l_tax > 0.075 AND l_discount > 0.095 THEN NULL
               WHEN p_size = 1 OR p_brand = 'Brand#13' THEN NULL
               ELSE CAST(floor((2 * round(l_extendedprice * 100) + l_quantity) / (2 * l_quantity)) AS DOUBLE) / 100 END AS price,
          CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_quantity
               WHEN l_tax > 0.075 AND l_discount < 0.005 THEN l_quantity * 40 ELSE l_quantity END AS DOUBLE) AS amount
        FROM {lineitem}
        JOIN {supplier} ON l_suppkey = s_suppkey
        JOIN {nation} ON s_nationkey = n_nationkey
        JOIN {part} ON l_partkey = p_partkey""",
    "requests": """
        SELECT DISTINCT n_regionkey AS shop_id,
          CAST(CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' AND l_discount > 0.095
               THEN -1 - l_partkey ELSE l_partkey END AS INT) AS item_id
        FROM {lineitem}
        JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey""",
}
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
RETAIL_SQL = {name: text.format_map({t: t for t in SOURCES}) for name, text in RETAIL_TEMPLATES.items()}


def retail_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables above; the same text runs in DuckDB."""
    template = RETAIL_TEMPLATES[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES if f"{{{t}}}" in template}
    return spark.sql(template, **tables)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with their dates as dates and keys named as in the dimensions."""
    return retail_table(spark, sf_dir, "sales")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables as their files hold them: text dates, keys named ``shop`` and ``item``."""
    tables = {t: retail_table(spark, sf_dir, t) for t in ("shop_list", "item_list", "category_list")}
    text_dates = sales(spark, sf_dir).withColumn("date", F.date_format("date", "dd.MM.yyyy"))
    tables["transaction"] = request_schema(text_dates)
    tables["test"] = request_schema(retail_table(spark, sf_dir, "requests"))
    return tables


def retail_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = raw_tables(spark, sf_dir)
    return tables | {"transaction": fix_schema(tables["transaction"])}


def builder(spark: SparkSession, sf_dir: str, spec: PanelSpec = SPEC, root: str | None = None) -> PanelBuilder:
    """Stages live below the shared folder, apart for each Spark application."""
    root = root or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    return PanelBuilder(retail_tables(spark, sf_dir), StageStore(spark, root), sf_dir, spec)
