"""Reading, typing, naming and saving."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.enrich import enrich_transactions, entity_pair, handle_dates
from shelfcast.operators.features import calendar_features, drop_label_columns, last_period_rows
from shelfcast.functions.scalars import cyclic, period_label, rounded_count, weekday_name
from shelfcast.plans.forecast import attach_forecast
from shelfcast.plans.panel import panel_rows
from shelfcast.session import shared_dir
from shelfcast.sources.stages import path_exists, scan_stage, write_predictions_csv, write_stage
from shelfcast.sources.tables import CSV_OPTIONS, drop_index_columns, fix_schema, load_tables, narrow_numeric_types, scan_csv, TABLE_TYPES
from workloads.digest import digest, digest_sql
from workloads.registry import query
from workloads.retail import SPEC, builder, raw_tables, retail_table, retail_tables, sales

PERIOD_SHOP = ["monthly_period", "shop_id"]
BASE_DOUBLES = ["price", "amount_item", "amount_cat"]


def scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    folder = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{folder}/{name}"


def csv_root(spark: SparkSession, sf_dir: str) -> str:
    """The raw tables as CSV files, with the row-number column a saved frame has; written once."""
    root = scratch(spark, sf_dir, "raw")
    for name, df in raw_tables(spark, sf_dir).items():
        path = f"{root}/{name}.csv"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            numbered = df.select(F.monotonically_increasing_id().alias("Unnamed: 0"), "*")
            numbered.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return root


SALE_TYPES = {"order_id": "bigint", "line_no": "int", **TABLE_TYPES["transaction"]}


@query(
    "scan_csv",
    "SELECT order_id, line_no, strftime(date, '%d.%m.%Y') AS date, shop_id AS shop, item_id AS item, price, amount FROM sales",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, f"{csv_root(spark, sf_dir)}/transaction.csv", SALE_TYPES)


@query(
    "scan_csv_names",
    """SELECT item_id, ' "' || item_name || '", no. "' || item_category_id || '", ' AS item_name, item_category_id FROM item_list""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item names with quotes, commas and blanks at both ends, written and read back."""
    path = scratch(spark, sf_dir, "names.csv")
    named = F.concat(F.lit(' "'), "item_name", F.lit('", no. "'), F.col("item_category_id").cast("string"), F.lit('", '))
    retail_table(spark, sf_dir, "item_list").withColumn("item_name", named).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return scan_csv(spark, path, TABLE_TYPES["item_list"])


@query(
    "narrow_numeric_types",
    "SELECT CAST(order_id AS INT) AS order_id, line_no, shop_id, item_id, "
    "CAST(price AS FLOAT) AS price, CAST(amount AS FLOAT) AS amount FROM sales",
)
def _(spark, sf_dir):
    return narrow_numeric_types(sales(spark, sf_dir).drop("date"))


@query("drop_index_columns", "SELECT r_regionkey AS shop_id, r_name AS shop_name FROM region")
def _(spark, sf_dir):
    saved = spark.read.option("header", True).csv(f"{csv_root(spark, sf_dir)}/shop_list.csv")
    return drop_index_columns(saved).select(F.col("shop_id").cast("int").alias("shop_id"), "shop_name")


@query(
    "load_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows FROM {source}"
        for name, source in {
            "shop_list": "shop_list",
            "item_list": "item_list",
            "category_list": "category_list",
            "transaction": "sales",
            "test": "requests",
        }.items()
    ),
)
def _(spark, sf_dir):
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in load_tables(spark, csv_root(spark, sf_dir)).items()
    ]
    result = counted[0]
    for c in counted[1:]:
        result = result.unionByName(c)
    return result


@query(
    "scan_parquet",
    "SELECT item_category_id, CAST(sum(amount_item) AS DOUBLE) AS amount FROM base GROUP BY item_category_id",
)
def _(spark, sf_dir):
    panel = builder(spark, sf_dir)
    panel.base()
    paths = panel.store.part_paths("base", panel.base_settings, list(panel.stage_parts))
    saved = panel_rows({part: scan_stage(spark, path) for part, path in paths.items()}, SPEC)
    return saved.groupBy("item_category_id").agg(F.sum("amount_item").alias("amount"))


@query("write_stage", digest_sql("base", PERIOD_SHOP, SPEC.base_columns, BASE_DOUBLES))
def _(spark, sf_dir):
    path = scratch(spark, sf_dir, "written_base")
    write_stage(builder(spark, sf_dir).base(), path, ["monthly_period"])
    return digest(scan_stage(spark, path), PERIOD_SHOP, SPEC.base_columns)


@query(
    "cached_stage",
    "SELECT min(monthly_period) AS first_period, max(monthly_period) AS last_period, count(*) AS rows, "
    "TRUE AS same_files FROM features",
)
def _(spark, sf_dir):
    panel = builder(spark, sf_dir)
    first, again = panel.features(), panel.features()
    reused = sorted(first.inputFiles()) == sorted(again.inputFiles())
    return again.agg(
        F.min("monthly_period").alias("first_period"),
        F.max("monthly_period").alias("last_period"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("same_files", F.lit(reused))


@query(
    "write_predictions_csv",
    "SELECT r.shop_id AS shop, r.item_id AS item, f.amount_item AS amount FROM requests r "
    "LEFT JOIN last_features f ON f.shop_id = r.shop_id AND f.item_id = r.item_id",
)
def _(spark, sf_dir):
    path = scratch(spark, sf_dir, "predictions")
    write_predictions_csv(attach_forecast(raw_tables(spark, sf_dir)["test"], carried_forward(spark, sf_dir), SPEC), path)
    return scan_csv(spark, path, {"shop": "int", "item": "int", "amount": "double"})


def carried_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The naive forecast: next month sells what the last one did."""
    last = last_period_rows(builder(spark, sf_dir).features(), SPEC)
    return last.select(F.col("shop_id").alias("shop"), F.col("item_id").alias("item"), F.col("amount_item").alias("amount"))


@query(
    "attach_forecast",
    "SELECT r.shop_id AS shop, r.item_id AS item, f.amount_item AS amount FROM requests r "
    "LEFT JOIN last_features f ON f.shop_id = r.shop_id AND f.item_id = r.item_id",
)
def _(spark, sf_dir):
    return attach_forecast(raw_tables(spark, sf_dir)["test"], carried_forward(spark, sf_dir), SPEC)


@query(
    "round_forecast",
    "SELECT r.shop_id AS shop, r.item_id AS item, CAST(round_even(f.amount_item / 2, 0) AS INT) AS amount "
    "FROM requests r LEFT JOIN last_features f ON f.shop_id = r.shop_id AND f.item_id = r.item_id",
)
def _(spark, sf_dir):
    forecast = attach_forecast(raw_tables(spark, sf_dir)["test"], carried_forward(spark, sf_dir), SPEC)
    return forecast.withColumn("amount", rounded_count(F.col("amount") / 2))


@query(
    "fix_schema",
    "SELECT order_id, line_no, strftime(date, '%d.%m.%Y') AS date, shop_id, item_id, price, amount FROM sales",
)
def _(spark, sf_dir):
    return fix_schema(raw_tables(spark, sf_dir)["transaction"])


@query("project_columns", "SELECT shop_id, item_id, price FROM sales")
def _(spark, sf_dir):
    return sales(spark, sf_dir).select("shop_id", "item_id", "price")


@query(
    "drop_label_columns",
    digest_sql("base", PERIOD_SHOP, ["monthly_period", "shop_id", "item_id", "item_category_id", "year", "month"], []),
)
def _(spark, sf_dir):
    left = drop_label_columns(builder(spark, sf_dir).base(), SPEC)
    return digest(left, PERIOD_SHOP, left.columns)


@query(
    "parse_date",
    "SELECT order_id, line_no, item_id, CAST(strptime(strftime(date, '%d.%m.%Y'), '%d.%m.%Y') AS DATE) AS date FROM sales",
)
def _(spark, sf_dir):
    dated = handle_dates(retail_tables(spark, sf_dir)["transaction"], SPEC)
    return dated.select("order_id", "line_no", "item_id", "date")


@query(
    "month_period",
    "SELECT order_id, line_no, item_id, CAST(date_trunc('month', date) AS DATE) AS monthly_period FROM sales",
)
def _(spark, sf_dir):
    dated = handle_dates(retail_tables(spark, sf_dir)["transaction"], SPEC)
    return dated.select("order_id", "line_no", "item_id", "monthly_period")


@query(
    "calendar_features",
    "SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS monthly_period, CAST(year(date) AS INT) AS year, "
    "CAST(month(date) AS INT) AS month FROM sales",
)
def _(spark, sf_dir):
    dated = handle_dates(retail_tables(spark, sf_dir)["transaction"], SPEC)
    return calendar_features(dated.select("monthly_period").distinct(), SPEC)


@query(
    "day_of_week",
    "SELECT date, CAST(isodow(date) - 1 AS INT) AS dayofweek, dayname(date) AS weekday_name, count(*) AS rows "
    "FROM sales GROUP BY date",
)
def _(spark, sf_dir):
    days = sales(spark, sf_dir).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    return days.select("date", F.weekday("date").alias("dayofweek"), weekday_name("date").alias("weekday_name"), "rows")


@query("period_label", "SELECT strftime(date, '%Y-%m') AS \"Period\", count(*) AS rows FROM sales GROUP BY 1")
def _(spark, sf_dir):
    return sales(spark, sf_dir).groupBy(period_label("date").alias("Period")).agg(F.count(F.lit(1)).alias("rows"))


@query("cast_category_int", "SELECT item_id, CAST(CAST(item_category_id AS DOUBLE) AS INT) AS item_category_id FROM item_list")
def _(spark, sf_dir):
    as_read_back = retail_table(spark, sf_dir, "item_list").select("item_id", F.col("item_category_id").cast("double"))
    return as_read_back.withColumn("item_category_id", F.col("item_category_id").cast("int"))


@query(
    "fill_zero",
    "SELECT r.shop_id, r.item_id, coalesce(CAST(s.amount AS DOUBLE), 0) AS amount FROM requests r "
    "LEFT JOIN (SELECT shop_id, item_id, sum(amount) AS amount FROM sales GROUP BY ALL) s "
    "ON s.shop_id = r.shop_id AND s.item_id = r.item_id",
)
def _(spark, sf_dir):
    sold = sales(spark, sf_dir).groupBy("shop_id", "item_id").agg(F.sum("amount").alias("amount"))
    return retail_table(spark, sf_dir, "requests").join(sold, ["shop_id", "item_id"], "left").fillna({"amount": 0.0})


@query("entity_pair", "SELECT DISTINCT shop_id AS pair_shop, item_id AS pair_item FROM sales")
def _(spark, sf_dir):
    pairs = entity_pair(sales(spark, sf_dir), SPEC).select("shop_item").distinct()
    return pairs.select(F.col("shop_item.shop_id").alias("pair_shop"), F.col("shop_item.item_id").alias("pair_item"))


@query(
    "cyclic_encode",
    "SELECT DISTINCT CAST(month(date) AS INT) AS month, round(sin(month(date) / 12.0 * 2 * pi()), 6) AS sin_month, "
    "round(cos(month(date) / 12.0 * 2 * pi()), 6) AS cos_month FROM sales",
)
def _(spark, sf_dir):
    months = sales(spark, sf_dir).select(F.month("date").alias("month")).distinct()
    waves = {f"{w}_month": F.round(cyclic("month", 12, w), 6) for w in ("sin", "cos")}
    return months.withColumns(waves)


@query(
    "enrich_transactions",
    "SELECT s.order_id, s.line_no, s.date, s.shop_id, s.item_id, s.price, s.amount, i.item_name, i.item_category_id, "
    "c.item_category_name, h.shop_name FROM sales s LEFT JOIN item_list i ON i.item_id = s.item_id "
    "LEFT JOIN category_list c ON c.item_category_id = i.item_category_id LEFT JOIN shop_list h ON h.shop_id = s.shop_id",
)
def _(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    return enrich_transactions(sales(spark, sf_dir), t["item_list"], t["category_list"], t["shop_list"], SPEC)
