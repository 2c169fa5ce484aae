"""Flags, limits and the cleaned sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.cleaning import (
    clean_transactions,
    cleaning_report,
    flag_negatives,
    flag_outliers,
    iqr_limits,
    std_limits,
)
from shelfcast.operators.enrich import enrich_transactions, handle_dates
from workloads.registry import query, step
from workloads.retail import SPEC, retail_tables, sales

SALE = "order_id, line_no, item_id"

step(
    "limits",
    "SELECT avg(price) - 3 * stddev_samp(price) AS lower_price, avg(price) + 3 * stddev_samp(price) AS upper_price, "
    "avg(amount) - 3 * stddev_samp(amount) AS lower_amount, avg(amount) + 3 * stddev_samp(amount) AS upper_amount FROM sales",
)
step(
    "quartiles",
    "SELECT quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3, "
    "quantile_cont(amount, 0.25) AS a1, quantile_cont(amount, 0.75) AS a3 FROM sales",
)
step(
    "iqr_ends",
    "SELECT p1 - 1.5 * (p3 - p1) AS lower_price, p3 + 1.5 * (p3 - p1) AS upper_price, "
    "a1 - 1.5 * (a3 - a1) AS lower_amount, a3 + 1.5 * (a3 - a1) AS upper_amount FROM quartiles",
)
step(
    "flagged",
    "SELECT s.*, coalesce(price < 0, FALSE) AS negative_price, coalesce(amount < 0, FALSE) AS negative_amount, "
    "coalesce(price < lower_price OR price > upper_price, FALSE) AS outlier_price, "
    "coalesce(amount < lower_amount OR amount > upper_amount, FALSE) AS outlier_amount FROM sales s, limits",
)
step(
    "cleaned",
    "SELECT f.order_id, f.line_no, f.date, CAST(date_trunc('month', f.date) AS DATE) AS monthly_period, f.shop_id, f.item_id, "
    "f.price, CAST(round(f.price * 100) AS BIGINT) AS cents, f.amount, i.item_category_id, i.item_name FROM flagged f "
    "LEFT JOIN item_list i ON i.item_id = f.item_id "
    "WHERE NOT (negative_price OR negative_amount OR outlier_price OR outlier_amount)",
)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched fact with its month."""
    t = retail_tables(spark, sf_dir)
    return handle_dates(enrich_transactions(t["transaction"], t["item_list"], t["category_list"], t["shop_list"], SPEC), SPEC)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(daily(spark, sf_dir))


@query("flag_negatives", f"SELECT {SALE}, NOT (negative_price OR negative_amount) AS valid FROM flagged")
def _(spark, sf_dir):
    return flag_negatives(sales(spark, sf_dir)).select("order_id", "line_no", "item_id", "valid")


@query("flag_outliers_std", f"SELECT {SALE}, NOT (outlier_price OR outlier_amount) AS valid FROM flagged")
def _(spark, sf_dir):
    return flag_outliers(sales(spark, sf_dir)).select("order_id", "line_no", "item_id", "valid")


@query(
    "flag_outliers_iqr",
    f"SELECT {SALE}, NOT (coalesce(price < lower_price OR price > upper_price, FALSE) "
    "OR coalesce(amount < lower_amount OR amount > upper_amount, FALSE)) AS valid FROM sales, iqr_ends",
)
def _(spark, sf_dir):
    return flag_outliers(sales(spark, sf_dir), method="iqr").select("order_id", "line_no", "item_id", "valid")


@query(
    "clean_transactions",
    "SELECT order_id, line_no, date, shop_id, item_id, price, amount FROM cleaned",
)
def _(spark, sf_dir):
    return clean_transactions(sales(spark, sf_dir))


@query(
    "threshold_filter",
    "SELECT CAST(count(*) FILTER (price < 0) AS BIGINT) AS price_below_0, count(*) FILTER (price > 100000) AS price_above_100000, "
    "count(*) FILTER (price > 200000) AS price_above_200000, count(*) FILTER (amount < -5) AS amount_below_minus_5, "
    "count(*) FILTER (amount < 0) AS amount_below_0, count(*) FILTER (amount > 500) AS amount_above_500 FROM sales",
)
def _(spark, sf_dir):
    price, amount = F.col("price"), F.col("amount")
    return sales(spark, sf_dir).agg(
        F.count_if(price < 0).alias("price_below_0"),
        F.count_if(price > 100000).alias("price_above_100000"),
        F.count_if(price > 200000).alias("price_above_200000"),
        F.count_if(amount < -5).alias("amount_below_minus_5"),
        F.count_if(amount < 0).alias("amount_below_0"),
        F.count_if(amount > 500).alias("amount_above_500"),
    )


@query(
    "split_by_null",
    "SELECT price IS NOT NULL AS has_price, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS amount FROM sales GROUP BY 1",
)
def _(spark, sf_dir):
    return (
        sales(spark, sf_dir)
        .groupBy(F.col("price").isNotNull().alias("has_price"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))
    )


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) for c in df.columns])


ENDS = ("lower_price", "upper_price", "lower_amount", "upper_amount")


@query("std_limits", f"SELECT {', '.join(f'round({e}, 4) AS {e}' for e in ENDS)} FROM limits")
def _(spark, sf_dir):
    return _rounded(std_limits(sales(spark, sf_dir)))


@query("iqr_limits", f"SELECT {', '.join(f'round({e}, 4) AS {e}' for e in ENDS)} FROM iqr_ends")
def _(spark, sf_dir):
    return _rounded(iqr_limits(sales(spark, sf_dir)))


RULES = ("negative_price", "negative_amount", "outlier_price", "outlier_amount")


@query(
    "cleaning_report",
    f"SELECT count(*) AS rows, {', '.join(f'CAST(sum(CAST({r} AS INT)) AS BIGINT) AS {r}' for r in RULES)}, "
    f"count(*) FILTER ({' OR '.join(RULES)}) AS removed, "
    f"round(count(*) FILTER ({' OR '.join(RULES)}) / count(*), 6) AS loss_rate FROM flagged",
)
def _(spark, sf_dir):
    return cleaning_report(sales(spark, sf_dir)).withColumn("loss_rate", F.round("loss_rate", 6))
