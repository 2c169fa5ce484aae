"""Data profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.enrich import unrepresented, unseen_pairs
from shelfcast.operators.profile import (
    amounts_by,
    boxplot_stats,
    completeness_profile,
    daily_counts,
    data_profile,
    date_range,
    describe_columns,
    distinct_counts,
    distinct_entities,
    grid_cardinality,
    missing_report,
    month_of_year_amounts,
    price_amount_correlation,
    shop_period_amounts,
    table_shapes,
    threshold_rows,
    top_categories,
    weekday_amounts,
)
from shelfcast.plans.panel import monthly_panel
from workloads.queries.cleaning import cleaned, daily
from workloads.queries import splits  # noqa: F401
from workloads.registry import ORACLES, query, step
from workloads.retail import SPEC, builder, retail_table, retail_tables, sales

step(
    "named",
    "SELECT c.*, k.item_category_name FROM cleaned c LEFT JOIN category_list k ON k.item_category_id = c.item_category_id",
)


@query(
    "table_shapes",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, {columns} AS columns FROM {source}"
        for name, source, columns in [
            ("shop_list", "shop_list", 2),
            ("item_list", "item_list", 3),
            ("category_list", "category_list", 2),
            ("transaction", "sales", 7),
            ("test", "requests", 2),
        ]
    ),
)
def _(spark, sf_dir):
    return table_shapes(retail_tables(spark, sf_dir))


@query(
    "distinct_counts",
    "SELECT 'items' AS name, count(DISTINCT item_id) AS n FROM item_list "
    "UNION ALL SELECT 'shops', count(DISTINCT shop_id) FROM shop_list "
    "UNION ALL SELECT 'categories', count(DISTINCT item_category_id) FROM category_list "
    "UNION ALL SELECT 'items_sold', count(DISTINCT item_id) FROM sales "
    "UNION ALL SELECT 'shops_selling', count(DISTINCT shop_id) FROM sales",
)
def _(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    return distinct_counts(
        {
            "items": (t["item_list"], "item_id"),
            "shops": (t["shop_list"], "shop_id"),
            "categories": (t["category_list"], "item_category_id"),
            "items_sold": (t["transaction"], "item_id"),
            "shops_selling": (t["transaction"], "shop_id"),
        }
    )


@query(
    "distinct_entities",
    "SELECT 'shop' AS role, CAST(shop_id AS VARCHAR) AS entity FROM (SELECT DISTINCT shop_id FROM shop_list) "
    "UNION ALL SELECT 'item', CAST(item_id AS VARCHAR) FROM (SELECT DISTINCT item_id FROM item_list) "
    "UNION ALL SELECT 'category', CAST(item_category_id AS VARCHAR) FROM (SELECT DISTINCT item_category_id FROM item_list) "
    "UNION ALL SELECT 'period', CAST(monthly_period AS VARCHAR) FROM (SELECT DISTINCT monthly_period FROM cleaned)",
)
def _(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    lists = {
        "shop": (t["shop_list"], "shop_id"),
        "item": (t["item_list"], "item_id"),
        "category": (t["item_list"], "item_category_id"),
        "period": (builder(spark, sf_dir).cleaned(), "monthly_period"),
    }
    return reduce(
        DataFrame.unionByName,
        [distinct_entities(df, c).select(F.lit(r).alias("role"), F.col(c).cast("string").alias("entity")) for r, (df, c) in lists.items()],
    )


@query("date_range", "SELECT min(date) AS first_date, max(date) AS last_date FROM sales")
def _(spark, sf_dir):
    return date_range(daily(spark, sf_dir))


def described_sql(column: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count({column}) AS count, round(avg({column}), 4) AS mean, "
        f"round(stddev_samp({column}), 4) AS std, min({column}) AS min, max({column}) AS max, "
        f"round(quantile_cont({column}, 0.25), 4) AS q25, round(quantile_cont({column}, 0.5), 4) AS q50, "
        f"round(quantile_cont({column}, 0.75), 4) AS q75 FROM {source}"
    )


def _rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


SPREAD = ["mean", "std", "q25", "q50", "q75"]


@query("describe_column", described_sql("price", "sales") + " UNION ALL " + described_sql("amount", "sales"))
def _(spark, sf_dir):
    return _rounded(describe_columns(sales(spark, sf_dir), ["price", "amount"]), SPREAD)


@query("describe_cleaned", described_sql("price", "cleaned") + " UNION ALL " + described_sql("amount", "cleaned"))
def _(spark, sf_dir):
    return _rounded(describe_columns(cleaned(spark, sf_dir), ["price", "amount"]), SPREAD)


@query("daily_transaction_counts", "SELECT date, count(*) AS count FROM cleaned GROUP BY date")
def _(spark, sf_dir):
    return daily_counts(cleaned(spark, sf_dir), SPEC)


@query("daily_amounts", "SELECT date, CAST(sum(amount) AS DOUBLE) AS amount FROM cleaned GROUP BY date")
def _(spark, sf_dir):
    return amounts_by(cleaned(spark, sf_dir), ["date"], SPEC)


@query(
    "month_of_year_amounts",
    "SELECT CAST(month(date) AS INT) AS month, CAST(sum(amount) AS DOUBLE) AS amount FROM cleaned GROUP BY 1",
)
def _(spark, sf_dir):
    return month_of_year_amounts(cleaned(spark, sf_dir), SPEC)


@query(
    "weekday_amounts",
    "SELECT CAST(isodow(date) - 1 AS INT) AS dayofweek, dayname(date) AS weekday_name, CAST(sum(amount) AS DOUBLE) AS amount "
    "FROM cleaned GROUP BY 1, 2",
)
def _(spark, sf_dir):
    return weekday_amounts(cleaned(spark, sf_dir), SPEC)


@query("shop_amounts", "SELECT shop_id, CAST(sum(amount) AS DOUBLE) AS amount FROM cleaned GROUP BY shop_id")
def _(spark, sf_dir):
    return amounts_by(cleaned(spark, sf_dir), ["shop_id"], SPEC)


@query(
    "shop_period_amounts",
    "SELECT strftime(date, '%Y-%m') AS \"Period\", shop_id, CAST(sum(amount) AS DOUBLE) AS amount FROM cleaned GROUP BY 1, 2",
)
def _(spark, sf_dir):
    return shop_period_amounts(cleaned(spark, sf_dir), SPEC)


@query(
    "top_categories",
    "SELECT item_category_name, CAST(sum(amount) AS DOUBLE) AS amount FROM named WHERE item_category_name IS NOT NULL "
    "GROUP BY 1 HAVING sum(amount) > 10000 ORDER BY 2 DESC, 1",
)
def _(spark, sf_dir):
    return top_categories(cleaned(spark, sf_dir), 10000, SPEC)


@query(
    "having_threshold",
    "SELECT item_id, CAST(sum(amount) AS DOUBLE) AS amount FROM cleaned GROUP BY 1 HAVING sum(amount) > 500",
)
def _(spark, sf_dir):
    return amounts_by(cleaned(spark, sf_dir), ["item_id"], SPEC).where(F.col("amount") > 500)


@query(
    "sort_desc",
    "SELECT item_category_name, CAST(sum(amount) AS DOUBLE) AS amount FROM named WHERE item_category_name IS NOT NULL "
    "GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _(spark, sf_dir):
    return amounts_by(cleaned(spark, sf_dir), ["item_category_name"], SPEC).orderBy(F.desc("amount"), "item_category_name")


def boxplot_sql(column: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75, "
        f"min({column}) FILTER ({column} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_low, "
        f"max({column}) FILTER ({column} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_high, "
        f"count({column}) FILTER ({column} < q25 - 1.5 * (q75 - q25) OR {column} > q75 + 1.5 * (q75 - q25)) AS outliers "
        f"FROM {source}, (SELECT quantile_cont({column}, 0.25) AS q25, quantile_cont({column}, 0.5) AS q50, "
        f"quantile_cont({column}, 0.75) AS q75 FROM {source}) GROUP BY q25, q50, q75"
    )


@query("boxplot_stats", boxplot_sql("price", "sales") + " UNION ALL " + boxplot_sql("amount", "sales"))
def _(spark, sf_dir):
    return _rounded(boxplot_stats(sales(spark, sf_dir), ["price", "amount"]), ["q25", "q50", "q75"])


@query(
    "price_amount_correlation",
    "SELECT count(*) AS pairs, round(corr(price, amount), 6) AS correlation FROM sales WHERE price IS NOT NULL AND amount IS NOT NULL",
)
def _(spark, sf_dir):
    return _rounded(price_amount_correlation(sales(spark, sf_dir), SPEC), ["correlation"], 6)


DAILY_TYPES = {
    "order_id": "bigint", "line_no": "int", "date": "date", "shop_id": "int", "item_id": "int", "price": "double",
    "amount": "double", "item_name": "string", "item_category_id": "int", "item_category_name": "string",
    "shop_name": "string", "monthly_period": "date",
}
step(
    "enriched",
    "SELECT s.*, i.item_name, i.item_category_id, c.item_category_name, h.shop_name, "
    "CAST(date_trunc('month', s.date) AS DATE) AS monthly_period FROM sales s LEFT JOIN item_list i ON i.item_id = s.item_id "
    "LEFT JOIN category_list c ON c.item_category_id = i.item_category_id LEFT JOIN shop_list h ON h.shop_id = s.shop_id",
)


@query(
    "completeness_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS known, count(*) AS rows FROM enriched" for c, t in DAILY_TYPES.items()
    ),
)
def _(spark, sf_dir):
    return completeness_profile(daily(spark, sf_dir))


@query(
    "missing_report",
    "SELECT count(*) AS rows, count(*) FILTER (item_category_id IS NULL) AS missing_category, "
    + ", ".join(
        f"count(*) FILTER (price_level > {i}) AS missing_after_{s}"
        for i, s in enumerate(["own_month", "shop_item", "item", "category", "global"])
    )
    + " FROM leveled",
)
def _(spark, sf_dir):
    b = builder(spark, sf_dir)
    leveled = monthly_panel(b.facts(), b.tables["item_list"], b.tables["shop_list"], SPEC, with_level=True)
    return missing_report(leveled)


@query(
    "grid_cardinality",
    "SELECT (SELECT count(*) FROM (SELECT DISTINCT shop_id, item_id FROM sales)) AS seen_pairs, "
    "(SELECT count(*) FROM shop_list) * (SELECT count(*) FROM item_list) AS all_pairs, "
    "round((SELECT count(*) FROM (SELECT DISTINCT shop_id, item_id FROM sales)) / "
    "((SELECT count(*) FROM shop_list) * (SELECT count(*) FROM item_list)), 6) AS seen_share",
)
def _(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    return _rounded(grid_cardinality(t["shop_list"], t["item_list"], t["transaction"], SPEC), ["seen_share"], 6)


@query(
    "unseen_pairs",
    "SELECT r.shop_id, r.item_id FROM requests r WHERE NOT EXISTS "
    "(SELECT 1 FROM sales s WHERE s.shop_id = r.shop_id AND s.item_id = r.item_id)",
)
def _(spark, sf_dir):
    return unseen_pairs(retail_table(spark, sf_dir, "requests"), sales(spark, sf_dir), SPEC)


@query("pair_difference", "SELECT shop_id, item_id FROM requests EXCEPT SELECT shop_id, item_id FROM sales")
def _(spark, sf_dir):
    return retail_table(spark, sf_dir, "requests").subtract(sales(spark, sf_dir).select("shop_id", "item_id"))


@query(
    "unrepresented_entities",
    "SELECT 'item' AS role, item_id AS entity FROM item_list WHERE item_id NOT IN (SELECT item_id FROM sales) "
    "UNION ALL SELECT 'shop', shop_id FROM shop_list WHERE shop_id NOT IN (SELECT shop_id FROM sales)",
)
def _(spark, sf_dir):
    """Items and shops without a single sale."""
    t, sold = retail_tables(spark, sf_dir), sales(spark, sf_dir)
    items = unrepresented(t["item_list"], sold, "item_id").select(F.lit("item").alias("role"), F.col("item_id").alias("entity"))
    shops = unrepresented(t["shop_list"], sold, "shop_id").select(F.lit("shop").alias("role"), F.col("shop_id").alias("entity"))
    return items.unionByName(shops)


@query(
    "union_all",
    "SELECT shop_id, item_id, 'sold' AS origin FROM sales UNION ALL SELECT shop_id, item_id, 'requested' FROM requests",
)
def _(spark, sf_dir):
    sold = sales(spark, sf_dir).select("shop_id", "item_id", F.lit("sold").alias("origin"))
    return sold.unionByName(retail_table(spark, sf_dir, "requests").withColumn("origin", F.lit("requested")))


BEYOND = ["price < 0", "price > 100000", "price > 200000", "amount < -5", "amount < 0", "amount > 500"]


@query(
    "threshold_rows",
    "SELECT order_id, line_no, item_id, price, amount, "
    + " || ".join(f"CASE WHEN {b} THEN '{b};' ELSE '' END" for b in BEYOND)
    + f" AS beyond FROM sales WHERE {' OR '.join(BEYOND)}",
)
def _(spark, sf_dir):
    rows = threshold_rows(sales(spark, sf_dir))
    return rows.select("order_id", "line_no", "item_id", "price", "amount", F.concat(F.array_join("beyond", ";"), F.lit(";")).alias("beyond"))


# Each report of the profile: a query with the same rows, and a number to add up over them.
PROFILE = {
    "table_shapes": ("table_shapes", "rows"),
    "completeness": ("completeness_profile", "known"),
    "date_range": ("date_range", "year(first_date) + year(last_date)"),
    "describe_raw": ("describe_column", "count"),
    "describe_cleaned": ("describe_cleaned", "count"),
    "boxplot_raw": ("boxplot_stats", "outliers"),
    "correlation": ("price_amount_correlation", "pairs"),
    "daily_counts": ("daily_transaction_counts", "count"),
    "daily_amounts": ("daily_amounts", "amount"),
    "month_amounts": ("month_of_year_amounts", "amount"),
    "weekday_amounts": ("weekday_amounts", "amount"),
    "shop_amounts": ("shop_amounts", "amount"),
    "shop_period_amounts": ("shop_period_amounts", "amount"),
    "top_categories": ("top_categories", "amount"),
    "grid_cardinality": ("grid_cardinality", "seen_pairs"),
    "distinct_counts": ("distinct_counts", "n"),
    "threshold_rows": ("threshold_rows", "amount"),
    "cleaning_report": ("cleaning_report", "removed"),
    "missing_report": ("missing_report", "missing_after_own_month"),
    "validation_months": ("validation_month_count", "months"),
    "unseen_pairs": ("unseen_pairs", "item_id"),
}


@query(
    "data_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS report, count(*) AS rows, CAST(round(sum({total}), 2) AS DOUBLE) AS total FROM ({ORACLES[source]})"
        for name, (source, total) in PROFILE.items()
    )
    + f" UNION ALL SELECT 'boxplot_cleaned', count(*), CAST(sum(outliers) AS DOUBLE) FROM ({boxplot_sql('price', 'cleaned')} UNION ALL {boxplot_sql('amount', 'cleaned')})"
    + "".join(
        f" UNION ALL SELECT '{name}', count(*), CAST(sum({key}) AS DOUBLE) FROM {table} WHERE {key} NOT IN (SELECT {key} FROM sales)"
        for name, key, table in (("unsold_items", "item_id", "item_list"), ("unselling_shops", "shop_id", "shop_list"))
    ),
)
def _(spark, sf_dir):
    """Every report of the profile in one frame, as its number of rows and the total of one column."""
    b = builder(spark, sf_dir)
    saved = [
        b.store.table(name, {"profile": sf_dir}, build)
        for name, build in (
            ("daily", lambda: daily(spark, sf_dir)),
            ("cleaned_daily", lambda: cleaned(spark, sf_dir)),
        )
    ]
    saved.append(b.base(with_level=True))
    totals = PROFILE | {"boxplot_cleaned": ("", "outliers"), "unsold_items": ("", "item_id"), "unselling_shops": ("", "shop_id")}
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.expr(totals[name][1]).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("x"), 2).alias("total"))
            .select(F.lit(name).alias("report"), "rows", "total")
            for name, df in data_profile(retail_tables(spark, sf_dir), *saved, SPEC).items()
        ],
    )
