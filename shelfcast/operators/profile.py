"""Reports on the raw and the cleaned data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.quantiles import cells, exact_quantiles
from shelfcast.functions.scalars import amount_sum, period_label, weekday_name
from shelfcast.operators.cleaning import cleaning_report
from shelfcast.operators.enrich import unrepresented, unseen_pairs
from shelfcast.operators.splits import val_month_count
from shelfcast.session import written_down
from shelfcast.sources.tables import fix_schema
from shelfcast.spec import PanelSpec


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    shapes = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, shapes)


def distinct_counts(columns: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(name, n)``: distinct known values of each named column."""
    counts = [
        df.select(F.count_distinct(F.col(c)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, (df, c) in columns.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def distinct_entities(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def date_range(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def _by_level(levels: Sequence[float], names: Sequence[str]) -> list[Column]:
    return [F.max(F.when(F.col("level") == q, F.col("quantile"))).alias(n) for q, n in zip(levels, names)]


def quartiles_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its three exact quartiles."""
    levels = [0.25, 0.5, 0.75]
    return exact_quantiles(df, list(columns), levels).groupBy("column").agg(*_by_level(levels, ["q25", "q50", "q75"]))


def describe_columns(df: DataFrame, columns: Sequence[str], quartiles: DataFrame | None = None) -> DataFrame:
    """One row per column: count, mean, deviation, extremes and exact quartiles, which may be given (see ``quartiles_of``)."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    moments = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy("cell.column")
        .agg(
            F.count("cell.value").alias("count"),
            F.avg("cell.value").alias("mean"),
            F.stddev_samp("cell.value").alias("std"),
            F.min("cell.value").alias("min"),
            F.max("cell.value").alias("max"),
        )
    )
    return moments.join(quartiles_of(df, columns) if quartiles is None else quartiles, "column", "left")


def boxplot_stats(df: DataFrame, columns: Sequence[str], reach: float = 1.5, quartiles: DataFrame | None = None) -> DataFrame:
    """One row per column: quartiles, which may be given, the ends of the whiskers, and the number of points beyond.

    The quartiles are broadcast: one row for each column named.
    """
    quartiles = quartiles_of(df, columns) if quartiles is None else quartiles
    value, spread = F.col("value"), F.col("q75") - F.col("q25")
    low, high = F.col("q25") - reach * spread, F.col("q75") + reach * spread
    inside = value.between(low, high)
    return (
        cells(df, list(columns))
        .join(F.broadcast(quartiles), "column")
        .groupBy("column", "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def amounts_by(df: DataFrame, keys: Mapping[str, Column] | Sequence[str], spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Total amount by the given columns; a group without a name is left out."""
    named = keys if isinstance(keys, Mapping) else {k: F.col(k) for k in keys}
    rows = df.select(*[v.alias(n) for n, v in named.items()], spec.amount).dropna(subset=list(named))
    return rows.groupBy(*named).agg(amount_sum(spec).alias(spec.amount))


def daily_counts(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return df.where(F.col(spec.date).isNotNull()).groupBy(spec.date).agg(F.count(F.lit(1)).alias("count"))


def month_of_year_amounts(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return amounts_by(df, {"month": F.month(spec.date)}, spec)


def weekday_amounts(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Monday is 0."""
    return amounts_by(df, {"dayofweek": F.weekday(spec.date), "weekday_name": weekday_name(spec.date)}, spec)


def shop_period_amounts(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return amounts_by(df, {"Period": period_label(spec.date), spec.shop: F.col(spec.shop)}, spec)


def top_categories(df: DataFrame, above: float, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Category totals above a threshold, largest first."""
    totals = amounts_by(df, ["item_category_name"], spec)
    return totals.where(F.col(spec.amount) > above).orderBy(F.desc(spec.amount), "item_category_name")


def price_amount_correlation(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    known = F.col(spec.price).isNotNull() & F.col(spec.amount).isNotNull()
    return df.where(known).agg(F.count(F.lit(1)).alias("pairs"), F.corr(spec.price, spec.amount).alias("correlation"))


def _known(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"known_{i}") for i, c in enumerate(df.columns)]]


def _by_column(counted: DataFrame, df: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"known_{i}").alias("known"))
        for i, f in enumerate(df.schema)
    ]
    return counted.select("rows", F.explode(F.array(*rows)).alias("r")).select("r.*", "rows")


def completeness_profile(df: DataFrame) -> DataFrame:
    """One row per column: its type and the number of known values, from one pass."""
    return _by_column(df.agg(*_known(df)), df)


def overview(df: DataFrame, spec: PanelSpec = PanelSpec()) -> dict[str, DataFrame]:
    """The reports ``completeness``, ``date_range`` and ``correlation`` from one pass, whose single row is written down."""
    both = F.col(spec.price).isNotNull() & F.col(spec.amount).isNotNull()
    row = written_down(
        df.agg(
            *_known(df),
            F.min(spec.date).alias("first_date"),
            F.max(spec.date).alias("last_date"),
            F.count_if(both).alias("pairs"),
            F.corr(spec.price, spec.amount).alias("correlation"),
        )
    )
    return {
        "completeness": _by_column(row, df),
        "date_range": row.select("first_date", "last_date"),
        "correlation": row.select("pairs", "correlation"),
    }


def sales_cube(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Sales and amount by day, shop and category name, unknown ones included; written down.

    All counts and amounts by day, month, weekday, shop and category are sums over it; ``amounts_by`` takes it in place of the sales.
    """
    keys = [spec.date, spec.shop, "item_category_name"]
    return written_down(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), amount_sum(spec).alias(spec.amount)))


def cube_reports(cube: DataFrame, spec: PanelSpec = PanelSpec(), above: float = 10000) -> dict[str, DataFrame]:
    """The reports of counts and amounts, from ``sales_cube``."""
    return {
        "daily_counts": cube.where(F.col(spec.date).isNotNull()).groupBy(spec.date).agg(F.sum("count").alias("count")),
        "daily_amounts": amounts_by(cube, [spec.date], spec),
        "month_amounts": month_of_year_amounts(cube, spec),
        "weekday_amounts": weekday_amounts(cube, spec),
        "shop_amounts": amounts_by(cube, [spec.shop], spec),
        "shop_period_amounts": shop_period_amounts(cube, spec),
        "top_categories": top_categories(cube, above, spec),
    }


def missing_report(leveled: DataFrame) -> DataFrame:
    """One row: cells whose price is still missing after each step of the fall-back.

    ``leveled`` is a panel with ``price_level``.
    """
    steps = ["own_month", "shop_item", "item", "category", "global"]
    level = F.col("price_level")
    return leveled.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("item_category_id").isNull()).alias("missing_category"),
        *[F.count_if(level.isNull() | (level > i)).alias(f"missing_after_{s}") for i, s in enumerate(steps)],
    )


def grid_cardinality(shops: DataFrame, items: DataFrame, transactions: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row: possible pairs, and pairs with a transaction."""
    n_shops = shops.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_items = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    seen = transactions.select(*spec.entity).distinct().agg(F.count(F.lit(1)).alias("seen_pairs"))
    return seen.withColumn("all_pairs", n_shops * n_items).withColumn("seen_share", F.col("seen_pairs") / F.col("all_pairs"))


# The thresholds the raw data is looked through for.
THRESHOLDS = {"price": {"below": [0], "above": [100000, 200000]}, "amount": {"below": [-5, 0], "above": [500]}}


def threshold_rows(df: DataFrame, thresholds: Mapping[str, Mapping[str, Sequence[float]]] = THRESHOLDS) -> DataFrame:
    """The rows beyond any of the thresholds, each with the list of those it is beyond, such as ``price < 0``."""
    beyond = {
        f"{c} {sign} {t:g}": (F.col(c) < t if sign == "<" else F.col(c) > t)
        for c, sides in thresholds.items()
        for sign, side in (("<", "below"), (">", "above"))
        for t in sides.get(side, [])
    }
    named = F.array(*[F.when(condition, F.lit(name)) for name, condition in beyond.items()])
    return df.withColumn("beyond", F.array_compact(named)).where(F.size("beyond") > 0)


def data_profile(
    tables: Mapping[str, DataFrame], daily: DataFrame, cleaned: DataFrame, leveled: DataFrame, spec: PanelSpec = PanelSpec()
) -> dict[str, DataFrame]:
    """All reports by name.

    ``daily`` is the enriched fact, ``cleaned`` what is left of it, ``leveled`` the
    monthly panel with the fall-back level of each price. All three are read
    several times; pass frames that are saved. One pass over ``daily`` and one over ``cleaned`` are made and
    written down at once, of which ten reports are taken; quartiles are worked out once for both reports that show them.
    """
    measures = [spec.price, spec.amount]
    sold, shops, items, categories = (tables[t] for t in ("transaction", "shop_list", "item_list", "category_list"))
    raw_quartiles, cleaned_quartiles = (quartiles_of(df, measures) for df in (daily, cleaned))
    return {
        "distinct_counts": distinct_counts(
            {
                "items": (items, spec.item),
                "shops": (shops, spec.shop),
                "categories": (categories, spec.category),
                "items_sold": (sold, spec.item),
                "shops_selling": (sold, spec.shop),
            }
        ),
        "threshold_rows": threshold_rows(daily),
        "cleaning_report": cleaning_report(daily),
        "missing_report": missing_report(leveled),
        "validation_months": leveled.agg(val_month_count(spec).alias("months")),
        "unseen_pairs": unseen_pairs(fix_schema(tables["test"]), sold, spec),
        "unsold_items": unrepresented(items, sold, spec.item),
        "unselling_shops": unrepresented(shops, sold, spec.shop),
        "table_shapes": table_shapes(tables),
        "describe_raw": describe_columns(daily, measures, raw_quartiles),
        "describe_cleaned": describe_columns(cleaned, measures, cleaned_quartiles),
        "boxplot_raw": boxplot_stats(daily, measures, quartiles=raw_quartiles),
        "boxplot_cleaned": boxplot_stats(cleaned, measures, quartiles=cleaned_quartiles),
        **overview(daily, spec),
        **cube_reports(sales_cube(cleaned, spec), spec),
        "grid_cardinality": grid_cardinality(tables["shop_list"], tables["item_list"], tables["transaction"], spec),
    }
