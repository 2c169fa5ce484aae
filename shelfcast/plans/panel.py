"""The monthly panel and the feature panel."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.scalars import mean_price
from shelfcast.operators.cleaning import clean_transactions
from shelfcast.operators.enrich import handle_dates
from shelfcast.operators.features import lag_averages
from shelfcast.operators.grid import dense, entity_grid, lay_out_periods, pack_history, period_list, sized, tasks_for
from shelfcast.operators.monthly import item_categories, monthly_facts, rolled_mean_prices, rolled_price
from shelfcast.operators.prices import FALLBACKS, category_totals, priced_items, substitute_level, with_category_totals
from shelfcast.operators.splits import clean_by_strategy
from shelfcast.session import co_located, dealt_by, grid_tasks
from shelfcast.sources.stages import StageStore
from shelfcast.spec import PanelSpec


def _sold(facts: DataFrame, spec: PanelSpec, substitutes: bool = False) -> DataFrame:
    """One row per shop x item with sales: its months, and with ``substitutes`` the mean price of all its sales."""
    month = {
        "price": mean_price(F.col("price_units"), F.col("price_count"), spec),
        "amount": F.col(spec.amount),
    }
    extra = [rolled_price(spec).alias("price_shop_item")] if substitutes else []
    return pack_history(facts, spec.entity, month, spec, extra)


def panel_entities(
    facts: DataFrame, items: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec(), price_facts: DataFrame | None = None
) -> DataFrame:
    """One row per shop x item: its months with sales, the totals of its category, its substitute prices.

    ``price_facts`` limits the substitute prices to other facts than the panel's,
    such as those before the validation months; by default they look at all months.
    """
    return with_category_totals(priced_entities(facts, items, shops, spec, price_facts), facts, spec)


def listed_entities(facts: DataFrame, items: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row per shop x item: the item's category and its months with sales."""
    spec = sized(facts, items, shops, spec)
    grid = entity_grid(shops, item_categories(items, spec), spec)
    return grid.join(_sold(facts, spec), spec.entity, "left").withColumn("periods", period_list(facts, spec))


def priced_entities(
    facts: DataFrame, items: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec(), price_facts: DataFrame | None = None
) -> DataFrame:
    """``listed_entities`` with the four substitute prices: the item's, category's and global ones come with the item list."""
    spec = sized(facts, items, shops, spec)
    history = _sold(facts, spec, substitutes=price_facts is None)
    if price_facts is not None:
        dealt = price_facts.repartition(grid_tasks(facts.sparkSession, spec), *dealt_by(facts.sparkSession, spec, spec.item))
        history = history.join(rolled_mean_prices(dealt, spec.entity, "price_shop_item", spec), spec.entity, "full")
    grid = entity_grid(shops, priced_items(items, facts if price_facts is None else price_facts, spec), spec)
    return grid.join(history, spec.entity, "left").withColumn("periods", period_list(facts, spec))


def packed(entities: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row per shop x item, with its cells: price and amount by position of the month, null where nothing was sold.

    With the entities' substitute prices come the closest one and its level. Totals and months are carried along.
    """
    known = entities.columns
    carried = [c for c in ("totals", "periods") if c in known]
    prices = [F.coalesce(*FALLBACKS).alias("substitute"), substitute_level().alias("substitute_level")] if FALLBACKS[0] in known else []
    return entities.select(*spec.entity, spec.category, *carried, *prices, dense("history").alias("cells"))


def _rows(entities: DataFrame, spec: PanelSpec, first: int = 0) -> DataFrame:
    """The cells of all months in arrays, then as rows."""
    return lay_out_periods(packed(entities, spec), spec, first)


def _cell(field: str, step: int = 0) -> Column:
    return F.get("cells", F.col("slot") - step)[field]


def _level() -> Column:
    return F.when(_cell("price").isNotNull(), 0).otherwise(F.col("substitute_level")).alias("price_level")


def backfilled_sales(facts: DataFrame, items: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Every shop x item x month with the item's category, the month's own price, which may be null, and amount."""
    rows = _rows(listed_entities(facts, items, shops, spec), spec)
    return rows.select(*spec.key, spec.category, _cell("price").alias(spec.price), _amount().alias(spec.amount))


def priced_grid(facts: DataFrame, items: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Every shop x item x month with the price that is closest to it, and which one it was (``price_level``)."""
    rows = _rows(priced_entities(facts, items, shops, spec), spec)
    return rows.select(*spec.key, spec.category, _measures(spec)[spec.price].alias(spec.price), _level())


def sales_with_totals(facts: DataFrame, items: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Every shop x item x month with its amount and that of its category in the shop; an absent total is 0."""
    entities = with_category_totals(listed_entities(facts, items, shops, spec), facts, spec)
    measures = _measures(spec)
    amounts = [measures[c].alias(c) for c in (spec.amount_item, spec.amount_cat)]
    return _rows(entities, spec).select(*spec.key, spec.category, *amounts)


def _amount(step: int = 0) -> Column:
    return F.coalesce(_cell("amount", step), F.lit(0.0))


def _measures(spec: PanelSpec, step: int = 0) -> dict[str, Column]:
    """The measures of ``step`` months earlier: an array position, so no row has to be found for it."""
    return {
        spec.price: F.coalesce(_cell("price", step), F.col("substitute")),
        spec.amount_item: _amount(step),
        spec.amount_cat: F.coalesce(F.get("totals", F.col("slot") - step), F.lit(0.0)),
    }


def _base(spec: PanelSpec) -> list[Column]:
    return [
        *[F.col(c) for c in (*spec.key, spec.category)],
        *[v.alias(c) for c, v in _measures(spec).items()],
        F.year(spec.period).alias("year"),
        F.month(spec.period).alias("month"),
    ]


def monthly_panel(
    facts: DataFrame,
    items: DataFrame,
    shops: DataFrame,
    spec: PanelSpec = PanelSpec(),
    with_level: bool = False,
    price_facts: DataFrame | None = None,
) -> DataFrame:
    """Every shop x item x month with price, amounts and calendar columns."""
    rows = _rows(panel_entities(facts, items, shops, spec, price_facts), spec)
    return rows.select(*_base(spec), *([_level()] if with_level else []))


def feature_panel(
    facts: DataFrame,
    items: DataFrame,
    shops: DataFrame,
    spec: PanelSpec = PanelSpec(),
    price_facts: DataFrame | None = None,
) -> DataFrame:
    """The monthly panel with lags and moving averages, from the first month that has them all.

    No row is sorted or shuffled for a lag. The moving average ends at the
    previous month and is therefore the mean of the first lags.
    """
    return _featured(_rows(panel_entities(facts, items, shops, spec, price_facts), spec, first=spec.lags), spec)


def _featured(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    lags = [
        _measures(spec, step)[c].alias(spec.lag(c, step)) for c in spec.measures for step in range(1, spec.lags + 1)
    ]
    return rows.select(*_base(spec), *lags).select("*", *lag_averages(spec))


def panel_parts(
    facts: DataFrame, items: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec(), price_facts: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The panel in three frames that stay far smaller than its rows: shops x items with their cells, the category totals of each
    shop as arrays, and the months with their position in both."""
    months = facts.sparkSession.range(1).select(F.posexplode(period_list(facts, spec)).alias("slot", spec.period))
    return {
        "entities": packed(priced_entities(facts, items, shops, spec, price_facts), spec).drop("periods"),
        "totals": category_totals(facts, spec),
        "months": months.coalesce(1),
    }


def panel_rows(
    parts: dict[str, DataFrame], spec: PanelSpec = PanelSpec(), lags: bool = False, with_level: bool = False
) -> DataFrame:
    """The monthly panel, which may come ``with_level``, or with ``lags`` the feature panel, from ``panel_parts`` as saved.

    The months, one row for each, are sent to all tasks; a filter by month reaches them before any row is made. Rows lie by item, in
    tasks of about ``grid.CELLS_PER_TASK`` rows, so windows by shop and item and look-ups by item shuffle none of them.
    """
    entities, months = parts["entities"], parts["months"].where(F.col("slot") >= spec.lags) if lags else parts["months"]
    dealt = entities.repartition(tasks_for(entities.count() * parts["months"].count(), entities.sparkSession, spec), spec.item)
    rows = dealt.join(parts["totals"], [spec.shop, spec.category], "left").crossJoin(F.broadcast(months))
    return _featured(rows, spec) if lags else rows.select(*_base(spec), *([_level()] if with_level else []))


class PanelBuilder:
    """Builds the stages of one set of raw tables: facts, base panel, feature panel.

    A panel is saved in parts, one row per shop x item, and its rows are laid out as they are read: written out, they would fill the
    disk several times, with the sort by month that goes before. The raw transactions are read twice, once for the outlier limits
    and once for the monthly facts; the facts are written to shared storage, and all that follows reads those. ``source`` names the
    raw data in the stage paths.
    """

    def __init__(
        self,
        tables: dict[str, DataFrame],
        store: StageStore,
        source: str,
        spec: PanelSpec = PanelSpec(),
        method: str = "std",
        **levels: float,
    ) -> None:
        self.tables, self.store, self.source, self.spec, self.method, self.levels = tables, store, source, spec, method, levels

    def settings(self, *names: str) -> dict:
        return {"source": self.source, "method": self.method, "levels": self.levels} | {k: v for k, v in asdict(self.spec).items() if k in names}

    @property
    def fact_settings(self) -> dict:
        return self.settings("shop", "item", "category", "date", "period", "price", "amount", "price_decimals")

    @property
    def base_settings(self) -> dict:
        return self.fact_settings | self.settings("calendar_periods")

    def cleaned(self) -> DataFrame:
        return clean_transactions(handle_dates(self.tables["transaction"], self.spec), method=self.method, **self.levels)

    def facts(self, refresh: bool = False) -> DataFrame:
        return self.store.table(
            "facts",
            self.fact_settings,
            lambda: monthly_facts(self.cleaned(), self.tables["item_list"], self.spec),
            refresh=refresh,
        )

    @property
    def stage_parts(self) -> dict[str, list[str]]:
        """The frames a panel is saved in, and what they are split by."""
        return {"entities": [], "totals": [], "months": [self.spec.period]}

    def _parts(self, name: str, settings: dict, facts: Callable[[], DataFrame], refresh: bool) -> dict[str, DataFrame]:
        def build() -> dict[str, DataFrame]:
            made = facts()
            return panel_parts(made, self.tables["item_list"], self.tables["shop_list"], self.spec)

        with co_located(self.store.spark):
            return self.store.tables(name, settings, build, self.stage_parts, refresh)

    def base(self, refresh: bool = False, with_level: bool = False) -> DataFrame:
        parts = self._parts("base", self.base_settings, lambda: self.facts(refresh), refresh)
        levels = ["price_level"] if with_level else []
        return panel_rows(parts, self.spec, with_level=with_level).select(*self.spec.base_columns, *levels)

    def features(self, refresh: bool = False, refresh_facts: bool = False) -> DataFrame:
        settings = self.base_settings | self.settings("lags")
        parts = self._parts("features", settings, lambda: self.facts(refresh_facts), refresh or refresh_facts)
        return panel_rows(parts, self.spec, lags=True).select(*self.spec.panel_columns)

    def split_features(self, strategy: str = "random", keys: list[str] | None = None, refresh: bool = False) -> dict[str, DataFrame]:
        """Feature panels of the train and validation sales, with outliers left in the latter.

        Each part has its own months, grid and prices, so neither sees the other's sales.
        """
        daily = handle_dates(self.tables["transaction"], self.spec)
        items = self.tables["item_list"]
        settings = self.base_settings | self.settings("lags", "val_ratio", "seed") | {"strategy": strategy, "keys": keys}
        panels = {}
        cleaned = clean_by_strategy(daily, "no_olrem_for_val", strategy, self.spec, keys, self.method, **self.levels)
        for name, sales in cleaned.items():
            facts = self.store.table(
                f"{name}_facts", settings, lambda sales=sales: monthly_facts(sales, items, self.spec), refresh=refresh
            )
            parts = self._parts(f"{name}_features", settings, lambda facts=facts: facts, refresh)
            panels[name] = panel_rows(parts, self.spec, lags=True).select(*self.spec.panel_columns)
        return panels
