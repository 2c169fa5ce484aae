"""Column roles and settings shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureRoles:
    categorical: list[str]
    seasonal: list[str]
    numeric: list[str]

    @property
    def features(self) -> list[str]:
        return self.categorical + self.seasonal + self.numeric


@dataclass(frozen=True)
class PanelSpec:
    """What the columns mean and how far the features look back.

    ``price_decimals`` turns on exact price sums: prices are added as whole
    units of ``10 ** -price_decimals``, so that a mean does not depend on the
    order in which Spark merges its partial sums. Leave it ``None`` for prices
    with an unknown number of decimals; they are then added as doubles.
    """

    shop: str = "shop_id"
    item: str = "item_id"
    category: str = "item_category_id"
    date: str = "date"
    period: str = "monthly_period"
    price: str = "price"
    amount: str = "amount"
    lags: int = 3
    val_ratio: float = 0.2
    seed: int = 42
    price_decimals: int | None = None
    calendar_periods: bool = False
    partitions: int | None = None

    def __post_init__(self) -> None:
        if self.lags < 2:
            raise ValueError("lags must be at least 2: the moving average spans lags - 1 months")

    @property
    def entity(self) -> list[str]:
        return [self.shop, self.item]

    @property
    def key(self) -> list[str]:
        return [self.period, self.shop, self.item]

    @property
    def amount_item(self) -> str:
        return f"{self.amount}_item"

    @property
    def amount_cat(self) -> str:
        return f"{self.amount}_cat"

    @property
    def measures(self) -> list[str]:
        return [self.price, self.amount_item, self.amount_cat]

    @property
    def window(self) -> int:
        return self.lags - 1

    def lag(self, column: str, step: int) -> str:
        return f"{column}_l{step}"

    def average(self, column: str, window: int | None = None) -> str:
        return f"{column}_ma{window or self.window}"

    @property
    def lag_columns(self) -> list[str]:
        return [self.lag(c, i) for c in self.measures for i in range(1, self.lags + 1)]

    @property
    def average_columns(self) -> list[str]:
        return [self.average(self.lag(c, 1)) for c in self.measures]

    @property
    def base_columns(self) -> list[str]:
        return [*self.key, self.category, *self.measures, "year", "month"]

    @property
    def panel_columns(self) -> list[str]:
        return self.base_columns + self.lag_columns + self.average_columns

    def roles(self, columns: Sequence[str] | None = None) -> FeatureRoles:
        """Sort feature columns into roles, in schema order.

        The label and the two measures known only after the month has ended are
        no features, nor is the period itself (its year and month are).
        """
        columns = list(columns or self.panel_columns)
        dropped = {self.period, *self.measures}
        categorical = [c for c in (self.shop, self.item, self.category) if c in columns]
        seasonal = [c for c in columns if c == "month"]
        known = dropped.union(categorical, seasonal)
        return FeatureRoles(categorical, seasonal, [c for c in columns if c not in known])
