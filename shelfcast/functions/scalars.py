"""Column expressions: dates, rounding, flags, seeded hashes."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.spec import PanelSpec

# Fixed value: day.month.year, one or two digits each, as in the raw files.
DATE_FORMAT = "d.M.yyyy"


def parse_date(column: Column | str, lenient: bool = False) -> Column:
    """Day.month.year text to a date; bad text raises unless ``lenient``, then it is null."""
    return F.try_to_date(column, DATE_FORMAT) if lenient else F.to_date(column, DATE_FORMAT)


def month_period(column: Column | str) -> Column:
    return F.trunc(column, "MM")


def period_label(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM")


def weekday_name(column: Column | str) -> Column:
    return F.date_format(column, "EEEE")


def next_month(column: Column | str, months: int = 1) -> Column:
    return F.add_months(column, months).cast("date")


def cyclic(column: Column | str, period: int, wave: str) -> Column:
    """Place a repeating number on the unit circle: ``wave`` is ``sin`` or ``cos``."""
    if wave not in ("sin", "cos"):
        raise ValueError(f"wave must be sin or cos, not {wave!r}")
    column = F.col(column) if isinstance(column, str) else column
    return getattr(F, wave)(column / F.lit(period) * F.lit(2 * math.pi))


def rounded_count(column: Column | str) -> Column:
    """Half-even rounding to a whole number; a missing forecast stays missing."""
    return F.bround(column, 0).cast("int")


def holds(condition: Column) -> Column:
    """A comparison in which null counts as not satisfied."""
    return F.coalesce(condition, F.lit(False))


def hash_value(columns: list[str], seed: int) -> Column:
    """A seeded 32-bit number from the row's key, the same on any partitioning or engine."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def in_sample(columns: list[str], seed: int, ratio: float) -> Column:
    return hash_value(columns, seed) < F.lit(int(ratio * 2**32))


def price_units(spec: PanelSpec) -> Column:
    """The price as a summable number: whole minor units when the spec knows its decimals."""
    price = F.col(spec.price)
    if spec.price_decimals is None:
        return price.cast("double")
    return F.rint(price * F.lit(float(10**spec.price_decimals))).cast("bigint")


def mean_price(units: Column, count: Column, spec: PanelSpec) -> Column:
    """Mean price from summed units and the number of known prices; null without any."""
    scale = 1.0 if spec.price_decimals is None else float(10**spec.price_decimals)
    return F.when(count > 0, units.cast("double") / (count.cast("double") * F.lit(scale)))


def price_sum(spec: PanelSpec) -> Column:
    return F.sum(price_units(spec))


def price_average(spec: PanelSpec) -> Column:
    """Aggregate: mean of the known prices of a group."""
    return mean_price(price_sum(spec), F.count(spec.price), spec)


def amount_sum(spec: PanelSpec) -> Column:
    """Aggregate: total amount; a group with no known amount has sold nothing."""
    return F.coalesce(F.sum(F.col(spec.amount).cast("double")), F.lit(0.0))
