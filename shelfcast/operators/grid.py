"""Every shop x item x month, without a cross join and without shuffling the grid.

The grid is as large as its three lists multiplied, so nothing is joined or
shuffled once it exists. Work happens on one row per shop x item, which carries
its few months with sales as a map, then all months as arrays; the months become
rows last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from math import ceil, prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.monthly import keyed
from shelfcast.session import dealt_by, grid_tasks
from shelfcast.spec import PanelSpec

SHOPS_PER_CHUNK = 1024
MOST_SHOPS = 100_000  # ids in one array, less than a megabyte
# About 400 MB of feature rows, so that a task sorts its rows in memory.
CELLS_PER_TASK = 2_000_000


def tasks_for(cells: int, spark: SparkSession, spec: PanelSpec) -> int:
    return spec.partitions or max(grid_tasks(spark, spec), ceil(cells / CELLS_PER_TASK))


def sized(facts: DataFrame, others: DataFrame, shops: DataFrame, spec: PanelSpec = PanelSpec(), other: str | None = None) -> PanelSpec:
    """The spec with enough grid tasks for all cells, from the counts of the three lists: what a task holds does not grow with the grid."""
    if spec.partitions:
        return spec
    lists = [(shops, spec.shop), (others, other or spec.item), (facts, spec.period)]
    cells = prod(df.agg(F.count_distinct(F.col(c)).alias("n")).first()["n"] for df, c in lists)
    return replace(spec, partitions=tasks_for(cells, facts.sparkSession, spec))


def period_list(facts: DataFrame, spec: PanelSpec = PanelSpec()) -> Column:
    """The months on record in order, as one array read by scalar subquery.

    One entry per calendar month of the history, so the array stays small at any
    number of sales. ``calendar_periods`` adds months without any sale.
    """
    known = keyed(facts, spec.key)
    if spec.calendar_periods:
        months = F.sequence(F.min(spec.period), F.max(spec.period), F.expr("INTERVAL 1 MONTH"))
    else:
        months = F.sort_array(F.collect_set(spec.period))
    return known.agg(months.alias("periods")).scalar()


def shop_chunks(shops: DataFrame, spec: PanelSpec = PanelSpec()) -> tuple[DataFrame, Column]:
    """Shop ids in lists of about a thousand, numbered from 0, and the number of lists.

    A list stays short however many shops there are. Few lists are broadcast by
    Spark's own size check; when they are too many for it, there are also
    thousands of numbers to spread the join over.
    """
    ids = shops.select(spec.shop).distinct()
    chunks = ids.agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(SHOPS_PER_CHUNK)), F.lit(1)).cast("int").alias("n")).scalar()
    numbered = ids.withColumn("chunk", F.pmod(F.xxhash64(spec.shop), chunks).cast("int"))
    return numbered.groupBy("chunk").agg(F.collect_list(spec.shop).alias("shops")), chunks


def entity_grid(shops: DataFrame, others: DataFrame, spec: PanelSpec = PanelSpec(), other: str | None = None) -> DataFrame:
    """Each row of ``others`` once for each shop; ``others`` is dealt out by its id ``other`` first, and its shops follow there.

    Up to MOST_SHOPS shops are one array that every row is exploded with, after their number was looked up. More come in
    numbered lists, by a join on the number. Outside ``co_located`` the rows are then dealt out by shop and ``other``, as
    ``pack_history`` deals the facts, so that no task's share is left to the size of its bytes before the months are laid out.
    """
    other, tasks = other or spec.item, grid_tasks(others.sparkSession, spec)
    keys = dealt_by(others.sparkSession, spec, other)
    grid = _with_shops(shops, others, others.repartition(tasks, other), spec)
    return grid if keys == [other] else grid.repartition(tasks, *keys)


def _with_shops(shops: DataFrame, others: DataFrame, spread: DataFrame, spec: PanelSpec) -> DataFrame:
    if shops.select(spec.shop).distinct().count() <= MOST_SHOPS:
        every = shops.agg(F.collect_set(spec.shop).alias("shops")).scalar()
        return spread.select(F.explode(every).alias(spec.shop), *others.columns)
    lists, chunks = shop_chunks(shops, spec)
    numbered = spread.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return numbered.join(lists, "chunk").select(F.explode("shops").alias(spec.shop), *others.columns)


def pack_history(
    facts: DataFrame, keys: Sequence[str], values: Mapping[str, Column], spec: PanelSpec, extra: Sequence[Column] = ()
) -> DataFrame:
    """One row per entity: a map from month to ``values``, at most one entry per month.

    Facts with shops are dealt out as ``entity_grid`` deals its rows. An item has one fact for a shop and month at most, so no item
    is much larger than another.
    """
    if spec.shop in keys and len(keys) == 2:
        (other,) = (k for k in keys if k != spec.shop)
        facts = facts.repartition(grid_tasks(facts.sparkSession, spec), *dealt_by(facts.sparkSession, spec, other))
    entry = F.struct(F.col(spec.period), F.struct(*[v.alias(n) for n, v in values.items()]))
    return (
        keyed(facts, [spec.period, *keys])
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(entry)).alias("history"), *extra)
    )


def dense(history: str) -> Column:
    """One array entry per month of ``periods``: the map entry of that month, or null. Each month is looked up once for all its values."""
    return F.transform("periods", lambda month: F.try_element_at(history, month))


def lay_out_periods(entities: DataFrame, spec: PanelSpec, first: int = 0) -> DataFrame:
    """Each entity once for each month of ``periods`` from position ``first`` on; ``slot`` is the position."""
    carried = [c for c in entities.columns if c != "periods"]
    rows = entities.select(*carried, F.posexplode("periods").alias("slot", spec.period))
    return rows.where(F.col("slot") >= first) if first else rows


def dense_grid(shops: DataFrame, items: DataFrame, facts: DataFrame, spec: PanelSpec = PanelSpec(), other: str | None = None) -> DataFrame:
    """All shop x item (or, with ``other``, shop x category) x month combinations."""
    other = other or spec.item
    spec = sized(facts, items, shops, spec, other)
    entities = entity_grid(shops, items.select(other).distinct(), spec, other)
    dated = entities.withColumn("periods", period_list_of(facts, spec))
    return lay_out_periods(dated, spec).select(spec.shop, other, spec.period)


def period_list_of(facts: DataFrame, spec: PanelSpec) -> Column:
    """As ``period_list``, for frames which may lack some of the panel's keys."""
    known = facts.select(spec.period, *[c for c in spec.entity if c in facts.columns])
    missing = [F.lit(0).alias(c) for c in spec.entity if c not in facts.columns]
    return period_list(known.select("*", *missing), spec)


def densify_zero_sales(
    monthly: DataFrame, shops: DataFrame, items: DataFrame, spec: PanelSpec = PanelSpec(), other: str | None = None
) -> DataFrame:
    """Monthly rows for all combinations: no sales is an amount of 0, other columns are null then.

    The months are attached to shop x item rows; the grid itself is not joined.
    """
    other = other or spec.item
    spec = sized(monthly, items, shops, spec, other)
    keys = [spec.shop, other]
    values = [c for c in monthly.columns if c not in (*keys, spec.period)]
    history = pack_history(monthly, keys, {c: F.col(c) for c in values}, spec)
    entities = entity_grid(shops, items.select(other).distinct(), spec, other).join(history, keys, "left")
    dated = entities.withColumn("periods", period_list_of(monthly, spec))
    rows = lay_out_periods(dated.select(*keys, "periods", dense("history").alias("cells")), spec)
    cell = F.get("cells", F.col("slot"))
    filled = [(F.coalesce(cell[c], F.lit(0.0)) if c == spec.amount else cell[c]).alias(c) for c in values]
    return rows.select(spec.period, *keys, *filled)
