"""Exact quantiles without gathering or sorting a column in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import written_down

ACCURACY = 10000
MOST_VALUES, PARTS = 100_000, 64  # different values that one task may put in order; parts of a longer range


def cells(df: DataFrame, columns: Sequence[str], **more: dict[str, Column]) -> DataFrame:
    """``(column, value)`` of all non-null values; ``more`` adds a field chosen by column."""
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), *[by[c].alias(n) for n, by in more.items()])
        for c in columns
    ]
    return df.select(F.explode(F.array(*rows)).alias("cell")).select("cell.*").where(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)``, counted map-side before the shuffle."""
    return cells(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _near(levels: Sequence[float]) -> tuple[list[float], list[int]]:
    """Levels just below and just above each quantile, and the numbers of the narrow ranges that they cut out."""
    near = sorted({min(max(q + side * 5 / ACCURACY, 0.0), 1.0) for q in levels for side in (-1, 1)})
    narrow = [i for i in range(1, len(near)) if near[i] - near[i - 1] <= 11 / ACCURACY]
    return near, narrow + [len(near)] * (near[-1] == 1.0)


def _cuts(df: DataFrame, columns: Sequence[str], near: list[float]) -> dict[str, Column]:
    """Approximate values of the levels ``near``, by column."""
    estimates = [F.percentile_approx(F.col(c).cast("double"), near, ACCURACY).alias(c) for c in columns]
    cuts = df.agg(F.struct(*estimates).alias("cuts")).scalar()
    return {c: cuts[c] for c in columns}


def _sought(parts: DataFrame, levels: Sequence[float]) -> DataFrame:
    """The ranks that the levels lie between: column, level, position, rank, the range it is in and its place ``within``."""
    in_order = Window.partitionBy("column").orderBy("range")
    n = F.col("n")
    ranges = parts.groupBy("column", "range").agg(F.sum("n").alias("n"))
    ranges = ranges.select("*", (F.sum("n").over(in_order) - n).alias("before"), F.sum("n").over(Window.partitionBy("column")).alias("total"))
    asked = ranges.withColumn("level", F.explode(F.array(*[F.lit(float(q)) for q in levels])))
    asked = asked.withColumn("position", F.col("level") * (F.col("total") - 1))
    asked = asked.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))))
    held = asked.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + n))
    return held.select("column", "level", "position", "rank", "range", (F.col("rank") - F.col("before")).alias("within"))


TARGET = ["column", "level", "rank"]


def _narrowed(values: DataFrame) -> DataFrame:
    """Of each target's values the part that holds its place: about one in PARTS."""
    shares = [i / PARTS for i in range(1, PARTS)]
    cuts = values.groupBy(*TARGET).agg(F.percentile_approx("value", shares, ACCURACY).alias("cuts"))
    cut = values.join(F.broadcast(cuts), TARGET)
    cut = cut.withColumn("part", F.size(F.filter("cuts", lambda c: c <= F.col("value")))).drop("cuts")
    sums = cut.groupBy(*TARGET, "part").agg(F.sum("n").alias("n"), F.first("within").alias("at"))
    sums = sums.withColumn("before", F.sum("n").over(Window.partitionBy(*TARGET).orderBy("part")) - F.col("n"))
    held = sums.where((F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("n")))
    kept = cut.join(F.broadcast(held.select(*TARGET, "part", "before")), [*TARGET, "part"])
    return kept.withColumn("within", F.col("within") - F.col("before")).drop("before", "part")


def exact_quantiles(df: DataFrame, columns: Sequence[str], levels: Sequence[float]) -> DataFrame:
    """``(column, level, quantile)`` with linear interpolation, exact at any size.

    The first reading estimates values just below and above each quantile. The second counts rows by the ranges between
    them, and inside the narrow ranges by value; that small table is written down. The counts tell the range and the place of each
    wanted rank. Should an estimate have been poor, the range is read again. A range with more than MOST_VALUES
    different values is cut further, by counting too, so no task puts more than those in order. A value
    that fills a third of the column is one row by then. Sent to all tasks are at most two ranks per column and level.
    """
    near, narrow = _near(levels)
    cuts = _cuts(df, columns, near)
    above = [F.coalesce((F.col("value") >= F.get("cuts", F.lit(i))).cast("int"), F.lit(0)) for i in range(len(near))]
    ranged = cells(df, columns, cuts=cuts).select("column", "value", reduce(add, above).alias("range"))
    by_value = F.when(F.col("range").isin(narrow), F.col("value")).alias("value")
    parts = written_down(ranged.groupBy("column", "range", by_value).agg(F.count(F.lit(1)).alias("n")))
    sought = written_down(_sought(parts, levels))
    wide = [(r["column"], r["range"]) for r in sought.where(~F.col("range").isin(narrow)).select("column", "range").distinct().collect()]
    values = parts.where(F.col("range").isin(narrow))
    if wide:
        again = reduce(or_, [(F.col("column") == c) & (F.col("range") == r) for c, r in wide])
        values = values.union(ranged.where(again).groupBy("column", "range", "value").agg(F.count(F.lit(1)).alias("n")))
    values = values.join(F.broadcast(sought), ["column", "range"]).drop("range")
    while True:
        values = written_down(values)
        most = values.groupBy(*TARGET).count().agg(F.max("count")).first()[0] or 0
        if most <= MOST_VALUES:
            break
        values = _narrowed(values)
    end = F.sum("n").over(Window.partitionBy(*TARGET).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    placed = values.withColumn("end", end).where((F.col("within") < F.col("end")) & (F.col("within") >= F.col("end") - F.col("n")))
    low, high = F.min_by("value", "rank"), F.max_by("value", "rank")
    return placed.groupBy("column", "level").agg(
        (low + (high - low) * (F.max("position") - F.floor(F.max("position")))).alias("quantile")
    )
