"""Whole panels compared by a few hundred rows: counts, sums and a checksum over every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

SCALE = 10000


def _scaled(column: str) -> Column:
    return F.rint(F.col(column) * F.lit(float(SCALE))).cast("bigint")


def digest(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """By group: rows, the sum of each double column, and the summed hash of all rows' text."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, DoubleType)}
    text = [F.coalesce((_scaled(c) if c in doubles else F.col(c)).cast("string"), F.lit("~")) for c in columns]
    row_hash = F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 8), 16, 10).cast("bigint")
    sums = [(F.sum(_scaled(c)) / F.lit(float(SCALE))).alias(f"sum_{c}") for c in columns if c in doubles]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums, F.sum(row_hash).alias("checksum"))


def digest_sql(source: str, by: Sequence[str], columns: Sequence[str], doubles: Sequence[str]) -> str:
    def scaled(c: str) -> str:
        return f"CAST(round_even({c} * {SCALE}.0::DOUBLE, 0) AS BIGINT)"

    text = ", ".join(f"coalesce(CAST({scaled(c) if c in doubles else c} AS VARCHAR), '~')" for c in columns)
    sums = "".join(f"CAST(sum({scaled(c)}) AS DOUBLE) / {SCALE}.0::DOUBLE AS sum_{c}, " for c in columns if c in doubles)
    keys = ", ".join(by)
    return (
        f"SELECT {keys}, count(*) AS rows, {sums}"
        f"CAST(sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT) AS BIGINT) AS checksum "
        f"FROM {source} GROUP BY {keys}"
    )
