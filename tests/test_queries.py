"""A part of the registered queries next to their SQL; ``check.py`` runs them all."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from workloads.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "clean_transactions",
    "iqr_limits",
    "monthly_item_sales",
    "monthly_panel",
    "feature_panel",
    "next_period_moving_average",
    "split_random",
    "clean_strategy_panels",
    "target_encode_crossfit",
    "assemble_scaled_features",
    "per_group_score",
    "attach_forecast",
    "scan_csv_names",
    "clean_strategy_iqr",
    "unrepresented_entities",
    "data_profile",
    "fit_transform_split",
    "save_model",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "monthly_period" and df.count() > 70


def test_every_query_has_its_sql():
    assert not set(QUERIES) - set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
