from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfcast.session import shared_dir
from shelfcast.sources.stages import StageStore, scan_stage, write_predictions_csv, write_stage
from shelfcast.sources.tables import drop_index_columns, fix_schema, load_tables, narrow_numeric_types, scan_csv


@pytest.fixture()
def root(tmp_path):
    files = {
        "shop_list": "shop_name,shop_id\nNorth,1\n\"South, old\",2\n",
        "item_list": ",item_name,item_id,item_category_id\n0,cup,11,1\n1,plate,12,\n",
        "category_list": "item_category_name,item_category_id\nware,1\n",
        "transaction": "Unnamed: 0,date,shop,item,price,amount\n0,02.01.2013,1,11,9.5,1.0\n1,3.1.2013,2,12,,-1\n",
        "test": "shop,item\n1,11\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_tables_load_by_column_name(spark, root):
    t = load_tables(spark, root)
    assert t["transaction"].columns == ["date", "shop_id", "item_id", "price", "amount"]
    assert [tuple(r) for r in t["transaction"].collect()] == [("02.01.2013", 1, 11, 9.5, 1.0), ("3.1.2013", 2, 12, None, -1.0)]
    assert [tuple(r) for r in t["item_list"].collect()] == [("cup", 11, 1), ("plate", 12, None)]
    assert t["shop_list"].where("shop_id = 2").first()["shop_name"] == "South, old"


def test_quotes_commas_and_blanks_survive(spark, tmp_path):
    rows = [("Game \"Gold\", disc 2", 1, 40), (" lead, trail ", 2, 40), ("", 3, None), ("\"", 4, 1), ("a,b", 5, 1), (None, 6, 1)]
    names = spark.createDataFrame(rows, "item_name string, item_id int, item_category_id int")
    write_predictions_csv(names, f"{tmp_path}/names")
    back = scan_csv(spark, f"{tmp_path}/names", {"item_name": "string", "item_id": "int", "item_category_id": "int"})
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == [(name or None, *ids) for name, *ids in rows]  # empty reads as missing
    (tmp_path / "x.csv").write_text('item_name,item_id,item_category_id\n"Game ""Gold"", disc 2",1,40\n')
    assert scan_csv(spark, f"{tmp_path}/x.csv", {"item_name": "string", "item_id": "int"}).first()["item_name"] == 'Game "Gold", disc 2'


def test_a_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("date,shop,item,cost,amount\n1.1.2013,1,2,3,4\n")
    types = {"date": "string", "shop": "int", "price": "double"}
    with pytest.raises(ValueError, match="no column price"):
        scan_csv(spark, f"{tmp_path}/t.csv", types)
    assert scan_csv(spark, f"{tmp_path}/t.csv", types, optional=["price"]).columns == ["date", "shop"]


def test_index_columns_go(spark):
    df = spark.createDataFrame([(0, 1, 2)], ["UNNAMED: 0", "_c0", "x"])
    assert drop_index_columns(df).columns == ["x"]
    assert fix_schema(spark.createDataFrame([(1, 2)], ["shop", "item"])).columns == ["shop_id", "item_id"]


def test_bad_numbers_and_overflow_raise(spark, tmp_path):
    (tmp_path / "x.csv").write_text("n\nabc\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        scan_csv(spark, str(tmp_path / "x.csv"), {"n": "int"}).collect()
    wide = spark.createDataFrame([(2**31, 0.5)], "a bigint, b double")
    assert [f.dataType.simpleString() for f in narrow_numeric_types(wide).schema] == ["int", "float"]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        narrow_numeric_types(wide).collect()


def test_partitioned_stage_round_trip(spark, tmp_path):
    df = spark.range(10).withColumn("monthly_period", F.add_months(F.lit("2020-01-01").cast("date"), (F.col("id") % 3).cast("int")))
    write_stage(df, f"{tmp_path}/s", ["monthly_period"])
    assert scan_stage(spark, f"{tmp_path}/s").select(df.columns).exceptAll(df).count() == 0


def test_stage_is_built_again_after_an_uncommitted_write(spark, tmp_path):
    store, built = StageStore(spark, str(tmp_path)), []

    def build():
        built.append(1)
        return spark.range(3)

    assert store.table("s", {"a": 1}, build).count() == 3
    store.table("s", {"a": 1}, build)
    assert len(built) == 1
    store.table("s", {"a": 2}, build)
    before = store.table("s", {"a": 1}, build)
    store.table("s", {"a": 1}, build, refresh=True)
    assert len(built) == 3 and before.count() == 3  # a refresh leaves the files of earlier frames alone
    folder = tmp_path / store.path("s", {"a": 1}).split("/")[-1]
    assert store.saved_path("s", {"a": 1}).endswith("/v2")
    (folder / "v2" / "_SUCCESS").unlink()
    (folder / "v1" / "_SUCCESS").unlink()
    store.table("s", {"a": 1}, build)
    assert len(built) == 4


def test_predictions_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3.25), (1, 3, None)], "shop int, item int, amount double")
    write_predictions_csv(df, f"{tmp_path}/p")
    back = scan_csv(spark, f"{tmp_path}/p", {"shop": "int", "item": "int", "amount": "double"})
    assert back.exceptAll(df).count() == 0 and back.count() == 2


def test_shared_folder_is_the_clusters(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_stage_of_several_frames_is_committed_by_the_last(spark, tmp_path):
    store, built = StageStore(spark, str(tmp_path)), []

    def build():
        built.append(1)
        return {"rows": spark.range(3 + len(built)), "days": spark.range(2)}

    parts = {"rows": [], "days": []}
    before = store.tables("s", 1, build, parts)
    assert store.tables("s", 1, build, parts)["rows"].count() == 4 and len(built) == 1
    assert store.tables("s", 1, build, parts, refresh=True)["rows"].count() == 5 and before["rows"].count() == 4
    (tmp_path / store.path("s", 1).split("/")[-1] / "v2" / "_SUCCESS").unlink()
    assert store.tables("s", 1, build, parts)["rows"].count() == 4
