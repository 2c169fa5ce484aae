"""From CSV files to a forecast file, as a user would run it."""

from __future__ import annotations

import small
from shelfcast import PanelSpec
from shelfcast.plans.forecast import forecast_next_period, round_forecast
from shelfcast.plans.panel import PanelBuilder
from shelfcast.plans.training import train_linear
from shelfcast.sources.stages import StageStore, load_model, save_model, write_predictions_csv
from shelfcast.sources.tables import load_tables, scan_csv


def test_from_files_to_forecast(spark, tmp_path):
    lines = [f"{d},{s},{i},{'' if p is None else p},{'' if a is None else a}" for s, i, d, p, a in small.SALES]
    files = {
        "transaction": ["date,shop,item,price,amount", *lines],
        "item_list": ["item_name,item_id,item_category_id", *[f"n{i},{i},{c}" for i, c in small.ITEMS]],
        "shop_list": ["shop_name,shop_id", *[f"s{s},{s}" for s in small.SHOPS]],
        "category_list": ["item_category_name,item_category_id", "a,1", "b,2", "c,3"],
        "test": ["shop,item", "1,11", "2,12", "7,11"],
    }
    for name, rows in files.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(rows) + "\n")
    spec = PanelSpec(lags=2, val_ratio=0.5, price_decimals=2)
    tables = load_tables(spark, str(tmp_path))
    features = PanelBuilder(tables, StageStore(spark, f"{tmp_path}/stages"), "small", spec).features()
    assert features.count() == len(small.features(2))
    trained = train_linear(features, "last_months_val", spec, alpha=0.1)
    assert {r["split"] for r in trained.scores().collect()} == {"train", "val"}
    model = load_model(save_model(trained.pipeline, f"{tmp_path}/models", "linear"))
    forecast = round_forecast(forecast_next_period(features, tables["test"], model, spec), spec)
    write_predictions_csv(forecast, f"{tmp_path}/forecast")
    back = scan_csv(spark, f"{tmp_path}/forecast", {"shop": "int", "item": "int", "amount": "int"})
    got = {(r["shop"], r["item"]): r["amount"] for r in back.collect()}
    assert got.keys() == {(1, 11), (2, 12), (7, 11)} and got[7, 11] is None and got[1, 11] is not None
