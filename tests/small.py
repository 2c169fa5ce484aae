"""A small chain worked out by hand in plain Python."""

from __future__ import annotations

import datetime as dt

# shop, item, date, price, amount. Shop 9 and item 99 are in no list, shop 3 and item 14 never sell, item 13 never has
# a price, category 3 (item 15) has neither sale nor price, and nothing is sold in March 2020.
SALES = [
    (1, 11, "2.1.2020", 10.0, 2.0),
    (1, 11, "20.1.2020", 13.0, 1.0),
    (1, 11, "5.2.2020", None, 4.0),
    (2, 11, "7.4.2020", 20.0, 1.0),
    (1, 12, "9.5.2020", 7.5, 3.0),
    (2, 12, "9.2.2020", 8.5, None),
    (2, 13, "1.6.2020", None, 5.0),
    (9, 12, "3.1.2020", 100.0, 1.0),
    (1, 99, "4.4.2020", 1000.0, 2.0),
    (2, 11, "30.12.2020", 22.0, 6.0),
]
ITEMS = [(11, 1), (12, 1), (13, 2), (14, 1), (15, 3)]
SHOPS = [1, 2, 3]


def frames(spark):
    from shelfcast.operators.enrich import handle_dates

    daily = handle_dates(
        spark.createDataFrame(SALES, "shop_id int, item_id int, date string, price double, amount double")
    )
    items = spark.createDataFrame(ITEMS, "item_id int, item_category_id int")
    shops = spark.createDataFrame([(s,) for s in SHOPS], "shop_id int")
    return daily, items, shops


def month(text: str) -> dt.date:
    d, m, y = text.split(".")
    return dt.date(int(y), int(m), 1)


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def panel(periods=None) -> dict[tuple, dict]:
    """(period, shop, item) -> measures, by the rules, one cell at a time."""
    category = dict(ITEMS)
    periods = periods or sorted({month(d) for _, _, d, _, _ in SALES})
    cells = {}
    for p in periods:
        for s in SHOPS:
            for i, c in ITEMS:
                own = [r for r in SALES if (r[0], r[1], month(r[2])) == (s, i, p)]
                sources = [
                    mean(r[3] for r in own),
                    mean(r[3] for r in SALES if r[:2] == (s, i)),
                    mean(r[3] for r in SALES if r[1] == i),
                    mean(r[3] for r in SALES if category.get(r[1]) == c),
                    mean(r[3] for r in SALES),
                ]
                level = next(k for k, v in enumerate(sources) if v is not None)
                sold = [r for r in SALES if r[0] == s and category.get(r[1]) == c and month(r[2]) == p]
                cells[p, s, i] = {
                    "item_category_id": c,
                    "price": sources[level],
                    "price_level": level,
                    "amount_item": sum(r[4] or 0.0 for r in own),
                    "amount_cat": sum(r[4] or 0.0 for r in sold),
                    "year": p.year,
                    "month": p.month,
                }
    return cells


def features(lags: int = 3) -> dict[tuple, dict]:
    base = panel()
    periods = sorted({p for p, _, _ in base})
    out = {}
    for (p, s, i), cell in base.items():
        at = periods.index(p)
        if at < lags:
            continue
        row = {k: v for k, v in cell.items() if k != "price_level"}
        for c in ("price", "amount_item", "amount_cat"):
            past = [base[periods[at - k], s, i][c] for k in range(1, lags + 1)]
            row |= {f"{c}_l{k}": v for k, v in enumerate(past, 1)}
            row[f"{c}_l1_ma{lags - 1}"] = sum(past[: lags - 1]) / (lags - 1)
        out[p, s, i] = row
    return out


def by_key(df) -> dict[tuple, dict]:
    rows = [r.asDict() for r in df.collect()]
    cells = {(r.pop("monthly_period"), r.pop("shop_id"), r.pop("item_id")): r for r in rows}
    assert len(cells) == len(rows), "a cell occurs twice"
    return cells


def assert_same(got: dict[tuple, dict], expected: dict[tuple, dict]) -> None:
    assert got.keys() == expected.keys()
    for key, cell in expected.items():
        for column, value in cell.items():
            found = got[key][column]
            same = found == value if value is None or found is None else abs(found - value) < 1e-9
            assert same, (key, column, found, value)


