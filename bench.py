"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query reads the raw parquet tables and writes to Spark's no-op sink, with a
stage folder of its own, so nothing is taken over from the query before. Only
``forecast_next_period`` starts from the saved features and the fitted model, as
a monthly run does; making those is timed as ``feature_stage`` and ``train_linear``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from shelfcast.operators.cleaning import iqr_limits  # noqa: E402
from shelfcast.operators.features import ts_features  # noqa: E402
from shelfcast.plans.forecast import forecast_next_period, round_forecast  # noqa: E402
from shelfcast.plans.panel import feature_panel, monthly_panel  # noqa: E402
from shelfcast.plans.training import train_linear  # noqa: E402
from workloads.queries.cleaning import cleaned  # noqa: E402
from workloads.retail import SPEC, builder, raw_tables, sales  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("shelfcast-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    shared = spark.conf.get("spark.checkpoint.dir")
    roots = iter(f"{shared}/run{i}" for i in range(1000))

    def fresh():
        b = builder(spark, SF_DIR, root=next(roots))
        return b, b.facts(), b.tables["item_list"], b.tables["shop_list"]

    def panel() -> None:
        _b, facts, items, shops = fresh()
        run(monthly_panel(facts, items, shops, SPEC))

    def features() -> None:
        _b, facts, items, shops = fresh()
        run(feature_panel(facts, items, shops, SPEC))

    def window_features() -> None:
        _b, facts, items, shops = fresh()
        run(ts_features(monthly_panel(facts, items, shops, SPEC), SPEC))

    saved = builder(spark, SF_DIR, root=next(roots))
    made = {}

    def stage() -> None:
        saved.features()

    def train() -> None:
        made["model"] = train_linear(saved.features(), "last_months_val", SPEC, alpha=0.1).pipeline

    def forecast() -> None:
        request = raw_tables(spark, SF_DIR)["test"]
        run(round_forecast(forecast_next_period(saved.features(), request, made["model"], SPEC), SPEC))

    steps: dict[str, Callable[[], None]] = {
        "clean_transactions": lambda: run(cleaned(spark, SF_DIR)),
        "iqr_limits": lambda: run(iqr_limits(sales(spark, SF_DIR))),
        "monthly_panel": panel,
        "feature_panel": features,
        "window_features": window_features,
        "feature_stage": stage,
        "train_linear": train,
        "forecast_next_period": forecast,
    }
    panel()  # starts the JVM's compilers
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "panel_forecast_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
