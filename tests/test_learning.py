from __future__ import annotations

import math
import time
from collections import defaultdict
from itertools import takewhile

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfcast import PanelSpec
from shelfcast.functions.scalars import hash_value
from shelfcast.operators.encoding import ENCODED, SCALED, LabelMeanEncoder, RangeScaler, feature_names
from shelfcast.operators import models
from shelfcast.operators.models import (
    auto_search,
    best_round,
    feature_importance,
    fit_elastic_net,
    fit_gbt,
    fit_gbt_early_stopping,
    random_search,
    search_history,
)
from shelfcast.operators.scoring import score
from shelfcast.plans.forecast import forecast_next_period, predict_next_period, round_forecast
from shelfcast.plans.training import linear_fit, train_linear, train_on, train_trees
from shelfcast.sources.stages import load_model, save_model

SPEC = PanelSpec()


def shrunk(values, overall):
    n, mean = len(values), np.mean(values)
    spread, variance = np.var(values), np.var(overall)
    if variance * n + spread == 0:
        return np.mean(overall)
    weight = variance * n / (variance * n + spread)
    return weight * mean + (1 - weight) * np.mean(overall)


@pytest.fixture(scope="module")
def labeled(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(c), float(rng.poisson(c + 1))) for i, c in enumerate(rng.choice([0, 1, 1, 1, 2, 5], 300))]
    return spark.createDataFrame([*rows, (300, 9, 4.0)], "id int, cat int, label double")


def test_label_means_are_shrunk(labeled):
    rows = labeled.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["cat"]].append(r["label"])
    overall = [r["label"] for r in rows]
    got = {r["value"]: (r["n"], r["encoding"]) for r in LabelMeanEncoder(inputCols=["cat"]).encodings(labeled).collect()}
    assert got.keys() == groups.keys()
    for value, labels in groups.items():
        assert got[value][0] == len(labels) and got[value][1] == pytest.approx(shrunk(labels, overall))


def test_unseen_category_gets_the_label_mean(spark, labeled):
    model = LabelMeanEncoder(inputCols=["cat"]).fit(labeled)
    new = spark.createDataFrame([(1, 77), (2, None)], "id int, cat int")
    mean = labeled.agg(F.avg("label")).first()[0]
    assert [r[ENCODED + "cat"] for r in model.transform(new).collect()] == [pytest.approx(mean)] * 2


def test_crossfit_never_uses_the_own_fold(labeled):
    encoder = LabelMeanEncoder(inputCols=["cat"])
    got = {r["id"]: r[ENCODED + "cat"] for r in encoder.crossfit(labeled, ["id"], folds=5, seed=1).collect()}
    rows = labeled.withColumn("fold", F.pmod(hash_value(["id"], 1), F.lit(5))).collect()
    assert len(got) == len(rows)
    for r in rows:
        others = [o for o in rows if o["fold"] != r["fold"]]
        same = [o["label"] for o in others if o["cat"] == r["cat"]]
        overall = [o["label"] for o in others]
        assert got[r["id"]] == pytest.approx(shrunk(same, overall) if same else np.mean(overall))


def test_constant_label_and_constant_column(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 2.0, 5.0)], "cat int, x double, label double")
    assert [r["encoding"] for r in LabelMeanEncoder(inputCols=["cat"]).encodings(df).collect()] == [5.0, 5.0]
    assert [r[SCALED + "x"] for r in RangeScaler(inputCols=["x"]).fit(df).transform(df).collect()] == [0.0, 0.0]


def test_scaling_uses_the_training_range(spark):
    train = spark.createDataFrame([(1.0,), (5.0,)], "x double")
    new = spark.createDataFrame([(1.0,), (3.0,), (9.0,)], "x double")
    assert [r[SCALED + "x"] for r in RangeScaler(inputCols=["x"]).fit(train).transform(new).collect()] == [0.0, 0.5, 2.0]


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * [1.0, 2.0, 0.5]
    y = x @ [12.0, -7.0, 0.1] + 3 + rng.normal(size=400)
    df = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id int, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


@pytest.mark.parametrize(("alpha", "ratio"), [(1.0, 0.5), (0.1, 0.9), (5.0, 0.3)])
def test_elastic_net_meets_its_optimality_conditions(matrix, alpha, ratio):
    rows = matrix.select("a", "b", "c", "label").toPandas().to_numpy()
    x, y = rows[:, :3], rows[:, 3]
    model = fit_elastic_net(matrix, alpha, ratio)
    w = model.coefficients.toArray()
    pull = x.T @ (y - x @ w - model.intercept) / len(y) - alpha * (1 - ratio) * w
    for weight, force in zip(w, pull):
        if abs(weight) < 1e-9:
            assert abs(force) <= alpha * ratio + 1e-4
        else:
            assert force == pytest.approx(math.copysign(alpha * ratio, weight), abs=1e-3)


def test_random_search_finds_the_mildest_penalty(spark, matrix):
    search = random_search(matrix, ["id"], draws=4, parallelism=2)
    history = search_history(search, spark).orderBy("trial").collect()
    assert len(history) == 4 and history[-1]["best_score"] == max(r["score"] for r in history)
    again = random_search(matrix.repartition(3), ["id"], draws=4, parallelism=2)
    assert [pytest.approx(m) for m in again.avgMetrics] == search.avgMetrics


def test_best_round():
    assert best_round([5, 4, 3, 3.5, 3.4, 3.2, 3.1, 3.05, 2.0], patience=5) == 3
    assert best_round([5, 4, 3, 3.5, 2.9, 3.0], patience=5) == 5
    assert best_round([1.0]) == 1


@pytest.fixture(scope="module")
def features(spark):
    """A feature panel whose label follows its lags."""
    rng = np.random.default_rng(8)
    rows = []
    for p in range(12):
        for shop in range(3):
            for item in range(12):
                lags = rng.poisson(item / 2 + 1, 3).astype(float)
                price, cat = 5.0 + item, rng.poisson(20, 4).astype(float)
                amount = float(round(0.6 * lags[0] + 0.4 * lags[1] + (p % 12 == 11) + rng.normal(0, 0.3)))
                rows.append((p, shop, item, item % 4, price, amount, cat[0], *([price] * 3), *lags, *cat[1:], price, lags[:2].mean(), cat[1:3].mean()))
    names = ["p", "shop_id", "item_id", "item_category_id", *SPEC.measures, *SPEC.lag_columns, *SPEC.average_columns]
    rows = [tuple(float(v) if i > 3 else int(v) for i, v in enumerate(r)) for r in rows]
    df = spark.createDataFrame(rows, names)
    ids = {c: F.col(c).cast("int") for c in ("shop_id", "item_id", "item_category_id")}
    df = df.withColumns(ids).withColumn("monthly_period", F.add_months(F.lit("2020-01-01").cast("date"), F.col("p").cast("int")))
    return df.withColumns({"year": F.year("monthly_period"), "month": F.month("monthly_period")}).select(SPEC.panel_columns).cache()


def test_early_stopping_beats_the_mean(features):
    from shelfcast.operators.encoding import fit_transform_split, tree_stages
    from shelfcast.operators.features import features_and_label
    from shelfcast.operators.splits import parts, split_panel

    train, val = (features_and_label(p, SPEC) for p in parts(split_panel(features, "months", SPEC)))
    fitted, matrix, val_matrix = fit_transform_split(train, val, tree_stages(SPEC), SPEC)
    model, losses = fit_gbt_early_stopping(matrix, val_matrix, maxIter=12, maxDepth=3)
    assert model.getNumTrees == best_round(losses)
    two = fit_gbt(matrix, maxIter=2, maxDepth=3)  # the first trees are the same, however many follow
    assert two.getNumTrees == 2 and score(two.transform(val_matrix)).first()["rmse"] ** 2 == pytest.approx(losses[1], rel=1e-6)
    assert two.featureImportances.size == model.featureImportances.size
    reached = score(model.transform(val_matrix)).first()
    assert reached["rmse"] ** 2 == pytest.approx(min(losses[: model.getNumTrees]), rel=1e-6)
    assert reached["r2"] > 0
    names = feature_names(fitted)
    assert names[:3] == ["sin__month", "cos__month", "shop_id"] and len(names) == 18
    importance = feature_importance(model, names, features.sparkSession).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)


def exchanges(plan: str) -> list[str]:
    return [line.split("hashpartitioning(")[1].split(",")[0].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_only_a_feature_with_many_codes_moves_the_rows(spark):
    """Items have more codes than are broadcast: the rows move to them once, and not for shop or category."""
    rows = spark.range(40_000).select(
        F.col("id").cast("int").alias("id"),
        (F.col("id") % 3).cast("int").alias("shop"),
        (F.col("id") % 20_000).cast("int").alias("item"),
        (F.col("id") % 7).cast("int").alias("cat"),
        (F.col("id") % 11).cast("double").alias("label"),
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "20000", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        encoder = LabelMeanEncoder(inputCols=["shop", "item", "cat"])
        model = encoder.fit(rows)
        for coded in (encoder.crossfit(rows, ["id"]), model.transform(rows)):
            plan = coded._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
            assert exchanges(plan) == ["item", "item"] and coded.count() == 40_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_codes_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "id int, cat int, label double")
    assert LabelMeanEncoder(inputCols=["cat"]).crossfit(rows, ["id"]).count() == 0


def test_parts_are_encoded_once(features):
    """Scores read the encoded rows that the fit was made with."""
    trained = train_linear(features, "last_months_val", SPEC, alpha=0.1)
    plan = trained.scores()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 2


def test_encoded_rows_are_written_by_column(spark, features):
    """One column for each feature lies on disk, no vectors; the vectors read are the ones scored."""
    trained = train_linear(features, "last_months_val", SPEC, alpha=0.1)
    written = spark.read.parquet(*trained.train.inputFiles())
    assert "features" not in written.columns and set(feature_names(trained.pipeline)) <= set(written.columns)
    assert trained.train.columns == [*SPEC.key, SPEC.category, "features", "label"]


def test_linear_pipeline_is_saved_whole(spark, features, tmp_path):
    trained = train_linear(features, "last_months_val", SPEC, alpha=0.1)
    scores = {r["split"]: r for r in trained.scores().collect()}
    assert scores["train"]["r2"] > 0 and scores["val"]["rmse"] > 0
    again = load_model(save_model(trained.pipeline, str(tmp_path), "linear"))
    before, after = (p.transform(features).select(*SPEC.key, F.round("prediction", 9)) for p in (trained.pipeline, again))
    assert before.exceptAll(after).count() == 0 and before.count() == features.count()
    assert feature_names(again) == feature_names(trained.pipeline)


def test_given_parts_are_trained_on(features):
    train, val = features.where("month < 10"), features.where("month >= 10")
    from shelfcast.operators.encoding import scaled_stages

    trained = train_on(train, val, scaled_stages(SPEC), linear_fit(0.1, 0.5), SPEC)
    assert {r["split"]: r["rows"] for r in trained.scores().collect()} == {"train": train.count(), "val": val.count()}


def test_forecast_of_requested_pairs(spark, features, tmp_path):
    trained = train_trees(features, "last_months_val", SPEC, maxIter=4, maxDepth=3)
    request = spark.createDataFrame([(0, 1), (2, 11), (2, 500), (8, 1)], "shop int, item int")
    raw = forecast_next_period(features, request, load_model(save_model(trained.pipeline, str(tmp_path), "trees")), SPEC)
    got = {(r["shop"], r["item"]): r["amount"] for r in raw.collect()}
    assert len(got) == 4 and got[2, 500] is None and got[8, 1] is None and got[2, 11] > got[0, 1]
    whole = {(r["shop"], r["item"]): r["amount"] for r in round_forecast(raw, SPEC).collect()}
    assert whole[2, 11] == round(got[2, 11]) and whole[2, 500] is None


def test_only_requested_pairs_are_scored(spark, features):
    """The request meets the rows of the last month, below the model."""
    request = spark.createDataFrame([(0, 1), (0, 1), (2, 500)], "shop int, item int")
    trained = train_linear(features, "last_months_val", SPEC, alpha=0.1)
    assert predict_next_period(features, trained.pipeline, SPEC, pairs=request).count() == 1
    raw = forecast_next_period(features, request, trained.pipeline, SPEC)
    assert sorted((r["shop"], r["item"]) for r in raw.collect()) == [(0, 1), (0, 1), (2, 500)]
    lines = raw._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    semi = next(i for i, line in enumerate(lines) if "Join LeftSemi" in line)
    below = takewhile(lambda i: depth[i] > depth[semi], range(semi + 1, len(lines)))
    assert not any("UDF(" in lines[i] or "found" in lines[i] for i in below)
    assert any("found" in line for line in lines)


def test_forecast_may_be_clipped(spark, features):
    class Below:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(-2.5))

    request = spark.createDataFrame([(0, 1)], "shop int, item int")
    assert forecast_next_period(features, request, Below(), SPEC).first()["amount"] == -2.5
    assert forecast_next_period(features, request, Below(), SPEC, clip_at_zero=True).first()["amount"] == 0.0


def test_tree_search_keeps_its_history(spark, matrix):
    search = auto_search(matrix, ["id"], trials=2, maxIter=3)
    assert auto_search(matrix.repartition(7), ["id"], trials=2, maxIter=3).scores == pytest.approx(search.scores, rel=0.2)
    history = search_history(search, spark).orderBy("trial").collect()
    assert [r["trial"] for r in history] == [1, 2] and "maxDepth" in history[0]["settings"]
    assert history[-1]["best_score"] == min(r["score"] for r in history)


def test_tree_search_halves(matrix, monkeypatch):
    """All trials start, the better half gets twice the rounds, the last one stops early and is fitted on all rows."""
    fitted = []
    plain = models.fit_gbt
    monkeypatch.setattr(models, "FIRST_ROUNDS", 2)
    monkeypatch.setattr(models, "fit_gbt", lambda rows, seed=42, **s: fitted.append(s["maxIter"]) or plain(rows, seed, **s))
    search = auto_search(matrix, ["id"], trials=5, maxIter=4, maxDepth=2)
    assert fitted[:7] == [1] * 5 + [2] * 2 and len(search.scores) == len(search.drawn) == 5 and sorted(search.rounds)[:3] == [1, 1, 1]
    best = min(range(5), key=lambda i: (search.scores[i], i))
    assert all(s > 0 for s in search.scores) and search.bestModel.getNumTrees <= 4 and search.rounds[best] >= 1


def test_fits_leave_no_shuffles_behind(spark):
    """Each pass of the encoders shuffles its input anew; until the next one, only the latest pass stays on disk."""

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_") and n.endswith(".data")}

    rows = spark.range(2_000).select("id", (F.col("id") % 7).alias("cat"), (F.col("id") % 11).cast("double").alias("label")).repartition(3, "cat")
    encoder = LabelMeanEncoder(inputCols=["cat"])
    for work in (RangeScaler(inputCols=["label"]).fit, encoder.fit, lambda df: encoder.crossfit(df, ["id"])):
        left = files()
        work(rows)
        until = time.time() + 20
        while files() & left and time.time() < until:
            time.sleep(0.2)
        assert not files() & left


def test_blocks_grow_the_trees_of_spark(spark, monkeypatch):
    """Trees from sums over blocks, in jobs or not, predict as Spark's own do on the same rows."""
    from pyspark.ml.feature import VectorAssembler

    from shelfcast.operators import boosting

    rows = spark.range(3_000).select(
        ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 53) % 17).cast("double").alias("b"), "id"
    )
    rows = rows.withColumn("label", F.when(F.col("a") > 50, F.col("b") * 3).otherwise(F.col("a") / 7 - F.col("b")))
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).repartition(3)
    settings = {"maxIter": 6, "maxDepth": 3, "featureSubsetStrategy": "1.0"}
    want = models.tree_regressor(**settings).fit(rows)
    local = fit_gbt(rows, **settings)
    monkeypatch.setattr(boosting, "BLOCK", 500)
    monkeypatch.setattr(boosting, "LOCAL_BLOCKS", 0)
    for got in (local, fit_gbt(rows, **settings)):
        assert got.getNumTrees == 6 and got.treeWeights == want.treeWeights
        both = want.transform(rows).select("id", F.col("prediction").alias("want")).join(got.transform(rows), "id")
        assert both.agg(F.max(F.abs(F.col("want") - F.col("prediction"))).alias("off")).first()["off"] < 1e-9
        assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
        assert got.totalNumNodes == want.totalNumNodes and [t.depth for t in got.trees] == [t.depth for t in want.trees]
    drawn = fit_gbt(rows, **settings, subsamplingRate=0.5, minInstancesPerNode=100)
    assert drawn.transform(rows).agg(F.avg((F.col("label") - F.col("prediction")) ** 2).alias("e")).first()["e"] < 200
    with pytest.raises(Exception, match="finite"):
        fit_gbt(rows.withColumn("label", F.when(F.col("id") > 5, F.col("label"))), **settings)
