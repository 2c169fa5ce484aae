"""Encodings, models, scores, the forecast."""

from __future__ import annotations

from functools import cache, reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators.encoding import (
    COS,
    ENCODED,
    SCALED,
    SIN,
    CyclicEncoder,
    LabelMeanEncoder,
    RangeScaler,
    feature_names,
    fit_transform_split,
    scaled_stages,
    tree_stages,
)
from shelfcast.operators.features import features_and_label
from shelfcast.operators.models import (
    ALPHAS,
    L1_RATIOS,
    TREE_CHOICES,
    auto_search,
    feature_importance,
    fit_gbt,
    label_spread,
    penalty,
    random_search,
    search_history,
)
from shelfcast.operators.scoring import r2, rmse, score
from shelfcast.operators.splits import parts, split_last_periods
from shelfcast.plans.forecast import forecast_next_period, round_forecast
from shelfcast.plans.training import train_linear, train_trees
from shelfcast.sources.stages import load_model, save_model
from workloads.digest import digest, digest_sql
from workloads.queries.features import PANEL_DOUBLES
from workloads.queries.sources import PERIOD_SHOP, scratch
from workloads.registry import query, step
from workloads.retail import SPEC, builder, raw_tables

ROLES = SPEC.roles()
IDS, NUMBERS = ROLES.categorical, ROLES.numeric


def split_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Features and label of the months before the last k, and of those."""
    labeled = split_last_periods(builder(spark, sf_dir).features(), SPEC)
    return tuple(features_and_label(p, SPEC) for p in parts(labeled))


step("train_rows", "SELECT *, amount_item AS label FROM split_by_end WHERE split = 'train'")
step("val_rows", "SELECT *, amount_item AS label FROM split_by_end WHERE split = 'val'")
step("label_moments", "SELECT CAST(count(*) AS DOUBLE) AS n, sum(label) AS total, sum(label * label) AS squares FROM train_rows")
step(
    "label_stats",
    "SELECT total / n AS m, greatest(squares / n - (total / n) * (total / n), 0) AS v FROM label_moments",
)


def shrunk(n: str, total: str, squares: str, mean: str, var: str) -> str:
    spread = f"greatest({squares} / {n} - ({total} / {n}) * ({total} / {n}), 0)"
    weight = f"({var} * {n} / ({var} * {n} + {spread}))"
    return (
        f"CASE WHEN {var} * {n} + {spread} > 0 THEN {weight} * ({total} / {n}) + (1.0::DOUBLE - {weight}) * {mean} ELSE {mean} END"
    )


step(
    "category_moments",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS BIGINT) AS value, CAST(count(*) AS DOUBLE) AS n, sum(label) AS total, "
        f"sum(label * label) AS squares FROM train_rows GROUP BY {c}"
        for c in IDS
    ),
)
step(
    "encodings",
    f"SELECT feature, value, CAST(n AS BIGINT) AS n, {shrunk('n', 'total', 'squares', 'm', 'v')} AS encoding FROM category_moments, label_stats",
)


@query("target_encode", "SELECT feature, value, n, round(encoding, 6) AS encoding FROM encodings")
def _(spark, sf_dir):
    train, _val = split_rows(spark, sf_dir)
    return LabelMeanEncoder(inputCols=IDS).encodings(train).withColumn("encoding", F.round("encoding", 6))


step(
    "folded",
    "SELECT *, CAST(('0x' || substr(md5(concat_ws('|', CAST(monthly_period AS VARCHAR), CAST(shop_id AS VARCHAR), "
    "CAST(item_id AS VARCHAR), '42')), 1, 8))::BIGINT % 5 AS INT) AS fold FROM train_rows",
)
step(
    "fold_rest",
    "SELECT fold, a.n - b.n AS n, a.total - b.total AS total, a.squares - b.squares AS squares FROM label_moments a, "
    "(SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(label) AS total, sum(label * label) AS squares FROM folded GROUP BY fold) b",
)
step(
    "fold_stats",
    "SELECT fold, total / n AS m, greatest(squares / n - (total / n) * (total / n), 0) AS v FROM fold_rest",
)
for c in IDS:
    step(
        f"fold_{c}",
        f"SELECT t.value, o.fold, t.n - o.n AS n, t.total - o.total AS total, t.squares - o.squares AS squares FROM category_moments t "
        f"JOIN (SELECT CAST({c} AS BIGINT) AS value, fold, CAST(count(*) AS DOUBLE) AS n, sum(label) AS total, "
        f"sum(label * label) AS squares FROM folded GROUP BY 1, 2) o ON o.value = t.value WHERE t.feature = '{c}'",
    )
    step(
        f"code_{c}",
        f"SELECT f.value, f.fold, CASE WHEN f.n > 0 THEN {shrunk('f.n', 'f.total', 'f.squares', 's.m', 's.v')} ELSE s.m END "
        f"AS encoding FROM fold_{c} f JOIN fold_stats s ON s.fold = f.fold",
    )
CROSSFITTED = ["item_id", *[ENCODED + c for c in IDS], "label"]
step(
    "crossfitted",
    "SELECT r.monthly_period, r.shop_id, r.item_id, r.label, "
    + ", ".join(f"x{i}.encoding AS {ENCODED}{c}" for i, c in enumerate(IDS))
    + " FROM folded r "
    + " ".join(f"JOIN code_{c} x{i} ON x{i}.value = r.{c} AND x{i}.fold = r.fold" for i, c in enumerate(IDS)),
)


@query("target_encode_crossfit", digest_sql("crossfitted", PERIOD_SHOP, CROSSFITTED, CROSSFITTED[1:]))
def _(spark, sf_dir):
    train, _val = split_rows(spark, sf_dir)
    return digest(LabelMeanEncoder(inputCols=IDS).crossfit(train, SPEC.key, seed=SPEC.seed), PERIOD_SHOP, CROSSFITTED)


step("ranges", "SELECT " + ", ".join(f"CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}" for c in NUMBERS) + " FROM train_rows")
SCALED_SQL = ", ".join(
    f"({c} - lo_{c}) / CASE WHEN hi_{c} > lo_{c} THEN hi_{c} - lo_{c} ELSE 1 END AS {SCALED}{c}" for c in NUMBERS
)
step("scaled_val", f"SELECT monthly_period, shop_id, item_id, {SCALED_SQL} FROM val_rows, ranges")
SCALED_COLUMNS = ["item_id", *[SCALED + c for c in NUMBERS]]


@query("min_max_scale", digest_sql("scaled_val", PERIOD_SHOP, SCALED_COLUMNS, SCALED_COLUMNS[1:]))
def _(spark, sf_dir):
    train, val = split_rows(spark, sf_dir)
    return digest(RangeScaler(inputCols=NUMBERS).fit(train).transform(val), PERIOD_SHOP, SCALED_COLUMNS)


WAVES = [SIN + "month", COS + "month"]
WAVE_SQL = "sin(month / 12.0::DOUBLE * 2 * pi()) AS sin__month, cos(month / 12.0::DOUBLE * 2 * pi()) AS cos__month"
TREE_COLUMNS = [*WAVES, *IDS, *NUMBERS]
step("tree_val", f"SELECT *, {WAVE_SQL} FROM val_rows")


@query("assemble_tree_features", digest_sql("tree_val", PERIOD_SHOP, TREE_COLUMNS, [*WAVES, *PANEL_DOUBLES]))
def _(spark, sf_dir):
    """The tree inputs by name, before they are put into one vector."""
    _train, val = split_rows(spark, sf_dir)
    return digest(CyclicEncoder(inputCol="month", period=12).transform(val), PERIOD_SHOP, TREE_COLUMNS)


LINEAR_COLUMNS = [*[ENCODED + c for c in IDS], *WAVES, *[SCALED + c for c in NUMBERS]]
step(
    "linear_val",
    f"SELECT v.monthly_period, v.shop_id, "
    + ", ".join(f"coalesce(e{i}.encoding, m) AS {ENCODED}{c}" for i, c in enumerate(IDS))
    + f", {WAVE_SQL}, {SCALED_SQL} FROM val_rows v CROSS JOIN ranges CROSS JOIN label_stats "
    + " ".join(f"LEFT JOIN encodings e{i} ON e{i}.feature = '{c}' AND e{i}.value = v.{c}" for i, c in enumerate(IDS)),
)


@query("assemble_scaled_features", digest_sql("linear_val", PERIOD_SHOP, LINEAR_COLUMNS, LINEAR_COLUMNS))
def _(spark, sf_dir):
    """The linear inputs by name, next to the vector they are put into."""
    train, val = split_rows(spark, sf_dir)
    _fitted, _matrix, val_matrix = fit_transform_split(train, val, scaled_stages(SPEC), SPEC)
    return digest(val_matrix, PERIOD_SHOP, LINEAR_COLUMNS)


step(
    "linear_both",
    "SELECT 'train' AS split, t.monthly_period, t.shop_id, "
    + ", ".join(f"t.{ENCODED}{c}" for c in IDS)
    + f", {WAVE_SQL}, {SCALED_SQL}, t.label FROM (SELECT r.*, "
    + ", ".join(f"x{i}.encoding AS {ENCODED}{c}" for i, c in enumerate(IDS))
    + " FROM folded r "
    + " ".join(f"JOIN code_{c} x{i} ON x{i}.value = r.{c} AND x{i}.fold = r.fold" for i, c in enumerate(IDS))
    + ") t CROSS JOIN ranges UNION ALL SELECT 'val', v.monthly_period, v.shop_id, "
    + ", ".join(f"coalesce(e{i}.encoding, m) AS {ENCODED}{c}" for i, c in enumerate(IDS))
    + f", {WAVE_SQL}, {SCALED_SQL}, v.label FROM val_rows v CROSS JOIN ranges CROSS JOIN label_stats "
    + " ".join(f"LEFT JOIN encodings e{i} ON e{i}.feature = '{c}' AND e{i}.value = v.{c}" for i, c in enumerate(IDS)),
)


@query("fit_transform_split", digest_sql("linear_both", ["split", *PERIOD_SHOP], [*LINEAR_COLUMNS, "label"], [*LINEAR_COLUMNS, "label"]))
def _(spark, sf_dir):
    train, val = split_rows(spark, sf_dir)
    _fitted, matrix, val_matrix = fit_transform_split(train, val, scaled_stages(SPEC), SPEC)
    both = matrix.withColumn("split", F.lit("train")).unionByName(val_matrix.withColumn("split", F.lit("val")))
    return digest(both, ["split", *PERIOD_SHOP], [*LINEAR_COLUMNS, "label"])


@cache
def _linear(app: str, sf_dir: str):
    return train_linear(builder(SparkSession.active(), sf_dir).features(), "last_months_val", SPEC)


@cache
def _trees(app: str, sf_dir: str):
    return train_trees(builder(SparkSession.active(), sf_dir).features(), "last_months_val", SPEC)


def linear(spark: SparkSession, sf_dir: str):
    return _linear(spark.sparkContext.applicationId, sf_dir)


def trees(spark: SparkSession, sf_dir: str):
    """The boosted trees of one application are fitted once; later queries use the same model."""
    return _trees(spark.sparkContext.applicationId, sf_dir)


ALPHA, L1_RATIO = 1.0, 0.5


@query("fit_elastic_net", f"SELECT count(*) AS rows, {len(LINEAR_COLUMNS)} AS weights, CAST(0 AS DOUBLE) AS violation FROM train_rows")
def _(spark, sf_dir):
    """How far the weights of the default elastic net are from the optimum: the largest slope left, over the penalty's own."""
    trained = linear(spark, sf_dir)
    weights = trained.pipeline.stages[-1].coefficients.toArray().tolist()
    x, left = vector_to_array("features"), F.col("label") - F.col("prediction")
    train = trained.predictions().where("split = 'train'").select(x.alias("x"), left.alias("left"))
    slopes = [F.avg(F.get("x", F.lit(i)) * F.col("left")) - ALPHA * (1 - L1_RATIO) * w for i, w in enumerate(weights)]
    off = [F.abs(s - ALPHA * L1_RATIO * (1 if w > 0 else -1)) if w else F.greatest(F.abs(s) - ALPHA * L1_RATIO, F.lit(0.0)) for s, w in zip(slopes, weights)]
    checked = train.agg(F.count(F.lit(1)).alias("rows"), F.round(F.greatest(*off), 2).alias("violation"))
    return checked.select("rows", F.lit(len(weights)).alias("weights"), "violation")


@cache
def _random_search(app: str, sf_dir: str):
    spark = SparkSession.active()
    train, val = split_rows(spark, sf_dir)
    _fitted, matrix, _val_matrix = fit_transform_split(train, val, scaled_stages(SPEC), SPEC)
    return random_search(matrix, SPEC.key, seed=SPEC.seed)


def history_sql(trials: int) -> str:
    """A numbered row for each trial; settings and running best are checked by the query."""
    return (
        f"SELECT CAST(t.trial AS INT) AS trial, TRUE AS settings_known, TRUE AS best_so_far, n.rows FROM range(1, {trials + 1}) t(trial), "
        "(SELECT count(*) AS rows FROM train_rows) n"
    )


def checked_history(history: DataFrame, matrix: DataFrame, choices: dict, larger: bool) -> DataFrame:
    """By trial: were its settings among the choices, is its best score the best up to here; and the rows searched on."""
    order = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, 0)
    best = (F.max if larger else F.min)("score").over(order)
    known = [F.col("settings")[k].isin([str(v) for v in values]) for k, values in choices.items()]
    rows = matrix.agg(F.count(F.lit(1)).alias("n")).scalar()
    return history.select("trial", reduce(and_, known).alias("settings_known"), (F.col("best_score") == best).alias("best_so_far"), rows.alias("rows"))


def checked_scores(scored: DataFrame, *by: str) -> DataFrame:
    """Rows, label total, and whether the predictions are nearer to the label than its mean."""
    error = F.avg((F.col("label") - F.col("prediction")) ** 2)
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("label"), 2).alias("label"), (error < F.var_pop("label")).alias("beats_mean")
    )


SCORED_SQL = "count(*) AS rows, round(sum(label), 2) AS label, TRUE AS beats_mean"
BOTH_SQL = (
    f"SELECT 'train' AS split, {SCORED_SQL} FROM train_rows "
    f"UNION ALL SELECT 'val', {SCORED_SQL} FROM val_rows"
)


@query("random_search", history_sql(10))
def _(spark, sf_dir):
    spread = label_spread(split_rows(spark, sf_dir)[0])
    penalties = [penalty(a, r, spread) for a in ALPHAS for r in L1_RATIOS]
    choices = {k: [p[k] for p in penalties] for k in ("regParam", "elasticNetParam")}
    history = search_history(_random_search(spark.sparkContext.applicationId, sf_dir), spark)
    return checked_history(history, split_rows(spark, sf_dir)[0], choices, larger=True)


@query("fit_gbt", f"SELECT {SCORED_SQL}, 100 AS rounds FROM train_rows")
def _(spark, sf_dir):
    """Trees boosted for the full number of rounds, on the rows they were fitted to."""
    train, val = split_rows(spark, sf_dir)
    _fitted, matrix, _val_matrix = fit_transform_split(train, val, tree_stages(SPEC), SPEC)
    model = fit_gbt(matrix, SPEC.seed)
    return checked_scores(model.transform(matrix)).withColumn("rounds", F.lit(model.getNumTrees))


@query("early_stopping", f"SELECT *, TRUE AS rounds_known FROM ({BOTH_SQL})")
def _(spark, sf_dir):
    """The stopped model on both parts."""
    trained = trees(spark, sf_dir)
    rounds = trained.pipeline.stages[-1].getNumTrees
    return checked_scores(trained.predictions(), "split").withColumn("rounds_known", F.lit(1 <= rounds <= 100))


TRIALS = 6


@cache
def _auto_search(app: str, sf_dir: str):
    spark = SparkSession.active()
    train, val = split_rows(spark, sf_dir)
    _fitted, matrix, _val_matrix = fit_transform_split(train, val, tree_stages(SPEC), SPEC)
    return auto_search(matrix, SPEC.key, trials=TRIALS, seed=SPEC.seed)


@query("auto_search", BOTH_SQL)
def _(spark, sf_dir):
    """The best model the search found, on the rows searched on and on those after them."""
    train, val = split_rows(spark, sf_dir)
    _fitted, matrix, val_matrix = fit_transform_split(train, val, tree_stages(SPEC), SPEC)
    both = matrix.withColumn("split", F.lit("train")).unionByName(val_matrix.withColumn("split", F.lit("val")))
    return checked_scores(_auto_search(spark.sparkContext.applicationId, sf_dir).bestModel.transform(both), "split")


@query("search_history", history_sql(TRIALS))
def _(spark, sf_dir):
    history = search_history(_auto_search(spark.sparkContext.applicationId, sf_dir), spark)
    return checked_history(history, split_rows(spark, sf_dir)[0], TREE_CHOICES, larger=False)


@query(
    "feature_importance",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS share_known, n.rows FROM (SELECT count(*) AS rows FROM train_rows) n" for c in TREE_COLUMNS),
)
def _(spark, sf_dir):
    """Each feature of the trees: is its importance a share, all of which add up to 1."""
    trained = trees(spark, sf_dir)
    shares = feature_importance(trained.pipeline.stages[-1], feature_names(trained.pipeline), spark)
    total = shares.agg(F.sum("importance").alias("t")).scalar()
    rows = split_rows(spark, sf_dir)[0].agg(F.count(F.lit(1)).alias("n")).scalar()
    return shares.select("feature", (F.col("importance").between(0, 1) & (F.abs(total - 1) < 1e-6)).alias("share_known"), rows.alias("rows"))


@query("predict", "SELECT monthly_period, shop_id, count(*) AS rows, round(sum(label), 2) AS label, count(*) AS predicted FROM val_rows GROUP BY ALL")
def _(spark, sf_dir):
    """Validation rows and those with a prediction, by month and shop."""
    trained = trees(spark, sf_dir)
    scored = trained.pipeline.stages[-1].transform(trained.val)
    return scored.groupBy(*PERIOD_SHOP).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("label"), 2).alias("label"), F.count("prediction").alias("predicted")
    )


@query("train_and_score", " UNION ALL ".join(f"SELECT '{m}' AS model, * FROM ({BOTH_SQL})" for m in ("elastic_net", "boosted_trees")))
def _(spark, sf_dir):
    scored = [(name, checked_scores(fit(spark, sf_dir).predictions(), "split")) for name, fit in (("elastic_net", linear), ("boosted_trees", trees))]
    named = [df.withColumn("model", F.lit(name)) for name, df in scored]
    return named[0].unionByName(named[1])


def reloaded(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return load_model(save_model(trees(spark, sf_dir).pipeline, scratch(spark, sf_dir, "models"), "trees"))


@query("save_model", "SELECT count(*) AS rows, count(*) AS alike FROM val_rows")
def _(spark, sf_dir):
    """Rows predicted alike by a pipeline and by the same pipeline saved and loaded."""
    trained = linear(spark, sf_dir)
    again = load_model(save_model(trained.pipeline, scratch(spark, sf_dir, "models"), "linear"))
    _train, val = split_rows(spark, sf_dir)
    keys = list(SPEC.key)
    before = trained.pipeline.transform(val).select(*keys, F.col("prediction").alias("before"))
    after = again.transform(val).select(*keys, F.col("prediction").alias("after"))
    return before.join(after, keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.abs(F.col("before") - F.col("after")) < 1e-9).alias("alike")
    )


@query(
    "forecast_next_period",
    "SELECT r.shop_id AS shop, r.item_id AS item, r.shop_id IN (SELECT shop_id FROM shop_list) AND r.item_id IN (SELECT item_id FROM item_list) "
    "AS forecast FROM requests r",
)
def _(spark, sf_dir):
    """Requested pairs, and whether a saved and loaded model has a whole-number forecast for them."""
    raw = forecast_next_period(builder(spark, sf_dir).features(), raw_tables(spark, sf_dir)["test"], reloaded(spark, sf_dir), SPEC)
    return round_forecast(raw, SPEC).select("shop", "item", F.col("amount").isNotNull().alias("forecast"))


# The naive forecast, last month's amount, is scored in SQL too.
step("naive", "SELECT *, amount_item_l1 AS prediction FROM val_rows")
ERROR = "avg((label - prediction) * (label - prediction))"


def naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(spark, sf_dir)[1].withColumn("prediction", F.col("amount_item_l1"))


@query("rmse", f"SELECT round(sqrt({ERROR}), 6) AS rmse FROM naive")
def _(spark, sf_dir):
    return naive(spark, sf_dir).agg(F.round(rmse(), 6).alias("rmse"))


@query("r2", f"SELECT round(1 - {ERROR} / nullif(var_pop(label), 0), 6) AS r2 FROM naive")
def _(spark, sf_dir):
    return naive(spark, sf_dir).agg(F.round(r2(), 6).alias("r2"))


@query("per_group_score", f"SELECT shop_id, count(*) AS rows, round(sqrt({ERROR}), 6) AS rmse, round(1 - {ERROR} / nullif(var_pop(label), 0), 6) AS r2 FROM naive GROUP BY shop_id")
def _(spark, sf_dir):
    scores = score(naive(spark, sf_dir), ["shop_id"])
    return scores.withColumns({c: F.round(c, 6) for c in ("rmse", "r2")})
