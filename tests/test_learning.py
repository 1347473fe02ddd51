"""Splits, metrics, models and explanations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from mergewell.operators import baseline, explain
from mergewell.operators.baseline import null_baseline
from mergewell.operators.explain import shap_importance, shap_values, signed_importance
from mergewell.operators.learners import (
    Learner, Problem, Proposer, label_levels, model_name, predict_first_level, search_space, thresholds)
from mergewell.operators.recipe import build_recipe, predictor_names
from mergewell.operators.resampling import assign_folds, stratified_split
from mergewell.operators.scoring import score
from mergewell.operators.selection import cut_rows
from mergewell.plans.train import is_worse, train

SMALL = dict(folds=3, repeats=2, tune_length=1, initial=2, trees_tune=5, trees_final=8, depth=4,
             max_iter=15, parallelism=4, null_runs=4)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    n = 240
    pdf = pd.DataFrame({"subject_id": [f"s{i}" for i in range(n)], "a": rng.normal(size=n),
                        "b": rng.normal(size=n), "group": rng.choice(["u", "v", "w"], n)})
    pdf["a2"] = pdf["a"] * 2
    pdf["flat"] = 1.0
    pdf["label"] = np.where(pdf["a"] + rng.normal(size=n) / 3 > 0, "yes", "no")
    pdf["amount"] = 3 * pdf["a"] - pdf["b"] + (pdf["group"] == "v") + rng.normal(size=n) / 10
    return spark.createDataFrame(pdf).cache()


def test_split_and_folds(rows):
    split = stratified_split(rows, "subject_id", "label", 0.7).toPandas()
    assert len(split) == 240 and split["subject_id"].is_unique
    for _, part in split.groupby("label"):
        assert part["is_train"].sum() == int(0.7 * len(part))
    again = stratified_split(rows.repartition(11), "subject_id", "label", 0.7).toPandas()
    assert set(again[again["is_train"]]["subject_id"]) == set(split[split["is_train"]]["subject_id"])
    folds = assign_folds(rows, "subject_id", "label", 5, 2).toPandas()
    for r in ("fold_r1", "fold_r2"):
        assert set(folds[r]) == set(range(5))
        assert folds.groupby(["label", r]).size().groupby("label").agg(lambda s: s.max() - s.min()).max() <= 1
    assert (folds["fold_r1"] != folds["fold_r2"]).any()


def test_numeric_strata(rows):
    split = stratified_split(rows, "subject_id", "amount", 0.5, kind="regression").toPandas()
    bins = pd.qcut(split["amount"], 4, labels=False)
    assert split.groupby(bins)["is_train"].sum().tolist() == [30] * 4


def test_perfect_and_constant_predictions(spark):
    truth = ["a", "b", "c", "a", "b"]
    perfect = spark.createDataFrame(
        [(t, t, [float(t == v) for v in "abc"]) for t in truth], "truth string, estimate string, scores array<double>")
    got = score(perfect, "classification", ["a", "b", "c"]).first().asDict()
    assert got == {"accuracy": 1, "bal_accuracy": 1, "f_meas": 1, "kap": 1, "roc_auc": 1}
    constant = perfect.withColumns({"estimate": F.lit("c"), "scores": F.array(*[F.lit(0.5)] * 3)})
    got = score(constant, "classification", ["a", "b", "c"]).first().asDict()
    assert got["bal_accuracy"] == 0.5 and got["roc_auc"] == 0.5 and got["kap"] == 0
    never = spark.createDataFrame([("a", "b"), ("b", "b")], "truth string, estimate string").withColumn(
        "scores", F.array(F.lit(0.1), F.lit(0.9)))
    assert score(never, "classification", ["a", "b"]).first()["f_meas"] is None
    numbers = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 2.0)], "truth double, estimate double")
    got = score(numbers, "regression").first()
    assert got["ccc"] == 0 and got["rsq"] is None and got["mae"] == 1


def test_null_runs(rows):
    runs = null_baseline(rows, "subject_id", "label", runs=5, levels=["no", "yes"]).collect()
    assert len(runs) == 5 and all(r["bal_accuracy"] == 0.5 for r in runs)
    numbers = null_baseline(rows, "subject_id", "amount", "regression", runs=3, fit_on="train").collect()
    assert all(r["rmse"] > 0 for r in numbers)


def test_recipe(rows):
    roles = ["subject_id", "label", "amount"]
    fitted = build_recipe(roles, 0.95).fit(rows)
    assert predictor_names(fitted) == ["a", "b", "group_v", "group_w"]
    out = fitted.transform(rows).first()
    assert out["features"].size == 4


def test_recipe_does_not_see_held_out_rows(rows):
    """An odd row outside the training part must not change what is learned."""
    roles = ["subject_id", "label", "amount", "part"]
    marked = rows.withColumn("part", F.lit(0))
    odd = marked.limit(1).withColumns({
        "part": F.lit(1), "flat": F.lit(99.0), "group": F.lit("zzz"), "a2": F.lit(1e9)})
    both = marked.unionByName(odd)
    learned = build_recipe(roles, 0.95).fit(both.filter("part = 0"))
    assert predictor_names(learned) == ["a", "b", "group_v", "group_w"]
    assert learned.transform(both.filter("part = 1")).count() == 1


def test_recipe_can_be_saved(rows, tmp_path):
    from pyspark.ml import PipelineModel

    fitted = build_recipe(["subject_id", "label", "amount"], 0.95).fit(rows)
    fitted.write().overwrite().save(str(tmp_path / "recipe"))
    loaded = PipelineModel.load(str(tmp_path / "recipe"))
    assert loaded.transform(rows).first()["features"] == fitted.transform(rows).first()["features"]


def test_guards(rows):
    with pytest.raises(ValueError):
        model_name("xgboost")
    with pytest.raises(ValueError):
        label_levels(rows, "subject_id")
    with pytest.raises(ValueError):
        train(rows, label="nothing")
    assert model_name("ranger") == "rf" and model_name("elasticnet") == "enet"


def test_proposer_spreads_then_searches_near_the_best():
    p = Proposer(2, 1)
    first = [p.next(None, 0) for _ in range(5)]
    assert all(sorted(x[d] for x in first) == [0.1, 0.3, 0.5, 0.7, 0.9] for d in (0, 1))
    near = p.next((0.5, 0.5), 1)
    assert all(0 <= x <= 1 for x in near)
    assert [d.name for d in search_space("rf", 10, 30)] == ["mtry", "min_n"]
    assert search_space("rf", 10, 30)[0].value(1.0) == 9


def test_forest_with_explanation(rows):
    report = train(rows.drop("amount"), explain=True, nsim=4, save_predictions=True, **SMALL)
    results = {r["metric"]: r for r in report.results.collect()}
    assert set(results) == {"accuracy", "bal_accuracy", "f_meas", "kap", "roc_auc"}
    assert results["accuracy"]["estimate"] > 0.7 > results["bal_accuracy"]["null_model_avg"]
    assert results["kap"]["null_model_avg"] is None
    oof = report.oof_predictions[0].toPandas()
    assert len(oof) == 2 * int(0.7 * 240) or len(oof) == 2 * oof["subject_id"].nunique()
    assert report.trace.select("iteration").distinct().count() >= 2
    top = shap_importance(report.importance["full"], 1).first()
    assert top["feature"] == "a"


def test_shap_is_additive(rows):
    data = rows.drop("amount").withColumn("target", (F.col("label") == "yes").cast("double"))
    roles = ["subject_id", "label", "target"]
    recipe = build_recipe(roles).fit(data)
    vectors = recipe.transform(data)
    model = Learner("rf", "classification", trees=5, depth=4).estimator({"mtry": 2, "min_n": 4}).fit(vectors)
    features = vectors.select(F.col("subject_id").alias("row_id"), "features")
    phi = shap_values(model, features, predictor_names(recipe), "classification", nsim=3).toPandas()
    fx = predict_first_level(model, features, "classification", "fx").select("row_id", "fx").toPandas()
    total = phi.groupby("row_id")["phi"].sum()
    want = fx.set_index("row_id")["fx"] - fx["fx"].mean()
    assert len(phi) == 240 * 4
    assert np.allclose(total.sort_index(), want.sort_index(), atol=1e-9)


@pytest.mark.parametrize("model", ["lasso", "ridge", "enet"])
def test_linear_models(rows, model):
    report = train(rows.drop("label"), label="amount", kind="regression", model=model, **SMALL)
    results = {r["metric"]: r["estimate"] for r in report.results.collect()}
    assert set(results) == {"mae", "rmse", "rsq", "ccc"} and results["rsq"] > 0.8


def test_several_classes(rows):
    report = train(rows.drop("label", "amount"), label="group", model="lasso", **SMALL)
    assert {r["estimator"] for r in report.results.collect()} == {"macro"}


def test_signed_importance(rows, spark):
    data = rows.withColumn("target", F.col("amount"))
    recipe = build_recipe(["subject_id", "label", "amount", "target"]).fit(data)
    model = Learner("ridge", "regression").estimator({"penalty": 1e-6}).fit(recipe.transform(data))
    got = {r["feature"]: (r["sign"], r["importance"]) for r in signed_importance(
        model, predictor_names(recipe), spark).collect()}
    assert got["a"][0] == "POS" and abs(got["a"][1] - 3) < 0.1
    assert got["b"][0] == "NEG" and abs(got["b"][1] - 1) < 0.1


def test_the_best_points_of_a_search(rows):
    report = train(rows.select("subject_id", "a", "b", F.col("amount").alias("label")), kind="regression", model="lasso", **SMALL)
    scores = {r["iteration"]: r["mean"] for r in report.trace.filter("metric = 'rmse'").collect()}
    top = report.best_points.collect()
    assert [r["mean"] for r in top] == sorted(scores.values())[:5] and report.best == {"penalty": top[0]["penalty"]}


def test_a_race_ends_for_what_is_clearly_worse():
    assert is_worse([1.0, 1.1, 0.9, 1.0], 2.0) and not is_worse([1.0, -1.0, 0.5, -0.4], 2.0)
    assert not is_worse([9.0, 9.0], 2.0) and not is_worse([-1.0] * 9, 2.0)


def test_null_runs_use_all_cores(rows, spark, monkeypatch):
    """However few parts the input is stored in: a pass hashes each row 20 times."""
    seen = []

    def cuts(hashed, *args):
        seen.append(hashed.rdd.getNumPartitions())
        return cut_rows(hashed, *args)

    monkeypatch.setattr(baseline, "cut_rows", cuts)
    assert null_baseline(rows.coalesce(1), "subject_id", "amount", kind="regression").count() == 20
    assert seen == [spark.sparkContext.defaultParallelism]


def test_a_forest_predicts_each_cell_once(spark, monkeypatch):
    """The same values as without cells, of fewer predictions than steps."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 3)).round(3)
    x[:, 2] = 1.0 * (x[:, 2] > 0)
    rows = spark.createDataFrame(
        [(f"r{i}", Vectors.dense(v), float(v[0] + v[1] > 0)) for i, v in enumerate(x.tolist())],
        ["row_id", "features", "target"])
    model = Learner("rf", "classification", trees=4, depth=3).estimator({"mtry": 2, "min_n": 5}).fit(rows)
    cuts = thresholds(model, 3)
    assert cuts[0] and all(c == sorted(set(c)) for c in cuts)
    predicted = []

    def counted(model, df, *args):
        predicted.append(df.count())
        return predict_first_level(model, df, *args)

    monkeypatch.setattr(explain, "predict_first_level", counted)
    cells = explain.shap_values(model, rows, ["a", "b", "c"], "classification", 20).toPandas()
    monkeypatch.setattr(explain, "thresholds", lambda *args: None)
    whole = explain.shap_values(model, rows, ["a", "b", "c"], "classification", 20).toPandas()
    both = cells.merge(whole, on=["row_id", "feature"])
    assert len(both) == 360 and np.allclose(both["phi_x"], both["phi_y"], atol=1e-9)
    assert (both["feature_value_x"] == both["feature_value_y"]).all()
    assert predicted[1] < predicted[3] < 120 * 20 * 4
    assert predicted[1] <= np.prod([len(c) + 1 for c in cuts])


def test_forests_remember_the_places_of_rows(spark):
    """Coming down from the root in every round makes fits grow with rows times depth."""
    for kind in ("classification", "regression"):
        assert Learner("rf", kind, trees=2).estimator({"mtry": 2, "min_n": 5}).getCacheNodeIds()
