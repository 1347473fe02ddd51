"""Forests grown tree by tree, and Shapley values that look predictions up."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from mergewell.functions.hashing import hashed_ints
from mergewell.operators import explain, forest
from mergewell.operators.explain import shap_values
from mergewell.operators.forest import BINS, Forest, encoded
from mergewell.operators.learners import Learner, predict_first_level, thresholds
from mergewell.queries import learning

NAMES = ["a", "b", "c", "d"]


def fitted(rows, trees=20, **settings):
    return Learner("rf", "classification", trees=trees, tree_by_tree=True, **settings).estimator(
        {"mtry": 2, "min_n": 5}).fit(rows)


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers of many values, of few, mostly zero, and a rare mark."""
    rng = np.random.default_rng(8)
    n = 3000
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 9, n), rng.poisson(0.1, n) * rng.integers(1, 50, n),
                         rng.random(n) < 0.01]).astype(float)
    y = (x[:, 0] + 0.3 * x[:, 1] + 2 * x[:, 3] + rng.normal(size=n) > 1.2).astype(float)
    return spark.createDataFrame(
        [(f"r{i}", Vectors.dense(v), t) for i, (v, t) in enumerate(zip(x.tolist(), y.tolist()))],
        ["row_id", "features", "target"]).repartition(5).cache()


@pytest.fixture(scope="module")
def model(rows):
    return fitted(rows)


def table(values):
    return values.toPandas().set_index(["row_id", "feature"]).sort_index()


def test_tasks_hash_as_spark_does(spark):
    sims = list(range(1, 6))
    found = spark.createDataFrame([("x",), ("",), (None,), ("yy",)], "id string").select(
        F.xxhash64(F.lit(42), "id").alias("before"),
        F.transform(F.array(*map(F.lit, sims)), lambda s: F.xxhash64(F.lit(42), "id", s)).alias("all")).collect()
    before = np.array([r["before"] for r in found])
    assert hashed_ints(before[:, None], np.array(sims)).tolist() == [r["all"] for r in found]


def test_cuts_are_those_of_spark(rows, model):
    """Spark names the middle between the cut and the next value, from all rows if they are 10,000 at most."""
    x = np.array(rows.select(vector_to_array("features").alias("x")).toPandas()["x"].to_list())
    cuts = forest._cuts(rows.select(vector_to_array("features").alias("x")))
    assert [len(c) < BINS for c in cuts] == [True] * 4 and cuts[1].tolist() == list(range(8)) and cuts[3].tolist() == [0]
    theirs = Learner("rf", "classification", trees=60).estimator({"mtry": 2, "min_n": 5}).fit(rows)
    for i, middles in enumerate(thresholds(theirs, 4)):
        assert middles and {x[x[:, i] <= m, i].max() for m in middles} <= set(cuts[i])
        assert set(model.cuts[i]) <= set(cuts[i])


def test_a_tree_alone_keeps_the_rules(rows):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 5, (3, 400)).astype(np.uint8)
    y = (codes[0] + codes[1] > 4).astype(np.int64)
    n = rng.integers(1, 9, 400)

    class Once:  # every row once, the features in their order
        def poisson(self, n):
            return n

        def random(self, shape):
            return np.tile(np.arange(shape[1]), (shape[0], 1))

    tree = forest.grown(codes, y, n, 3, 4, 30, Once())
    one = Forest([np.arange(4.0)] * 3, [tree])
    assert (one.first_class(codes) == (y == 0)).all()
    assert len(forest.grown(codes, y, n, 3, 4, 0, Once()).feature) == 1
    assert len(forest.grown(codes, y, n, 3, int(n.sum()), 30, Once()).feature) == 1
    inner = tree.feature >= 0
    assert (tree.left[inner] > np.flatnonzero(inner)).all() and len(tree.feature) == 2 * inner.sum() + 1


def test_nodes_taken_in_parts_give_the_same_tree(rows, monkeypatch):
    rng = np.random.default_rng(2)
    codes, y = rng.integers(0, 9, (4, 2000)).astype(np.uint8), rng.integers(0, 3, 2000)
    whole = forest.grown(codes, y, np.ones(2000, int), 2, 2, 30, np.random.default_rng(5))
    monkeypatch.setattr(forest, "COUNTED", 100)
    parts = forest.grown(codes, y, np.ones(2000, int), 2, 2, 30, np.random.default_rng(5))
    assert len(whole.feature) > 100
    for c in ("feature", "cut", "left", "share"):
        assert (getattr(whole, c) == getattr(parts, c)).all()


def test_a_forest_of_cells_is_like_one_of_rows(rows):
    """Same shape and nearly the same probabilities as Spark's, whatever the partitions."""
    mine = fitted(rows, 100)
    theirs = Learner("rf", "classification", trees=100).estimator({"mtry": 2, "min_n": 5}).fit(rows)
    nodes = sum(len(t.feature) for t in mine.trees)
    assert abs(nodes / sum(t.numNodes for t in theirs.trees) - 1) < 0.05
    a, b = (predict_first_level(m, rows, "classification", "p").select("row_id", "p").toPandas().set_index(
        "row_id")["p"].sort_index() for m in (mine, theirs))
    assert (a - b).abs().mean() < 0.02 and abs(a.mean() - b.mean()) < 0.01
    again = fitted(rows.repartition(11), 100)
    assert all((p.share == q.share).all() and (p.cut == q.cut).all() for p, q in zip(mine.trees, again.trees))


def test_rows_of_too_many_cells_are_left_to_spark(rows, model, monkeypatch):
    assert isinstance(model, Forest) and len(model.trees) == 20
    monkeypatch.setattr(forest, "SENT_CELLS", 10)
    assert len(fitted(rows, 3).trees) == 3 and not isinstance(fitted(rows, 3), Forest)


def test_looked_up_values_are_those_of_joined_steps(rows, model, monkeypatch):
    """The same draws, so the same values, without a row per mixture or step."""
    few = rows.filter("row_id < 'r2'")
    found = shap_values(model, few, NAMES, "classification", 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    monkeypatch.setattr(explain, "STEPS", 7_000)
    small = table(shap_values(model, few, NAMES, "classification", 20))
    monkeypatch.setattr(explain, "_key_weights", lambda sizes, seed: (
        np.random.default_rng(seed).integers(-2**63, 2**63, (len(sizes), max(sizes)), np.int64), False))
    random = table(shap_values(model, few, NAMES, "classification", 20))
    monkeypatch.setattr(explain, "SENT_MB", 0)
    joined = table(shap_values(model, few, NAMES, "classification", 20))
    found = table(found)
    assert len(found) == few.count() * 4 and found["phi"].abs().max() > 0.05
    for other in (small, random, joined):
        assert found.index.equals(other.index)
        assert np.allclose(found["phi"], other["phi"], atol=1e-12)
        assert (found["feature_value"] == other["feature_value"]).all()


def test_weights_tell_cells_apart():
    weights, exact = explain._key_weights([3, 2, 5], 1)
    cells = np.stack(np.meshgrid(range(3), range(2), range(5)), -1).reshape(-1, 3)
    assert exact and sorted(weights[np.arange(3), cells].sum(1)) == list(range(30))
    assert not explain._key_weights([32] * 40, 1)[1]


def test_keys_that_coincide_are_not_used(rows, model, monkeypatch):
    monkeypatch.setattr(explain, "_key_weights", lambda sizes, seed: (np.zeros((len(sizes), max(sizes)), np.int64), False))
    few = rows.filter("row_id < 'r12'")
    assert explain._looked_up(model, few, NAMES, 5, 42, "full") is None
    phi = table(shap_values(model, few, NAMES, "classification", 5))
    assert abs(phi["phi"].sum()) < 1e-9 and len(phi) == few.count() * 4


def test_rows_that_repeat_an_id_are_explained_one_by_one(rows, model):
    few = rows.filter("row_id < 'r12'")
    twice = shap_values(model, few.unionByName(few), NAMES, "classification", 9).toPandas()
    fx = predict_first_level(model, few, "classification", "fx").toPandas().set_index("row_id")["fx"]
    total = twice.groupby("row_id")["phi"].sum().sort_index() / 2
    assert len(twice) == 8 * len(fx)
    assert np.allclose(total, (fx - fx.mean()).sort_index(), atol=1e-12)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """300 labelled documents."""
    at = tmp_path_factory.mktemp("documents")
    rng = np.random.default_rng(4)
    texts = [" ".join(["word", "Word", "7", "line\n"][k] for k in rng.integers(0, 4, rng.integers(5, 60))) for _ in range(300)]
    spark.createDataFrame(pd.DataFrame({
        "doc_id": range(300), "text": texts, "lang": rng.choice(["en", "de"], 300), "source": "s",
        "n_chars": [len(t) for t in texts]})).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame(pd.DataFrame({
        "doc_id": range(300), "quality": [int(t.count("7") > 8) for t in texts], "toxic": 0})).write.parquet(
            str(at / "labels.parquet"))
    return str(at)


@pytest.fixture
def looked_up(monkeypatch):
    """The numbers of trees of the forests whose values are looked up."""
    seen, whole = [], explain._looked_up

    def watched(model, *args):
        found = whole(model, *args)
        seen.append(len(model.trees) if found is not None else 0)
        return found

    monkeypatch.setattr(explain, "_looked_up", watched)
    return seen


def test_q_shap_grows_tree_by_tree_on_many_rows(spark, folder, looked_up, monkeypatch):
    learning.q_shap(spark, folder)
    assert looked_up == []
    monkeypatch.setattr(learning, "FEW_ROWS", 200)
    values = learning.q_shap(spark, folder).toPandas()
    assert looked_up == [500] * 3
    sizes = values.groupby("slice")["row_id"].nunique()
    assert sizes["full"] == 300 and sizes["train"] + sizes["test"] == 300
    assert values.groupby("slice")["phi"].sum().abs().max() < 1e-9
    for name, part in values.groupby("slice"):
        assert len(part) == sizes[name] * part["feature"].nunique()


def test_q_shap_additivity_holds_on_many_rows(spark, folder, looked_up, monkeypatch):
    monkeypatch.setattr(learning, "FEW_ROWS", 200)
    found = {r["slice"]: r for r in learning.q_shap_additivity(spark, folder).collect()}
    assert looked_up == [500] * 3 and all(r["adds_up"] for r in found.values())
    assert found["full"]["rows"] == 300 == found["train"]["rows"] + found["test"]["rows"]


def test_q_shap_importance_on_many_rows_is_that_of_few(spark, folder, looked_up, monkeypatch):
    """Forests of other draws name the same feature first, with nearly the same importance."""
    few = learning.q_shap_importance(spark, folder).toPandas().set_index(["slice", "feature"])["importance"]
    monkeypatch.setattr(learning, "FEW_ROWS", 200)
    many = learning.q_shap_importance(spark, folder).toPandas().set_index(["slice", "feature"])["importance"]
    assert looked_up == [500] * 3 and sorted(few.index) == sorted(many.index)
    assert (few - many).abs().max() < 0.03
    assert {s: i[1] for s, i in many.groupby("slice").idxmax().items()} == dict.fromkeys(["full", "train", "test"], "n_digits")


def test_codes_count_the_cuts_below():
    cuts = [np.array([0.0, 2.0]), np.array([])]
    x = np.array([[-1.0, 5.0], [0.0, 5.0], [1.0, 5.0], [2.0, 5.0], [np.inf, 5.0]])
    assert encoded(x, cuts).tolist() == [[0, 0], [0, 0], [1, 0], [1, 0], [2, 0]]
