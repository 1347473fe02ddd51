"""The four models, their search spaces and their predictions."""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass

from pyspark.ml.classification import (
    LogisticRegression, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from mergewell.operators.columns import numeric_columns
from mergewell.operators.correlation import spearman_pairs
from mergewell.operators.forest import Forest, TreeByTree
from mergewell.operators.redundancy import group_correlated

# Accepted spellings and what they stand for (fixed values).
MODELS = {"rf": "rf", "ranger": "rf", "randomforest": "rf", "lasso": "lasso",
          "ridge": "ridge", "enet": "enet", "elasticnet": "enet"}
MAX_CLASSES = 9


@dataclass(frozen=True)
class Dimension:
    """One parameter of a model: its range, on a log10 scale or in whole numbers."""

    name: str
    low: float
    high: float
    log: bool = False
    whole: bool = False

    def value(self, unit: float) -> float:
        x = self.low + unit * (self.high - self.low)
        x = 10.0**x if self.log else x
        return int(round(x)) if self.whole else x


def model_name(name: str) -> str:
    if name not in MODELS:
        raise ValueError(f"unknown model {name}; choose from {', '.join(MODELS)}")
    return MODELS[name]


def label_levels(df: DataFrame, label: str) -> list[str]:
    """Sorted classes; ten or more are refused."""
    found = df.select(F.col(label).cast("string").alias("v")).distinct().limit(
        MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has 10 or more classes; is this a regression?")
    return sorted(r["v"] for r in found)


def correlation_group_count(df: DataFrame, roles: list[str], level: float) -> int:
    """Number of groups of correlated numeric predictors (singletons included)."""
    columns = numeric_columns(df, roles)
    pairs = spearman_pairs(df, columns, level - 1e-12)
    return group_correlated(pairs, columns, level).count()


def search_space(model: str, groups: int = 2, test_rows: int = 2) -> list[Dimension]:
    """Ranges to search.  Forests: features per split up to 90 % of the groups of
    correlated predictors, node size up to the size of the test part."""
    penalty = Dimension("penalty", -10, 0, log=True)
    return {
        "rf": [Dimension("mtry", 2, max(2, round(0.9 * groups)), whole=True),
               Dimension("min_n", 2, max(2, test_rows), whole=True)],
        "lasso": [penalty], "ridge": [penalty],
        "enet": [penalty, Dimension("mixture", 0.05, 1)],
    }[model]


DEEPEST = 30  # the deepest tree that Spark ML grows


@dataclass(frozen=True)
class Problem:
    """What is predicted: by which key, from which label, as classes or as a number."""

    key: str
    label: str
    kind: str
    levels: tuple[str, ...] = ()

    def target(self) -> Column:
        """Numeric target: the value itself, or the place of the class in sort order."""
        if self.kind == "regression":
            return F.col(self.label).cast("double")
        levels = F.array(*[F.lit(v) for v in self.levels])
        return (F.array_position(levels, F.col(self.label).cast("string")) - 1).cast("double")


@dataclass(frozen=True)
class Learner:
    """A kind of model with the settings that are not searched."""

    model: str
    kind: str
    trees: int = 500
    depth: int = DEEPEST
    max_iter: int = 100
    seed: int = 42
    tree_by_tree: bool = False  # classification forests that tasks grow from counts of cells

    def __post_init__(self):
        if self.depth > DEEPEST:
            raise ValueError(f"forests are at most {DEEPEST} deep here")

    def estimator(self, params: dict):
        """A Spark ML estimator over (features, target).

        min_n is the size below which a node is not split; Spark asks for the smallest
        child instead, so half of it is passed on.
        """
        classes = self.kind == "classification"
        columns = {"featuresCol": "features", "labelCol": "target"}
        if self.model == "rf":
            make = RandomForestClassifier if classes else RandomForestRegressor
            least = max(1, math.ceil(params["min_n"] / 2))
            forest = make(
                numTrees=self.trees, maxDepth=self.depth, seed=self.seed,
                featureSubsetStrategy=str(int(params["mtry"])),
                minInstancesPerNode=least,
                # Rows keep their places in the trees instead of coming down from the root each round.
                cacheNodeIds=True, **columns)
            if not (self.tree_by_tree and classes):
                return forest
            return TreeByTree(forest, int(params["mtry"]), least, self.trees, self.depth, self.seed)
        mixture = {"lasso": 1.0, "ridge": 0.0}.get(self.model, params.get("mixture", 0.5))
        make = LogisticRegression if classes else LinearRegression
        return make(
            regParam=params["penalty"], elasticNetParam=mixture, standardization=True,
            maxIter=self.max_iter, **columns)


def predictions(model, df: DataFrame, problem: Problem, keep: list[str]) -> DataFrame:
    """(keep..., truth, estimate[, scores]) of a fitted model."""
    scored = model.transform(df)
    if problem.kind == "regression":
        return scored.select(*keep, F.col(problem.label).cast("double").alias("truth"),
                             F.col("prediction").alias("estimate"))
    names = F.array(*[F.lit(v) for v in problem.levels])
    return scored.select(
        *keep, F.col(problem.label).cast("string").alias("truth"),
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("estimate"),
        vector_to_array("probability").alias("scores"))


def predict_first_level(model, df: DataFrame, kind: str, out: str = "score") -> DataFrame:
    """Adds the probability of the first class, or the predicted number."""
    if isinstance(model, Forest):
        return model.with_first_class(df, out)
    scored = model.transform(df)
    value = F.col("prediction") if kind == "regression" else vector_to_array("probability")[0]
    return scored.withColumn(out, value).drop("prediction", "probability", "rawPrediction")


CONDITION = re.compile(r"feature (\d+) (?:<= (\S+)\)|in )")


def thresholds(model, size: int) -> list[list[float] | None] | None:
    """What a forest compares each of `size` features with, in order: values between the same two
    get the same prediction.  None for features that it looks up as categories, and for models
    that are no forests.  Trees are looked at one by one; Spark cuts a feature at 31 points at most."""
    if isinstance(model, Forest):
        return [c.tolist() for c in model.cuts]
    if not isinstance(model, (RandomForestClassificationModel, RandomForestRegressionModel)):
        return None
    found: list[set[float]] = [set() for _ in range(size)]
    looked_up = set()
    for tree in model.trees:
        for feature, value in set(CONDITION.findall(tree.toDebugString)):
            if value:
                found[int(feature)].add(float(value))
            else:
                looked_up.add(int(feature))
    return [None if i in looked_up else sorted(v) for i, v in enumerate(found)]


class Proposer:
    """Suggests points of the unit cube: spread first, then around the best one.

    Every fifth round without gain it takes the point farthest from all tried.
    """

    def __init__(self, dimensions: int, seed: int, initial: int = 5):
        self.random = random.Random(seed)
        self.dimensions = dimensions
        columns = [self.random.sample(range(initial), initial) for _ in range(dimensions)]
        self.start = [
            tuple((column[i] + 0.5) / initial for column in columns) for i in range(initial)]
        self.tried: list[tuple[float, ...]] = []

    def next(self, best: tuple[float, ...] | None, without_gain: int) -> tuple[float, ...]:
        if len(self.tried) < len(self.start):
            point = self.start[len(self.tried)]
        elif best is None or (without_gain and without_gain % 5 == 0):
            point = max((self._anywhere() for _ in range(200)), key=self._distance)
        else:
            width = 0.25 * 0.8**without_gain
            near = [tuple(min(1.0, max(0.0, self.random.gauss(b, width))) for b in best)
                    for _ in range(20)]
            point = max(near, key=self._distance)
        self.tried.append(point)
        return point

    def _anywhere(self):
        return tuple(self.random.random() for _ in range(self.dimensions))

    def _distance(self, point):
        return min(math.dist(point, t) for t in self.tried)
