"""Train, tune, score and explain a model on one complete table."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from mergewell.functions.naming import clean_name
from mergewell.jobs import in_threads
from mergewell.lineage import cut_lineage
from mergewell.operators.baseline import RUNS, null_baseline
from mergewell.operators.explain import shap_values, signed_importance
from mergewell.operators.learners import (
    DEEPEST, Dimension, Learner, Problem, Proposer, correlation_group_count, label_levels, model_name,
    predictions, search_space)
from mergewell.operators.recipe import build_recipe, predictor_names
from mergewell.operators.resampling import assign_folds, stratified_split
from mergewell.operators.scoring import (
    CLASS_METRICS, LOWER_IS_BETTER, NUMBER_METRICS, compare_to_null, metric_average, score,
    to_metric_rows)
from mergewell.sources.delimited import load_ml_table

TARGET = "target"
PARTITIONS = 8  # of the rows that models are fitted on


@dataclass
class Resample:
    repeat: int
    fold: int
    train: DataFrame
    held_out: DataFrame


@dataclass
class TuningResult:
    trace: DataFrame
    best: dict
    predictions: list[DataFrame] = field(default_factory=list)
    dropped: list[int] = field(default_factory=list)  # iterations that a race ended early


@dataclass
class TrainReport:
    results: DataFrame
    null_runs: DataFrame
    trace: DataFrame
    best: dict
    recipe: object
    model: object
    best_points: DataFrame | None = None
    importance: dict[str, DataFrame] = field(default_factory=dict)
    oof_predictions: list[DataFrame] = field(default_factory=list)


def metrics_of(kind: str) -> tuple[str, ...]:
    return NUMBER_METRICS if kind == "regression" else (*CLASS_METRICS, "roc_auc")


def dealt(rows: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows dealt by key and sorted: forests draw their samples by partition and place, so
    the same count of partitions gives the same model on every cluster."""
    return rows.repartition(partitions, key).sortWithinPartitions(key)


def make_resamples(
    train: DataFrame, roles: list[str], folds: int, repeats: int, cor_level: float,
    parallelism: int = 2,
) -> list[Resample]:
    """Repeated folds, each with preprocessing learned on its own training part.

    What is learned does not depend on the model's parameters, so it is learned once
    and used for every candidate.
    """
    def one(place: tuple[int, int]) -> Resample:
        repeat, fold = place
        mark = F.col(f"fold_r{repeat}")
        part, held_out = train.filter(mark != fold), train.filter(mark == fold)
        recipe = build_recipe(roles, cor_level).fit(part)
        return Resample(repeat, fold, recipe.transform(part), recipe.transform(held_out))

    places = [(r, f) for r in range(1, repeats + 1) for f in range(folds)]
    return in_threads(train.sparkSession, one, places, parallelism)


def tune(
    resamples: list[Resample], problem: Problem, learner: Learner, space: list[Dimension],
    metric: str, tune_length: int = 80, tune_stop: int = 10, tune_time: float = 10,
    initial: int = 5, parallelism: int = 2, save_predictions: bool = False, race: float | None = None,
) -> TuningResult:
    """Sequential search: `initial` spread points, then up to `tune_length` more.

    Stops after `tune_stop` rounds without gain or `tune_time` minutes.  A candidate's
    score is the mean over all resamples; models are fitted in parallel, and all their
    held-out predictions are scored in one job.

    With `race` a candidate is first scored on the resamples of the first repeat.  If it is worse
    there than the best so far, fold by fold, by more than `race` standard errors of the mean
    difference, the others are not fitted; it cannot become the best.
    """
    if metric not in metrics_of(problem.kind):
        raise ValueError(f"{metric} is no metric for {problem.kind}")
    sign = -1 if metric in LOWER_IS_BETTER else 1
    proposer = Proposer(len(space), learner.seed, initial)
    deadline = time.monotonic() + 60 * tune_time
    best, best_point, best_params, without_gain, rows, saved = None, None, {}, 0, [], []
    seen: dict[tuple, tuple[dict, bool]] = {}
    best_folds, dropped = {}, []
    heat = [r for r in resamples if r.repeat == resamples[0].repeat]
    for iteration in range(initial + tune_length):
        point = proposer.next(best_point, without_gain)
        params = {d.name: d.value(u) for d, u in zip(space, point)}
        found, lost = seen.get(tuple(params.values()), (None, False))
        folds = {}
        if found is None:
            if race is not None and best_folds and len(heat) < len(resamples):
                found, held, folds = _scored(heat, problem, learner, params, parallelism, metric)
                lost = is_worse([sign * (best_folds[k] - v) for k, v in folds.items()
                                 if v is not None and best_folds.get(k) is not None], race)
            if lost:
                dropped.append(iteration)
            else:
                found, held, folds = _scored(resamples, problem, learner, params, parallelism, metric)
            seen[tuple(params.values())] = (found, lost)
            if save_predictions:
                saved.append(written_predictions(held, iteration))
        rows += [(iteration, m, v, *[float(x) for x in params.values()]) for m, v in found.items()]
        value = None if lost else found[metric]
        if value is not None and (best is None or sign * value > sign * best):
            best, best_point, best_params, without_gain = value, point, params, 0
            best_folds = folds
        elif iteration >= initial:
            without_gain += 1
        if without_gain >= tune_stop or time.monotonic() > deadline:
            break
    if not best_params:
        raise ValueError(f"{metric} was undefined for every candidate")
    columns = ", ".join(f"{d.name} double" for d in space)
    trace = resamples[0].train.sparkSession.createDataFrame(
        rows, f"iteration int, metric string, mean double, {columns}")
    return TuningResult(trace, best_params, saved, dropped)


def is_worse(losses: list[float], errors: float) -> bool:
    """Whether the mean of paired losses is above zero by so many of its standard errors."""
    n = len(losses)
    if n < 3:
        return False
    mean = sum(losses) / n
    spread = math.sqrt(sum((x - mean) ** 2 for x in losses) / (n - 1))
    return mean > 0 and mean > errors * spread / math.sqrt(n)


def best_points(trace: DataFrame, metric: str, n: int = 5) -> DataFrame:
    """The n best candidates of a search by one metric, best first; ties go to the earlier one."""
    order = F.asc("mean") if metric in LOWER_IS_BETTER else F.desc("mean")
    return trace.filter((F.col("metric") == metric) & F.col("mean").isNotNull()).orderBy(order, "iteration").limit(n)


def written_predictions(held: DataFrame, iteration: int) -> DataFrame:
    """Held-out predictions that no longer depend on the folds they came from."""
    return cut_lineage(held.withColumn("iteration", F.lit(iteration)))


def score_candidate(
    resamples: list[Resample], problem: Problem, learner: Learner, params: dict, parallelism: int,
) -> tuple[dict, DataFrame]:
    """Mean of every metric over the resamples, and the held-out predictions."""
    means, held, _ = _scored(resamples, problem, learner, params, parallelism, metrics_of(problem.kind)[0])
    return means, held


def _scored(resamples, problem, learner, params, parallelism, metric) -> tuple[dict, DataFrame, dict]:
    """score_candidate() and the metric of each (repeat, fold)."""
    estimator = learner.estimator(params)

    def held_out_predictions(r: Resample) -> DataFrame:
        fitted = estimator.fit(r.train)
        return predictions(fitted, r.held_out, problem, [problem.key]).withColumns(
            {"repeat": F.lit(r.repeat), "fold": F.lit(r.fold)})

    spark = resamples[0].train.sparkSession
    parts = in_threads(spark, held_out_predictions, resamples, parallelism)
    held = reduce(DataFrame.unionByName, parts)
    held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # A line per resample.
        lines = score(held, problem.kind, list(problem.levels), ("repeat", "fold")).collect()
    finally:
        held.unpersist()
    means = {}
    for m in metrics_of(problem.kind):
        values = [r[m] for r in sorted(lines, key=lambda r: (r["repeat"], r["fold"])) if r[m] is not None]
        means[m] = sum(values) / len(values) if values else None
    return means, held, {(r["repeat"], r["fold"]): r[metric] for r in lines}


def fit_final(rows: DataFrame, roles: list[str], cor_level: float, learner: Learner, params: dict):
    """Recipe and model learned on the given rows with the chosen parameters."""
    recipe = build_recipe(roles, cor_level).fit(rows)
    return recipe, learner.estimator(params).fit(recipe.transform(rows))


def result_table(
    metrics: DataFrame, averages: DataFrame, problem: Problem, learner: Learner) -> DataFrame:
    """(metric, estimator, estimate, null_model_avg, model, seed)."""
    how = ("standard" if problem.kind == "regression"
           else "binary" if len(problem.levels) == 2 else "macro")
    return compare_to_null(metrics, averages).select(
        "metric", F.lit(how).alias("estimator"), "estimate", "null_model_avg",
        F.lit(learner.model).alias("model"), F.lit(learner.seed).alias("seed"))


def importance_of(
    rows: DataFrame, name: str, problem: Problem, learner: Learner, params: dict,
    roles: list[str], cor_level: float = 0.95, nsim: int = 100,
) -> DataFrame:
    """Shapley values of a forest or signed coefficients, model refitted on the slice."""
    recipe, fitted = fit_final(rows, roles, cor_level, learner, params)
    names = predictor_names(recipe)
    if learner.model == "rf":
        features = recipe.transform(rows).select(
            F.col(problem.key).cast("string").alias("row_id"), "features")
        return shap_values(fitted, features, names, problem.kind, nsim, learner.seed, name)
    return signed_importance(fitted, names, rows.sparkSession).withColumn("slice", F.lit(name))


def train(
    source: DataFrame | str, subject_identifier: str = "subject_id", label: str = "label",
    cor_level: float = 0.95, train_split: float = 0.7, model: str = "rf", folds: int = 10,
    repeats: int = 3, metric: str | None = None, kind: str = "classification", seed: int = 42,
    tune_length: int = 80, tune_time: float = 10, tune_stop: int = 10, explain: bool = False,
    parallelism: int = 2, trees_tune: int = 1500, trees_final: int = 500, depth: int = DEEPEST,
    max_iter: int = 100, initial: int = 5, null_runs: int = RUNS, nsim: int = 100,
    save_predictions: bool = False, partitions: int = PARTITIONS, spark: SparkSession | None = None,
    race: float | None = None,
) -> TrainReport:
    """Null model, split, tuning by repeated cross-validation, final fit, test scores.

    Rows with gaps are dropped.  `partitions` is the number of parts that fits work on; choose
    it for the size of the table, as forests depend on it.  All preprocessing is learned inside the resamples.
    """
    learner = Learner(model_name(model), kind, trees_tune, depth, max_iter, seed)
    metric = metric or ("rmse" if kind == "regression" else "bal_accuracy")
    key, label = clean_name(subject_identifier), clean_name(label)
    table = load_ml_table(source, spark)
    for needed in (key, label):
        if needed not in table.columns:
            raise ValueError(f"{needed} not found in the input")
    table.persist(StorageLevel.MEMORY_AND_DISK)
    levels = label_levels(table, label) if kind == "classification" else []
    problem = Problem(key, label, kind, tuple(levels))
    rows = table.withColumn(TARGET, problem.target())
    roles = [key, label, TARGET, *[f"fold_r{r}" for r in range(1, repeats + 1)]]

    split = dealt(stratified_split(rows, key, label, train_split, seed, kind), key, partitions)
    split.persist(StorageLevel.MEMORY_AND_DISK)
    part = split.filter("is_train").drop("is_train")
    test = split.filter(~F.col("is_train")).drop("is_train")
    folded = dealt(assign_folds(part, key, label, folds, repeats, seed, kind), key, partitions)
    folded.persist(StorageLevel.MEMORY_AND_DISK)
    folded.count()
    table.unpersist()
    try:
        if learner.model == "rf":
            groups = correlation_group_count(part, roles, cor_level)
            space = search_space(learner.model, groups, test.count())
        else:
            space = search_space(learner.model)
        resamples = make_resamples(folded, roles, folds, repeats, cor_level, parallelism)
        tuned = tune(
            resamples, problem, learner, space, metric, tune_length, tune_stop, tune_time,
            initial, parallelism, save_predictions, race)
        folded.unpersist()

        learner = replace(learner, trees=trees_final)
        recipe, fitted = fit_final(part, roles, cor_level, learner, tuned.best)
        held = predictions(fitted, recipe.transform(test), problem, [key])
        # A handful of lines: computed now, so that the cached rows can be released.
        nulls = _fixed(null_baseline(
            split.drop("is_train"), key, label, kind, train_split, null_runs, seed, levels))
        results = _fixed(result_table(
            to_metric_rows(score(held, kind, levels)), metric_average(nulls), problem, learner))
        report = TrainReport(
            results, nulls, tuned.trace, tuned.best, recipe, fitted, best_points(tuned.trace, metric),
            oof_predictions=tuned.predictions)
        if explain and (kind == "regression" or len(levels) == 2):
            for name, rows in (("full", split.drop("is_train")), ("train", part), ("test", test)):
                report.importance[name] = importance_of(
                    rows, name, problem, learner, tuned.best, roles, cor_level, nsim)
        return report
    finally:
        if not explain:
            split.unpersist()


def _fixed(small: DataFrame) -> DataFrame:
    """A result of a few lines as a table of its own."""
    return small.sparkSession.createDataFrame(small.collect(), small.schema)
