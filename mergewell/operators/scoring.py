"""Model metrics from predictions, for any number of resamples in one job.

`by` names columns that tell resamples apart (run, candidate, fold ...); without it
the whole frame is one resample.  Undefined values are NULL, never 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mergewell.operators.ranking import sums_below

CLASS_METRICS = ("accuracy", "bal_accuracy", "f_meas", "kap")
NUMBER_METRICS = ("mae", "rmse", "rsq", "ccc")
LOWER_IS_BETTER = ("mae", "rmse")


def confusion(df: DataFrame, by: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """(by..., truth, estimate, n); at most levels squared rows per resample.  `weight` names a
    column that says how many predictions a row stands for."""
    return df.groupBy(*by, F.col("truth").cast("string").alias("truth"),
                      F.col("estimate").cast("string").alias("estimate")).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))


def class_metrics(
    df: DataFrame, levels: list[str], by: tuple[str, ...] = (), weight: str | None = None,
) -> DataFrame:
    """One row per resample: accuracy, bal_accuracy, f_meas, kap.

    Two levels: the event is the first one.  More: macro averages over the levels.
    """
    truth, estimate, n = F.col("truth"), F.col("estimate"), F.col("n")

    def cells(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    measures = {"total": F.sum(n), "hits": cells(truth == estimate)}
    for i, level in enumerate(levels):
        measures[f"tp{i}"] = cells((truth == level) & (estimate == level))
        measures[f"t{i}"] = cells(truth == level)
        measures[f"p{i}"] = cells(estimate == level)
    counts = confusion(df, by, weight).groupBy(*by).agg(*[m.alias(k) for k, m in measures.items()])

    def per_level(i: int) -> dict[str, Column]:
        tp, t, p = (F.col(f"{k}{i}") for k in ("tp", "t", "p"))
        sens = F.try_divide(tp, t)
        spec = F.try_divide(F.col("total") - t - p + tp, F.col("total") - t)
        precision = F.try_divide(tp, p)
        return {"bal": (sens + spec) / 2,
                "f": F.try_divide(2 * precision * sens, precision + sens)}

    each = [per_level(i) for i in range(len(levels))]
    if len(levels) <= 2:
        balanced, f_meas = each[0]["bal"], each[0]["f"]
    else:
        balanced, f_meas = _mean([e["bal"] for e in each]), _mean([e["f"] for e in each])
    observed = F.col("hits") / F.col("total")
    expected = reduce(Column.__add__, [
        F.col(f"t{i}") * F.col(f"p{i}") for i in range(len(levels))]) / (
        F.col("total") * F.col("total"))
    return counts.select(
        *by, observed.alias("accuracy"), balanced.alias("bal_accuracy"), f_meas.alias("f_meas"),
        F.try_divide(observed - expected, 1 - expected).alias("kap"))


def _mean(values: list[Column]) -> Column:
    """Mean of the defined values."""
    total = reduce(Column.__add__, [F.coalesce(v, F.lit(0.0)) for v in values])
    defined = reduce(Column.__add__, [v.isNotNull().cast("int") for v in values])
    return F.try_divide(total, defined)


def roc_auc(df: DataFrame, levels: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per resample with `roc_auc`, exact under ties.

    `scores` is an array with one probability per level, in level order.  Two levels:
    rank statistic of the first one; more: mean over all ordered pairs of levels.
    The scores are reduced to distinct values before anything is sorted.
    """
    k = len(levels)
    tracked = [0] if k == 2 else list(range(k))
    weights = [f"n{i}" for i in range(k)]
    points = df.select(
        *by, F.col("truth").cast("string").alias("truth"),
        F.posexplode(F.slice("scores", 1, len(tracked))).alias("level", "score"),
    ).groupBy(*by, "level", "score").agg(*[
        F.count_if(F.col("truth") == v).alias(w) for v, w in zip(levels, weights)])
    placed = sums_below(points, [*by, "level"], "score", weights)
    couples = [(i, j) for i in tracked for j in range(k) if i != j]
    sums = placed.groupBy(*by).agg(
        *[F.sum(F.when(F.col("level") == i, F.col(f"n{i}") * (
            F.col(f"n{j}_below") + F.col(f"n{j}") / 2))).alias(f"u{i}_{j}") for i, j in couples],
        *[F.sum(F.when(F.col("level") == 0, F.col(w))).alias(f"s_{w}") for w in weights])
    areas = [F.try_divide(F.col(f"u{i}_{j}"), F.col(f"s_n{i}") * F.col(f"s_n{j}"))
             for i, j in couples]
    return sums.select(*by, _mean(areas).alias("roc_auc"))


def number_metrics(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per resample: mae, rmse, rsq (squared correlation), ccc."""
    truth, estimate = F.col("truth").cast("double"), F.col("estimate").cast("double")
    error = truth - estimate
    sums = df.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
        F.covar_samp(truth, estimate).alias("c"), F.var_samp(truth).alias("vt"),
        F.var_samp(estimate).alias("ve"), F.avg(truth).alias("mt"), F.avg(estimate).alias("me"))
    gap = F.col("mt") - F.col("me")
    return sums.select(
        *by, "mae", "rmse",
        F.try_divide(F.col("c") * F.col("c"), F.col("vt") * F.col("ve")).alias("rsq"),
        F.try_divide(2 * F.col("c"), F.col("vt") + F.col("ve") + gap * gap).alias("ccc"))


def score(df: DataFrame, kind: str, levels: list[str] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """All metrics of the problem kind, one row per resample."""
    if kind == "regression":
        return number_metrics(df, by)
    keys = by or ("__all",)
    frame = df if by else df.withColumn("__all", F.lit(1))
    return class_metrics(frame, levels, keys).join(
        roc_auc(frame, levels, keys), list(keys)).drop("__all")


def to_metric_rows(wide: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Wide metric row(s) to (by..., metric, estimate)."""
    names = [c for c in wide.columns if c not in by]
    return wide.unpivot(list(by), names, "metric", "estimate")


def metric_average(runs: DataFrame, by: tuple[str, ...] = ("seed",)) -> DataFrame:
    """Mean of every metric over the runs: (metric, null_model_avg)."""
    return to_metric_rows(runs, by).groupBy("metric").agg(
        F.avg("estimate").alias("null_model_avg"))


def compare_to_null(metrics: DataFrame, averages: DataFrame) -> DataFrame:
    """Trained metrics beside the averages of the null model; either may lack a metric."""
    return metrics.join(averages, "metric", "full")
