"""The null model: how well does a constant prediction do?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mergewell.functions.hashing import seeded_hash
from mergewell.lineage import cut_lineage, spread
from mergewell.operators.resampling import stratum
from mergewell.operators.scoring import class_metrics
from mergewell.operators.selection import cut_rows, is_within

RUNS = 20


def constant_prediction(df: DataFrame, kind: str, by: list[str]) -> DataFrame:
    """Per run the majority class (ties: the first label) or the mean of the labels."""
    if kind == "regression":
        return df.groupBy(*by).agg(F.avg("truth").alias("estimate"))
    counts = df.groupBy(*by, "truth").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("truth").alias("estimate")))
    return counts.groupBy(*by).agg(best.alias("best")).select(*by, "best.estimate")


def null_baseline(
    df: DataFrame, key: str, label: str, kind: str = "classification", prop: float = 0.7,
    runs: int = RUNS, seed: int = 42, levels: list[str] | None = None, fit_on: str = "test",
) -> DataFrame:
    """Scores of a constant predictor over `runs` stratified splits, one row per run.

    All runs are measured together: a row is compared with the cut of its stratum in every run
    (operators/selection.py) and added up where it is.  Classes need one aggregate, numbers two,
    the second with the means of the first.  The predictor is fitted on the part it is scored on
    unless fit_on="train".
    """
    truth = F.col(label).cast("double" if kind == "regression" else "string")
    seeds = range(seed + 1, seed + runs + 1)
    orders = [f"order{s}" for s in seeds]
    # Every pass hashes each row once per run: all cores share that, however the input is stored.
    rows = cut_lineage(spread(df.select(
        F.col(key).cast("string").alias("key"), truth.alias("truth"), stratum(df, label, kind).alias("stratum"))))
    hashed = rows.withColumns({o: seeded_hash(F.lit(s), F.col("key")) for o, s in zip(orders, seeds)})
    cuts = cut_rows(hashed, "stratum", "key", orders, prop)
    marked = is_within(cuts, hashed, "stratum", "key", orders).select("truth", "within")
    test = [~F.col("within")[i] for i in range(runs)]
    fitted = test if fit_on == "test" else [F.col("within")[i] for i in range(runs)]
    if kind == "regression":
        return _number_runs(marked, list(seeds), test, fitted)
    cells = F.array(*[F.struct(F.lit(s).alias("seed"), F.count_if(t).alias("n"), F.count_if(f).alias("fit"))
                      for s, t, f in zip(seeds, test, fitted)])
    # One line per run and class.
    counts = cut_lineage(marked.groupBy("truth").agg(cells.alias("cells")).select("truth", F.explode("cells").alias("c")).select(
        "truth", "c.*"))
    best = F.min(F.struct((-F.col("fit")).alias("fit"), F.col("truth").alias("estimate")))
    predicted = counts.filter("fit > 0").groupBy("seed").agg(best.alias("best")).select("seed", "best.estimate")
    scored = counts.filter("n > 0").join(predicted, "seed")
    levels = levels or sorted(r["truth"] for r in counts.select("truth").distinct().collect())
    return class_metrics(scored, levels, ("seed",), "n").select(
        "seed", "bal_accuracy", "f_meas", "accuracy")


def _number_runs(marked: DataFrame, seeds: list[int], test: list, fitted: list) -> DataFrame:
    """mae, rmse and ccc of the mean, per run: it does not vary, so its covariance is 0."""
    truth = F.col("truth")
    # A number per run.
    means = marked.agg(*[F.avg(F.when(f, truth)) for f in fitted]).first()

    def measures(s, t, mean):
        tested, mean = F.when(t, truth), F.lit(mean).cast("double")
        gap = F.avg(tested) - mean
        return F.struct(
            F.lit(s).alias("seed"), F.avg(F.abs(tested - mean)).alias("mae"),
            F.sqrt(F.avg((tested - mean) * (tested - mean))).alias("rmse"),
            F.try_divide(F.lit(0.0), F.var_samp(tested) + gap * gap).alias("ccc"))

    cells = marked.agg(F.array(*[measures(*x) for x in zip(seeds, test, means)]).alias("cells"))
    return cells.select(F.explode("cells").alias("c")).select("c.*").filter("mae IS NOT NULL")
