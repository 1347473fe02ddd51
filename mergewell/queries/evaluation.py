"""Splits, folds, metrics and the null model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mergewell.operators.baseline import null_baseline
from mergewell.operators.resampling import assign_folds, stratified_split
from mergewell.operators.scoring import (
    class_metrics, compare_to_null, confusion, metric_average, number_metrics, roc_auc,
    to_metric_rows)
from mergewell.operators.selection import exact_quantiles
from mergewell.queries.registry import query, table


def labelled(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic")


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("q_split", """
WITH ranked AS (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS rn,
         count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, rn <= floor(0.7::DOUBLE * n) AS is_train FROM ranked""")
def q_split(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return stratified_split(rows, "doc_id", "quality")


@query("q_split_numeric", """
WITH cuts AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b,
                     quantile_cont(o_totalprice, 0.75) AS c FROM orders),
binned AS (SELECT o_orderkey, o_totalprice, (o_totalprice > a)::INT + (o_totalprice > b)::INT
                  + (o_totalprice > c)::INT AS bin FROM orders, cuts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('7:' || o_orderkey), o_orderkey) AS rn,
         count(*) OVER (PARTITION BY bin) AS n FROM binned)
SELECT o_orderkey, o_totalprice, rn <= floor(0.8::DOUBLE * n) AS is_train FROM ranked""")
def q_split_numeric(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return stratified_split(rows, "o_orderkey", "o_totalprice", 0.8, 7, "regression")


@query("q_quantiles", """
SELECT p AS prob, round(q, 6) AS value FROM (
  SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]) AS p,
         unnest(quantile_cont(l_extendedprice, [0.1, 0.25, 0.5, 0.75, 0.9])) AS q FROM lineitem)""".replace(
    "AS prob", "::DOUBLE AS prob"))
def q_quantiles(spark, sf_dir):
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    values = exact_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", probs)
    return spark.createDataFrame(
        list(zip(probs, values)), "prob double, value double").withColumn("value", F.round("value", 6))


@query("q_folds", """
WITH ranked AS (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS rn,
         count(*) OVER (PARTITION BY quality) AS n FROM labels),
train AS (SELECT doc_id, quality FROM ranked WHERE rn <= floor(0.7::DOUBLE * n))
SELECT doc_id, quality, """ + ", ".join(
    f"((row_number() OVER (PARTITION BY quality ORDER BY md5('42:{r}:' || doc_id), doc_id) - 1) % 10)::INT"
    f" AS fold_r{r}" for r in (1, 2, 3)) + " FROM train")
def q_folds(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality")
    train = stratified_split(rows, "doc_id", "quality").filter("is_train").drop("is_train")
    return assign_folds(train, "doc_id", "quality")


def _runs_sql(rows: str, prop: float = 0.7) -> str:
    return f"""rows AS ({rows}), seeds AS (SELECT unnest(range(43, 63))::INT AS seed),
ranked AS (SELECT seed, truth, row_number() OVER (
             PARTITION BY seed, stratum ORDER BY md5(seed || ':' || key), key) AS rn,
           count(*) OVER (PARTITION BY seed, stratum) AS n FROM rows, seeds),
test AS (SELECT seed, truth FROM ranked WHERE rn > floor({prop}::DOUBLE * n))"""


def null_class_sql(source: str) -> str:
    """The null model's 20 runs on the quality labels of `source`."""
    return _runs_sql(f"SELECT doc_id::VARCHAR AS key, quality::VARCHAR AS truth, quality AS stratum {source}") + """,
majority AS (SELECT seed, truth AS estimate FROM (
  SELECT seed, truth, row_number() OVER (PARTITION BY seed ORDER BY count(*) DESC, truth) AS place
  FROM test GROUP BY seed, truth) WHERE place = 1),
cells AS (SELECT seed, count(*) AS n, sum((truth = estimate)::INT) AS hits,
    sum((truth = '0')::INT) AS t0, sum((estimate = '0')::INT) AS p0,
    sum((truth = '0' AND estimate = '0')::INT) AS tp
  FROM test JOIN majority USING (seed) GROUP BY seed),
runs AS (SELECT seed, (tp / t0 + (n - t0 - p0 + tp) / (n - t0)) / 2 AS bal_accuracy,
    CASE WHEN p0 > 0 AND tp > 0 THEN 2 * (tp / p0) * (tp / t0) / (tp / p0 + tp / t0) END AS f_meas,
    hits / n AS accuracy FROM cells)"""


NULL_CLASS_SQL = null_class_sql("FROM labels")


def _null_class(spark, sf_dir) -> DataFrame:
    return null_baseline(table(spark, sf_dir, "labels"), "doc_id", "quality", levels=["0", "1"])


@query("q_null_baseline_cls", f"""WITH {NULL_CLASS_SQL}
SELECT seed, round(bal_accuracy, 6) AS bal_accuracy, round(f_meas, 6) AS f_meas,
       round(accuracy, 6) AS accuracy FROM runs""")
def q_null_baseline_cls(spark, sf_dir):
    return _rounded(_null_class(spark, sf_dir), ["bal_accuracy", "f_meas", "accuracy"])


@query("q_null_average", f"""WITH {NULL_CLASS_SQL}
SELECT 'bal_accuracy' AS metric, round(avg(bal_accuracy), 6) AS null_model_avg FROM runs
UNION ALL SELECT 'f_meas', round(avg(f_meas), 6) FROM runs
UNION ALL SELECT 'accuracy', round(avg(accuracy), 6) FROM runs""")
def q_null_average(spark, sf_dir):
    return _rounded(metric_average(_null_class(spark, sf_dir)), ["null_model_avg"])


@query("q_null_baseline_reg", f"""
WITH cuts AS (SELECT quantile_cont(c_acctbal, 0.25) AS a, quantile_cont(c_acctbal, 0.5) AS b,
                     quantile_cont(c_acctbal, 0.75) AS c FROM customer),
{_runs_sql('''SELECT c_custkey::VARCHAR AS key, c_acctbal AS truth, (c_acctbal > a)::INT + (c_acctbal > b)::INT
                  + (c_acctbal > c)::INT AS stratum FROM customer, cuts''')},
means AS (SELECT seed, avg(truth) AS estimate FROM test GROUP BY seed)
SELECT seed, round(avg(abs(truth - estimate)), 6) AS mae,
       round(sqrt(avg((truth - estimate) * (truth - estimate))), 6) AS rmse, 0.0::DOUBLE AS ccc
FROM test JOIN means USING (seed) GROUP BY seed""")
def q_null_baseline_reg(spark, sf_dir):
    runs = null_baseline(
        table(spark, sf_dir, "customer"), "c_custkey", "c_acctbal", kind="regression")
    return _rounded(runs, ["mae", "rmse", "ccc"])


# A fixed rule stands in for a model: long documents are called good.
PREDICTED_SQL = """predicted AS (
  SELECT quality::VARCHAR AS truth, CASE WHEN n_chars > 300 THEN '1' ELSE '0' END AS estimate,
         1.0 / n_chars AS score FROM documents JOIN labels USING (doc_id))"""
CELLS_SQL = """cells AS (SELECT count(*) AS n, sum((truth = estimate)::INT) AS hits,
    sum((truth = '0')::INT) AS t0, sum((estimate = '0')::INT) AS p0,
    sum((truth = '0' AND estimate = '0')::INT) AS tp FROM predicted),
measured AS (SELECT hits / n AS accuracy, (tp / t0 + (n - t0 - p0 + tp) / (n - t0)) / 2 AS bal_accuracy,
    2 * (tp / p0) * (tp / t0) / (tp / p0 + tp / t0) AS f_meas,
    (hits / n - (t0 * p0 + (n - t0) * (n - p0)) / (n * n)) / (1 - (t0 * p0 + (n - t0) * (n - p0)) / (n * n)) AS kap
  FROM cells)"""


def predicted(spark, sf_dir) -> DataFrame:
    return labelled(spark, sf_dir).select(
        F.col("quality").cast("string").alias("truth"),
        F.when(F.col("n_chars") > 300, "1").otherwise("0").alias("estimate"),
        F.array(F.lit(1.0) / F.col("n_chars"), F.lit(1.0) - F.lit(1.0) / F.col("n_chars")).alias("scores"))


@query("q_confusion", f"""WITH {PREDICTED_SQL}
SELECT truth, estimate, count(*) AS n FROM predicted GROUP BY truth, estimate""")
def q_confusion(spark, sf_dir):
    return confusion(predicted(spark, sf_dir))


@query("q_cls_metrics", f"""WITH {PREDICTED_SQL}, {CELLS_SQL}
SELECT round(accuracy, 6) AS accuracy, round(bal_accuracy, 6) AS bal_accuracy,
       round(f_meas, 6) AS f_meas, round(kap, 6) AS kap FROM measured""")
def q_cls_metrics(spark, sf_dir):
    wide = class_metrics(predicted(spark, sf_dir), ["0", "1"])
    return _rounded(wide, wide.columns)


@query("q_roc_auc", f"""WITH {PREDICTED_SQL}, ranks AS (
  SELECT truth, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM predicted)
SELECT round((sum(CASE WHEN truth = '0' THEN r END) - n0 * (n0 + 1) / 2) / (n0 * n1), 6) AS roc_auc
FROM ranks, (SELECT sum((truth = '0')::INT) AS n0, sum((truth = '1')::INT) AS n1 FROM ranks)
GROUP BY n0, n1""")
def q_roc_auc(spark, sf_dir):
    return _rounded(roc_auc(predicted(spark, sf_dir), ["0", "1"]), ["roc_auc"])


# Several classes: the language is "predicted" from the source of the document.
MULTI_SQL = """predicted AS (
  SELECT lang AS truth, CASE WHEN source = 'src0' THEN 'de' WHEN source = 'src1' THEN 'en'
         WHEN source = 'src2' THEN 'es' ELSE 'fr' END AS estimate, n_chars FROM documents),
levels AS (SELECT unnest(['de', 'en', 'es', 'fr']) AS level)"""


def _multi(spark, sf_dir) -> DataFrame:
    source = F.col("source")
    chars = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("truth"),
        F.when(source == "src0", "de").when(source == "src1", "en").when(source == "src2", "es")
        .otherwise("fr").alias("estimate"),
        F.array(*[(chars % m).cast("double") for m in (7, 11, 13, 17)]).alias("scores"))


@query("q_cls_metrics_multi", f"""WITH {MULTI_SQL}, cells AS (
  SELECT level, count(*) AS n, sum((truth = level)::INT) AS t, sum((estimate = level)::INT) AS p,
         sum((truth = level AND estimate = level)::INT) AS tp FROM predicted, levels GROUP BY level),
each AS (SELECT *, CASE WHEN t > 0 THEN tp / t END AS sens, (n - t - p + tp) / (n - t) AS spec,
         CASE WHEN p > 0 THEN tp / p END AS prec FROM cells)
SELECT round(sum(tp) / max(n), 6) AS accuracy, round(avg((sens + spec) / 2), 6) AS bal_accuracy,
       round(avg(CASE WHEN prec + sens > 0 THEN 2 * prec * sens / (prec + sens) END), 6) AS f_meas,
       round((sum(tp) / max(n) - sum(t * p) / (max(n) * max(n)))
             / (1 - sum(t * p) / (max(n) * max(n))), 6) AS kap FROM each""")
def q_cls_metrics_multi(spark, sf_dir):
    wide = class_metrics(_multi(spark, sf_dir), ["de", "en", "es", "fr"])
    return _rounded(wide, wide.columns)



@query("q_roc_auc_multi", "WITH predicted AS (SELECT lang AS truth, n_chars FROM documents), areas AS (" + " UNION ALL ".join(
    f"""SELECT (sum(CASE WHEN truth = '{a}' THEN r END) - na * (na + 1) / 2) / (na * nb) AS area FROM (
      SELECT truth, rank() OVER (ORDER BY n_chars % {m}) + (count(*) OVER (PARTITION BY n_chars % {m}) - 1) / 2 AS r,
             sum((truth = '{a}')::INT) OVER () AS na, sum((truth = '{b}')::INT) OVER () AS nb
      FROM predicted WHERE truth IN ('{a}', '{b}')) GROUP BY na, nb"""
    for i, (a, m) in enumerate((("de", 7), ("en", 11), ("es", 13), ("fr", 17)))
    for j, b in enumerate(("de", "en", "es", "fr")) if i != j) + ") SELECT round(avg(area), 6) AS roc_auc FROM areas")
def q_roc_auc_multi(spark, sf_dir):
    return _rounded(roc_auc(_multi(spark, sf_dir), ["de", "en", "es", "fr"]), ["roc_auc"])


@query("q_reg_metrics", """
WITH predicted AS (SELECT l_extendedprice AS truth, l_quantity * 1000.0 * (1 + l_tax) AS estimate FROM lineitem)
SELECT round(avg(abs(truth - estimate)), 4) AS mae, round(sqrt(avg((truth - estimate) * (truth - estimate))), 4) AS rmse,
       round(corr(truth, estimate) * corr(truth, estimate), 6) AS rsq,
       round(2 * covar_samp(truth, estimate) / (var_samp(truth) + var_samp(estimate)
             + (avg(truth) - avg(estimate)) * (avg(truth) - avg(estimate))), 6) AS ccc FROM predicted""")
def q_reg_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("truth"),
        (F.col("l_quantity") * 1000.0 * (1 + F.col("l_tax"))).alias("estimate"))
    return number_metrics(rows).select(
        F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
        F.round("rsq", 6).alias("rsq"), F.round("ccc", 6).alias("ccc"))


@query("q_compare_to_null", f"""
WITH {NULL_CLASS_SQL}, {PREDICTED_SQL}, measured AS (
  SELECT hits / n AS accuracy, (tp / t0 + (n - t0 - p0 + tp) / (n - t0)) / 2 AS bal_accuracy FROM (
    SELECT count(*) AS n, sum((truth = estimate)::INT) AS hits,
    sum((truth = '0')::INT) AS t0, sum((estimate = '0')::INT) AS p0,
    sum((truth = '0' AND estimate = '0')::INT) AS tp FROM predicted)),
trained AS (SELECT 'accuracy' AS metric, round(accuracy, 6) AS estimate FROM measured
            UNION ALL SELECT 'bal_accuracy', round(bal_accuracy, 6) FROM measured),
averages AS (SELECT 'bal_accuracy' AS metric, round(avg(bal_accuracy), 6) AS null_model_avg FROM runs
  UNION ALL SELECT 'f_meas', round(avg(f_meas), 6) FROM runs
  UNION ALL SELECT 'accuracy', round(avg(accuracy), 6) FROM runs)
SELECT metric, estimate, null_model_avg FROM trained FULL JOIN averages USING (metric)""")
def q_compare_to_null(spark, sf_dir):
    metrics = to_metric_rows(class_metrics(predicted(spark, sf_dir), ["0", "1"]).select(
        "accuracy", "bal_accuracy"))
    averages = metric_average(_null_class(spark, sf_dir))
    return _rounded(compare_to_null(metrics, averages), ["estimate", "null_model_avg"])
