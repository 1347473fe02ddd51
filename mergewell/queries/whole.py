"""Whole runs: profiling several tables, combining them, training on the result."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mergewell.lineage import shared_folder
from mergewell.operators.baseline import constant_prediction
from mergewell.operators.keys import subject_index
from mergewell.operators.learners import correlation_group_count, label_levels
from mergewell.plans.combine import combine, exclude_unresolved
from mergewell.plans.profile import as_raw, profile
from mergewell.queries.combining import (
    COMPLETE, DENSE, GROUPS_SQL, MERGED_SQL, _line_numbers, subject_tables)
from mergewell.queries.registry import query, table
from mergewell.sources.delimited import MALFORMED, RawDataset, load_ml_table, read_delimited
from mergewell.sources.sinks import write_combined


def _raw_tables(spark, sf_dir) -> list[RawDataset]:
    """Five datasets, four of them with problems."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Subject ID"), F.col("c_acctbal").alias("Balance"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("Segment"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("subject_id"), F.col("o_orderstatus").alias("status"),
        F.concat_ws("/", F.month("o_orderdate"), F.dayofmonth("o_orderdate"),
                    F.year("o_orderdate")).alias("ordered"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("subject_id"), F.when(
            F.col("n_regionkey") == 0, "-?").otherwise(F.col("n_name")).alias("name"))
    size, price = F.col("p_size"), F.col("p_retailprice")
    part = table(spark, sf_dir, "part").select(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(
        (F.col("p_partkey"), size, F.when(size > 10, size), price, price * 2))])
    raws = [as_raw(n, df) for n, df in (
        ("customer", customer), ("orders", orders), ("supplier", supplier), ("nation", nation))]
    return raws + [RawDataset("part", part, ["subject_id", "size", "Size", "price", "price"])]


def _flags_sql(name: str, source: str, **flags: str) -> str:
    problems = ("subject_id_not_found", "subject_id_duplicated", "date_not_unix",
                "duplicated_data", "duplicated_column_names", "data_are_symbols")
    columns = ", ".join(f"({flags.get(p, '0')})::INT AS {p}" for p in problems)
    return f"SELECT '{name}' AS dataset, {columns} FROM {source}"


@query("q_problem_summary", "WITH flags AS (" + " UNION ALL ".join([
    _flags_sql("customer", "customer",
               subject_id_duplicated="count(*) > count(DISTINCT c_custkey)",
               data_are_symbols="coalesce(bool_or(NOT regexp_matches(c_mktsegment, '[A-Za-z0-9]')), false)"),
    _flags_sql("orders", "orders", subject_id_duplicated="count(*) > count(DISTINCT o_custkey)",
               date_not_unix="count(o_orderdate) > 0",
               data_are_symbols="bool_or(NOT regexp_matches(o_orderstatus, '[A-Za-z0-9]'))"),
    _flags_sql("supplier", "supplier", subject_id_not_found="count(*) > 0"),
    _flags_sql("nation", "nation", subject_id_duplicated="count(*) > count(DISTINCT n_nationkey)",
               data_are_symbols="count(*) FILTER (WHERE n_regionkey = 0) > 0"),
    _flags_sql("part", "part",
               duplicated_data="2 * count(*) FILTER (WHERE p_size > 10) > 0.2 * (count(*) + count(*) FILTER (WHERE p_size > 10))",
               duplicated_column_names="2 * count(*) FILTER (WHERE p_retailprice = 0) <= 0.2 * 2 * count(*)"),
]) + """) SELECT * FROM flags WHERE subject_id_not_found + subject_id_duplicated + date_not_unix
  + duplicated_data + duplicated_column_names + data_are_symbols > 0""")
def q_problem_summary(spark, sf_dir):
    return profile(spark, _raw_tables(spark, sf_dir)).problems


def _counted_sql(source: str, *features: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, '{f}' AS feature, md5('{d}_{u}') AS data_feature_hash, "
        f"count(*) - count({e}) AS na_count, count({e}) AS have_data FROM {source}"
        for d, f, u, e in features)


@query("q_profile_na_counts", "WITH counts AS (" + " UNION ALL ".join([
    _counted_sql("customer", ("customer", "balance", "balance", "c_acctbal"),
                 ("customer", "segment", "segment", "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END")),
    _counted_sql("orders", ("orders", "status", "status", "o_orderstatus"),
                 ("orders", "ordered", "ordered", "o_orderdate")),
    _counted_sql("nation", ("nation", "name", "name", "n_name")),
    _counted_sql("part", ("part", "size", "size", "p_size"),
                 ("part", "size", "size_2", "CASE WHEN p_size > 10 THEN p_size END"),
                 ("part", "price", "price", "p_retailprice"), ("part", "price", "price_2", "p_retailprice")),
]) + ") SELECT *, count(*) OVER (PARTITION BY feature) > 1 AS duplicated_feature FROM counts")
def q_profile_na_counts(spark, sf_dir):
    return profile(spark, _raw_tables(spark, sf_dir)).na_counts


@query("q_exclude_unresolved", """
SELECT 'customer' AS dataset, count(*) AS rows FROM customer
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'part', count(*) FROM part""")
def q_exclude_unresolved(spark, sf_dir):
    """Nation was repaired after it had been flagged and the profile itself resolved the copied
    columns of part; orders still has dates and repeated subjects."""
    report = profile(spark, _raw_tables(spark, sf_dir))
    repaired = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("subject_id"), "n_name")
    kept, _ = exclude_unresolved(
        spark, {**report.clean, "nation": repaired}, report.problems)
    counted = [df.agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("rows"))
               for n, df in kept.items()]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result


ML_SQL = f"""
WITH merged AS ({MERGED_SQL}), dense AS (
  SELECT * FROM merged WHERE segment IS NOT NULL
  AND {" + ".join(f"({c} IS NOT NULL)::INT" for c in DENSE)} >= 0.75 * {len(DENSE)})
SELECT subject_id, nation, n_orders, spent, segment, urgent FROM (
  SELECT *, CASE WHEN priority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0 END AS urgent FROM dense
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in COMPLETE)})"""


@query("q_ml_table", ML_SQL)
def q_ml_table(spark, sf_dir):
    names = ("customer", "orders", "events")
    report = combine(
        spark, dict(zip(names, subject_tables(spark, sf_dir))), label="segment")
    urgent = next(c for c in report.ml_table.columns if c.endswith("1_urgent"))
    return report.ml_table.select(
        "subject_id", "nation", "n_orders", "spent", "segment", F.col(urgent).alias("urgent"))


@query("q_written_ml_table", ML_SQL)
def q_written_ml_table(spark, sf_dir):
    """The report written together, and its complete table read back from there."""
    names = ("customer", "orders", "events")
    report = combine(
        spark, dict(zip(names, subject_tables(spark, sf_dir))), label="segment")
    folder = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    write_combined(report, folder)
    back = load_ml_table(f"{folder}/ml_table", spark)
    urgent = next(c for c in back.columns if c.endswith("1_urgent"))
    return back.select("subject_id", "nation", "n_orders", "spent", "segment", F.col(urgent).alias("urgent"))


@query("q_read_delimited", """
SELECT c_custkey::VARCHAR AS c0, c_name AS c1, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c2,
  count(*) OVER () AS rows FROM customer""")
def q_read_delimited(spark, sf_dir):
    """Compressed files with repeated header names and spelled-out missing values, read back."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise("N/A").alias("segment"))
    path = f"{shared_folder(spark)}/read-{uuid.uuid4().hex}.csv"
    customer.write.csv(path, header=True, compression="gzip")
    raw = read_delimited(spark, path)
    unlike = raw.checked.agg(F.count("c0").alias("rows"), F.count_if(MALFORMED).alias("bad")).filter("bad = 0")
    return raw.frame.crossJoin(F.broadcast(unlike.select("rows")))  # one line


@query("q_wide_levels", """
WITH rows AS (SELECT 'customer ' || o_custkey || ' ' || o_orderpriority AS item FROM orders),
one AS (SELECT item AS level, count(*) AS n FROM rows GROUP BY item)
SELECT 'item' AS feature, level, n FROM one WHERE n < (SELECT count(*) FROM rows)""")
def q_wide_levels(spark, sf_dir):
    """combine() on a text with more levels than may become columns: how many rows have each level
    that stays.  A second text says the same in other words; its levels go as correlated ones."""
    orders = table(spark, sf_dir, "orders")
    item = F.concat_ws(" ", F.lit("customer"), "o_custkey", "o_orderpriority")
    first = orders.select(F.col("o_orderkey").alias("subject_id"), item.alias("item"), "o_totalprice")
    second = orders.select(F.col("o_orderkey").alias("subject_id"), F.md5(item).alias("same"), F.col("o_orderstatus").alias("label"))
    report = combine(spark, {"first": first, "second": second}, near_empty_rows=None)
    places = report.ml_table.select(F.explode(F.unwrap_udt("levels")["indices"]).alias("place"))
    return places.groupBy(F.col("place").cast("long").alias("index")).agg(F.count(F.lit(1)).alias("n")).join(report.levels, "index").select(
        "feature", "level", "n")


@query("q_advisories", f"""
WITH merged AS ({MERGED_SQL}), size AS (SELECT count(*)::DOUBLE AS value FROM merged)
SELECT 'few_samples' AS code, value FROM size WHERE value BETWEEN 200 AND 399
UNION ALL SELECT 'very_few_samples', value FROM size WHERE value < 200
UNION ALL SELECT 'low_cor_level', 0.9::DOUBLE
UNION ALL SELECT 'class_count', count(*)::DOUBLE FROM merged WHERE segment IS NOT NULL GROUP BY segment""")
def q_advisories(spark, sf_dir):
    names = ("customer", "orders", "events")
    report = combine(
        spark, dict(zip(names, subject_tables(spark, sf_dir))), label="segment", cor_level=0.9)
    return report.advisories.select("code", "value")


@query("q_subject_index", """
SELECT c_name, dense_rank() OVER (ORDER BY c_name) AS subject_index FROM customer""")
def q_subject_index(spark, sf_dir):
    return subject_index(table(spark, sf_dir, "customer"), "c_name")


@query("q_label_levels", "SELECT DISTINCT lang AS level FROM documents")
def q_label_levels(spark, sf_dir):
    return spark.createDataFrame(
        [(v,) for v in label_levels(table(spark, sf_dir, "documents"), "lang")], "level string")


@query("q_majority_class", """
SELECT source, lang AS estimate FROM (SELECT source, lang, row_number() OVER (
  PARTITION BY source ORDER BY count(*) DESC, lang) AS rn FROM documents GROUP BY source, lang) WHERE rn = 1""")
def q_majority_class(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", F.col("lang").alias("truth"))
    return constant_prediction(rows, "classification", ["source"])


@query("q_mtry_limit", GROUPS_SQL + " SELECT count(*) AS groups FROM grouped")
def q_mtry_limit(spark, sf_dir):
    """Groups of correlated line columns, which bound the features tried per split."""
    lines = _line_numbers(spark, sf_dir)
    groups = correlation_group_count(lines, ["line"], 0.95)
    return spark.createDataFrame([(groups,)], "groups bigint")
