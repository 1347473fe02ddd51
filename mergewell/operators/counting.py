"""Missing-value counts per feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mergewell.functions.hashing import feature_hash


def na_counts(df: DataFrame, dataset: str, key: str | None = None) -> DataFrame:
    """One row per feature: (dataset, feature, data_feature_hash, na_count, have_data).

    A single aggregate over the wide table; only its one row is turned to long form.
    """
    features = [c for c in df.columns if c != key]
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in features])
    long = counted.unpivot(["__rows"], features, "feature", "have_data")
    return long.select(
        F.lit(dataset).alias("dataset"), "feature",
        feature_hash(F.lit(dataset), F.col("feature")).alias("data_feature_hash"),
        (F.col("__rows") - F.col("have_data")).alias("na_count"), "have_data")


def mark_duplicated(counts: DataFrame) -> DataFrame:
    """Flag every feature name that occurs more than once over all datasets."""
    same = W.partitionBy(F.trim("feature"))
    return counts.withColumn("duplicated_feature", F.count(F.lit(1)).over(same) > 1)


def rename_across_datasets(counts: DataFrame) -> DataFrame:
    """New names for features that several datasets share.

    The copy with most data keeps the name, the next ones get _2, _3 ..., skipping every
    name that some dataset has.  The input has one row per feature of the schema, not per
    data row.
    """
    same = W.partitionBy("feature")
    fullest = same.orderBy(F.desc("have_data"), "dataset")
    placed = (
        counts.withColumn("copies", F.count(F.lit(1)).over(same))
        .withColumn("place", F.row_number().over(fullest))
        .filter("copies > 1"))
    # As many numbered names as there are copies and names that could be in their way.
    names = counts.select("feature").distinct()
    wanted = placed.groupBy("feature").agg(F.max("copies").alias("copies"))
    in_the_way = wanted.join(names.withColumnRenamed("feature", "name"), F.startswith(
        F.col("name"), F.concat("feature", F.lit("_"))), "left").groupBy("feature").agg(
        (F.max("copies") + F.count("name")).alias("last"))
    free = in_the_way.withColumn("number", F.explode(F.sequence(F.lit(2).cast("long"), "last"))).select(
        "feature", "number", F.concat_ws("_", "feature", F.col("number").cast("string")).alias("name")).join(
        names.select(F.col("feature").alias("name")), "name", "left_anti")
    numbered = free.withColumn("place", F.row_number().over(W.partitionBy("feature").orderBy("number")) + 1)
    return placed.join(numbered.select("feature", "place", "name"), ["feature", "place"], "left").select(
        "dataset", "feature", "have_data", F.coalesce("name", "feature").alias("new_feature_name"))


def features_with_gaps(counts: DataFrame) -> DataFrame:
    """The table behind a missing-values chart: features with gaps, worst first."""
    return counts.filter("na_count > 0").orderBy(F.desc("na_count"), "dataset", "feature")
