"""Train/test split and repeated folds, stratified, reproducible by hashing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mergewell.functions.hashing import seeded_hash
from mergewell.operators.ranking import join_null_safe, rank_in_group
from mergewell.operators.selection import cut_rows, exact_quantiles, is_within


def stratum(df: DataFrame, label: str, kind: str) -> Column:
    """The label itself, or the quartile bin of a numeric label."""
    if kind == "classification":
        return F.col(label).cast("string")
    cuts = exact_quantiles(df, label, [0.25, 0.5, 0.75])
    above = [(F.col(label) > c).cast("int") for c in cuts]
    return reduce(Column.__add__, above, F.lit(0)).cast("string")


def stratified_split(
    df: DataFrame, key: str, label: str, prop: float = 0.7, seed: int = 42,
    kind: str = "classification",
) -> DataFrame:
    """Adds `is_train`: the first floor(prop * n) rows of every stratum in hash order.

    Only the row at the cut is looked for; rows are compared with it where they are."""
    marked = df.withColumns({
        "__stratum": stratum(df, label, kind), "__order": seeded_hash(F.lit(seed), F.col(key))})
    cuts = cut_rows(marked.select("__stratum", key, "__order"), "__stratum", key, ["__order"], prop)
    return is_within(cuts, marked, "__stratum", key, ["__order"]).withColumn(
        "is_train", F.col("within")[0]).drop("__stratum", "__order", "within")


def assign_folds(
    df: DataFrame, key: str, label: str, folds: int = 10, repeats: int = 3, seed: int = 42,
    kind: str = "classification",
) -> DataFrame:
    """Adds `fold_r1` ... `fold_rN` with values 0 ... folds-1, balanced within strata.

    Keys and hashes are ranked and joined back once; rows that repeat a key share its folds."""
    keys = df.select(F.col(key), stratum(df, label, kind).alias("__stratum")).groupBy(key).agg(
        F.min("__stratum").alias("__stratum"))
    for r in range(1, repeats + 1):
        ordered = keys.withColumn("__order", seeded_hash(F.lit(seed), F.lit(r), F.col(key)))
        ranked = rank_in_group(ordered, ["__stratum"], "__order", "__rn", (key,))
        keys = ranked.withColumn(
            f"fold_r{r}", ((F.col("__rn") - 1) % folds).cast("int")).drop("__order", "__rn")
    return join_null_safe(df, keys.drop("__stratum"), [key], "inner")
