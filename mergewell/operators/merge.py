"""Joining datasets on the subject key."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, functions as F


def find_repeats(datasets: dict[str, DataFrame], key: str) -> list[str]:
    """Names of the datasets in which some key occurs more than once; one job for all."""
    keys = reduce(DataFrame.union, [
        df.select(F.lit(name).alias("dataset"), F.col(key)) for name, df in datasets.items()])
    repeated = keys.groupBy("dataset", key).count().filter("count > 1")
    return sorted(r["dataset"] for r in repeated.select("dataset").distinct().collect())


def missing_keys(datasets: dict[str, DataFrame], key: str) -> list[tuple[str, int]]:
    """Datasets with rows without a key, which a merge leaves out, and how many; one job for all."""
    keys = reduce(DataFrame.union, [
        df.select(F.lit(name).alias("dataset"), F.col(key)) for name, df in datasets.items()])
    missing = keys.filter(F.col(key).isNull()).groupBy("dataset").count()
    return sorted((r["dataset"], r["count"]) for r in missing.collect())


def apart(datasets: list[DataFrame], key: str) -> list[DataFrame]:
    """The datasets with features of one name told apart: the first dataset keeps the name,
    later ones get _2, _3 ..., skipping every name that some dataset has."""
    used = {c for df in datasets for c in df.columns}
    seen: set[str] = set()
    result = []
    for df in datasets:
        renamed = {}
        for c in df.columns:
            if c != key and c in seen:
                number = next(n for n in count(2) if f"{c}_{n}" not in used)
                renamed[c] = f"{c}_{number}"
                used.add(renamed[c])
        seen.update(df.columns)
        result.append(df.withColumnsRenamed(renamed))
    return result


def merge_all(datasets: list[DataFrame], key: str) -> DataFrame:
    """Full outer merge of any number of datasets with unique keys.

    Features that share a name stay two features, see apart().  Stacking and grouping by the
    key needs one shuffle, a chain of full outer joins one or two per dataset.  A stacked row
    holds the features of its own dataset, packed, and nothing for those of others; a group has
    at most one row per dataset.
    """
    datasets = apart(datasets, key)
    packed = [df.filter(F.col(key).isNotNull()).select(key, F.struct(*[c for c in df.columns if c != key]).alias(f"__{i}"))
              if len(df.columns) > 1 else df.filter(F.col(key).isNotNull()).select(key, F.struct(F.lit(1)).alias(f"__{i}"))
              for i, df in enumerate(datasets)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    grouped = stacked.groupBy(key).agg(*[
        F.get(F.collect_list(f"__{i}"), F.lit(0)).alias(f"__{i}") for i in range(len(datasets))])
    return grouped.select(key, *[
        F.col(f"__{i}")[c].alias(c) for i, df in enumerate(datasets) for c in df.columns if c != key])


def merge_bucketed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer merge of two datasets that are stored in the same number of buckets by key: no row
    is shuffled (sinks.write_bucketed)."""
    left, right = apart([left, right], key)
    return left.filter(F.col(key).isNotNull()).join(right.filter(F.col(key).isNotNull()), key, "full_outer")


def reattach(df: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Inner merge that brings back columns kept aside; AQE picks the join strategy."""
    return df.join(side, key, "inner")


def keep_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_semi")


def keep_not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_anti")


def to_long(df: DataFrame, ids: list[str]) -> DataFrame:
    """Wide to long; values become text, missing cells stay as NULL rows."""
    features = [c for c in df.columns if c not in ids]
    texts = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in features])
    return texts.unpivot(ids, features, "feature", "value")


def to_wide(long: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Long to wide, one row per subject; the given feature list saves a job."""
    return long.groupBy(key).pivot("feature", features).agg(F.first("value", ignorenulls=True))
