"""Filters on how much of a column or row is filled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mergewell.operators.columns import count_values


def column_completeness(df: DataFrame, columns: list[str], share: float = 0.5) -> DataFrame:
    """Per column: non-null cells, rows, and whether it reaches the share."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in columns])
    return counted.unpivot(["rows"], columns, "feature", "have_data").select(
        "feature", "have_data", "rows",
        (F.col("have_data") >= F.lit(share) * F.col("rows")).alias("kept"))


def filled_columns(rows: int, filled: dict[str, int], share: float = 0.5) -> list[str]:
    return [c for c, n in filled.items() if n >= share * rows]


def sparse_columns(rows: int, filled: dict[str, int], share: float = 0.45) -> list[str]:
    return [c for c, n in filled.items() if n <= share * rows]


def filled_cells(columns: list[str]) -> Column:
    """Number of non-null cells of a row."""
    ones = [F.col(c).isNotNull().cast("int") for c in columns]
    return reduce(Column.__add__, ones) if len(ones) < 100 else F.aggregate(
        F.array(*ones), F.lit(0), lambda total, one: total + one)


def drop_sparse_rows(df: DataFrame, columns: list[str], share: float = 0.75) -> DataFrame:
    return df.filter(filled_cells(columns) >= share * len(columns))


def na_cutoff(gaps: list[int], preserve_samples: bool = False) -> float:
    """Largest number of gaps a feature may have: the 25 % quantile over the features,
    or its mean with the minimum when samples matter more than features."""
    ordered = sorted(gaps)
    place = 0.25 * (len(ordered) - 1)
    low = int(place)
    high = min(low + 1, len(ordered) - 1)
    quartile = ordered[low] + (place - low) * (ordered[high] - ordered[low])
    return (ordered[0] + quartile) / 2 if preserve_samples else quartile


def complete_table(
    df: DataFrame, key: str, preserve_samples: bool = False,
) -> tuple[DataFrame, list[str], float]:
    """Column filter, row filter, automatic cut-off, complete cases - in this order.

    Returns the complete rows, the columns kept and the cut-off.  Two aggregate passes
    decide on columns; the rows themselves are filtered without a shuffle.
    """
    features = [c for c in df.columns if c != key]
    rows, filled = count_values(df, features)
    kept = filled_columns(rows, filled)
    if not kept:
        return df.select(key), [], 0.0
    dense = drop_sparse_rows(df.select(key, *kept), kept)
    left, filled = count_values(dense, kept)
    gaps = {c: left - n for c, n in filled.items()}
    cutoff = na_cutoff(list(gaps.values()), preserve_samples)
    final = [c for c in kept if gaps[c] <= cutoff]
    return dense.select(key, *final).na.drop(subset=final), final, cutoff
