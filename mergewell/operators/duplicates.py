"""Columns that carry the same name inside one dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mergewell.functions.cells import as_number, clean_text

SAME_DATA_SHARE = 0.2


def copies_to_long(
    df: DataFrame, key: str, copies: dict[str, list[str]], numeric: set[str] = frozenset(),
) -> DataFrame:
    """Non-null cells of all duplicated columns, one row each, in comparable form.

    `copies` maps a shared feature name to the unique names of its columns; features in
    `numeric` compare as numbers with two decimals, all others as cleaned text.
    """
    def cell(feature: str, place: int, name: str):
        text = F.col(name).cast("string")
        number = F.round(as_number(text), 2) if feature in numeric else F.lit(None).cast("double")
        value = number.cast("string") if feature in numeric else clean_text(text)
        return F.struct(
            F.lit(feature).alias("feature"), F.lit(place).alias("position"),
            F.lit(name).alias("copy"), number.alias("number"), value.alias("value"))

    cells = [cell(f, i, n) for f, names in copies.items() for i, n in enumerate(names)]
    return df.select(F.col(key).alias("subject_id"), F.inline(F.array(*cells))).filter(
        F.col("value").isNotNull())


def classify_duplicates(long: DataFrame, share: float = SAME_DATA_SHARE) -> DataFrame:
    """Per feature: cells, cells that agree with another copy, and the verdict.

    'duplicated_data' when more than `share` of the cells occur again for the same
    subject; otherwise the copies share only their name.
    """
    groups = long.groupBy("feature", "subject_id", "value").agg(F.count(F.lit(1)).alias("n"))
    shared = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    return groups.groupBy("feature").agg(
        F.sum("n").alias("cells"), shared.alias("dup_cells"),
    ).withColumn("verdict", F.when(
        F.col("dup_cells") > F.lit(share) * F.col("cells"), "duplicated_data",
    ).otherwise("duplicated_column_names"))


def surviving_copies(long: DataFrame) -> DataFrame:
    """Copies that supply the smallest value of at least one subject (ties: first column)."""
    first = F.min(F.struct("number", "value", "position", "copy"))
    return (
        long.groupBy("feature", "subject_id").agg(first.alias("best"))
        .select("feature", F.col("best.position").alias("position"), F.col("best.copy").alias("copy"))
        .distinct())


def duplicate_evidence(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """The copies of one feature side by side, for a check by eye."""
    some = F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()
    return df.select(F.col(key).alias("subject_id"), *names).filter(some)
