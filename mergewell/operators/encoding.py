"""Turning categories into numbers and removing columns without information."""

from __future__ import annotations

from pyspark.ml.feature import VectorSizeHint
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mergewell.functions.naming import clean_name, make_unique
from mergewell.operators.columns import scan
from mergewell.operators.keys import subject_index


#: Levels of a text column that may become columns of their own; beyond it they stay sparse
#: (operators/levels.py).
COLUMN_LIMIT = 200


def level_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Exact number of levels of each text column."""
    if not columns:
        return {}
    counted = _levels(df, columns).groupBy("feature").count().collect()  # a line per column
    found = {r["feature"]: r["count"] for r in counted}
    return {c: found.get(c, 0) for c in columns}


def _levels(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).unpivot([], columns, "feature", "level").distinct().filter(
        F.col("level").isNotNull())


def category_levels(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted levels of text columns; one distinct over (column, value) pairs.

    Each level becomes a column of its own later, so columns with more than COLUMN_LIMIT levels
    are refused: operators/levels.py encodes those.
    """
    levels: dict[str, list[str]] = {c: [] for c in columns}
    if columns:
        place = W.partitionBy("feature").orderBy("level")
        few = _levels(df, columns).withColumn("place", F.row_number().over(place)).filter(
            F.col("place") <= COLUMN_LIMIT + 1)
        for row in few.collect():  # COLUMN_LIMIT + 1 lines per column at most
            levels[row["feature"]].append(row["level"])
    wide = [c for c, v in levels.items() if len(v) > COLUMN_LIMIT]
    if wide:
        raise ValueError(f"more than {COLUMN_LIMIT} levels in {', '.join(wide)}")
    return {c: sorted(v) for c, v in levels.items()}


def with_ones(df: DataFrame, places: list[str], size: int, out: str) -> DataFrame:
    """df with the columns of places, which grow from left to right, replaced by one sparse vector
    with a 1 at each of them; a missing place has none.

    The column's metadata hold the vector's size only: Spark's own encoder would name every entry
    there, as many in the driver as there are levels."""
    @F.udf(VectorUDT())
    def ones(found):
        return SparseVector(size, found, [1.0] * len(found))

    made = df.withColumn(out, ones(F.array_compact(F.array(*[F.col(p).cast("int") for p in places])))).drop(*places)
    return VectorSizeHint(inputCol=out, size=size, handleInvalid="optimistic").transform(made)


def sparse_one_hot(df: DataFrame, column: str, out: str) -> DataFrame:
    """One vector per row for a text column with any number of levels: 1 at the place of the
    row's level in sort order; a missing value has no 1.  Places are found by joins, so that
    no list of levels is held anywhere; a vector holds one number whatever its size."""
    places = subject_index(df.filter(F.col(column).isNotNull()), column).select(
        F.col(column).alias("__level"), (F.col("subject_index") - 1).alias("__place")).distinct()
    size = places.agg(F.coalesce(F.max("__place") + 1, F.lit(1))).first()[0]
    indexed = df.join(places, F.col(column) == F.col("__level"), "left").drop("__level")
    return with_ones(indexed, ["__place"], size, out)


def indicator(column: str, level: str) -> Column:
    """1.0 where the level is present, 0.0 elsewhere, NULL where the value is missing."""
    return F.when(F.col(column).isNull(), None).otherwise(
        (F.col(column) == level).cast("double"))


def one_hot(df: DataFrame, columns: list[str], levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Two levels give one 0/1 column (for the second), more give one column per level."""
    levels = levels or category_levels(df, columns)
    wanted = [(c, v) for c in columns for v in (
        levels[c][1:] if len(levels[c]) <= 2 else levels[c])]
    return _with_indicators(df, columns, wanted)


def dummy_encode(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """k levels give k-1 columns; the first level is the reference."""
    wanted = [(c, v) for c in levels for v in levels[c][1:]]
    return _with_indicators(df, list(levels), wanted)


def _with_indicators(df: DataFrame, columns: list[str], wanted: list[tuple[str, str]]) -> DataFrame:
    rest = [c for c in df.columns if c not in columns]
    names = make_unique(rest + [f"{c}_{clean_name(v)}" for c, v in wanted])[len(rest):]
    return df.select(*rest, *[indicator(c, v).alias(n) for (c, v), n in zip(wanted, names)])


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns whose non-null values are all the same; one pass.  Vectors are not looked at."""
    columns = [c for c in columns if not isinstance(df.schema[c].dataType, VectorUDT)]
    same = scan(df, {c: F.min(c).eqNullSafe(F.max(c)) for c in columns})
    return [c for c in columns if same[c]]


def variance_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column whether it is constant and whether at most one row is non-zero."""
    counted = df.agg(*[
        F.struct(F.min(c).eqNullSafe(F.max(c)).alias("constant"),
                 F.count_if(F.col(c) != 0).alias("non_zero")).alias(c) for c in columns])
    return counted.unpivot([], columns, "feature", "m").select(
        "feature", F.col("m.constant").alias("constant"), F.col("m.non_zero").alias("non_zero"),
        (F.col("m.non_zero") <= 1).alias("near_empty"))


def near_empty_columns(df: DataFrame, columns: list[str], rows: int = 1) -> list[str]:
    """Numeric columns that differ from zero in at most `rows` rows."""
    counts = scan(df, {c: F.count_if(F.col(c) != 0) for c in columns})
    return [c for c in columns if counts[c] <= rows]
