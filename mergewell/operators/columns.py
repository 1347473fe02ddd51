"""Choosing, typing and counting columns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mergewell.functions.cells import as_number, is_numeric_text
from mergewell.functions.hashing import seeded_hash

# Aggregates per job: wide tables are scanned once per this many expressions.
EXPRESSIONS_PER_SCAN = 1000
# Spellings of "missing" that may come back from a text round trip (fixed values).
RETYPE_NULLS = ("na", "nan", "NA")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def drop_any(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*names)


def scan(df: DataFrame, measures: dict[str, Column]) -> dict[str, object]:
    """Values of many aggregates; one job per EXPRESSIONS_PER_SCAN of them."""
    names = list(measures)
    values: dict[str, object] = {}
    for start in range(0, len(names), EXPRESSIONS_PER_SCAN):
        part = names[start:start + EXPRESSIONS_PER_SCAN]
        row = df.agg(*[measures[n].alias(f"m{i}") for i, n in enumerate(part)]).first()
        values.update(zip(part, row))
    return values


def count_values(df: DataFrame, columns: Iterable[str] | None = None) -> tuple[int, dict[str, int]]:
    """Number of rows and, per column, of non-null cells, in one pass."""
    columns = list(df.columns if columns is None else columns)
    measures = {"": F.count(F.lit(1)), **{c: F.expr(f"count(`{c}`)") for c in columns}}
    values = scan(df, measures)
    return values.pop(""), values


def drop_all_null(df: DataFrame) -> DataFrame:
    _, filled = count_values(df)
    return df.drop(*[c for c, n in filled.items() if n == 0])


def numeric_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row; per text column whether all its non-null cells are plain numbers."""
    return df.agg(*[
        F.coalesce(F.bool_and(is_numeric_text(F.col(c))), F.lit(False)).alias(c) for c in columns])


def infer_types(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Text columns that hold only numbers become DOUBLE; one pass, no sampling."""
    texts = string_columns(df, exclude)
    if not texts:
        return df
    cleaned = df.withColumns({
        c: F.when(F.col(c).isin(*RETYPE_NULLS), None).otherwise(F.col(c)) for c in texts})
    numeric = scan(cleaned, {c: F.bool_and(is_numeric_text(F.col(c))) for c in texts})
    return cleaned.withColumns({c: as_number(F.col(c)) for c in texts if numeric[c]})


def shuffle(df: DataFrame, seed: int, key: str) -> DataFrame:
    """Reproducible random order of columns and, within the written output, of rows."""
    columns = sorted(df.columns, key=lambda c: hashlib.md5(f"{seed}:{c}".encode()).hexdigest())
    return df.select(*columns).orderBy(seeded_hash(F.lit(seed), F.col(key)))
