"""Preprocessing learned on the training rows only, as stages of a Spark ML pipeline.

Dummy coding, correlation filter, zero-variance filter and assembly into one vector.
Columns named in `roles` (key, label, split marks) are never predictors.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from mergewell.functions.naming import make_unique
from mergewell.lineage import cut_lineage, written
from mergewell.operators.columns import numeric_columns, string_columns
from mergewell.operators.redundancy import correlated_columns
from mergewell.operators.encoding import (
    COLUMN_LIMIT, category_levels, constant_columns, dummy_encode, level_counts)
from mergewell.operators.levels import (
    as_vector, find_levels, informative, keep_uncorrelated, numbered, sizes_of)


MANY_COLUMNS = 15


class _Roles(Params):
    roles = Param(Params._dummy(), "roles", "columns that are no predictors",
                  TypeConverters.toListString)


class DummyEncoder(Estimator, _Roles, DefaultParamsReadable, DefaultParamsWritable):
    """k levels of a text column to k-1 columns; the first level is the reference.

    Columns with more than COLUMN_LIMIT levels share one sparse vector column.  Its levels pass
    the filters here: those of all rows go, and of correlated ones (|Pearson| above `level`) the
    first stays, or none if a column says the same.  The first of `roles` is the key of the rows.
    """

    level = Param(Params._dummy(), "level", "largest |correlation|", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, roles=None, level=0.95):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> DummyModel:
        roles = self.getOrDefault(self.roles)
        texts = string_columns(df, roles)
        counts = level_counts(df, texts)
        wide = [c for c in texts if counts[c] > COLUMN_LIMIT]
        narrow = category_levels(df, [c for c in texts if c not in wide])
        if not wide:
            return DummyModel(levels=json.dumps(narrow), wide="{}")
        key = roles[0]
        rows = cut_lineage(dummy_encode(df, narrow) if narrow else df)
        levels = informative(find_levels(rows, key, wide, skip_first=True), near_empty=None)
        levels, _ = keep_uncorrelated(
            levels, rows, numeric_columns(rows, roles), self.getOrDefault(self.level))
        entries = numbered(levels)
        names = make_unique([*rows.columns, "levels"])
        return DummyModel(levels=json.dumps(narrow), wide=json.dumps({
            "columns": wide, "sizes": sizes_of(entries), "table": written(entries, "levels"), "out": names[-1]}))


class DummyModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    levels = Param(Params._dummy(), "levels", "levels per column as JSON",
                   TypeConverters.toString)
    wide = Param(Params._dummy(), "wide", "columns of the vector and the path of its levels as JSON",
                 TypeConverters.toString)

    @keyword_only
    def __init__(self, *, levels=None, wide="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        levels, wide = json.loads(self.getOrDefault(self.levels)), json.loads(self.getOrDefault(self.wide))
        df = dummy_encode(df, levels) if levels else df
        if not wide:
            return df
        entries = df.sparkSession.read.parquet(wide["table"])
        return as_vector(df, wide["columns"], entries, wide["sizes"], wide["out"])


class ColumnDropper(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Leaves out the columns found superfluous while fitting."""

    dropped = Param(Params._dummy(), "dropped", "columns to leave out",
                    TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, dropped=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.dropped))


class CorrelationFilter(Estimator, _Roles, DefaultParamsReadable, DefaultParamsWritable):
    """Drops predictors until no pair has |Pearson| above the level."""

    level = Param(Params._dummy(), "level", "largest |correlation|", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, roles=None, level=0.95):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ColumnDropper:
        columns = numeric_columns(df, self.getOrDefault(self.roles))
        if len(columns) < 2:
            return ColumnDropper(dropped=[])
        # With many dummies of one column the optimiser would take longer than the work.
        numbers = df.select(*columns)
        numbers = numbers if len(columns) <= MANY_COLUMNS else cut_lineage(numbers)
        return ColumnDropper(dropped=correlated_columns(numbers, columns, self.getOrDefault(self.level)))


class ZeroVarianceFilter(Estimator, _Roles, DefaultParamsReadable, DefaultParamsWritable):
    """Drops predictors with a single value."""

    @keyword_only
    def __init__(self, *, roles=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ColumnDropper:
        columns = [c for c in df.columns if c not in self.getOrDefault(self.roles)]
        return ColumnDropper(dropped=constant_columns(df, columns) if columns else [])


class PredictorAssembler(Estimator, _Roles, DefaultParamsReadable, DefaultParamsWritable):
    """Collects all remaining predictors in the vector column `features`."""

    @keyword_only
    def __init__(self, *, roles=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> VectorAssembler:
        names = [c for c in df.columns if c not in self.getOrDefault(self.roles)]
        if not names:
            raise ValueError("no predictor is left after preprocessing")
        return VectorAssembler(inputCols=names, outputCol="features")


def build_recipe(roles: list[str], cor_level: float = 0.95) -> Pipeline:
    return Pipeline(stages=[
        DummyEncoder(roles=roles, level=cor_level), CorrelationFilter(roles=roles, level=cor_level),
        ZeroVarianceFilter(roles=roles), PredictorAssembler(roles=roles)])


def predictor_names(recipe) -> list[str]:
    """Names of the vector's entries, of a fitted recipe.  Entries of the vector of levels are
    numbered; Spark's models hold one coefficient for each in any case."""
    wide = json.loads(recipe.stages[0].getOrDefault("wide"))
    names = []
    for c in recipe.stages[-1].getInputCols():
        if wide and c == wide["out"]:
            names += [f"{c}_{i}" for i in range(sum(wide["sizes"].values()))]
        else:
            names.append(c)
    return names
