"""Row-wise work in Python on Arrow batches, with the other columns passed through untouched."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_type

from mergewell.jobs import ship

SLICE = 512  # rows that are Python objects at the same time


def with_computed(
    df: DataFrame, inputs: list[str], fields: list[T.StructField], make: Callable[[], Callable],
    together: bool = False,
) -> DataFrame:
    """df plus one column per field.  make() is called once per task and returns a function
    of the input values of one row that returns the new values as a tuple; with together, of
    lists of the values of up to SLICE rows that returns such tuples.

    A column of df that has the name of a new field is replaced by it.
    """
    ship(df.sparkSession)
    df = df.drop(*[c for c in df.columns if c in {f.name for f in fields} - set(inputs)])
    kept = [c for c in df.columns if c not in {f.name for f in fields}]
    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    kinds = [to_arrow_type(f.dataType) for f in fields]
    columns = list(df.columns)

    def work(batches):
        compute = make()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                values = [batch.column(columns.index(c)).to_pylist() for c in inputs]
                made = compute(*values) if together else [compute(*row) for row in zip(*values)]
                new = [pa.array([row[i] for row in made], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(columns.index(c)) for c in kept] + new, names=schema.names)

    return df.mapInArrow(work, schema)
