"""Reading directories of csv, tsv and txt files."""

from __future__ import annotations

import csv
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from mergewell.functions.cells import NA_TOKENS, null_tokens
from mergewell.functions.naming import clean_names, dataset_name
from mergewell.operators.columns import infer_types

READER_TOKENS = ("", "NA")  # fixed values: all that a table reader takes for missing by default
MALFORMED = "__malformed"
SEPARATORS = {"csv": ",", "tsv": "\t", "txt": "\t"}


@dataclass
class RawDataset:
    """One file: text cells in columns c0, c1 ..., and the header as it was written."""

    name: str
    frame: DataFrame
    header: list[str]
    #: frame with MALFORMED, whether a row of the file has more or fewer cells than the header.
    checked: DataFrame | None = None


def list_datasets(spark: SparkSession, path: str) -> list[str]:
    """All files below a directory, recursively, by name; none is an error."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path").orderBy("path"))
    found = [r["path"] for r in files.collect()]
    if not found:
        raise FileNotFoundError(f"no files below {path}")
    return found


def separator(path: str) -> str:
    """By the extension; the reader unpacks a file that also ends in .gz."""
    extension = os.path.splitext(path.lower().removesuffix(".gz"))[1].lstrip(".")
    if extension not in SEPARATORS:
        raise ValueError(f"{path}: expected one of {', '.join(SEPARATORS)}")
    return SEPARATORS[extension]


def read_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names exactly as written, repeats included."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return next(csv.reader([first["value"].lstrip("﻿")], delimiter=sep))


def read_delimited(
    spark: SparkSession, path: str, sep: str | None = None, tokens=NA_TOKENS,
    multiline: bool = False,
) -> RawDataset:
    """Every cell as text, missing-value spellings as NULL, columns by position.

    Spark would rename repeated header names; a schema by position keeps both columns
    and the header is read apart.  `multiline` allows line breaks inside quotes, at the
    price that a file cannot be split.  Cells beyond the header have no column; rows with them,
    and rows that are too short, are marked in `checked`.
    """
    sep = sep or separator(path)
    header = read_header(spark, path, sep)
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    marked = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])

    def cells(schema, reader):
        return reader.csv(
            path, schema=schema, sep=sep, header=True, escape='"', multiLine=multiline,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="",
            enforceSchema=True)

    texts = [null_tokens(F.col(c), tokens).alias(c) for c in schema.names]
    # A pruned reader does not look at the number of cells.
    checked = cells(marked, spark.read.options(
        columnPruning=False, columnNameOfCorruptRecord=MALFORMED)).select(
        *texts, F.col(MALFORMED).isNotNull().alias(MALFORMED))
    return RawDataset(dataset_name(path), cells(schema, spark.read).select(*texts), header, checked)


def read_all(spark: SparkSession, path: str) -> list[RawDataset]:
    """All files below a directory; one of an unknown kind becomes a dataset without columns,
    which profile() reports as a dataset without key."""
    return [
        read_delimited(spark, p) if known_kind(p) else RawDataset(
            dataset_name(p), spark.createDataFrame([], T.StructType([])), [])
        for p in list_datasets(spark, path)]


def known_kind(path: str) -> bool:
    return os.path.splitext(path.lower().removesuffix(".gz"))[1].lstrip(".") in SEPARATORS


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """One file with clean unique names and inferred types."""
    raw = read_delimited(spark, path, tokens=READER_TOKENS)
    return infer_types(raw.frame.toDF(*clean_names(raw.header)))


def read_clean(spark: SparkSession, path: str, key: str = "subject_id") -> dict[str, DataFrame]:
    """The clean datasets written by sinks.write_profile, by name."""
    root = os.path.join(path, "clean_files")
    names = sorted({os.path.basename(os.path.dirname(p)) for p in list_datasets(spark, root)})
    return {n: spark.read.parquet(os.path.join(root, n)) for n in names}


def load_problems(spark: SparkSession, path: str) -> DataFrame:
    """The problem table of an earlier profile run, incomplete lines removed."""
    return spark.read.parquet(os.path.join(path, "summary_dataset_problems")).na.drop()


def load_ml_table(source: DataFrame | str, spark: SparkSession | None = None) -> DataFrame:
    """Complete rows with clean names, from a table or a csv, tsv, txt or Parquet path."""
    if isinstance(source, str):
        if os.path.splitext(source.rstrip("/").removesuffix(".gz"))[1].lstrip(".") in SEPARATORS:
            df = read_table(spark, source)
        else:
            df = spark.read.parquet(source)
    else:
        df = source
    return df.toDF(*clean_names(df.columns)).na.drop()
