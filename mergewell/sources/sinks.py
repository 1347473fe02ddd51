"""Writing results.  `mode` is Spark's save mode; the default refuses to overwrite.

The tables of a report belong together.  They are staged beside their places and moved there only
when all are complete, so a writer that is killed leaves the tables of the last one.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

STAGING = "_staging"  # tables that are being written
COMMIT = "_commit.json"  # names of staged tables that are complete and on their way
MODES = ("errorifexists", "error", "overwrite", "ignore")


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", form: str = "parquet") -> None:
    writer = df.write.mode(mode)
    if form == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(form).save(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A table of the catalog in sorted buckets by key: merges on the key need no shuffle."""
    writer = df.write.bucketBy(buckets, key).sortBy(key)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def append_results(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Add result lines to those of earlier runs."""
    write_table(df.coalesce(1), path, "append", form)


class _Folder:
    """The file system below a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.store = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.store.exists(self._path(name))

    def delete(self, name: str) -> None:
        self.store.delete(self._path(name), True)

    def move(self, source: str, target: str) -> None:
        self.store.mkdirs(self._path(target).getParent())
        if not self.store.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be moved to {target} in {self.root}")

    def write(self, name: str, content: str) -> None:
        """A file that appears with all of its content."""
        part = f"{name}-{uuid.uuid4().hex}"
        out = self.store.create(self._path(part), True)
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()
        self.move(part, name)

    def read(self, name: str) -> str:
        stream = self.store.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def finish_commit(spark: SparkSession, path: str) -> bool:
    """Move the tables of a commit that was interrupted on its way; whether there was one."""
    folder = _Folder(spark, path)
    if not folder.exists(COMMIT):
        return False
    for staged, name in json.loads(folder.read(COMMIT)):
        if folder.exists(staged):  # else it was moved already
            folder.delete(name)
            folder.move(staged, name)
    folder.delete(COMMIT)
    folder.delete(STAGING)
    return True


def write_together(tables: dict[str, tuple[DataFrame, str]], path: str, mode: str = "errorifexists") -> None:
    """Write {name: (table, form)} below path, all or none.

    Tables are staged; the commit is one small file that names them; then they are moved.  A
    writer killed before the commit changes nothing, one killed after it is finished by the next
    writer or by finish_commit().  mode: errorifexists, overwrite, or ignore (tables that are
    there stay).
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode}: choose from {', '.join(MODES)}")
    if not tables:
        return
    spark = next(iter(tables.values()))[0].sparkSession
    finish_commit(spark, path)
    folder = _Folder(spark, path)
    there = [name for name in tables if folder.exists(name)]
    if there and mode in ("errorifexists", "error"):
        raise FileExistsError(f"{', '.join(there)} exist in {path}")
    wanted = {n: t for n, t in tables.items() if mode == "overwrite" or n not in there}
    stage = f"{STAGING}/{uuid.uuid4().hex}"
    for name, (df, form) in wanted.items():
        write_table(df, f"{folder.root}/{stage}/{name}", "errorifexists", form)
    folder.write(COMMIT, json.dumps([(f"{stage}/{name}", name) for name in wanted]))
    finish_commit(spark, path)


def write_profile(report, path: str, mode: str = "errorifexists") -> None:
    """Clean datasets, evidence for duplicated columns, NA counts and the problem table."""
    tables = {os.path.join("clean_files", name): (frame, "parquet") for name, frame in report.clean.items()}
    tables |= {os.path.join(kind, f"{name}_{feature}"): (frame, "csv")
               for (kind, name, feature), frame in report.evidence.items()}
    tables |= {os.path.join("duplicated_rows", name): (frame, "parquet")
               for name, frame in report.duplicate_rows.items()}
    tables |= {"na_counts": (report.na_counts, "parquet"), "summary_dataset_problems": (report.problems, "parquet")}
    if report.losses is not None:
        tables["summary_dataset_losses"] = (report.losses, "parquet")
    write_together(tables, path, mode)


def write_combined(report, path: str, mode: str = "errorifexists") -> None:
    """Merged table with gaps, correlated pairs, feature summary, the complete table and the names
    of its vector's entries."""
    names = ("merged_data_with_nas", "correlated_features", "feature_summary", "ml_table", "levels")
    write_together({n: (getattr(report, n), "parquet") for n in names if getattr(report, n) is not None}, path, mode)
