"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from mergewell.llm.rows import ship


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local session without it gets its own."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="mergewell-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


class Scratch:
    """Written tables: they cut the lineage, survive lost executors and take less room than
    checkpoints.  drop() removes those no longer needed, the rest goes when Python ends."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/mergewell-{uuid.uuid4().hex}"
        atexit.register(self.drop_all)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.scratch_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self.delete(table.scratch_path)

    def delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def drop_all(self) -> None:
        try:
            self.delete(self.folder)
        except Exception:  # the session may be gone already
            pass
